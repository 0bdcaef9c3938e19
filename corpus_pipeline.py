"""From raw documents to token ids: the stages of a training-data pipeline, each by one of the llm operators.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps; ``run`` writes each stage's result as a
Parquet table in the shared folder and hands the next stage what it reads back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fedlake.llm import byte_bpe, exact_dedup, mixing, ngram_join, quality
from fedlake.session import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on these documents and their labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    scored = quality.score(docs, *quality.train(docs, labels), score_col="_quality_score")
    return scored.where(F.col("_quality_score") >= quality.THRESHOLD).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more of five-word shingles."""
    return ngram_join.deduplicate(docs, k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix of sources takes, as often as it takes them."""
    return mixing.mixed(docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the length and digest of the bytes decoded from them."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    return byte_bpe.decode(coded, ranks, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens", "ids", F.octet_length("decoded").cast("long").alias("n_bytes"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", to_tokens),
]

#: The first stage is a trained network, which SQL cannot express; tests/llm holds a brute-force version of the others.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of what all stages keep of documents."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = materialize(stage(spark, docs, sf_dir), "stage_" + name.split()[0].lower())
    return docs
