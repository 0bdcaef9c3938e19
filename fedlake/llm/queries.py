"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    def deco(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents),
r AS (
  SELECT doc_id, h, count(*) OVER (PARTITION BY h) AS group_size,
         first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
         row_number() OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS k
  FROM d)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, h AS text_sha256 FROM r"""


@query(OP7_SQL)
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts (white space apart) over all of documents, with the row that stays."""
    from .exact_dedup import exact_groups

    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query()
def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each of documents by a mix of its sources to their targets."""
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text of documents by the rank file, and the text decoded from them, as digests."""
    import public_tokenizers as P

    from .byte_bpe import decode, encode

    ranks = P.path("byte_bpe_multi_50k.tiktoken")
    coded = encode(table(spark, sf_dir, "documents"), ranks, P.PATTERN)
    return decode(coded, ranks, P.PATTERN).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query()
def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum, read back from wavelet-matrix shards of all of documents."""
    import public_tokenizers as P

    from .token_shards import read_shards, write_shards

    path = write_shards(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"), added=True)
    return read_shards(spark, path)


@query()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text of documents, by a network that learned labels.quality."""
    from .quality import THRESHOLD, held_out, score, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, *train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@query()
def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of four-word shingles have a Jaccard similarity of 0.85 or more."""
    from .ngram_join import near_groups

    return near_groups(table(spark, sf_dir, "documents"), k=4, percent=85)


@query()
def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page of pages."""
    from .html_text import extract

    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


@query()
def op1_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of every vector whose id is divisible by 20, over all of embeddings."""
    from .multi_index import search

    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


@query()
def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stupid-backoff trigram score of every whole text of documents, by counts over all other documents."""
    from .lm_backoff import score

    return score(table(spark, sf_dir, "documents"))


@query()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text of documents without the bytes that strings of 400 repeated bytes cover."""
    from .suffix_dedup import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
t AS (SELECT r, lang, source, unnest(ts) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (
  SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (gn.n + v.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 1)) // (v.n + v.v) AS q
  FROM gn JOIN v USING (lang) JOIN k USING (lang)
  LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q),
n AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM n WHERE part = 'pair' OR rank <= 200"""


@query(OP11_SQL)
def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Divergence of the term distributions of documents' sources from each other, and the terms that set each off."""
    from .divergence import audit

    return audit(table(spark, sf_dir, "documents"))


@query()
def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of tokens of every whole text of documents, by transducers compiled from the tokenizer."""
    import public_tokenizers as P

    from .token_transducer import token_counts

    return token_counts(table(spark, sf_dir, "documents"), P.path("byte_bpe_50k.json"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(text, '') AS t FROM documents),
l AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
w AS (
  SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
         min(doc_id) OVER (PARTITION BY t) AS first_id
  FROM d),
m AS (
  SELECT source, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         [len(ws) < 50, 100 * len(list_distinct(ws)) < 65 * len(ws),
          100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t),
          regexp_matches(t, '[#$%&*|]'), coalesce(w.doc_id > first_id, false)] AS f
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT source, good, toxic, f, count(*) AS n FROM m GROUP BY ALL),
i AS (SELECT unnest(range(1, 6)) AS i),
o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM i a, i b, i c, i d, i e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT o, i AS step, o[i] AS k, o[1:i - 1] AS earlier FROM o, i),
x AS (
  SELECT source, o, step, k, n, good, toxic, f[k] AS fails,
         len(list_filter(earlier, lambda y: f[y])) > 0 AS gone, len(list_filter(f, lambda y: y)) AS failed
  FROM c, s),
r AS (
  SELECT source, o, step, k,
         sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails AND failed = 1 THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND fails AND good THEN n ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND fails AND toxic THEN n ELSE 0 END) AS toxic_lost
  FROM x GROUP BY ALL)
SELECT source AS part, array_to_string(list_transform(o, lambda y: 'ABCDE'[y]), '') AS filter_order,
       CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY source, k) AS BIGINT) AS shapley
FROM r"""


@query(OP13_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of documents at every step of all 120 orders, by source."""
    from .filter_audit import audit, failures

    return audit(failures(table(spark, sf_dir, "documents")), table(spark, sf_dir, "labels"))
