"""The pipeline's stages against plain versions on the small table."""

import re
from collections import Counter

import corpus_pipeline
from fedlake.llm import mixing, quality

from .test_near_and_repeats import united

SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, SMALL)
        after = docs.collect()
        docs = spark.createDataFrame(after, docs.schema)
        if name != names[-1]:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        if stage is corpus_pipeline.drop_exact_copies:
            norm = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in before]
            best = {}
            for r, n in zip(before, norm):
                best[n] = min(best.get(n, (1, 0)), (-len(r.text or ""), r.doc_id))
            assert sorted(r.doc_id for r in after) == sorted(b[1] for b in best.values())
        elif stage is corpus_pipeline.drop_near_copies:
            component = united([(r.doc_id, r.text) for r in before], 5, 80)
            assert sorted(r.doc_id for r in after) == sorted(i for i, c in component.items() if i == c)
        elif stage is corpus_pipeline.mix_sources:
            taken = mixing.mix(spark.createDataFrame(before)).collect()
            assert Counter(r.doc_id for r in after) == Counter(
                {r.doc_id: r.taken // r.size for r in taken if r.taken})
        elif stage is corpus_pipeline.to_tokens:
            assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)
            sizes = {r.doc_id: len(r.text.encode()) for r in before}
            assert all(r.n_bytes == sizes[r.doc_id] and len(r.ids) == 4 * r.n_tokens for r in after)
        else:
            assert {r.doc_id for r in after} <= {r.doc_id for r in before}
            assert quality.THRESHOLD == 0.7


def test_run(spark):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.count() > 0 and "ids" in got.columns
