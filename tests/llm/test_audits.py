import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from fedlake.llm import divergence, filter_audit, token_transducer

from .fixtures import documents, words

BPE = P.path("byte_bpe_50k.json")


def test_filter_audit_against_brute_force(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(i, int(i % 3 > 0), int(i % 7 == 0), "?") for i in range(60)] + [(3, None, 1, "?"), (3, 1, None, "?"), (None, 1, 1, "?")],
        "doc_id long, quality int, toxic int, part string")
    rows = docs.collect()
    first = defaultdict(lambda: 1 << 60)
    for r in rows:
        if r.doc_id is not None:
            first[r.text or ""] = min(first[r.text or ""], r.doc_id)
    good = {r.doc_id for r in labels.collect() if r.quality == 1} - {None}
    toxic = {r.doc_id for r in labels.collect() if r.toxic == 1} - {None}
    want = defaultdict(lambda: [0] * 6)
    for r in rows:
        t = r.text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": r.doc_id is not None and first[t] < r.doc_id}
        for order in permutations("ABCDE"):
            gone = False
            for step, f in enumerate(order, 1):
                c = want[r.source or "", "".join(order), step]
                removed = fails[f] and not gone
                c[0] += not gone and not fails[f]
                c[1] += removed
                c[2] += gone and fails[f]
                c[3] += fails[f] and sum(fails.values()) == 1
                c[4] += removed and r.doc_id in good
                c[5] += removed and r.doc_id in toxic
                gone = gone or fails[f]
    shapley = Counter()
    for (part, order, step), c in want.items():
        shapley[part, order[step - 1]] += c[1]
    got = filter_audit.audit(filter_audit.failures(docs), labels).collect()
    assert len(got) == len(want) == 600 * len({r.source or "" for r in rows})
    for r in got:
        c = want[r.part, r.filter_order, r.step]
        assert (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost) == tuple(c)
        assert r.shapley == shapley[r.part, r.filter_order[r.step - 1]]


def test_filter_audit_counts_beyond_a_field(spark):
    counts = np.arange(filter_audit.FIELDS, dtype=np.uint64) % 200
    total = 0
    for times in (1, 2, 300, 70_000, 5_000_000_000):
        total += times
        width, fields = filter_audit.narrowed(filter_audit.as_integer(counts) * total)
        assert len(fields) == width * filter_audit.FIELDS
        assert (filter_audit.as_counts(filter_audit.widened(width, fields)) == counts * np.uint64(total)).all()
    assert width == 8


def test_filter_audit_many_parts_copies_and_no_rows(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    none = documents(spark, [])
    assert filter_audit.audit(filter_audit.failures(none), labels).count() == 0
    rows = [(i % 1500, "copy", "en", f"s{i % 20}", 4) for i in range(3000)]
    got = filter_audit.audit(filter_audit.failures(documents(spark, rows).repartition(30)), labels, held_parts=3)
    got = got.where("filter_order = 'EABCD' and step = 1").collect()
    assert len(got) == 20 and sum(r.removed for r in got) == 2998 and sum(r.kept for r in got) == 2
    assert sum(r.removed + r.kept for r in got if r.part == "s1") == 150


def library_counts(texts):
    from tokenizers import Tokenizer

    return [len(e.ids) for e in Tokenizer.from_file(BPE).encode_batch(texts, add_special_tokens=False)]


def test_token_counts_against_the_library(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), n)
                   for r, n in zip(rows, library_counts([r.text or "" for r in rows])))
    got = token_transducer.token_counts(docs, BPE).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got) and {r.over_limit for r in got} == {True, False}
    text_ids = docs.selectExpr("cast(doc_id as string) doc_id", "text")
    assert token_transducer.token_counts(text_ids, BPE).schema["doc_id"].dataType.simpleString() == "string"
    assert token_transducer.token_counts(documents(spark, []), BPE).count() == 0


@pytest.mark.parametrize("chunk, run", [(1, 1 << 20), (5, 64), (128, 1 << 20)])
def test_transducer_on_awkward_texts(monkeypatch, chunk, run):
    monkeypatch.setattr(token_transducer, "CHUNK", chunk)
    monkeypatch.setattr(token_transducer, "RUN_CHARS", run)
    made = token_transducer.Transducer(BPE, token_transducer.compile_classes(BPE))
    rng = random.Random(3)
    parts = ["'s", "'re", "'r", "'v", "'ve", "'l", "'ll", "'t", "'", "''", " ", "  ", "\n", "\t", "a", "re", "12", "!", "é", "漢", "😀",
             "<|endoftext|>", "e", "s", "l", " ", "՘", "\x00", "\x1c", "́"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 700, "!" * 200, " " * 500, "ab" * 300, "'" * 99, "", "x " * 400, "0" * 333]
    assert made.counts(texts) == library_counts(texts)


def test_transducer_forgets_and_makes_again(monkeypatch):
    monkeypatch.setattr(token_transducer, "HELD_STATES", 50)
    monkeypatch.setattr(token_transducer, "HELD_PAIRS", 20)
    monkeypatch.setattr(token_transducer, "REMEMBERED", 5)
    monkeypatch.setattr(token_transducer, "RUN_CHARS", 100)
    rng = random.Random(4)
    texts = [words(rng, 30) + " unforgettable" for _ in range(60)]
    made = token_transducer.Transducer(BPE, token_transducer.compile_classes(BPE))
    assert made.counts(texts) == library_counts(texts)


def test_classes_are_the_librarys():
    """Every code point of the first planes between a letter, a number and a sign splits as its class says."""
    import zlib

    from tokenizers import Tokenizer

    made = np.frombuffer(zlib.decompress(token_transducer.compile_classes(BPE)), np.uint8)
    split = Tokenizer.from_file(BPE).pre_tokenizer.pre_tokenize_str
    kind = {token_transducer.LETTER: "a", token_transducer.NUMBER: "1", token_transducer.SIGN: "!"}
    simple = made.copy()
    simple[made < token_transducer.LETTER] = token_transducer.LETTER
    points = [c for c in range(0x3000) if made[c] not in (token_transducer.QUOTE, token_transducer.SPACE)]
    for k, before in kind.items():
        starts = {a for _, (a, _) in split("".join([f"\n{before}{chr(c)}" for c in points]))}
        assert [3 * i + 2 not in starts for i in range(len(points))] == [simple[c] == k for c in points]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        token_transducer.compile_classes(P.path("word_bpe_49k.json"))


def brute_audit(rows, min_docs=3, top=200):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, in_docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r.lang or "", r.source or ""
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r.text or "").translate(lower))
        groups[lang].add(source)
        counts[lang, source].update(found)
        in_docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        n = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: 1 + 10**9 * (counts[lang, s][t] + 1) // (n[s] + len(kept)) for t in kept} for s in sources}
        q = {t: 1 + 10**9 * (sum(counts[lang, s][t] for s in sources) + 1) // (sum(n.values()) + len(kept)) for t in kept}
        f = lambda a, b: (a - b) * (a - b) // b
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            first = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", first)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))
                out |= {(lang, s, part, t, v, i) for i, (v, t) in enumerate(ranked, 1) if part == "pair" or i <= top}
    return out


def audited(docs, **params):
    got = divergence.audit(docs, **params).collect()
    out = {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got}
    assert len(out) == len(got)
    return out


def test_divergence_against_brute_force(spark, monkeypatch):
    long = ["x" * n for n in (4, 5, 8, 9, 16, 17, 32, 33, 256, 257, 300, 5000)] + ["é" * 9, "漢字" * 60, "ZÉBRE", "zÉbre"]
    rng = random.Random(9)
    rows = [(i, words(rng, 40, 60) + " Alpha BETA gamma " + rng.choice(long) + "1" + rng.choice(long) + "\x00" + rng.choice(long),
             rng.choice(["en", "en", "de", None]), rng.choice(["a", "a", "b", "c", "é", None]), 1) for i in range(150)]
    rows += [(900, "", "it", "a", 0), (901, None, "it", "b", None), (902, "12 !", "fr", "only", 1), (903, "a a a", "el", "x", 1),
             *[(904 + i, "solo Solo tanto", "pt", "x", 1) for i in range(4)], rows[0], rows[0]]
    docs = documents(spark, rows)
    want = brute_audit(docs.collect())
    assert audited(docs) == want
    small = {"min_docs": 2, "top": 5, "run_bytes": 500, "block_counts": 10, "cells": 20}
    assert audited(docs, **small) == brute_audit(docs.collect(), 2, 5)
    assert divergence.audit(documents(spark, [])).count() == 0
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 150, "source": ["a"] * 150, "text": [r[1] for r in rows[:150]]})
    whole = Counter()
    for out_rows, out_bytes in ((1 << 17, 8 << 20), (7, 300)):
        monkeypatch.setattr(divergence, "OUT_ROWS", out_rows)
        monkeypatch.setattr(divergence, "OUT_BYTES", out_bytes)
        got = Counter()
        for b in divergence.count_terms([batch], 1 << 30):
            got.update({r["term"]: r["n"] * 1000 + r["docs"] for r in b.to_pylist()})
        whole = whole or got
        assert got == whole and len(got) > 15


def test_divergence_of_the_shared_fixture(spark):
    docs = documents(spark)
    assert audited(docs) == brute_audit(docs.collect())


def test_exact_division_and_radix():
    counts = np.array([0, 1, 999, 10**12, 9 * 10**14], np.int64)
    for total in (1, 7, 10**9 + 7, 9 * 10**15):
        small = counts[counts < total]
        assert divergence.parts_of(small, total).tolist() == [1 + 10**9 * (c + 1) // total for c in small.tolist()]
    with pytest.raises(ValueError):
        divergence.parts_of(counts, 10**16)
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 5, 1000).astype(np.uint64) << np.uint64(40), rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    assert (divergence.radix_order([a, b]) == np.lexsort((b, a))).all()
