import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from fedlake.llm import ngram_join, packed_counts, suffix_dedup
from fedlake.llm.components import components

from .fixtures import documents, texts


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()


def united(rows, k, percent):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = defaultdict(list)
    for i, t in rows:
        if i is not None:
            parent.setdefault(i, i)
            sets[i].append(shingles(t, k))
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if any(s and t and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_near_groups_against_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(packed_counts, "BLOCK_BYTES", 30_000)
    monkeypatch.setattr(packed_counts, "BUCKET_KEYS", 5_000)
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = united(rows, k, percent)
    got = ngram_join.near_groups(docs, k, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.component_id == want.get(r.doc_id)
    assert Counter(r.n_shingles for r in got) == Counter(len(shingles(t, k)) for _, t in rows)
    out = ngram_join.deduplicate(docs, k, percent)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(
        [i for i, c in want.items() if i == c] + [i for i, _ in rows if i is None])


def test_ids_with_several_texts(spark):
    """Near copies of each text of such an id, and of other texts, are linked; a repeated id of one set stays as it was."""
    def text(name, changed=None):
        return " ".join("changed" if j == changed else f"{name}{j}" for j in range(120))

    rows = [(5, text("a")), (5, text("b")), (5, text("c")), (9, text("b", 50)), (8, text("a", 50)), (7, text("c", 50)),
            (3, text("d")), (4, text("d")), (4, text("e")), (6, text("e", 50)), (10, text("f")), (10, text("F")), (11, text("f", 50)),
            (-4, text("g")), (12, text("g")), (12, text("h")), (13, text("h", 60)), (14, text("h")), (5, None), (20, "z"), (None, text("a"))]
    want = united(rows, 4, 85)
    assert [want[i] for i in (9, 8, 7, 6, 11, 13)] == [5, 5, 5, 3, 10, -4]
    for order in (rows, rows[::-1]):
        got = ngram_join.near_groups(documents(spark, [(i, t, "en", "s", 1) for i, t in order]), 4, 85).collect()
        assert len(got) == len(rows)
        assert {(r.doc_id, r.component_id) for r in got} == {*want.items(), (None, None)}


def test_chain_of_near_copies_in_one_large_bucket(spark, monkeypatch):
    """Each text is near the next only; blocks are small, so the bucket is searched in several."""
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", 2_000)
    monkeypatch.setattr(ngram_join, "spread_parts", lambda n: (n / 10).cast("int") + 1)
    base = [f"v{i}" for i in range(140)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in range(i):
            w[(j * 7) % 140] = f"n{j}"
        rows.append((100 + i, " ".join(w), "en", "s", 1))
    rows += [(i, " ".join(base[:60] + [f"u{i}x{j}" for j in range(200)]), "en", "s", 1) for i in range(20)]
    want = united([(r[0], r[1]) for r in rows], 4, 85)
    got = ngram_join.near_groups(documents(spark, rows), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert len(set(want.values())) < 70


def test_divide_skip_against_counting():
    rng = np.random.default_rng(3)
    for percent in (50, 80, 85):
        sets = []
        for _ in range(120):
            s = set(rng.integers(0, 200, rng.integers(1, 60)).tolist()) if rng.random() < 0.5 or not sets else set(
                sets[rng.integers(len(sets))].tolist())
            if rng.random() < 0.7 and len(s) > 3:
                s = set(list(s)[: -rng.integers(1, 3)]) | set(rng.integers(0, 200, 2).tolist())
            sets.append(np.array(sorted(s), np.uint64))
        index = ngram_join.Index(sets, percent)
        for q in sets:
            want = {i for i, s in enumerate(sets) if 100 * len(set(q) & set(s)) >= percent * len(set(q) | set(s))}
            got = index.search(q)
            assert set(got) == want and len(got) == len(want)


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2)) if a != b]
    links += [(i, i + 1) for i in range(1000, 1040)] + [(5000, i) for i in range(4000, 4050)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    parent = {x: x for e in links for x in e}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}


def removed(rows, length):
    seen = Counter(t[j:j + length] for t in rows for j in range(len(t) - length + 1))
    out = []
    for t in rows:
        mask = np.zeros(len(t) + 1, int)
        for j in range(len(t) - length + 1):
            if seen[t[j:j + length]] > 1:
                mask[j] += 1
                mask[j + length] -= 1
        mask = np.cumsum(mask)[:-1] > 0
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(t, np.uint8)[~mask])
        out.append((len(t), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("length,chunk", [(400, 1 << 20), (150, 1 << 9)])
def test_repeats_against_brute_force(spark, monkeypatch, length, chunk):
    monkeypatch.setattr(suffix_dedup, "SORTED", 2_000)
    if chunk < 1 << 20:
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    docs = documents(spark)
    rows = [(r.text or "").encode() for r in docs.collect()]
    got = suffix_dedup.remove_repeats(docs, length).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == removed(rows, length)
    for r in got:
        assert r.n_removed == sum(s.stop - s.start for s in r.spans)


def test_a_frequent_text_cut_at_many_places(spark):
    base = texts()[-1][:4000]
    rows = [(i, base[i:3000 + 3 * i] + f" end{i}", "en", "s", 1) for i in range(150)]
    docs = documents(spark, rows)
    got = suffix_dedup.remove_repeats(docs).collect()
    assert Counter((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got) == removed(
        [r[1].encode() for r in rows], 400)


def thue_morse(n):
    return np.array([i.bit_count() & 1 for i in range(n)], np.uint8) + 97


def test_contexts_that_collide_in_the_polynomial_hash(spark):
    one, other = thue_morse(4096), 195 - thue_morse(4096)
    p = suffix_dedup.Prefixes(np.concatenate([one, other]))
    assert p.of(np.array([0]), 4096) == p.of(np.array([4096]), 4096)
    none_frequent = np.zeros(1 << suffix_dedup.CELLS_LOG, bool)
    digests = [np.concatenate(suffix_dedup.contexts(x, none_frequent, 4096), axis=1)[1:3, 0].tolist() for x in (one, other)]
    assert digests[0] != digests[1]
    rows = [one.tobytes().decode(), other.tobytes().decode(), one.tobytes().decode()[:4000]]
    got = suffix_dedup.remove_repeats(documents(spark, [(i, t, "en", "s", 1) for i, t in enumerate(rows)]), 4096).collect()
    assert [r.n_removed for r in got] == [0, 0, 0]
    rows.append("x" + rows[0])
    got = suffix_dedup.remove_repeats(documents(spark, [(i, t, "en", "s", 1) for i, t in enumerate(rows)]), 4096).collect()
    assert {r.doc_id: r.n_removed for r in got} == {0: 4096, 1: 0, 2: 0, 3: 4096}


def test_different_rows_of_one_uid(spark):
    rows = [(1, 7, 100, b"a"), (2, 7, 200, b"bb"), (2, 7, 200, b"bb"), (3, 8, 300, b"c"), (4, 9, 400, b"d"), (4, 9, 400, b"d")]
    apart, twice, several = suffix_dedup.told_apart(spark.createDataFrame(rows, "id long, uid long, apart long, data binary"))
    got = apart.collect()
    assert len(got) == 6 and len({r.uid for r in got}) == 4 and len({(r.uid, r.id) for r in got}) == 4
    of = {r.id: r.uid for r in got}
    assert several == 2 and {(r.uid, r["size"]) for r in twice.collect()} == {(of[2], 2), (of[4], 1)}


def test_sorted_suffixes():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    data[1500:1900] = data[200:600]
    p = suffix_dedup.Prefixes(data)
    starts = rng.permutation(2900)[:700]
    segment = np.sort(rng.integers(0, 4, 700))
    got = suffix_dedup.sort_suffixes(data, p, starts, segment, 100)
    raw = data.tobytes()
    for s in range(4):
        mine = [raw[i:i + 100] for i in got[segment == s]]
        assert mine == sorted(raw[i:i + 100] for i in starts[segment == s])
    e = suffix_dedup.common_extension(p, np.array([200, 201]), np.array([1500, 1500]), 100)
    assert e[0] == 100 and raw[201:201 + e[1]] == raw[1500:1500 + e[1]]


def test_empty_tables(spark):
    none = documents(spark, []).limit(0)
    assert ngram_join.near_groups(none).count() == 0
    assert ngram_join.deduplicate(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
