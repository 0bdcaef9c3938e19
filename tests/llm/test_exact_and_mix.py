import re
from collections import Counter, defaultdict

import pytest

from fedlake.llm import exact_dedup, mixing

from .fixtures import documents

BLANK = r"[\x20\x09-\x0D]"


def norm(t):
    return re.sub(BLANK, "", t or "")


def test_exact_groups_against_brute_force(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = exact_dedup.exact_groups(docs).collect()
    assert len(got) == len(rows)
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((i, t))
    size = {i: len(g) for g in groups.values() for i, _ in g if i is not None}
    best = {}
    for g in groups.values():
        keep = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0]))[0]
        best.update({i: keep for i, _ in g})
    assert sum(r.kept for r in got) == len(groups)
    for r in got:
        if r.doc_id is not None:
            assert (r.group_size, r.keep_id) == (size[r.doc_id], best[r.doc_id])
    # of rows that agree in everything one stays
    assert sum(r.kept for r in got if r.doc_id == 8) <= 1


def test_exact_dedup_keeps_columns_and_one_row_a_group(spark):
    docs = documents(spark)
    out = exact_dedup.deduplicate(docs)
    assert out.columns == docs.columns
    kept = [norm(r.text) for r in out.collect()]
    assert sorted(kept) == sorted({norm(r.text) for r in docs.collect()})


def test_many_copies_in_many_runs(spark):
    rows = [(i, "same  text" if i % 3 else f"t{i}", "en", "s", 1) for i in range(3000)]
    got = exact_dedup.exact_groups(documents(spark, rows).repartition(40)).collect()
    copies = [r for r in got if r.group_size > 1]
    assert len(copies) == 2000 and {r.keep_id for r in copies} == {1} and sum(r.kept for r in copies) == 1


def targets(sizes):
    total, out, capped = sum(sizes.values()), {}, set()
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        w = sum(weight[s] for s in order if s not in capped)
        out = {s: 3.0 * sizes[s] if s in capped else left * weight[s] / w for s in order}
        over = {s for s in order if out[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return out
        capped |= over


@pytest.mark.parametrize("shape", ["fixture", "uneven"])
def test_mix(spark, shape):
    rows = None
    if shape == "uneven":  # some sources reach three times their size
        rows = [(i, "w " * (i % 40), "en", "abcdefg"[i % 7] if i % 7 < 2 or i < 80 else "g", 1) for i in range(900)]
    docs = documents(spark, rows)
    got = mixing.mix(docs).collect()
    source = {r.doc_id: r.source for r in docs.collect()}
    size = Counter()
    for r in got:
        size[source[r.doc_id]] += r.size
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    want, taken, largest = targets(size), Counter(), Counter()
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == size[s] and r.target == pytest.approx(want[s])
        taken[s] += r.taken
        largest[s] = max(largest[s], 2 * r.size)
    for s in size:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(3)).collect()))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(
        {i: n for i, n in ((i, sum(r.taken // r.size for r in got if r.doc_id == i and r.size)) for i in source) if n})


def test_empty_tables(spark):
    none = documents(spark, []).limit(0)
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.deduplicate(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert mixing.mixed(none).count() == 0
