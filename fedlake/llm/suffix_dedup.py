"""Suffix-array dedup: remove every byte covered by a string of ``length`` bytes that also starts anywhere else.

1. Anchors. Every window of ``length`` bytes has one anchor: of the GRAM-byte strings in it the first in one global order, the
   leftmost of equal ones. Equal windows have equal anchors at the same place, so only windows of equal anchors need be
   compared. Strings that are frequent (by a counting sketch of fixed size over all bytes) are last in that order, so
   only windows made of nothing but frequent strings have a frequent anchor.
2. Contexts. Neighbouring windows of one anchor form a context, the bytes they cover. Contexts are first counted by a
   128-bit digest of their bytes (no polynomial hash, which texts can be built to collide in):
   all windows of a context that occurs twice are repeated, wherever its copies are, and one of each different
   context goes on. (A frequent anchor has few different contexts: all of one frequent text, cut at different places.)
3. Suffix sort. The different contexts of an anchor come together. Their suffixes, one per window, are sorted by
   mergesort; two suffixes are compared through the length of their common extension, which a binary search finds with
   prefix polynomial hashes. Windows that are neighbours in the order with a common extension of ``length`` bytes are equal;
   those that bound a removed run are compared byte by byte before they count.
4. The runs of each document are joined with its text.

All windows that a context has in common with others contain its anchor, so their union is one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fedlake.session import materialize

LENGTH = 400
GRAM = 64
CELLS_LOG = 18
CELL_BLOCK = 1 << 12
#: Window starts handled at once; longer texts are cut, which only cuts contexts.
CHUNK = 1 << 20
#: Suffixes sorted at once, about.
SORTED = 1 << 18
RUN_BYTES = 4 << 20

_rng = np.random.default_rng(20240229)
_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POWERS = [np.ones(1, np.uint64)]


def powers(n: int) -> np.ndarray:
    """Powers 0 .. n of the base, modulo 2^64."""
    if len(_POWERS[0]) <= n:
        _POWERS[0] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(2 * n + 1024, _BASE, np.uint64)]))
    return _POWERS[0]


class Prefixes:
    """Prefix polynomial hashes of a byte string: the hash of any part in constant time."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.n, self.pw = n, powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[data] * self.pw[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, size) -> np.ndarray:
        """Hashes of the parts of ``size`` bytes from ``start``, comparable within and between strings of one ``n``."""
        return (self.sums[start + size] - self.sums[start]) * self.pw[self.n - start]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def _part_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all parts of ``size`` bytes, the same wherever they stand."""
    n, pw = len(data), powers(len(data))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[data] * pw[n:0:-1], out=sums[1:])
    # times the inverse of the base to the power that is left: a part's hash does not depend on its place
    start = np.arange(n - size + 1)
    return _mix((sums[start + size] - sums[start]) * _inverse_powers(n)[n - size - start])


_INVERSE = [np.ones(1, np.uint64)]


def _inverse_powers(n: int) -> np.ndarray:
    if len(_INVERSE[0]) <= n:
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        _INVERSE[0] = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(2 * n + 1024, inverse, np.uint64)]))
    return _INVERSE[0]


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from minima of blocks forwards and backwards."""
    n = len(x)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    square = padded.reshape(blocks, width)
    forward = np.minimum.accumulate(square, axis=1).ravel()
    backward = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n - width + 1], forward[width - 1:n])


def contexts(data: np.ndarray, frequent: np.ndarray, length: int) -> list[np.ndarray]:
    """Contexts of a text: arrays of (anchor hash, context digest in two words, first window, last window, place of the anchor).

    The digest covers the bytes and the anchor's place in them, so that equal digests mean equal windows at equal places.
    """
    out = []
    raw = memoryview(data)
    place_bits = np.uint64(22)
    for begin in range(0, len(data) - length + 1, CHUNK):
        part = data[begin:begin + CHUNK + length - 1]
        grams = _part_hashes(part, GRAM)
        late = frequent[(grams >> np.uint64(64 - CELLS_LOG)).astype(np.int64)]
        key = (grams >> np.uint64(1) | late.astype(np.uint64) << np.uint64(63)) >> place_bits << place_bits
        first = _sliding_min(key | np.arange(len(key), dtype=np.uint64), length - GRAM + 1)
        anchor = (first & np.uint64((1 << 22) - 1)).astype(np.int64)
        lo = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        hi = np.append(lo[1:], len(anchor)) - 1
        at = anchor[lo]
        spans = zip((lo + begin).tolist(), (hi + begin + length).tolist(), (at - lo).tolist())
        digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(raw[i:j], seed) for i, j, seed in spans), "<i8").reshape(-1, 2)
        out.append(np.stack([grams[at].view(np.int64), *digests.T, lo + begin, hi + begin, at + begin]))
    return out


def common_extension(p: Prefixes, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Length of the common extension of the suffixes at a and b, at most ``most``: binary search over hash comparisons."""
    out = np.full(len(a), most, np.int64)
    open_ = np.flatnonzero(p.of(a, most) != p.of(b, most))
    a, b = a[open_], b[open_]
    lo, hi = np.zeros(len(a), np.int64), np.full(len(a), most - 1, np.int64)
    for _ in range(int(most).bit_length()):
        mid = (lo + hi + 1) >> 1
        same = p.of(a, mid) == p.of(b, mid)
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    out[open_] = lo
    return out


def _before(data: np.ndarray, p: Prefixes, a: np.ndarray, b: np.ndarray, most: int, or_equal: np.ndarray) -> np.ndarray:
    """Whether the suffix at a comes before that at b, or equals it where ``or_equal``."""
    e = common_extension(p, a, b, most)
    equal = e >= most
    e = np.minimum(e, most - 1)
    return np.where(equal, or_equal, data[a + e] < data[b + e])


def sort_suffixes(data: np.ndarray, p: Prefixes, starts: np.ndarray, segment: np.ndarray, most: int) -> np.ndarray:
    """``starts`` sorted within segments of equal ``segment`` (ascending), by their first ``most`` bytes.

    Bottom-up mergesort of all segments at once. In a pass every element finds its place in the
    neighbouring run by binary search, with comparisons by ``common_extension``.
    """
    order = starts.copy()
    n = len(order)
    first = np.concatenate([[True], segment[1:] != segment[:-1]])
    seg_start = np.flatnonzero(first)[np.cumsum(first) - 1]
    sizes = np.diff(np.append(np.flatnonzero(first), n))
    seg_end = seg_start + sizes[np.cumsum(first) - 1]
    width, longest = 1, int(sizes.max(initial=0))
    index = np.arange(n)
    while width < longest:
        inner = index - seg_start
        run = inner // width
        own = seg_start + run * width
        right = run % 2 == 1
        other = np.where(right, own - width, own + width)
        other_end = np.minimum(np.where(right, own, other + width), seg_end)
        lo, hi = np.minimum(other, other_end), other_end.copy()
        base = lo.copy()
        active = np.flatnonzero(lo < hi)
        while len(active):
            mid = (lo[active] + hi[active]) >> 1
            # an element of the left run goes before equal ones of the right run
            less = _before(data, p, order[mid], order[active], most, right[active])
            lo[active] = np.where(less, mid + 1, lo[active])
            hi[active] = np.where(less, hi[active], mid)
            active = active[lo[active] < hi[active]]
        start = np.where(right, own - width, own)
        # unpaired runs stay where they are
        paired = np.where(right, True, other < seg_end)
        to = np.where(paired, start + (index - own) + (lo - base), index)
        merged = np.empty_like(order)
        merged[to] = order
        order = merged
        width *= 2
    return order


def repeated_runs(group: np.ndarray, texts: list[bytes], offsets: np.ndarray, length: int) -> list[tuple[int, int] | None]:
    """For each context (of anchor group ``group``, anchor at ``offsets``) the run of bytes covered by windows that
    another context of its group has as well; None if there is none."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    p = Prefixes(data)
    sizes = np.array([len(t) for t in texts])
    begin = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    context = np.repeat(np.arange(len(texts)), windows)
    inner = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    # windows can be equal only if the anchor stands at the same place in them
    shift = inner - offsets[context]
    order = np.lexsort((shift, group[context]))
    g, s = group[context][order], shift[order]
    segment = np.cumsum(np.concatenate([[True], (g[1:] != g[:-1]) | (s[1:] != s[:-1])]))
    starts = (begin[context] + inner)[order]
    # a segment of one suffix has nothing to compare
    several = np.bincount(segment)[segment] > 1
    starts, segment = starts[several], segment[several]
    ranked = sort_suffixes(data, p, starts, segment, length)
    pair = np.flatnonzero((segment[1:] == segment[:-1]))
    a, b = ranked[pair], ranked[pair + 1]
    same = common_extension(p, a, b, length) >= length
    a, b = a[same], b[same]
    equal = np.concatenate([a, b])
    partner = np.concatenate([b, a])
    at = np.lexsort((partner, equal))
    equal, partner = equal[at], partner[at]
    owner = np.searchsorted(begin, equal, side="right") - 1
    out: list[tuple[int, int] | None] = [None] * len(texts)
    raw = data.tobytes()
    cuts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else np.zeros(0, int)
    for lo, hi in zip(cuts.tolist(), np.append(cuts[1:], len(owner)).tolist()):
        # the outermost windows decide: their bytes are compared
        check = lambda i: raw[equal[i]:equal[i] + length] == raw[partner[i]:partner[i] + length]
        while lo < hi and not check(lo):
            lo += 1
        while lo < hi and not check(hi - 1):
            hi -= 1
        if lo < hi:
            c = owner[lo]
            out[c] = int(equal[lo] - begin[c]), int(equal[hi - 1] - begin[c] + length)
    return out


def _runs_of_bytes(column) -> Iterator[tuple[int, list[bytes]]]:
    held, size, start = [], 0, 0
    for i, t in enumerate(column):
        held.append(t.as_py())
        size += len(held[-1])
        if size >= RUN_BYTES:
            yield start, held
            held, size, start = [], 0, i + 1
    if held:
        yield start, held


def frequent_cells(rows: DataFrame) -> np.ndarray:
    """Which of 2^CELLS_LOG hash cells hold frequent GRAM-byte strings, by counts over all bytes."""
    def count(batches):
        cells = np.zeros(1 << CELLS_LOG, np.int64)
        for batch in batches:
            for _, texts in _runs_of_bytes(batch.column(1)):
                hashes = [np.zeros(0, np.int32)]
                for t in texts:
                    data = np.frombuffer(t, np.uint8)
                    for begin in range(0, max(0, len(data) - GRAM + 1), CHUNK):
                        h = _part_hashes(data[begin:begin + CHUNK + GRAM - 1], GRAM)
                        hashes.append((h >> np.uint64(64 - CELLS_LOG)).astype(np.int32))
                cells += np.bincount(np.concatenate(hashes), minlength=len(cells))
        blocks = cells.astype("<i8").reshape(-1, CELL_BLOCK)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(blocks)), pa.int32()),
                                          pa.array([b.tobytes() for b in blocks], pa.binary())], names=["block", "counts"])

    def add(key: tuple[Any, ...], parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(CELL_BLOCK, np.int64)
        for part in parts:
            for c in part["counts"]:
                total += np.frombuffer(c, "<i8")
        yield pd.DataFrame({"block": [key[0]], "counts": [total.tobytes()]})

    summed = rows.select("uid", "data").mapInArrow(count, "block int, counts binary").groupBy("block").applyInPandas(
        add, "block int, counts binary")
    cells = np.zeros((1 << CELLS_LOG) // CELL_BLOCK * CELL_BLOCK, np.int64).reshape(-1, CELL_BLOCK)
    for r in summed.collect():  # 2^CELLS_LOG counts
        cells[r["block"]] = np.frombuffer(r["counts"], "<i8")
    cells = cells.ravel()
    mean = cells.mean()
    return cells > mean + 8 * mean ** 0.5 + 8


def repeated_spans(rows: DataFrame, length: int = LENGTH) -> DataFrame:
    """(uid, start, stop): runs of bytes of (uid, data) covered by repeated windows; runs of a row may touch or overlap."""
    spark = rows.sparkSession
    long = rows.where(F.octet_length("data") >= length).select("uid", "data")
    frequent = spark.sparkContext.broadcast(frequent_cells(long))

    def find(batches):
        for batch in batches:
            for start, texts in _runs_of_bytes(batch.column(1)):
                made, uids = [], []
                for i, t in enumerate(texts):
                    for c in contexts(np.frombuffer(t, np.uint8), frequent.value, length):
                        made.append(c)
                        uids.append(np.full(c.shape[1], batch.column(0)[start + i].as_py(), np.int64))
                if made:
                    c = np.concatenate(made, axis=1)
                    # first window; number of further windows and the anchor's place after the first, both below length
                    span = (c[4] - c[3]) << 16 | (c[5] - c[3])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(uids)), *map(pa.array, c[:4]), pa.array(span.astype(np.int32), pa.int32())],
                        names=["uid", "anchor", "context", "context2", "lo", "span"])

    found = long.mapInArrow(find, "uid long, anchor long, context long, context2 long, lo long, span int")
    found, _ = materialize(found, "window_contexts")
    place = F.struct("uid", "lo", "span")
    key = ["anchor", "context", "context2"]
    different = found.groupBy(*key).agg(F.min(place).alias("one"), F.max(place).alias("last"))
    different = different.select(*key, "one", (F.col("one") != F.col("last")).alias("often"))
    # anchors that more than one place has
    of_anchor = different.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("contexts"), F.count_if("often").alias("repeated"))
    different, _ = materialize(different, "different_contexts")
    of_anchor, _ = materialize(of_anchor.where("contexts > 1 or repeated > 0"), "shared_anchors")

    whole = found.join(different.where("often").select(*key), key).select(
        "uid", F.col("lo").alias("start"), (F.col("lo") + F.shiftright("span", 16) + length).alias("stop"))
    compared = different.join(of_anchor.where("contexts > repeated and contexts > 1").select("anchor"), "anchor")
    wanted = compared.select("one.uid", "one.lo", "one.span", "anchor", "often").groupBy("uid").agg(
        F.collect_list(F.struct("anchor", "lo", "span", "often")).alias("wanted"))  # bounded by the text's length
    wanted, n = materialize(wanted, "wanted_contexts")
    if not n:
        return whole

    def cut(batches):
        for batch in batches:
            for uid, data, contexts_ in zip(*(batch.column(i) for i in range(3))):
                uid, data = uid.as_py(), data.as_py()
                w = contexts_.values if hasattr(contexts_, "values") else contexts_
                anchor, lo, span, often = (w.field(i).to_pylist() for i in range(4))
                for at in range(0, len(lo), 4096):
                    to = min(len(lo), at + 4096)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor[at:to], pa.int64()), pa.array([uid] * (to - at), pa.int64()),
                         pa.array(lo[at:to], pa.int64()), pa.array([x & 0xFFFF for x in span[at:to]], pa.int32()),
                         pa.array(often[at:to], pa.bool_()),
                         pa.array([data[a:a + (x >> 16) + length] for a, x in zip(lo[at:to], span[at:to])], pa.binary())],
                        names=["anchor", "uid", "lo", "offset", "often", "bytes"])

    pieces = long.join(wanted, "uid").select("uid", "data", "wanted").mapInArrow(
        cut, "anchor long, uid long, lo long, offset int, often boolean, bytes binary")

    def compare(batches):
        held: list[tuple] = []
        size = 0

        def answer():
            anchors = np.array([h[0] for h in held], np.int64)
            runs = repeated_runs(np.unique(anchors, return_inverse=True)[1], [h[5] for h in held],
                                 np.array([h[3] for h in held]), length)
            out = [(h[1], h[2] + r[0], h[2] + r[1]) for h, r in zip(held, runs) if r and not h[4]]
            return pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.int64()) for i in range(3)],
                                              names=["uid", "start", "stop"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if held and size >= SORTED and row[0] != held[-1][0]:
                    yield answer()
                    held, size = [], 0
                held.append(row)
                size += len(row[5]) - length + 1
        if held:
            yield answer()

    sorted_ = pieces.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, "uid long, start long, stop long")
    return whole.union(sorted_)


def told_apart(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(id, uid, data) of (id, uid, apart, data) with a uid for each different row, (uid, size) of those that stand more than once,
    and the number of these.

    Different rows whose 64-bit ``uid`` is the same differ in the second hash ``apart`` and get uids made of it, until none is shared.
    Rows of one uid repeat each other in whole, and one of them stands for all.
    """
    attempt = 0
    while True:
        twice = rows.groupBy("uid").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("data")).cast("long").alias("size"),
                                        (F.min("apart") != F.max("apart")).alias("shared"))
        twice, several = materialize(twice.where("n > 1").drop("n"), "repeated_rows")
        shared = twice.where("shared").select("uid", "shared")
        if not several or shared.isEmpty():
            return rows.select("id", "uid", "data"), twice.select("uid", "size"), several
        attempt += 1
        new: Column = F.when(F.col("shared"), F.xxhash64(F.lit(attempt), "apart")).otherwise(F.col("uid"))
        rows = rows.join(shared, "uid", "left").select("id", new.alias("uid"), "apart", "data")


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id_col, n_bytes, n_removed, n_spans, kept, spans).

    Texts are UTF-8 bytes, null counts as empty. ``kept`` is what is left, concatenated; ``spans`` are the maximal removed
    runs (start, stop) in order. Strings are judged on the input; matches do not cross documents. Null ids stay; rows that agree
    in id and text repeat each other. Other columns are left out. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(id_col), text).alias("uid"),
                       F.xxhash64(F.lit("apart"), text, F.col(id_col)).alias("apart"), text.cast("binary").alias("data"))
    rows, twice, several = told_apart(rows)
    spans = repeated_spans(rows, length)
    if several:
        spans = spans.union(twice.where(F.col("size") >= length).select("uid", F.lit(0).cast("long"), "size")).distinct()
    spans = spans.groupBy("uid").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))  # bounded by the text's length
    spans, _ = materialize(spans, "repeated_spans")
    id_type = docs.schema[id_col].dataType.simpleString()

    def take_out(batches):
        for batch in batches:
            for id_, data, runs in zip(*(batch.column(i) for i in range(3))):
                data, merged = data.as_py(), []
                for r in sorted((r["start"], r["stop"]) for r in runs.as_py() or ()):
                    if merged and r[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], r[1])
                    else:
                        merged.append(list(r))
                edges = [0, *(x for m in merged for x in m), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([id_.as_py()], batch.schema.field(0).type), pa.array([len(data)], pa.int64()),
                     pa.array([len(data) - len(kept)], pa.int64()), pa.array([len(merged)], pa.int64()),
                     pa.array([kept], pa.binary()),
                     pa.array([[{"start": a, "stop": b} for a, b in merged]],
                              pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept", "spans"])

    joined = rows.join(spans, "uid", "left").select("id", "data", "spans")
    out = joined.mapInArrow(take_out, f"id {id_type}, n_bytes long, n_removed long, n_spans long, kept binary, "
                                      "spans array<struct<start:bigint,stop:bigint>>")
    return out.withColumnRenamed("id", id_col)
