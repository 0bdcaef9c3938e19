"""Source divergence audit: how far the term distributions of a language's sources lie apart, and which terms set a
source off from its language.

Counting is length-bucketed packing. A task finds the terms of many whole texts at once in their bytes; terms of up to 8
bytes become one uint64, of up to 16 bytes two, radix-sorted by digits of 16 bits in numpy and run-counted; longer terms go to
buckets of fixed widths that are sorted by their bytes. Rows are sorted by (source group, document) before, and the sorts are stable, so a
run of equal terms lists its groups and documents in order and gives both counts in one pass.

Jobs: the counts are exchanged by (lang, term), added, kept where enough documents of the language hold the term,
and written once with a row per term. Totals by group follow. A language's terms are dealt to blocks of bounded size by hash;
a block sees the totals of its language beside its terms, sums the divergence of every pair of sources, and picks its own
first terms per source; sums and ranks over blocks are small. Terms that both sources of a pair lack add a constant
each, so a block's work grows with the counts that are not zero.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fedlake.session import materialize

#: Fixed by the contract: probabilities in parts of a thousand million, documents a kept term is in, ranks of terms.
SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
#: Bytes of text a task sorts at once; a longer text is a run of its own.
RUN_BYTES = 24 << 20
#: Rows of an output batch, and bytes of one of long terms.
OUT_ROWS, OUT_BYTES = 1 << 17, 8 << 20
#: Counts other than zero in a block of terms, about; cells of a dense part of a block.
BLOCK_COUNTS = 1 << 16
DENSE_CELLS = 1 << 20
#: Widest bucket of fixed width for long terms; longer ones are sorted as byte strings.
WIDEST = 256

_TERM = np.ones(256, bool)
_TERM[:0x41] = _TERM[0x5B:0x61] = _TERM[0x7B:0x80] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_GAP = np.array([0x20], np.uint8)


def radix_order(words: list[np.ndarray]) -> np.ndarray:
    """Stable order of keys of uint64 words, the first word most significant, by digits of 16 bits from the last on."""
    order = np.arange(len(words[0]))
    for word in reversed(words):
        for shift in (0, 16, 32, 48):
            digit = (word >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and (digit != digit[0]).any():
                # numpy sorts 16-bit integers stably by radix
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def gathered(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """The bytes of terms in rows of ``width``, filled up with zeros, which no term holds. ``text`` ends ``width`` bytes
    after the last term or later."""
    rows = np.lib.stride_tricks.sliding_window_view(text, width)[starts]
    rows[np.arange(width) >= lengths[:, None]] = 0
    return rows


def _runs(new_term: np.ndarray, group: np.ndarray, doc: np.ndarray):
    """Of sorted terms: where runs of one (term, group) begin, their lengths, and the documents in each."""
    new_group, new_doc = new_term.copy(), new_term.copy()
    new_group[1:] |= group[1:] != group[:-1]
    new_doc[1:] |= doc[1:] != doc[:-1]
    at = np.flatnonzero(new_group)
    return at, np.diff(np.append(at, len(group))), np.add.reduceat(new_doc.astype(np.int64), at)


def _strings(rows: np.ndarray) -> pa.Array:
    """Rows of bytes filled up with zeros as strings."""
    held = rows != 0
    ends = np.cumsum(held.sum(axis=1), dtype=np.int64)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows[held])])


def run_counts(text: np.ndarray, doc_ends: np.ndarray, doc_group: np.ndarray):
    """Counts of the terms of one run of documents, sorted by group, with a gap after each: yields (groups, terms,
    occurrences, documents), a row per (group, term)."""
    lower = np.concatenate([_LOWER[text], np.zeros(WIDEST, np.uint8)])
    edges = np.flatnonzero(np.diff(_TERM[lower], prepend=False))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    docs = np.searchsorted(doc_ends, starts, side="right")
    low = 0
    widths = [4, 8, 16]
    while widths[-1] < WIDEST:
        widths.append(2 * widths[-1])
    for width in widths:
        of = np.flatnonzero((lengths > low) & (lengths <= width))
        low = width
        if not len(of):
            continue
        doc = docs[of]
        if width <= 16:
            rows = gathered(lower, starts[of], lengths[of], max(width, 8))
            words = [rows[:, k:k + 8].copy().view(">u8")[:, 0].astype(np.uint64) for k in range(0, rows.shape[1], 8)]
            order = radix_order(words)
            words = [w[order] for w in words]
            new = np.ones(len(of), bool)
            new[1:] = words[0][1:] != words[0][:-1]
            for w in words[1:]:
                new[1:] |= w[1:] != w[:-1]
        else:
            rows = gathered(lower, starts[of], lengths[of], width)
            keys = rows.view(f"S{width}")[:, 0]
            order = np.argsort(keys, kind="stable")
            keys = keys[order]
            new = np.ones(len(of), bool)
            new[1:] = keys[1:] != keys[:-1]
        doc = doc[order]
        group = doc_group[doc]
        at, times, in_docs = _runs(new, group, doc)
        for k in range(0, len(at), OUT_ROWS):
            part = slice(k, k + OUT_ROWS)
            yield group[at[part]], _strings(rows[order[at[part]]]), times[part], in_docs[part]
    of = np.flatnonzero(lengths > WIDEST)
    if len(of):
        keys = [lower[a:b].tobytes() for a, b in zip(starts[of].tolist(), ends[of].tolist())]
        order = np.array(sorted(range(len(keys)), key=keys.__getitem__))
        new = np.array([True, *(keys[a] != keys[b] for a, b in zip(order[1:], order[:-1]))])
        doc = docs[of][order]
        group = doc_group[doc]
        at, times, in_docs = _runs(new, group, doc)
        first, size = 0, 0
        for i, a in enumerate(at.tolist()):  # batches by bytes, as these terms have any length
            size += len(keys[order[a]])
            if size >= OUT_BYTES or i == len(at) - 1:
                part = at[first:i + 1]
                yield group[part], pa.array([keys[k].decode() for k in order[part]]), times[first:i + 1], in_docs[first:i + 1]
                first, size = i + 1, 0


PARTS = "lang string, source string, term string, n long, docs long"


def count_terms(batches, run_bytes: int):
    """Counts by (lang, source, term) of the runs of a task's rows (lang, source, text)."""
    held: list[tuple[str, str, np.ndarray]] = []
    size = 0
    for batch in batches:
        langs, sources, texts = (batch.column(i) for i in range(3))
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].tolist()
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        for lang, source, a, b in zip(langs.to_pylist(), sources.to_pylist(), offsets, offsets[1:]):
            held.append((lang, source, data[a:b]))
            size += b - a
            if size >= run_bytes:
                yield from _run_batches(held)
                held, size = [], 0
    if held:
        yield from _run_batches(held)


def _run_batches(held):
    names = sorted({(lang, source) for lang, source, _ in held})
    number = {g: i for i, g in enumerate(names)}
    held.sort(key=lambda r: number[r[0], r[1]])
    text = np.concatenate([x for _, _, t in held for x in (t, _GAP)])
    ends = np.cumsum([len(t) + 1 for _, _, t in held])
    langs, sources = (pa.array([n[i] for n in names]) for i in (0, 1))
    for group, terms, n, docs in run_counts(text, ends, np.array([number[a, b] for a, b, _ in held])):
        at = pa.array(group)
        yield pa.RecordBatch.from_arrays([langs.take(at), sources.take(at), terms, pa.array(n), pa.array(docs)],
                                         names=["lang", "source", "term", "n", "docs"])


def parts_of(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) exactly, by long division in steps of a thousand; total below 2^63 / 1000."""
    if total >= (1 << 63) // 1000:
        raise ValueError("too many occurrences for exact 64-bit division")
    left, out = counts + 1, np.zeros_like(counts)
    out, left = left // total, left % total
    for _ in range(3):
        left = left * 1000
        out, left = out * 1000 + left // total, left % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); both are at most SCALE + 1, so the square fits."""
    d = p - q
    return d * d // q


AUDIT = "lang string, source string, part string, item string, value long"


def block(lang: str, terms: pa.Table, totals: pa.Table, top: int, cells: int) -> pa.Table:
    """Pair sums of one block of a language's kept terms, and each source's first ``top`` terms in it."""
    row = totals.slice(0, 1).to_pylist()[0]
    of = {g["source"]: g["n"] for g in row["sources"]}
    names = sorted(of, key=str.encode)
    place = {s: i for i, s in enumerate(names)}
    size, kept = len(names), row["kept"]
    sums = np.zeros((size, size), np.int64)
    firsts: list[list[tuple[int, str]]] = [[] for _ in names]
    if kept:
        whole = [of[s] + kept for s in names]
        all_of = sum(of.values()) + kept
        absent = np.concatenate([parts_of(np.zeros(1, np.int64), w) for w in whole])
        both_absent = divergence(absent[:, None], absent[None, :])
        step = max(1, cells // size)
        for at in range(0, terms.num_rows, step):
            part = terms.slice(at, step).combine_chunks()
            lists = part.column("counts").chunk(0) if part.column("counts").num_chunks else None
            n = part.num_rows
            flat = lists.flatten()
            rows = np.repeat(np.arange(n), lists.value_lengths().to_numpy())
            columns = np.array([place[s] for s in flat.field("source").to_pylist()], np.int64)
            counts = np.zeros((n, size), np.int64)
            counts[rows, columns] = flat.field("n").to_numpy()
            p = np.stack([parts_of(counts[:, i], whole[i]) for i in range(size)], axis=1)
            q = parts_of(counts.sum(axis=1), all_of)
            held = counts > 0
            sums += n * both_absent
            words = part.column("term").to_pylist()
            for i in range(size):
                r = np.flatnonzero(held[:, i])
                if not len(r):
                    continue
                own = p[r, i][:, None]
                sums[i] += (divergence(own, p[r]) - both_absent[i]).sum(axis=0)
                # the others' side where they lack the term
                sums[:, i] += np.where(held[r], 0, divergence(absent[None, :], own) - both_absent[:, i]).sum(axis=0)
                above = r[p[r, i] > q[r]]
                values = divergence(p[above, i], q[above])
                if len(values) > top:
                    enough = values >= np.partition(values, len(values) - top)[len(values) - top]
                    above, values = above[enough], values[enough]
                found = [(v, words[t]) for v, t in zip(values.tolist(), above.tolist())]
                firsts[i] = sorted(firsts[i] + found, key=lambda x: (-x[0], x[1].encode()))[:top]
    out = [(names[a], "pair", names[b], int(sums[a, b])) for a in range(size) for b in range(size) if a != b]
    out += [(names[a], "term", t, v) for a in range(size) for v, t in firsts[a]]
    sources, kinds, items, values = zip(*out) if out else ((),) * 4
    return pa.table({"lang": pa.array([lang] * len(out), pa.string()), "source": pa.array(sources, pa.string()),
                     "part": pa.array(kinds, pa.string()), "item": pa.array(items, pa.string()),
                     "value": pa.array(values, pa.int64())})


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", min_docs: int = MIN_DOCS,
          top: int = TOP, run_bytes: int = RUN_BYTES, block_counts: int = BLOCK_COUNTS, cells: int = DENSE_CELLS) -> DataFrame:
    """(lang, source, part, item, value, rank) over all whole texts of ``docs``.

    Null texts, languages and sources are empty strings. Terms are runs of letters A-Z, a-z and characters above U+007F, A-Z
    lower-cased; a language keeps those in at least ``min_docs`` of its rows (a repeated row counts each time). ``pair`` rows: every other
    source of the language with the divergence from it, summed over all kept terms (0 if there are none). ``term`` rows: the
    first ``top`` kept terms that the source holds and that are likelier there than in the language. Ranks run by value downwards, then by
    item's UTF-8 bytes. A source without terms has pair rows only, the only source of a language term rows only; an empty
    table gives no rows.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).alias("text"))
    counted = rows.mapInArrow(lambda batches: count_terms(batches, run_bytes), PARTS)
    # by (lang, term) alone, so that both sums below need no other exchange
    summed = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = summed.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("counts"))
    terms, _ = materialize(terms.where(F.col("docs") >= min_docs).select("lang", "term", "counts"), "divergence_terms")

    groups = rows.select("lang", "source").distinct()
    used = terms.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source").agg(
        F.sum("c.n").alias("n"), F.count(F.lit(1)).alias("cells"))
    kept = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    # a row per language with a list of its sources; the result has a row for each pair of them
    langs = groups.join(used, ["lang", "source"], "left").groupBy("lang").agg(
        F.collect_list(F.struct("source", F.coalesce("n", F.lit(0)).alias("n"))).alias("sources"),
        F.coalesce(F.sum("cells"), F.lit(0)).alias("cells"))
    langs = langs.join(kept, "lang", "left").select(
        "lang", "sources", F.coalesce("kept", F.lit(0)).alias("kept"),
        (1 + F.floor(F.col("cells") / block_counts)).cast("long").alias("blocks"))
    langs, _ = materialize(langs, "divergence_langs")

    dealt = terms.join(langs.select("lang", "blocks"), "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "blocks").alias("block"), "term", "counts")
    totals = langs.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "sources", "kept")

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        return block(key[0].as_py(), left, right, top, cells)

    found = dealt.groupBy("lang", "block").cogroup(totals.groupBy("lang", "block")).applyInArrow(run, AUDIT)
    found = found.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))
