"""Filter interaction audit: what every filter of a chain removes, in every order the filters could be applied.

A document's failures are a mask of five bits. What a mask does is known for every order and step in advance, so a mask
(with the document's two labels) maps to one big integer whose fields hold all 600 step outcomes, MEASURES of them each.
Documents are counted by adding these integers per part: first in each task, then, in two rounds of small groups,
across tasks. A field has 64 bits while it is added to, so no field runs into the next; between tasks an integer is
stored with fields as narrow as its largest count allows.

Jobs: one scan of the texts writes a narrow table (id, part, text digest, mask); the smallest id of each digest is
aggregated and joined back on (digest, id), a key that no group of copies shares; then the integers are added.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fedlake.session import materialize

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
MEASURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
FIELDS = len(ORDERS) * len(FILTERS) * len(MEASURES)
#: The label bits above a class's failure bits.
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
CLASSES = 4 << len(FILTERS)
#: Parts a task adds up at once; more are sent on and begun anew.
HELD_PARTS = 512

BLANK = " \t\n\x0b\x0c\r"


def text_failures(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters A to D, functions of the (not null) text and of its ``words``.

    A: under 50 words; B: 100 * distinct words < 65 * words; C: 100 * capitals A-Z > 5 * code points; D: one of #$%&*|.
    Words are maximal runs of other characters than blanks; an empty text has none and fails A only.
    """
    n = F.when(F.col("words")[0] == "", 0).otherwise(F.size("words"))
    return {
        "A": n < 50,
        "B": (n > 0) & (100 * F.size(F.array_distinct("words")) < 65 * n),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(id, part, mask) of every row of ``docs``: bit i of mask is set where filter FILTERS[i] fails.

    Null texts are empty, null parts the empty string. E fails where a row of a smaller id has the identical text; a
    null id is not above any other, and repeated rows of the smallest id all pass.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       text.alias("text"))
    rows = rows.withColumn("words", F.split(F.btrim("text", F.lit(BLANK)), r"[\x20\x09-\x0D]+"))
    mask = sum((c.cast("int") * (1 << FILTERS.index(k)) for k, c in text_failures(F.col("text")).items()), F.lit(0))
    rows = rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))
    rows, _ = materialize(rows, "filter_masks")
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).where(F.col("id").isNotNull()).withColumn("first", F.lit(True))
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    return rows.join(first, ["digest", "id"], "left").select(
        "id", "part", (F.col("mask") + copy.cast("int") * (1 << FILTERS.index("E"))).alias("mask"))


def outcomes(failed: int) -> np.ndarray:
    """What a class (mask and label bits) does at every (order, step): FIELDS zeros and ones."""
    out = np.zeros((len(ORDERS), len(FILTERS), len(MEASURES)), np.uint64)
    for o, order in enumerate(ORDERS):
        gone = False
        for s, letter in enumerate(order):
            fails = bool(failed >> FILTERS.index(letter) & 1)
            removed = fails and not gone
            out[o, s] = (not gone and not fails, removed, fails and gone, failed & (GOOD - 1) == 1 << FILTERS.index(letter),
                         removed and bool(failed & GOOD), removed and bool(failed & TOXIC))
            gone = gone or fails
    return out.ravel()


def as_integer(counts: np.ndarray) -> int:
    """The big integer whose 64-bit fields are ``counts``."""
    return int.from_bytes(counts.astype("<u8").tobytes(), "little")


def as_counts(wide: int) -> np.ndarray:
    """The fields of a big integer."""
    return np.frombuffer(wide.to_bytes(8 * FIELDS, "little"), "<u8")


def narrowed(wide: int) -> tuple[int, bytes]:
    """A big integer with fields of as few bytes as its largest needs, and that width."""
    counts = as_counts(wide)
    width = next(w for w in (1, 2, 4, 8) if int(counts.max()) < 1 << 8 * w)
    return width, counts.astype(f"<u{width}").tobytes()


def widened(width: int, fields: bytes) -> int:
    return as_integer(np.frombuffer(fields, f"<u{width}"))


PARTIAL = "part string, salt int, width int, fields binary"


def _partials(totals: dict[str, int], salt: int) -> pa.RecordBatch:
    packed = [narrowed(v) for v in totals.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(totals), pa.string()), pa.array([salt] * len(packed), pa.int32()),
         pa.array([w for w, _ in packed], pa.int32()), pa.array([b for _, b in packed], pa.binary())],
        names=["part", "salt", "width", "fields"])


def _counted(batches: Iterator[pa.RecordBatch], held_parts: int) -> Iterator[pa.RecordBatch]:
    """Big integers of the parts of a task's rows (part, class)."""
    wide = [None] * CLASSES
    totals: dict[str, int] = {}
    # partitions p of about sqrt(P) neighbours are added first, whatever their number P
    salt = isqrt(TaskContext.get().partitionId())
    for batch in batches:
        names = pc.dictionary_encode(batch.column(0))
        key = names.indices.to_numpy().astype(np.int64) * CLASSES + batch.column(1).to_numpy()
        parts = names.dictionary.to_pylist()
        for k, n in zip(*(a.tolist() for a in np.unique(key, return_counts=True))):
            part, c = parts[k // CLASSES], k % CLASSES
            if wide[c] is None:
                wide[c] = as_integer(outcomes(c))
            totals[part] = totals.get(part, 0) + n * wide[c]
        if len(totals) > held_parts:
            yield _partials(totals, salt)
            totals = {}
    if totals:
        yield _partials(totals, salt)


def _total(batches: Iterator[pa.RecordBatch]) -> int:
    return sum(widened(w, f) for b in batches for w, f in zip(b.column("width").to_pylist(), b.column("fields").to_pylist()))


def _added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield _partials({key[0].as_py(): _total(batches)}, key[1].as_py())


RESULT = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES) + ", shapley long"


def _unpacked(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The 600 rows of a part from its integer."""
    counts = as_counts(_total(batches)).astype(np.int64).reshape(-1, len(MEASURES))
    letters = np.array([FILTERS.index(x) for order in ORDERS for x in order])
    removed = counts[:, MEASURES.index("removed")]
    shapley = np.array([removed[letters == i].sum() for i in range(len(FILTERS))])[letters]
    n = len(letters)
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[0].as_py()] * n, pa.string()), pa.array([o for o in ORDERS for _ in FILTERS], pa.string()),
         pa.array([1 + i % len(FILTERS) for i in range(n)], pa.int32()),
         *(pa.array(counts[:, m]) for m in range(len(MEASURES))), pa.array(shapley)],
        names=["part", "filter_order", "step", *MEASURES, "shapley"])


def audit(masks: DataFrame, labels: DataFrame, id_col: str = "doc_id", held_parts: int = HELD_PARTS) -> DataFrame:
    """Counts of every (part, filter_order, step), zeros included, of rows (id, part, mask) as ``failures`` gives them.

    kept: rows that pass this and all earlier filters; removed: rows this step removes; redundant: rows that fail it but
    were removed before; unique_fails: rows that fail its filter only; good_lost, toxic_lost: removed rows whose id has a
    label with quality or toxic 1; shapley: what the step's filter removes, summed over all orders. ``labels`` may lack
    ids, repeat them or hold nulls. No rows give no parts.
    """
    of = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    flag = lambda c, bit: F.coalesce(F.col(c), F.lit(False)).cast("int") * bit
    rows = masks.join(of, "id", "left").select(
        "part", (F.col("mask") + flag("good", GOOD) + flag("toxic", TOXIC)).cast("int").alias("class"))
    partial = rows.mapInArrow(lambda batches: _counted(batches, held_parts), PARTIAL)
    added = partial.groupBy("part", "salt").applyInArrow(_added, PARTIAL)
    return added.groupBy("part").applyInArrow(_unpacked, RESULT)
