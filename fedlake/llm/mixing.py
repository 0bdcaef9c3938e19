"""Mixing sources to target weights by hash thresholds (DataFrame functions only).

Every document has a 60-bit hash of its id and text. A source takes the
documents below its threshold, chosen so that their sizes come to its budget.
The threshold is found from histograms, not by sorting: sizes are summed by
source and the top ``BITS`` hash bits, the bucket in which the running sum
crosses the budget is the boundary bucket, and only the documents of boundary
buckets go on to the next round, which splits them by the next bits. Budgets
are nested: a larger budget only adds documents to a smaller one's.

A source whose target is above its size first takes every document whole times
(at most three) and draws only the rest of its target by threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fedlake.session import materialize

#: Fixed by the contract: weights of the sources in order, repeating; the most a source or document may be repeated.
WEIGHTS = (1.0, 2.0, 3.0)
MOST = 3

BITS = 12
ROUNDS = 5
HASH_BITS = BITS * ROUNDS
#: A source's documents are spread over so many parts when its budget is joined to them.
SALTS = 32


def word_count(text: Column) -> Column:
    """Number of [^\\x20\\x09-\\x0D]+ runs; null: 0."""
    blank = " \t\n\x0b\x0c\r"
    t = F.concat(F.lit(" "), F.translate(F.coalesce(text, F.lit("")), blank, " " * len(blank)))
    # a word starts where a blank stands before another character
    return F.regexp_count(t, F.lit(" [^ ]")).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """Targets of the sources: ``sizes`` has (source, source_size), one row each.

    Sources are ranked by code point, null last; weights repeat in that order.
    A target stops at MOST times its source's size and the excess is shared by
    weight among the others, until none is above. Returns (source,
    source_size, weight, target). The rank is a count per range of sources plus the place within it, so no task sees
    all of them; the sharing out is a loop over scalar sums that ends when no further source is capped.
    """
    ordered = sizes.withColumn("last", F.col("source").isNull()).repartitionByRange("last", "source")
    ordered = ordered.sortWithinPartitions("last", "source").select(
        "source", "source_size", F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().alias("place"))
    ordered, _ = materialize(ordered, "mix_sources")
    starts = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = F.coalesce(
        F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = starts.select("part", "first", before.alias("before"))  # one row per partition
    rank = F.col("before") + F.col("place") - F.col("first")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.pmod(rank, F.lit(len(WEIGHTS))) + 1).cast("int"))
    weighted = ordered.join(starts, "part").select("source", "source_size", weight.alias("weight"))
    weighted, _ = materialize(weighted, "mix_weights")

    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    cap = F.col("source_size") * F.lit(MOST)
    # a source is capped when its share of what the others leave reaches its cap
    level, capped_before = 0.0, -1
    while True:
        is_capped = (cap <= F.lit(level) * F.col("weight")) if capped_before >= 0 else F.lit(False)
        s = weighted.agg(
            F.count_if(is_capped).alias("n"), F.sum(F.when(is_capped, cap).otherwise(0)).alias("capped"),
            F.sum(F.when(is_capped, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not s["open"] or s["n"] == capped_before:
            break
        capped_before, level = s["n"], (total - s["capped"]) / s["open"]
    target = F.least(cap.cast("double"), F.lit(float(level)) * F.col("weight"))
    return weighted.select("source", "source_size", "weight", target.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per input row: (id_col, size, source_size, target, taken).

    ``taken`` is the number of words that the mix takes of the document, its
    size times the number of copies. Null texts have size 0, null sources are one source. The same
    table always gives the same mix; rows that agree in id and text have one hash and are taken alike. A
    source's taken words differ from its target by at most half of the size
    of the document (or such rows) at its threshold. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), _hash(id_col, text_col).alias("hash"))
    rows, _ = materialize(rows, "mix_rows")
    taken = F.col("size") * _copies()
    return _salted(rows, _plan(rows)).select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target", taken.alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it is taken, with the columns of ``docs``.

    Documents without words carry nothing into a mix and go.
    """
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), _hash(id_col, text_col).alias("hash"))
    sizes, _ = materialize(rows.select("source", "size", "hash"), "mix_sizes")
    taken = _salted(rows.where("size > 0"), _plan(sizes)).withColumn("copies", _copies())
    return taken.where("copies > 0").select(
        "row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def _hash(id_col: str, text_col: str) -> Column:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.shiftrightunsigned(F.xxhash64(F.lit("mix"), F.col(id_col), text), 64 - HASH_BITS)


def _copies() -> Column:
    return F.col("copies") + (F.col("hash") < F.col("limit")).cast("long")


def _plan(rows: DataFrame) -> DataFrame:
    """For each source of (source, size, hash): source_size, target, whole copies, and the limit below which a hash adds one."""
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("copies", F.least(copies, F.lit(MOST)).cast("long")).withColumn(
        "budget", F.greatest(F.col("target") - F.col("copies") * F.col("source_size"), F.lit(0.0)))
    targets, _ = materialize(targets, "mix_targets")

    # state: for each source, documents with hash < edge are taken and "left" is still to be found among the
    # documents of the boundary bucket, whose hashes start at edge
    state = targets.select("source", F.lit(0).cast("long").alias("edge"), F.col("budget").alias("left"))
    inside = rows.select("source", "size", "hash")
    for level in range(1, ROUNDS + 1):
        shift = HASH_BITS - BITS * level
        bucket = F.shiftleft(F.shiftright("hash", shift), shift)
        sums = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        sums = sums.alias("h").join(state.select("source", "left").alias("s"),
                                    F.col("h.source").eqNullSafe(F.col("s.source"))).select(
            "h.source", "bucket", "words", "left")
        # at most 2^BITS buckets a source
        below = F.coalesce(F.sum("words").over(
            Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        boundary = sums.withColumn("below", below).where(
            (F.col("below") <= F.col("left")) & (F.col("below") + F.col("words") > F.col("left")))
        boundary = boundary.select("source", F.col("bucket").alias("edge"),
                                   (F.col("left") - F.col("below")).alias("left"), "words")
        state, _ = materialize(boundary, f"mix_boundary{level}")
        if level < ROUNDS:
            inside, _ = materialize(_of_boundary(inside, state.select("source", "edge"), shift), f"mix_inside{level}")
    # the last boundary bucket holds one document (or rows of one hash): it is taken if that comes nearer
    limits = state.select("source", F.when(F.col("left") * 2 >= F.col("words"), F.col("edge") + 1)
                          .otherwise(F.col("edge")).alias("limit"))
    return targets.alias("t").join(limits.alias("l"), F.col("t.source").eqNullSafe(F.col("l.source")), "left").select(
        "t.source", "source_size", "target", "copies",
        # without a boundary the source is taken whole (again) or, with nothing left to draw, not at all
        F.coalesce("limit", F.when(F.col("budget") > 0, F.lit(1 << HASH_BITS)).otherwise(0)).alias("limit"))


def _salted(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Join a row per source to the documents; a source's documents are spread over SALTS parts."""
    salt = F.pmod(F.col("hash"), F.lit(SALTS)).cast("int")
    r = rows.withColumn("salt", salt).alias("r")
    p = per_source.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).alias("p")
    return r.join(p, (F.col("r.salt") == F.col("p.salt")) & F.col("r.source").eqNullSafe(F.col("p.source"))).select(
        "r.*", *[f"p.{c}" for c in per_source.columns if c != "source"])


def _of_boundary(rows: DataFrame, boundary: DataFrame, shift: int) -> DataFrame:
    """The rows of the boundary buckets."""
    joined = _salted(rows, boundary)
    return joined.where(F.shiftleft(F.shiftright("hash", shift), shift) == F.col("edge")).select("source", "size", "hash")
