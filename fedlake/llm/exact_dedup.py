"""Exact dedup: a tree-merge of sorted digest runs (DataFrame functions only).

Every row becomes one digest entry; the entries that one input partition wrote
are its *run*. Runs are merged in binomial rounds of ``RADIX_BITS`` bits each: in
a round, the runs whose numbers differ only in the lowest bits go to the run
with those bits clear, which merges them (a multiway merge of sorted runs: the
plan sorts by digest and run and merges equal digests) and keeps the best
entry of each digest together with the number of rows behind it. After the last round one entry per
digest is left. The way back follows the same tree downwards, so that neither
way do all the rows of a hot digest meet in one task: a round moves at most
one entry per digest and run.

An entry counts as equal only if SHA-256, length and an independent 64-bit hash of the
normalised text all agree; all three are merge keys at every level, so a
digest collision is kept apart instead of merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fedlake.session import materialize

#: Fixed by the contract: the characters that do not count, [\x20\x09-\x0D].
IGNORED = " \t\n\x0b\x0c\r"

RUNS = 256
RADIX_BITS = 4
KEY = ["digest", "check", "norm_length"]


def normalised(text: Column) -> Column:
    """The text without ignored characters; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), IGNORED, "")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row with its group of equal texts.

    Returns ``(id_col, keep_id, group_size, kept, text_sha256)`` plus the text's
    length in code points, ``n_points``. Of a group the row with the most code
    points stays, then the smallest id; a null id loses to any other. Rows that
    agree in text and id (repeated rows) are told apart by their place in the
    input: exactly one of them stays. Null and empty texts form one group. Other columns of
    the input are ignored, whatever their names. An empty table gives no rows.
    """
    text = F.col(text_col)
    norm = normalised(text)
    entries = docs.select(
        F.col(id_col).alias("doc_id"),
        F.char_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_points"),
        F.sha2(norm.cast("binary"), 256).alias("text_sha256"),
        F.xxhash64(norm).alias("check"),
        F.char_length(norm).cast("long").alias("norm_length"),
        F.monotonically_increasing_id().alias("place"),
        F.pmod(F.spark_partition_id(), F.lit(RUNS)).alias("run"),
    ).withColumn("digest", F.unhex("text_sha256")).drop("text_sha256")
    # written once: the places and runs must be the same on the way up and down
    entries, _ = materialize(entries, "digest_entries")

    # the greatest entry stays: most code points, then smallest id, then first place
    entry = F.struct(F.col("n_points").alias("n"), F.bitwise_not("doc_id").alias("i"),
                     F.bitwise_not("place").alias("p"))
    level = entries.groupBy(*KEY, "run").agg(F.max(entry).alias("best"), F.count(F.lit(1)).alias("rows"))
    shifts = list(range(RADIX_BITS, RUNS.bit_length() - 1 + RADIX_BITS, RADIX_BITS))
    for shift in shifts:
        level = level.groupBy(*KEY, F.shiftright("run", shift).alias("up")).agg(
            F.max("best").alias("best"), F.sum("rows").alias("rows"))
        level = level.select(*KEY, F.shiftleft("up", shift).alias("run"), "best", "rows")
    final = level.select(*KEY, "best", "rows")

    # down the tree: each run of a digest learns the winner from the run it merged into; only
    # digests with more than one row need it
    shared = final.where(F.col("rows") > 1)
    shared, _ = materialize(shared.withColumn("run", F.lit(0)), "digest_shared")
    for shift in [*reversed(shifts[:-1]), 0]:
        low = entries.select(*KEY, F.shiftleft(F.shiftright("run", shift), shift).alias("run")).distinct()
        parent = F.shiftleft(F.shiftright(F.col("c.run"), shift + RADIX_BITS), shift + RADIX_BITS)
        up = shared.alias("u")
        shared = low.alias("c").join(
            up, [F.col(f"c.{k}") == F.col(f"u.{k}") for k in KEY] + [parent == F.col("u.run")]
        ).select(*[F.col(f"c.{k}") for k in KEY], F.col("c.run"), "best", "rows")
    e = entries.alias("e")
    s = shared.alias("s")
    joined = e.join(s, [F.col(f"e.{k}") == F.col(f"s.{k}") for k in KEY + ["run"]], "left")
    return joined.select(
        F.col("e.doc_id").alias(id_col),
        F.when(F.col("rows").isNull(), F.col("e.doc_id")).otherwise(F.bitwise_not("best.i")).alias("keep_id"),
        F.coalesce("rows", F.lit(1)).alias("group_size"),
        (F.col("rows").isNull() | (F.bitwise_not("best.p") == F.col("e.place"))).alias("kept"),
        F.lower(F.hex("e.digest")).alias("text_sha256"),
        F.col("e.n_points").alias("n_points"),
        F.col("e.place").alias("place"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one of each group of equal texts, with all their columns."""
    names = docs.columns
    key = ["_id", "_digest", "_points"]
    groups = exact_groups(docs, id_col, text_col)
    stay = groups.where("kept").select(
        F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_digest"), F.col("n_points").alias("_points"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(id_col).alias("_id"),
        F.unhex(F.sha2(normalised(F.col(text_col)).cast("binary"), 256)).alias("_digest"),
        F.char_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("_points"))
    stay, _ = materialize(stay, "digest_stay")
    kept = rows.alias("r").join(
        stay.alias("s"), F.col("r._id").eqNullSafe(F.col("s._id")) & (F.col("r._digest") == F.col("s._digest"))
        & (F.col("r._points") == F.col("s._points")), "left_semi")
    # rows that agree in id and text: one of them
    repeated = groups.groupBy(id_col, "text_sha256", "n_points").count().where("count > 1").limit(1).count()
    if repeated:
        kept = kept.dropDuplicates(key)
    return kept.select("row.*")
