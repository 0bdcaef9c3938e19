"""LM scoring: stupid-backoff scores, computed relationally from n-gram counts over the whole corpus.

The score of a word is S(w | context) = c(context w) / c(context) for the longest context (at most ``order`` - 1
words) that the corpus continues with w, times ``backoff`` for every word the context was shortened by; a word
the corpus lacks gets backoff^m / (N + 1). All counts leave out the scored document's own occurrences, so a
text does not vouch for itself; N is the number of all other words.

Tables: documents are dealt to *blocks* of bounded size by hash. Each block is exploded to its distinct
n-grams with counts; these rows go, packed by hash range (*bucket*), to the count table, which is partitioned by that hash. The totals
come back to the blocks as a join on the same rows, and each block sums the scores of its documents. A block sends each n-gram
once, however often it stands there, so a frequent n-gram is no hot key. One row carries the n-grams of a block and bucket as
sorted hash differences, since single rows would take several times the space and time: ``score_by_rows`` is that form,
one row for each distinct n-gram of a document, joined to its count and summed by Spark alone.

N-grams are told apart by HASH_BITS-bit hashes: among 10^10 different ones about one in 10^7 shares its count
with another.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fedlake.session import materialize

from . import packed_counts
from .mixing import word_count

ORDER = 3
BACKOFF = 0.4
HASH_BITS = 58
REMEMBERED = 300_000


class Ngrams:
    """The distinct n-grams of the documents of a block, one order after the other.

    ``keys`` (ascending) and ``counts`` are those of all orders. With ``places`` each word knows, for each order, the n-gram
    that ends there and how often it stands in the word's own document.
    """

    def __init__(self, texts: list[str], order: int, places: bool):
        known: dict[bytes, int] = {}
        codes = [np.zeros(0, np.uint64)]
        lengths = []
        for t in texts:
            words = t.encode().split()
            lengths.append(len(words))
            got = list(map(known.get, words))
            if None in got:
                if len(known) > REMEMBERED:
                    known.clear()
                for i, c in enumerate(got):
                    if c is None:
                        got[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
            codes.append(np.array(got, np.uint64))
        w = np.concatenate(codes)
        del known, codes
        self.order, self.lengths = order, np.array(lengths, np.int64)
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int32), self.lengths)
        starts = np.cumsum(self.lengths) - self.lengths
        self.place = (np.arange(len(w)) - np.repeat(starts, self.lengths)).astype(np.int32)
        distinct, counts, self.ends, self.key_at, self.own = [], [], [], [], []
        h = np.zeros(len(w), np.uint64)
        for n in range(1, order + 1):
            at = np.flatnonzero(self.place >= n - 1).astype(np.int32)
            before = h[at - 1] if n > 1 else np.zeros(len(at), np.uint64)
            now = _mixed(before * np.uint64(0x9E3779B97F4A7C15) + w[at] + np.uint64(n))
            h = np.zeros(len(w), np.uint64)
            h[at] = now
            now >>= np.uint64(64 - HASH_BITS)
            by = np.argsort(now, kind="stable").astype(np.int32) if places else None  # documents stay in order
            s = now[by] if places else np.sort(now)
            fresh = np.ones(len(s), bool)
            fresh[1:] = s[1:] != s[:-1]
            distinct.append(s[fresh])
            counts.append(np.diff(np.append(np.flatnonzero(fresh), len(s))))
            if places:
                self.ends.append(at)
                key_at, own = np.empty(len(s), np.int32), np.empty(len(s), np.int32)
                key_at[by] = np.cumsum(fresh) - 1
                d = self.doc[at][by]
                fresh[1:] |= d[1:] != d[:-1]
                size = np.diff(np.append(np.flatnonzero(fresh), len(s)))
                own[by] = np.repeat(size, size)
                self.key_at.append(key_at)
                self.own.append(own)
        keys = np.concatenate(distinct)
        by = np.argsort(keys, kind="stable")
        self.keys, self.counts = keys[by], np.concatenate(counts)[by]
        self.sizes = [len(x) for x in distinct]
        self.merged = by

    def others(self, totals: np.ndarray) -> list[np.ndarray]:
        """For each order, the count of the n-gram that ends at each word, outside the word's document."""
        apart = np.empty(len(totals), np.int64)
        apart[self.merged] = totals
        out, first = [], 0
        for ends, key_at, own, size in zip(self.ends, self.key_at, self.own, self.sizes):
            c = np.zeros(len(self.doc), np.int64)
            c[ends] = apart[first:first + size][key_at] - own
            out.append(c)
            first += size
        return out

    def scores(self, totals: np.ndarray, words: int, backoff: float) -> tuple[np.ndarray, np.ndarray]:
        """Sum of log S and number of shortened contexts of each document."""
        c = self.others(totals)
        outside = words - np.repeat(self.lengths, self.lengths)
        longest = np.minimum(self.place + 1, self.order)
        used = np.zeros(len(self.place), np.int32)
        log_s = longest * math.log(backoff) - np.log(outside + 1.0)
        for n in range(1, self.order + 1):
            at = np.flatnonzero(c[n - 1] > 0)
            below = outside[at] if n == 1 else c[n - 2][at - 1]
            log_s[at] = (longest[at] - n) * math.log(backoff) + np.log(c[n - 1][at] / below)
            used[at] = n
        n_docs = len(self.lengths)
        return (np.bincount(self.doc, weights=log_s, minlength=n_docs),
                np.bincount(self.doc, weights=used < longest, minlength=n_docs).astype(np.int64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def score(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """One row per input row: (id_col, n_words, log_score, mean_score, shortened).

    ``log_score`` is the sum of ln S over the words [^\\x20\\x09-\\x0D]+ of the whole text, ``mean_score`` that sum by
    n_words (null without words), ``shortened`` the number of words scored with a shorter context than their place allows. Null and empty
    texts have 0 words and score 0. Null ids stay; rows that repeat an id or a text are documents each.
    Other columns are left out. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    size = docs.agg(F.sum(F.octet_length(text)).alias("bytes"), F.sum(word_count(text)).alias("words")).first()
    words = int(size["words"] or 0)
    n_blocks = packed_counts.n_blocks(size["bytes"] or 0)
    shift = packed_counts.bucket_shift(words * order, HASH_BITS)
    id_type = docs.schema[id_col].dataType.simpleString()
    # both sides of the last join read this one exchange
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_col), text), F.lit(n_blocks)).cast("int").alias("block"),
        F.col(id_col).alias("id"), text.alias("text")).repartition(n_blocks, "block")

    def explode(t: pa.Table) -> pa.Table:
        grams = Ngrams(t.column("text").to_pylist(), order, False)
        return packed_counts.to_rows(t.column("block")[0].as_py(), grams.keys, grams.counts, shift)

    def sum_up(texts: pa.Table, counted: pa.Table) -> pa.Table:
        grams = Ngrams(texts.column("text").to_pylist(), order, True)
        log_score, shortened = grams.scores(packed_counts.totals_of(counted), words, backoff)
        n = grams.lengths
        mean = [s / k if k else None for s, k in zip(log_score.tolist(), n.tolist())]
        return pa.table({"id": texts.column("id"), "n_words": pa.array(n, pa.int64()), "log_score": pa.array(log_score, pa.float64()),
                         "mean_score": pa.array(mean, pa.float64()), "shortened": pa.array(shortened, pa.int64())})

    exploded = dealt.groupBy("block").applyInArrow(explode, packed_counts.EXPLODED)
    counted = packed_counts.counted(exploded)
    scored = dealt.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        sum_up, f"id {id_type}, n_words long, log_score double, mean_score double, shortened long")
    return scored.withColumnRenamed("id", id_col)


def score_by_rows(docs: DataFrame, order: int = ORDER, backoff: float = BACKOFF, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``score`` by DataFrame operations: exploded n-grams, a count table, their join, and a sum per document.

    A frequent n-gram is counted by partial sums and is one row of the count table; its many documents are on the other side of
    the join, where adaptive execution splits a partition that is much larger than the others. Only a document's own places
    come together, so a group is bounded by its text. N-grams are told apart by 64-bit hashes.
    """
    numbered, _ = materialize(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text")), "numbered_texts")
    words = numbered.agg(F.sum(word_count(F.col("text")))).first()[0] or 0
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def of_order(n: int):
        ends = F.when(F.size("words") >= n, F.sequence(F.lit(n), F.size("words"))).otherwise(F.array().cast("array<int>"))
        return F.transform(ends, lambda end: F.struct(
            F.lit(n).alias("n"), end.alias("place"), F.xxhash64(F.lit(n), F.slice("words", end - (n - 1), n)).alias("gram")))

    # documents are dealt by uid before they are exploded, so that n-grams are gathered by document without an exchange
    exploded = numbered.repartition("uid").select("uid", split.alias("words")).select(
        "uid", F.explode(F.flatten(F.array(*(of_order(n) for n in range(1, order + 1))))).alias("g")).select("uid", "g.*")
    grams = exploded.groupBy("uid", "n", "gram").agg(F.collect_list("place").alias("places"))
    counts = grams.groupBy("gram").agg(F.sum(F.size("places")).alias("total"))
    others = grams.join(counts, "gram").select("uid", "n", (F.col("total") - F.size("places")).alias("c"), "places")
    at_word = others.repartition("uid").select("uid", "n", "c", F.explode("places").alias("place")).groupBy("uid", "place").agg(
        *(F.max(F.when(F.col("n") == n, F.col("c"))).alias(f"c{n}") for n in range(1, order + 1)))
    in_order = Window.partitionBy("uid").orderBy("place")
    outside = words - F.count(F.lit(1)).over(Window.partitionBy("uid"))
    longest = F.least(F.col("place"), F.lit(order))
    at_word = at_word.select("uid", longest.alias("longest"), outside.alias("c0"), *(f"c{n}" for n in range(1, order + 1)),
                             *(F.lag(f"c{n}").over(in_order).alias(f"before{n}") for n in range(1, order)))
    used, log_s = F.lit(0), -F.log(F.col("c0") + 1.0)
    for n in range(1, order + 1):
        below = F.col("c0") if n == 1 else F.col(f"before{n - 1}")
        seen = F.col(f"c{n}") > 0
        used = F.when(seen, F.lit(n)).otherwise(used)
        log_s = F.when(seen, F.log(F.col(f"c{n}") / below)).otherwise(log_s)
    log_s = log_s + (F.col("longest") - used) * math.log(backoff)
    sums = at_word.groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_words"), F.sum(log_s).alias("log_score"), F.count_if(used < F.col("longest")).alias("shortened"))
    return numbered.select("uid", "id").join(sums, "uid", "left").select(
        F.col("id").alias(id_col), F.coalesce("n_words", F.lit(0)).alias("n_words"),
        F.coalesce("log_score", F.lit(0.0)).alias("log_score"), (F.col("log_score") / F.col("n_words")).alias("mean_score"),
        F.coalesce("shortened", F.lit(0)).alias("shortened"))
