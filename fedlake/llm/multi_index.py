"""Approximate nearest neighbours with an inverted multi-index.

Vectors are cut into two halves and each half is quantised by its own centroids, so that K + K centroids make K x K cells.
A query traverses the pairs of centroids in order of their summed distance (here: of the sum of both halves' inner
products, largest first) with a heap, until the cells it has seen hold its share of all entries; the entries of those
cells are reranked with the original vectors. Centroids, and the share of entries that a query must see for the
aimed recall, are fitted on a bounded sample; every valid row is indexed.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fedlake.session import materialize

#: Centroids of a half: the number of vectors to this power, within these bounds. (Cells are counted on the driver: 8 MB at most.)
GROWTH = 0.4
FEWEST, MOST = 128, 1024
#: Vectors that centroids and share are fitted on, at most.
SAMPLE = 20_000
SAMPLE_QUERIES = 400
#: Recall that the share of entries is chosen for, on the sample.
AIM = 0.96
#: Entries in one part of the index.
PART_ENTRIES = 20_000
QUERY_BLOCK = 256
#: More than the rounding of a block of inner products of unit vectors.
SLACK = 1e-9


@dataclass
class Codebook:
    first: np.ndarray
    second: np.ndarray
    share: float

    @property
    def cut(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _nearest(x[:, :self.cut], self.first), _nearest(x[:, self.cut:], self.second)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres ** 2).sum(axis=1) - 2 * x @ centres.T).argmin(axis=1)


def _kmeans(x: np.ndarray, k: int, rng, rounds: int = 15) -> np.ndarray:
    distinct = np.unique(x, axis=0)
    centres = distinct[np.sort(rng.choice(len(distinct), min(k, len(distinct)), replace=False))].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def traverse(a: np.ndarray, b: np.ndarray, counts: np.ndarray, entries: int) -> list[int]:
    """Cells (i * K + j) by falling a[i] + b[j] until they hold ``entries``; empty cells are passed over.

    Multi-sequence walk: the heap holds the best pair not yet seen of each row of centroids that was reached.
    """
    oa, ob = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
    sa, sb = (-a[oa]).tolist(), (-b[ob]).tolist()
    oa, ob, width = oa.tolist(), ob.tolist(), len(sb)
    sizes = counts.tolist() if isinstance(counts, np.ndarray) else counts
    heap, seen, out = [(sa[0] + sb[0], 0, 0)], 0, []
    while heap and seen < entries:
        _, i, j = heap[0]
        cell = oa[i] * width + ob[j]
        if sizes[cell]:
            out.append(cell)
            seen += sizes[cell]
        if j + 1 < width:
            heapq.heapreplace(heap, (sa[i] + sb[j + 1], i, j + 1))
        else:
            heapq.heappop(heap)
        if j == 0 and i + 1 < len(sa):
            heapq.heappush(heap, (sa[i + 1] + sb[0], i + 1, 0))
    return out


def fit(x: np.ndarray, k: int, near: int, seed: int = 11) -> Codebook:
    """Centroids of both halves of the sample ``x``, and the share of entries that holds AIM of the true neighbours there."""
    rng = np.random.default_rng(seed)
    cut = x.shape[1] // 2
    book = Codebook(_kmeans(x[:, :cut], k, rng), _kmeans(x[:, cut:], k, rng), 1.0)
    width = len(book.second)
    one, two = book.cells(x)
    counts = np.bincount(one * width + two, minlength=len(book.first) * width)
    shares = []
    for q in rng.choice(len(x), min(SAMPLE_QUERIES, len(x)), replace=False):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.argsort(-s, kind="stable")[:min(near, len(x) - 1)]
        sums = ((book.first @ x[q, :cut])[:, None] + (book.second @ x[q, cut:])[None, :]).ravel()
        order = np.argsort(-sums, kind="stable")
        reached = np.empty(len(order))
        reached[order] = np.cumsum(counts[order])
        shares.extend(reached[one[best] * width + two[best]] / len(x))
    if shares:
        book.share = float(min(1.0, np.quantile(shares, AIM)))
    return book


def valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): vectors of doubles of the commonest length, without null, zero, or null or non-finite components."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull())
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.where(~bad & F.exists("v", lambda x: x != 0))
    length = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).first()
    return rows.where(F.size("v") == (length["d"] if length else 0))


def centroids(n: int) -> int:
    """Centroids of a half for an index of ``n`` vectors: more of them, and so finer cells, the more vectors there are."""
    return int(min(MOST, max(FEWEST, np.ceil(n ** GROWTH))))


def fitted(rows: DataFrame, n: int, k: int) -> Codebook:
    """Centroids and share of entries for ``n`` rows (id, v), from a sample of at most SAMPLE of them by hash of the id."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "v").toPandas()  # bounded by SAMPLE
    x = np.array(sample["v"].tolist(), np.float64)
    return fit(x, min(centroids(n), max(1, len(x) // 8)), k)


def search(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The k nearest found of each query by inner product: (query_id, rank, vec_id, score), score in double precision.

    Queries are the valid rows for which the condition ``is_query`` (on the column ``id``) holds; candidates are all valid rows of
    another id. Ties go to the smaller id; with fewer than k candidates all are returned. Null ids and invalid vectors
    take no part; other columns are left out. Rows that repeat an id are entries each. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows, n = materialize(valid(vectors, id_col, vec_col), "ann_vectors")
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    book = fitted(rows, n, k)
    n_cells = len(book.first) * len(book.second)
    width = len(book.second)
    shared = spark.sparkContext.broadcast(book)

    def code(batches):
        for batch in batches:
            if batch.num_rows:
                v = batch.column(1)
                m = v.flatten().to_numpy().reshape(batch.num_rows, -1)
                one, two = shared.value.cells(m)
                yield pa.RecordBatch.from_arrays([batch.column(0), v, pa.array(one * width + two, pa.int32())],
                                                 names=["id", "v", "cell"])

    coded, _ = materialize(rows.mapInArrow(code, "id long, v array<double>, cell int"), "ann_entries")
    counts = np.zeros(n_cells, np.int64)
    for r in coded.groupBy("cell").count().collect():  # at most MOST^2 cells
        counts[r["cell"]] = r["count"]
    # rows of centroids are dealt to buckets; a bucket's entries to parts of bounded size
    per_row = counts.reshape(-1, width).sum(axis=1)
    n_buckets = int(min(len(book.first), max(16, n // 200_000)))
    bucket_size = np.bincount(np.arange(len(per_row)) % n_buckets, weights=per_row, minlength=n_buckets)
    parts = np.maximum(1, np.ceil(bucket_size / PART_ENTRIES)).astype(int).tolist()
    # a query's own rows are no candidates: k others are seen even if all of these are
    own = coded.where(is_query).groupBy("id").count().agg(F.max("count")).first()[0] or 0
    entries = int(max(own + k, np.ceil(book.share * n)))
    shared_counts = spark.sparkContext.broadcast(counts.tolist())
    parts_of = F.element_at(F.array(*map(F.lit, parts)), F.col("bucket") + 1)
    stored = coded.withColumn("bucket", F.pmod(F.floor(F.col("cell") / width).cast("int"), F.lit(n_buckets))).select(
        "bucket", F.pmod(F.xxhash64("id"), parts_of).cast("int").alias("part"), F.lit(0).alias("role"), "id", "v", "cell",
        F.lit(None).cast("array<int>").alias("cells"))

    def visit(batches):
        for batch in batches:
            ids, v = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                q = v[i].values.to_numpy()
                cells = np.array(traverse(shared.value.first @ q[:shared.value.cut], shared.value.second @ q[shared.value.cut:],
                                          shared_counts.value, entries), np.int32)
                bucket = cells // width % n_buckets
                used = np.unique(bucket)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([ids[i].as_py()] * len(used), pa.int64()),
                     pa.array([q] * len(used), pa.list_(pa.float64())),
                     pa.array([cells[bucket == b] for b in used], pa.list_(pa.int32()))], names=["bucket", "id", "v", "cells"])

    # a walk over the cells costs far more than its row's bytes tell, so the number of tasks is set
    tasks = max(2 * spark.sparkContext.defaultParallelism, n // 20_000)
    asked = coded.where(is_query).select("id", "v").repartition(tasks, "id").mapInArrow(
        visit, "bucket int, id long, v array<double>, cells array<int>")
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), parts_of - 1))).select(
        "bucket", "part", F.lit(1).alias("role"), "id", "v", F.lit(None).cast("int").alias("cell"), "cells")

    def rerank(batches):
        key, entry, asked_now = None, None, []
        held: tuple[list, list, list] = ([], [], [])

        def answer():
            ids, m, cell = entry
            scores = np.array([a[1] for a in asked_now]) @ m.T
            out = []
            for (query, v, cells), s in zip(asked_now, scores):
                seen = np.zeros(n_cells, bool)
                seen[cells] = True
                at = np.flatnonzero(seen[cell] & (ids != query))
                s = s[at]
                if len(s) > k:
                    least = np.partition(s, len(s) - k)[len(s) - k]
                    least -= SLACK * max(1.0, abs(least))
                    at = at[s >= least]
                # summed row by row, so that equal vectors have equal scores
                s = (m[at] * v).sum(axis=1)
                best = np.lexsort((ids[at], -s))[:k]
                out.append((query, ids[at[best]], s[best]))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.full(len(o[1]), o[0]) for o in out]), pa.int64()),
                 pa.array(np.concatenate([o[1] for o in out]), pa.int64()),
                 pa.array(np.concatenate([o[2] for o in out]), pa.float64())], names=["query_id", "vec_id", "score"])

        for batch in batches:
            for i, now in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)))):
                if now[:2] != key:
                    if asked_now:
                        yield answer()
                    key, entry, asked_now, held = now[:2], None, [], ([], [], [])
                v = batch.column(4)[i].values.to_numpy()
                if now[2] == 0:
                    held[0].append(now[3])
                    held[1].append(v)
                    held[2].append(batch.column(5)[i].as_py())
                elif held[0]:
                    if entry is None:
                        entry = np.array(held[0]), np.array(held[1]), np.array(held[2])
                    asked_now.append((now[3], v, batch.column(6)[i].values.to_numpy()))
                    if len(asked_now) >= QUERY_BLOCK:
                        yield answer()
                        asked_now = []
        if asked_now:
            yield answer()

    dealt = stored.union(asked).repartition("bucket", "part").sortWithinPartitions("bucket", "part", "role")
    found = dealt.mapInArrow(rerank, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
