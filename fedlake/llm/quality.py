"""Quality classifier: random-indexing word vectors pooled per document, then a small network with
temperature-calibrated probabilities.

Random indexing: every term has a fixed sparse index vector (a few +1 and -1 of DIM places, by hash). The context vector
of a word is the sum of the index vectors of the words beside it, over all occurrences in all documents.
Words share SLOTS hashed slots, so the table of context vectors is SLOTS x DIM whatever
the corpus; the sums are of whole numbers, so they do not depend on the order of tasks.

A document is the mean of its words' context vectors and of the index vectors of their shapes (runs of letters,
capitals, digits and other signs; a word that repeats the one before has a shape of its own). Longer words than PIECE
are cut, and each piece is a word. The network has one
hidden layer and is trained in numpy on at most ``sample`` labelled documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .memory import release, released

DIM = 64
SLOTS = 8192
SHAPES = 512
NONZERO = 4
BLOCK = 256
#: Characters of a word, at most.
PIECE = 64
#: Labelled documents the network is fitted to, at most.
SAMPLE = 20_000
THRESHOLD = 0.7
#: Words are looked up in a memory of so many entries a worker.
REMEMBERED = 300_000
#: Texts are taken in runs of about so many characters, so long texts do not fill a worker's memory.
RUN_CHARS = 4 << 20

_AGAIN = 0  # shape of a word that repeats the one before it
_RUNS = [(re.compile(r"[^\W\d_]+"), lambda m: "X" if len(m[0]) > 1 and m[0].isupper() else "x"), (re.compile(r"\d+"), "9"),
         (re.compile(r"(.)\1+"), r"\1")]


@lru_cache
def index_vectors(n: int, salt: int) -> np.ndarray:
    """Sparse ternary index vectors of n terms."""
    rng = np.random.default_rng(salt)
    out = np.zeros((n, DIM), np.int8)
    for row in out:
        places = rng.choice(DIM, NONZERO, replace=False)
        row[places] = rng.permutation([1, -1] * (NONZERO // 2))
    return out


def shape(word: str) -> int:
    """Number of a word's shape, from 1."""
    s = word
    for pattern, by in _RUNS:
        s = pattern.sub(by, s)
    return 1 + xxhash.xxh3_64_intdigest(s) % (SHAPES - 1)


class Terms:
    """Slots and shapes of words, remembered."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        known = self.known
        codes = list(map(known.get, words))
        if None in codes:
            if len(known) > REMEMBERED:
                known.clear()
            for i, c in enumerate(codes):
                if c is None:
                    w = words[i]
                    if len(w) > PIECE:  # never remembered, so no long word is missed
                        return self.of([x[at:at + PIECE] for x in words for at in range(0, len(x), PIECE)])
                    codes[i] = known[w] = xxhash.xxh3_64_intdigest(w) % SLOTS * SHAPES + shape(w)
        code = np.array(codes, np.int64)
        slots, shapes = code // SHAPES, code % SHAPES
        shapes[1:][slots[1:] == slots[:-1]] = _AGAIN
        return slots, shapes


def _texts(column) -> Iterator[list[str]]:
    """The texts of an Arrow column in runs of bounded length."""
    held, size = [], 0
    for t in column:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= RUN_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _terms(terms: Terms, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots and shapes of the words of all texts, and each text's number of words."""
    found = [terms.of(w) if (w := t.split()) else (np.zeros(0, np.int64),) * 2 for t in texts]
    counts = np.array([len(f[0]) for f in found])
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), counts


def context_table(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Context vectors of all slots over every document: SLOTS x DIM, scaled to unit length."""
    def run(batches):
        # the places of each index vector's +1s, then of its -1s
        terms, places = Terms(), np.argsort(-index_vectors(SLOTS, 1), axis=1, kind="stable").T
        places = [*places[:NONZERO // 2], *places[DIM - NONZERO // 2:]]
        sums = np.zeros(SLOTS * DIM, np.int64)
        for batch in batches:
            for texts in _texts(batch.column(0)):
                slots, _, counts = _terms(terms, texts)
                ends = np.cumsum(counts)
                inner = np.ones(len(slots), bool)  # has a neighbour to the right in the same text
                inner[ends[counts > 0] - 1] = False
                left = np.flatnonzero(inner)
                a, b = slots[left], slots[left + 1]
                for at, other in ((a, b), (b, a)):
                    for k in range(NONZERO):
                        counted = np.bincount(at * DIM + places[k][other], minlength=SLOTS * DIM)
                        if k < NONZERO // 2:
                            sums += counted
                        else:
                            sums -= counted
        blocks = sums.reshape(-1, BLOCK * DIM)
        used = [i for i in range(len(blocks)) if blocks[i].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([blocks[i].astype("<i8").tobytes() for i in used], pa.binary())],
            names=["block", "sums"])

    def add(key: tuple[Any, ...], parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BLOCK * DIM, np.int64)
        for part in parts:
            for s in part["sums"]:
                total += np.frombuffer(s, "<i8")
        yield pd.DataFrame({"block": [key[0]], "sums": [total.astype("<i8").tobytes()]})

    rows = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        lambda batches: released(run(batches)), "block int, sums binary")
    table = np.zeros((SLOTS // BLOCK, BLOCK * DIM))
    for r in rows.groupBy("block").applyInPandas(add, "block int, sums binary").collect():  # SLOTS / BLOCK rows
        table[r["block"]] = np.frombuffer(r["sums"], "<i8")
    table = table.reshape(SLOTS, DIM)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1.0)).astype(np.float32)


def pooled(terms: Terms, texts: list[str], table: np.ndarray) -> np.ndarray:
    """Features of texts: pooled context vectors, pooled shape vectors, and the logarithm of the number of words."""
    shapes_index = index_vectors(SHAPES, 2).astype(np.float32)
    out = np.zeros((len(texts), 2 * DIM + 1), np.float32)
    slots, shapes, counts = _terms(terms, texts)
    ends = np.cumsum(counts)
    for i, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
        if n:
            total = np.zeros(2 * DIM)
            for at in range(end - n, end, 1 << 16):
                to = min(end, at + (1 << 16))
                total[:DIM] += table[slots[at:to]].sum(axis=0)
                total[DIM:] += np.bincount(shapes[at:to], minlength=SHAPES) @ shapes_index
            out[i, :-1] = total / n
    out[:, -1] = np.log1p(counts) / 8
    return out


class Network:
    """Two layers in numpy: tanh units, then one logistic unit; the logit is divided by the temperature."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature=1.0):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2
        self.temperature = temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1)
        return (hidden @ self.w2 + self.b2)[:, 0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, seed: int = 7) -> Network:
    """Train on four fifths of the rows (Adam), choose the temperature on the rest by likelihood.

    Without rows, or with one class only, the network gives that class's share (one half without rows).
    """
    rng = np.random.default_rng(seed)
    n, d = x.shape
    mean, scale = (x.mean(axis=0), x.std(axis=0) + 1e-3) if n else (np.zeros(d), np.ones(d))
    w1, b1 = rng.normal(0, d ** -0.5, (d, hidden)), np.zeros(hidden)
    w2, b2 = rng.normal(0, hidden ** -0.5, (hidden, 1)), np.zeros(1)
    if n < 10 or len(np.unique(y)) < 2:
        share = (y.sum() + 1) / (n + 2)
        return Network(mean, scale, w1, b1, w2 * 0, np.array([np.log(share / (1 - share))]))
    order = rng.permutation(n)
    held, rows = order[:n // 5], order[n // 5:]
    net = Network(mean, scale, w1, b1, w2, b2)
    z = (x - mean) / scale
    params = [net.w1, net.b1, net.w2, net.b2]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        rng.shuffle(rows)
        for at in range(0, len(rows), 256):
            b = rows[at:at + 256]
            h = np.tanh(z[b] @ net.w1 + net.b1)
            p = 1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -30, 30)))
            g = (p - y[b, None]) / len(b)
            gh = g @ net.w2.T * (1 - h * h)
            grads = [z[b].T @ gh + 1e-4 * net.w1, gh.sum(axis=0), h.T @ g + 1e-4 * net.w2, g.sum(axis=0)]
            step += 1
            for k, (param, grad) in enumerate(zip(params, grads)):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad * grad
                param -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    logits = net.logits(x[held])
    losses = {t: np.logaddexp(0, np.where(y[held] > 0, -logits, logits) / t).mean() for t in np.geomspace(0.25, 8, 41)}
    net.temperature = float(min(losses, key=losses.get))
    return net


def held_out(id_col: str = "doc_id"):
    """Rows whose labels are never learned: crc32 of the id as text, modulo 4, is 2. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> tuple[np.ndarray, Network]:
    """Context table over all documents and the network fitted to labelled ones that are not held out.

    At most ``sample`` labels are used, those with the smallest hashes of their ids; only they are broadcast.
    Labels other than 0 and 1 and null ids take no part; an id's repeated rows count each.
    """
    table = context_table(docs, text_col)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    # bounded by sample
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(
        F.broadcast(chosen), "id").select("id", "text", "y")

    def run(batches):
        terms = Terms()
        for batch in batches:
            at = 0
            for texts in _texts(batch.column(1)):
                x = pooled(terms, texts, shared.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(2).slice(at, len(texts)),
                     pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "y", "x"])
                at += len(texts)

    id_type = docs.schema[id_col].dataType.simpleString()
    made = rows.mapInArrow(run, f"id {id_type}, y int, x binary").collect()
    made.sort(key=lambda r: (r["id"], r["y"], bytes(r["x"])))  # the fit does not depend on the order of tasks
    x = np.array([np.frombuffer(r["x"], np.float32) for r in made], np.float64).reshape(len(made), 2 * DIM + 1)
    return table, fit(x, np.array([r["y"] for r in made], np.float64))


def score(docs: DataFrame, table: np.ndarray, net: Network, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with ``score_col`` added: the calibrated probability of label 1 of every whole text.

    Null and empty texts have a score as well (that of a text without words). All columns and rows stay.
    A column of that name is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast((table, net))

    # only the texts go to Python, and only the scores come back
    @F.arrow_udf("double")
    def scores(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        terms = Terms()
        for column in columns:
            yield pa.array(np.concatenate([np.zeros(0), *[shared.value[1].scores(pooled(terms, texts, shared.value[0]))
                                                          for texts in _texts(column)]]), pa.float64())
        del terms
        release()

    return docs.drop(score_col).withColumn(score_col, scores(F.coalesce(F.col(text_col), F.lit(""))))
