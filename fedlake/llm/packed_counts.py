"""Counts of hashed items over blocks of rows, exchanged as packed rows.

A block sends its distinct keys with their counts, split by hash range (bucket); the task of a bucket sums the counts
and answers each block with the totals in the order of its keys. One row holds the keys of a block and
bucket as sorted differences, which takes a fraction of the space and time of a row per key. A
key is sent once by each block however often it stands there, so a frequent key is no hot spot.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

#: Text in a block and keys in a bucket, about.
BLOCK_BYTES = 8 << 20
BUCKET_KEYS = 3 << 20

EXPLODED = "block int, bucket int, keys binary, counts binary"
COUNTED = "block int, bucket int, totals binary"


def n_blocks(n_bytes: int) -> int:
    return max(1, math.ceil(n_bytes / BLOCK_BYTES))


def bucket_shift(n_keys: int, bits: int) -> int:
    """Bits of a key of ``bits`` bits below its bucket's number, for about ``n_keys`` keys from all blocks."""
    return bits - min(bits, max(0, math.ceil(math.log2(max(1, n_keys) / BUCKET_KEYS))))


def pack(x: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").ravel()


def to_rows(block: int, keys: np.ndarray, counts: np.ndarray, shift: int) -> pa.Table:
    """Rows of a block's distinct keys (ascending) and their counts."""
    bucket = (keys >> np.uint64(shift)).astype(np.int64)
    used, starts = np.unique(bucket, return_index=True)
    ends = np.append(starts[1:], len(bucket))
    return pa.table({
        "block": pa.array([block] * len(used), pa.int32()), "bucket": pa.array(used, pa.int32()),
        # differences to the key before; the first one keeps its value
        "keys": pa.array([pack(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in zip(starts, ends)], pa.binary()),
        "counts": pa.array([pack(counts[a:b]) for a, b in zip(starts, ends)], pa.binary())})


def _add(t: pa.Table) -> pa.Table:
    keys = [np.cumsum(unpack(k.as_py()), dtype=np.uint64) for k in t.column("keys")]
    counts = np.concatenate([unpack(c.as_py()) for c in t.column("counts")]).astype(np.int64)
    all_keys = np.concatenate(keys)
    order = np.argsort(all_keys, kind="stable")
    s = all_keys[order]
    fresh = np.ones(len(s), bool)
    fresh[1:] = s[1:] != s[:-1]
    sums = np.add.reduceat(counts[order], np.flatnonzero(fresh))
    totals = np.empty(len(s), np.int64)
    totals[order] = sums[np.cumsum(fresh) - 1]
    ends = np.cumsum([len(k) for k in keys])
    return pa.table({"block": t.column("block"), "bucket": t.column("bucket"),
                     "totals": pa.array([pack(totals[e - len(k):e]) for k, e in zip(keys, ends)], pa.binary())})


def counted(exploded: DataFrame) -> DataFrame:
    """Totals over all blocks for each row of EXPLODED."""
    return exploded.groupBy("bucket").applyInArrow(_add, COUNTED)


def totals_of(rows: pa.Table) -> np.ndarray:
    """Totals of a block's keys, ascending by key, from its rows of COUNTED."""
    by_bucket = sorted(zip(rows.column("bucket").to_pylist(), rows.column("totals")), key=lambda r: r[0])
    return np.concatenate([np.zeros(0, np.int64), *(unpack(x.as_py()).astype(np.int64) for _, x in by_bucket)])
