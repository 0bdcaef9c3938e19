"""Token shards as wavelet matrices: a succinct file that gives access, counts and places of token ids.

A wavelet matrix keeps ids as bit planes, highest bit first. Below each plane the ids are parted, stably, into
those with bit 0 and those with bit 1. With the number of ones before each block of BLOCK bits (the rank
directory) an id is read, counted or found by one step per plane.

File: MAGIC, a JSON header (length first) and sections compressed with zstd, each found by the header:
the planes, the rank directories, and the document table (ids, null marks, lengths).
"""

from __future__ import annotations

import json
import struct

import numpy as np
import zstandard

MAGIC = b"FLWM1\n"
BLOCK = 512


class WaveletMatrix:
    """Bit planes over ``n`` ids of ``bits`` bits with rank and select."""

    def __init__(self, n: int, bits: int, planes: list[np.ndarray], ranks: list[np.ndarray] | None = None):
        self.n, self.bits, self.planes = n, bits, planes
        self.ranks = ranks if ranks is not None else [self._directory(p) for p in planes]
        self.zeros = [n - self._ones(k, n) for k in range(bits)]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> "WaveletMatrix":
        cur, planes = ids, []
        for k in range(bits - 1, -1, -1):
            one = (cur >> np.array(k, cur.dtype)) & np.array(1, cur.dtype) != 0
            planes.append(np.packbits(one, bitorder="little"))
            if k:  # places are cheaper to take by than masks
                cur = np.concatenate([cur.take(np.flatnonzero(~one)), cur.take(np.flatnonzero(one))])
        return cls(len(ids), bits, planes)

    @staticmethod
    def _directory(plane: np.ndarray) -> np.ndarray:
        step = BLOCK // 8
        counts = np.bitwise_count(plane)
        padded = np.zeros(-(-len(counts) // step) * step, np.uint8)
        padded[:len(counts)] = counts
        per_block = padded.reshape(-1, step).sum(axis=1, dtype=np.uint64)
        return np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32)

    def _ones(self, k: int, i: int) -> int:
        """Ones among the first ``i`` bits of plane ``k``."""
        block = i // BLOCK
        total = int(self.ranks[k][block])
        lo, hi = block * (BLOCK // 8), i // 8
        total += int(np.bitwise_count(self.planes[k][lo:hi]).sum())
        if i % 8:
            total += int(self.planes[k][hi] & ((1 << (i % 8)) - 1)).bit_count()
        return total

    def _bit(self, k: int, i: int) -> int:
        return int(self.planes[k][i >> 3]) >> (i & 7) & 1

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for k in range(self.bits):
            bit = self._bit(k, i)
            ones = self._ones(k, i)
            value = value << 1 | bit
            i = self.zeros[k] + ones if bit else i - ones
        return value

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first ``i`` ids."""
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the first ``i`` ids that equal ``token`` lie below the last plane."""
        if token >> self.bits or token < 0:
            return 0, 0
        lo, hi = 0, i
        for k in range(self.bits):
            a, b = self._ones(k, lo), self._ones(k, hi)
            lo, hi = (self.zeros[k] + a, self.zeros[k] + b) if token >> (self.bits - 1 - k) & 1 else (lo - a, hi - b)
        return lo, hi

    def select(self, token: int, j: int) -> int:
        """Place of the ``j``-th (from 0) occurrence of ``token``."""
        lo, hi = self._range(token, self.n)
        if not 0 <= j < hi - lo:
            raise IndexError(j)
        i = lo + j
        for k in range(self.bits - 1, -1, -1):
            one = token >> (self.bits - 1 - k) & 1
            i = self._place(k, i - self.zeros[k] if one else i, one)
        return i

    def _place(self, k: int, j: int, one: int) -> int:
        """Place of the ``j``-th bit that equals ``one`` in plane ``k``."""
        lo, hi = 0, self.n
        while lo < hi:  # the last place with at most j such bits before it
            mid = (lo + hi + 1) // 2
            ones = self._ones(k, mid)
            if (ones if one else mid - ones) <= j:
                lo = mid
            else:
                hi = mid - 1
        return lo

    def occurrences(self, token: int) -> list[int]:
        """All places of ``token``, ascending."""
        return [self.select(token, j) for j in range(self.count(token))]

    def ids(self) -> np.ndarray:
        """All ids in order, put together plane by plane from the lowest."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        cur = np.zeros(self.n, kind)
        for k in range(self.bits - 1, -1, -1):
            one = np.unpackbits(self.planes[k], count=self.n, bitorder="little").view(bool)
            up = np.empty(self.n, kind)
            up[np.flatnonzero(~one)] = cur[:self.zeros[k]]
            up[np.flatnonzero(one)] = cur[self.zeros[k]:] | np.array(1 << (self.bits - 1 - k), kind)
            cur = up
        return cur


def to_bytes(matrix: WaveletMatrix, doc_ids: list, lengths: list[int]) -> bytes:
    """The file of a shard: the matrix and the documents it holds, in order."""
    null = np.array([d is None for d in doc_ids], np.uint8)
    sections = [np.concatenate(matrix.planes).tobytes() if matrix.n else b"",
                np.concatenate(matrix.ranks).astype("<u4").tobytes(),
                np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(),
                np.array(lengths, "<u4").tobytes()]
    packed = [zstandard.compress(s, 1) for s in sections]
    head = json.dumps({"n": matrix.n, "bits": matrix.bits, "docs": len(doc_ids),
                       "sections": [len(p) for p in packed]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *packed])


def from_bytes(data: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """Matrix, document ids and lengths of a file that ``to_bytes`` made."""
    if data[:len(MAGIC)] != MAGIC:
        raise ValueError("not a token shard")
    at = len(MAGIC) + 4
    size = struct.unpack("<I", data[len(MAGIC):at])[0]
    head = json.loads(data[at:at + size])
    at += size
    raw = []
    for s in head["sections"]:
        raw.append(zstandard.decompress(data[at:at + s]))
        at += s
    n, bits = head["n"], head["bits"]
    step = -(-n // 8)
    bytes_ = np.frombuffer(raw[0], np.uint8)
    planes = [bytes_[k * step:(k + 1) * step] for k in range(bits)]
    entries = -(-step // (BLOCK // 8)) + 1
    ranks_ = np.frombuffer(raw[1], "<u4")
    ranks = [ranks_[k * entries:(k + 1) * entries] for k in range(bits)]
    null = np.frombuffer(raw[3], np.uint8)
    ids = [None if z else int(d) for d, z in zip(np.frombuffer(raw[2], "<i8"), null)]
    return WaveletMatrix(n, bits, planes, ranks), ids, np.frombuffer(raw[4], "<u4")
