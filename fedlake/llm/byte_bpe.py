"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The work is per row, in Arrow batches: Spark deals out the rows, each Python
worker loads the rank file once. Long texts are cut first, at places where the pattern's matches
always end, so that the ids of the pieces are the ids of the whole.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .memory import released

#: Texts are encoded in pieces of about so many characters.
PIECE_CHARS = 1 << 16
#: Output batches are cut at about so many bytes.
FLUSH_BYTES = 8 << 20

# No alternative of the pattern matches a space or line feed after another kind of
# character, and none looks back, so a match ends before one that follows a non-blank.
_BOUNDARY = re.compile(r"(?<=\S)[ \n]")

_ENCODERS: dict = {}


def encoder(rank_path: str, pattern: str):
    """The tiktoken encoding of a rank file, loaded once a process."""
    key = (rank_path, pattern)
    if key not in _ENCODERS:
        import tiktoken

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        _ENCODERS[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[key]


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Cut ``text`` at safe boundaries into pieces of ``limit`` characters or a little more."""
    start = 0
    while len(text) - start > limit:
        m = _BOUNDARY.search(text, start + limit)
        if m is None:
            break
        yield text[start:m.start()]
        start = m.start()
    yield text[start:]


def encode_text(enc, text: str) -> bytes:
    """Ids of a whole text as little-endian unsigned 32-bit integers."""
    return b"".join(np.asarray(enc.encode_to_numpy(p, disallowed_special=()), dtype="<u4").tobytes()
                    for p in pieces(text))


def decode_ids(enc, ids: bytes) -> bytes:
    """The raw bytes of little-endian 32-bit ids; they need not be valid UTF-8."""
    return enc.decode_bytes(np.frombuffer(ids, dtype="<u4").tolist())


def _batches(schema: pa.Schema, rows: Iterator[tuple], weigh: int) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of bounded size; ``weigh`` is the place of the large value."""
    held: list[tuple] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[weigh]) + 64
        if size >= FLUSH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held), schema)], schema=schema)


def encode(docs: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every whole text: ``(id_col, n_tokens, ids)``, one row per input row.

    ``ids`` is binary, little-endian unsigned 32-bit integers. Special tokens are ordinary text. Null and
    empty texts give no ids; null ids of documents stay; repeated rows are encoded each. Other columns are
    left out, whatever their names. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        enc = encoder(rank_path, pattern)

        def made():
            for batch in batches:
                ids = batch.column(0)
                for i, text in enumerate(batch.column(1)):
                    coded = encode_text(enc, text.as_py())
                    yield ids[i].as_py(), len(coded) // 4, coded

        schema = pa.schema([("id", _ARROW[id_type]), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        yield from _batches(schema, made(), 2)

    coded = rows.mapInArrow(lambda batches: released(run(batches)), f"id {id_type}, n_tokens long, ids binary")
    return coded.withColumnRenamed("id", id_col)


def decode(coded: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded``, the bytes of ``ids_col``, to rows that ``encode`` made. Null ids count as none."""
    names = coded.columns
    i = names.index(ids_col)

    def run(batches):
        enc = encoder(rank_path, pattern)
        for batch in batches:
            start, size = 0, 0
            texts: list[bytes] = []
            for k, ids in enumerate(batch.column(i)):
                texts.append(decode_ids(enc, ids.as_py() or b""))
                size += len(texts[-1])
                if size >= FLUSH_BYTES:
                    yield _appended(batch.slice(start, k + 1 - start), texts)
                    start, size, texts = k + 1, 0, []
            if texts:
                yield _appended(batch.slice(start), texts)

    schema = StructType([*coded.schema.fields, StructField("decoded", BinaryType())])
    return coded.mapInArrow(lambda batches: released(run(batches)), schema)


def _appended(batch: pa.RecordBatch, texts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())],
                                      names=[*batch.schema.names, "decoded"])


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
