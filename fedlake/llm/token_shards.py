"""Token-id output: documents encoded with the tokenizers library, written as one wavelet-matrix file per shard.

Jobs: encode (the token table, written once), order by document id in range partitions, build and write
shards of bounded size, read them back. Shards are rows of a Parquet
table, one file's bytes in each, so that Spark's commit protocol and any store it can write hold them; a
shard's bytes are complete in themselves (``wavelet.from_bytes``).
"""

from __future__ import annotations

import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fedlake.session import materialize, scratch_path

from . import wavelet

END_ID = 0
SHARD_TOKENS = 4 << 20
#: Words whose ids a worker remembers; further ones are encoded each time.
REMEMBERED = 800_000
FLUSH_BYTES = 8 << 20

# Every match of byte-level pre-tokenisation ends before a space or line feed that follows a non-blank character, and
# between letters and these signs.
_CHUNK = re.compile(r"\s*\S+|\s+")
_SIGNS = ".,!?#$%&*|;:"
_WORD = re.compile(rf"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([{_SIGNS}]*)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {b: chr(b) if b in prints else chr(next(others)) for b in range(256)}


class Encoder:
    """Ids of texts by the tokenizers library.

    Texts are cut at safe boundaries: into words and, for words not met before, into letters and closing signs.
    Words of letters go to the library's model, anything else through its whole pipeline; the ids of words are remembered.
    With ``added``, the strings of the tokenizer's added tokens have their ids, as the library's default is; otherwise
    they are ordinary text.
    """

    def __init__(self, path: str, added: bool = False):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not added
        tokens = self.tok.get_added_tokens_decoder() if added else {}
        self.added = {t.content: i for i, t in tokens.items()}
        #: around such tokens the text can be cut
        self.cut = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if tokens and not any(
            t.single_word or t.lstrip or t.rstrip or t.normalized for t in tokens.values()) else None
        self.bits = max(1, max(self.tok.get_vocab_size() - 1, 1, *tokens).bit_length())
        self.kind, self.code = ("<u2", "H") if self.bits <= 16 else ("<u4", "I")
        self.letters = _byte_letters()
        self.space = self.letters[0x20]
        #: the bytes of each id
        self.bytes = [i.to_bytes(2 if self.bits <= 16 else 4, "little") for i in range(1 << self.bits)]
        #: ids of words with a space before them, and without; of the former none is empty or ends with a blank
        self.known: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})
        #: ids of a line feed between other characters
        self.feed = self._piped("\n")

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _piped(self, text: str) -> bytes:
        return self._ids(self.tok.encode(text, add_special_tokens=False).ids)

    def _letters(self, word: str, plain: int) -> bytes:
        """Ids of a word of letters."""
        known = self.known[plain]
        ids = known.get(word)
        if ids is None:
            # letters of ASCII stand for themselves
            model = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([self.bytes[t.id] for t in self.tok.model.tokenize(model if plain else self.space + model)])
            if len(known) < REMEMBERED:
                known[word] = ids
        return ids

    def _word(self, word: str, plain: int) -> bytes:
        """Ids of " " + word, or of word itself if ``plain``, between two safe boundaries."""
        ids = self.known[plain].get(word)
        if ids is not None:
            return ids
        if "\n" in word and (lines := word.split("\n")) == word.split():
            # a single line feed between other characters is a match of its own
            return self._word(lines[0], plain) + b"".join([self.feed + self._word(x, 1) for x in lines[1:]])
        letters = word.rstrip(_SIGNS)
        if letters.isascii() and letters.isalpha() or _WORD.fullmatch(word):
            signs = word[len(letters):]
            ids = self._letters(letters, plain)
            if signs:
                ids += self._word(signs, 1)
                if len(self.known[plain]) < REMEMBERED:
                    self.known[plain][word] = ids
            return ids
        ids = self._piped(word if plain else " " + word)
        if len(self.known[plain]) < REMEMBERED and word and not word[-1].isspace():
            self.known[plain][word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, little-endian, in ``kind``."""
        if any(a in text for a in self.added):
            if self.cut is None:
                return self._piped(text)
            ids, at = [], 0
            for m in self.cut.finditer(text):
                ids += [self._ordinary(text[at:m.start()]), self._ids([self.added[m[0]]])]
                at = m.end()
            return b"".join([*ids, self._ordinary(text[at:])])
        return self._ordinary(text)

    def _ordinary(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        if not text:
            return b""
        parts = text.split(" ")
        ids = list(map(self.known[0].get, parts))
        ids[0] = b"" if not parts[0] else self._word(parts[0], 1) if len(parts) == 1 or not parts[0][-1].isspace() else None
        missing = [k for k, i in enumerate(ids) if i is None]
        # a space after a blank is no boundary; words met before never leave one
        if any(k < len(parts) - 1 and (not parts[k] or parts[k][-1].isspace()) for k in missing):
            return b"".join([self._word(c[1:], 0) if c[0] == " " and not c[1:2].isspace() else self._piped(c)
                             for c in _CHUNK.findall(text)])
        for k in missing:
            ids[k] = self._word(parts[k], 0)
        return b"".join(ids)

    def encode_all(self, texts: pa.Array) -> pa.Array:
        """Ids of each of one or more whole texts, as ``encode`` has them, with END_ID after them.

        A word that stands in several places of the texts is looked up once.
        """
        n = len(texts)
        parts = pc.split_pattern(texts, " ")
        bounds = parts.offsets.to_numpy().astype(np.int64)
        first, last, text = bounds[:-1], bounds[1:] - 1, np.repeat(np.arange(n), np.diff(bounds))
        coded = parts.flatten().dictionary_encode()
        codes, words = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known[0].get, words))
        blank = np.zeros(len(words), bool)
        for k in [k for k, i in enumerate(ids) if i is None]:
            w = words[k]
            ids[k] = self._word(w, 0)
            blank[k] = not w or w[-1].isspace()
        heads = [words[c] for c in codes[first].tolist()]
        starts = [self._word(w, 1) if w else b"" for w in heads]
        # a space after a blank is no boundary: such texts, and those with added tokens, are encoded by themselves
        joined = blank[codes]
        joined[last] = False
        joined[first] &= np.array([w != "" for w in heads])
        alone = np.logical_or.reduceat(joined, first)
        for a in self.added:
            alone |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(alone).tolist():
            starts[i] = self.encode(texts[i].as_py())
        # the words' ids in order: a text's start, its further words and the end
        nothing, end = len(words) + n, len(words) + n + 1
        order = np.full(len(codes) + n, end)
        order[np.arange(len(codes)) + text] = np.where(alone[text], nothing, codes)
        order[first + np.arange(n)] = len(words) + np.arange(n)
        found = pa.array([*ids, *starts, b"", self.bytes[END_ID]], pa.binary()).take(pa.array(order))
        _, offsets, data = found.buffers()
        offsets = np.frombuffer(offsets, np.int32)[bounds + np.arange(n + 1)]
        return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), data])


_ENCODERS: dict[tuple[str, bool], Encoder] = {}


def _encoder(path: str, added: bool) -> Encoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks share the cores
    if (path, added) not in _ENCODERS:
        _ENCODERS[path, added] = Encoder(path, added)
    return _ENCODERS[path, added]


def token_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                added: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids): every whole text's ids with END_ID after them, as binary; null texts are empty."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])

    def run(batches):
        enc = _encoder(tokenizer_path, added)
        width = len(enc.bytes[END_ID])
        for batch in batches:
            size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64)
            start = 0
            while start < batch.num_rows:
                stop = min(batch.num_rows, int(np.searchsorted(size, (size[start - 1] if start else 0) + FLUSH_BYTES)) + 1)
                coded = enc.encode_all(batch.column(1).slice(start, stop - start))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start),
                     pc.divide(pc.binary_length(coded).cast(pa.int64()), width), coded], schema=schema)
                start = stop

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def write_shards(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", added: bool = False) -> str:
    """Encode ``docs`` and write their shards in ascending document id order; returns the folder.

    Shards hold about SHARD_TOKENS ids (a longer document is a shard of its own). A null id comes first;
    rows that share an id follow each other by their ids' checksum and length. An empty table writes no shard. With ``added``, strings of added
    tokens have their ids; otherwise they are ordinary text.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "token_shards")
    tokens, _ = materialize(token_table(docs, tokenizer_path, id_col, text_col, added), "token_table")
    order = ["doc_id", "crc", "n_tokens", "place"]
    ordered = tokens.withColumn("crc", F.crc32("ids")).withColumn("place", F.monotonically_increasing_id())
    ordered = ordered.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "n_tokens", "ids")

    def build(batches):
        enc = _encoder(tokenizer_path, added)
        part, held, size, number = TaskContext.get().partitionId(), [], 0, 0
        for batch in batches:
            for d, n, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if held and size + n > SHARD_TOKENS:
                    yield _shard(part, number, held, enc)
                    held, size, number = [], 0, number + 1
                held.append((d, n, ids.as_py()))
                size += n
        if held:
            yield _shard(part, number, held, enc)

    ordered.mapInArrow(build, "part int, number int, n_docs long, n_tokens long, shard binary").write.parquet(path)
    return path


def _shard(part: int, number: int, held: list[tuple], enc: Encoder) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(h[2] for h in held), enc.kind)
    data = wavelet.to_bytes(wavelet.WaveletMatrix.build(ids, enc.bits), [h[0] for h in held], [h[1] for h in held])
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([len(held)], pa.int64()),
         pa.array([len(ids)], pa.int64()), pa.array([data], pa.binary())],
        names=["part", "number", "n_docs", "n_tokens", "shard"])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the shards' own bytes."""
    shards = spark.read.parquet(path)

    def run(batches):
        for batch in batches:
            for part, number, data in zip(*(batch.column(i) for i in range(3))):
                matrix, docs, lengths = wavelet.from_bytes(data.as_py())
                ids = matrix.ids().astype("<u4")
                ends = np.cumsum(lengths, dtype=np.int64)
                starts = ends - lengths
                view = memoryview(ids).cast("B")
                crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.as_py()] * len(docs), pa.int32()), pa.array([number.as_py()] * len(docs), pa.int32()),
                     pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(crc, pa.int64())], names=["part", "number", "doc_id", "inner", "n_tokens", "ids_crc32"])

    read = shards.select("part", "number", "shard").mapInArrow(
        run, "part int, number int, doc_id long, inner long, n_tokens long, ids_crc32 long")
    # ids before a shard: those of earlier partitions (a row per partition) and of its own earlier shards
    sizes = shards.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", before(Window.orderBy("part")).alias("earlier"))
    sizes = sizes.withColumn("own", before(Window.partitionBy("part").orderBy("number")))
    starts = sizes.join(parts, "part").select("part", "number", (F.col("earlier") + F.col("own")).alias("first"))
    return read.join(starts, ["part", "number"]).select(
        "doc_id", (F.col("first") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32")
