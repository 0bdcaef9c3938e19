import base64
import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from fedlake.llm import byte_bpe, lm_backoff, packed_counts, token_shards, wavelet

from .fixtures import documents, texts

RANKS = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encode_and_decode(spark, reference):
    docs = documents(spark)
    got = byte_bpe.decode(byte_bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    want = Counter()
    for r in docs.collect():
        ids = np.array(reference.encode_ordinary(r.text or ""), "<u4").tobytes()
        want[r.doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), (r.text or "").encode()] += 1
    assert Counter((r.doc_id, r.n_tokens, hashlib.sha256(r.ids).hexdigest(), bytes(r.decoded)) for r in got) == want


def test_pieces_give_the_ids_of_the_whole(reference):
    enc = byte_bpe.encoder(RANKS, P.PATTERN)
    samples = [*texts()[-4:], "a \n b  c d \t\n e's 12 3!? " * 300, " \n" * 500 + "x", "it's " * 100 + "\x1c\x1d z "]
    for t in samples:
        cut = list(byte_bpe.pieces(t, 50))
        assert "".join(cut) == t
        assert [i for p in cut for i in reference.encode_ordinary(p)] == reference.encode_ordinary(t)
        assert byte_bpe.decode_ids(enc, byte_bpe.encode_text(enc, t)).decode() == t
    # ids that are no valid UTF-8 decode to their bytes
    half = reference.encode_single_token(b"\xc3")
    assert byte_bpe.decode_ids(enc, np.array([half], "<u4").tobytes()) == b"\xc3"


def test_added_tokens_as_the_library_has_them(spark, tmp_path):
    from fedlake.llm.queries import QUERIES

    end = "<|endoftext|>"
    samples = ["", end, end * 2, f"a {end} b", f"a  {end}\n\n b c{end}", f"quote '{end}', and <|endoftext| >.", *texts()[-8:]]
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = [tok.encode(t, add_special_tokens=False).ids for t in samples]
    enc = token_shards.Encoder(P.path("byte_bpe_50k.json"), added=True)
    assert [np.frombuffer(enc.encode(t), enc.kind).tolist() for t in samples] == want and 50256 in want[1]
    documents(spark, [(i, t, "en", "s", 1) for i, t in enumerate(samples)]).write.parquet(f"{tmp_path}/documents.parquet")
    at = 0
    for r, ids in zip(QUERIES["op8_token_shards"](spark, str(tmp_path)).orderBy("start").collect(), want):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids) + 1, zlib.crc32(np.array([*ids, 0], "<u4").tobytes()))
        at += r.n_tokens


@pytest.mark.parametrize("added", [True, False])
def test_texts_encoded_together_have_the_ids_of_each(added):
    bits = ["", " ", "\n", "\n\n", "\t", "\r\n", "the", "The,", "it's", "don't", "Größe", "çé.", "12", "a1", "x\ny", "日本",
            "\u3000", "ª", "ŉ", "!?", "é\n", "<|endoftext|>"]
    rng = np.random.default_rng(3)
    samples = ["", " ", "  ", "a ", " a", "a\n", "\n", "a \n b", "a\t b", *texts()[-8:]]
    samples += ["".join(bits[i] + " " * (i % 3) for i in rng.integers(0, 66, rng.integers(0, 12)) % len(bits)) for _ in range(2_000)]
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = not added
    enc = token_shards.Encoder(P.path("byte_bpe_50k.json"), added=added)
    for n in (1, 7, len(samples)):
        got = [x for i in range(0, len(samples), n) for x in enc.encode_all(pa.array(samples).slice(i, n)).to_pylist()]
        assert [np.frombuffer(x, enc.kind).tolist() for x in got] == [
            tok.encode(t, add_special_tokens=False).ids + [token_shards.END_ID] for t in samples]


def test_words_that_repeat_are_encoded_once(spark, monkeypatch):
    seen = Counter()
    for name in ("_piped", "_word"):
        def counted(self, text, *rest, _fn=getattr(token_shards.Encoder, name), _name=name):
            seen[_name] += 1
            return _fn(self, text, *rest)
        monkeypatch.setattr(token_shards.Encoder, name, counted)
    monkeypatch.setattr(token_shards, "REMEMBERED", 0)
    enc = token_shards.Encoder(P.path("byte_bpe_50k.json"))
    # line feeds do not go through the whole pipeline each time
    enc.encode("one line\nand another " * 200)
    assert seen["_piped"] < 10
    # no word is remembered, yet those of one batch are looked up once
    seen.clear()
    monkeypatch.setattr(token_shards, "_ENCODERS", {})
    batch = pa.RecordBatch.from_arrays([pa.array(range(50)), pa.array(["some words of a text"] * 50)], names=["doc_id", "text"])
    run = []
    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", lambda self, f, schema: run.append(f))
    token_shards.token_table(spark.createDataFrame([(1, "")], "doc_id long, text string"), P.path("byte_bpe_50k.json"))
    (out,) = run[0](iter([batch]))
    assert out.column(1).to_pylist() == [6] * 50 and seen["_word"] <= 50 + 5


def test_shards_read_back(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(token_shards, "SHARD_TOKENS", 5_000)
    docs = documents(spark)
    tok = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    path = token_shards.write_shards(docs, P.path("byte_bpe_50k.json"))
    got = sorted(token_shards.read_shards(spark, path).collect(), key=lambda r: r.start)
    ids = {}
    for r in docs.collect():
        ids.setdefault(r.doc_id, []).append(tok.encode(r.text or "", add_special_tokens=False).ids + [0])
    at = 0
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in docs.collect()), key=lambda i: (i is not None, i))
    for r in got:
        crcs = {zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids[r.doc_id]}
        assert (r.start, r.n_tokens) == (at, len(ids[r.doc_id][0])) and r.ids_crc32 in crcs
        at += r.n_tokens
    shard = spark.read.parquet(path).orderBy("part", "number").collect()
    assert len(shard) > 3
    # a shard's bytes are a file of their own
    file = tmp_path / "shard"
    file.write_bytes(shard[0].shard)
    matrix, names, lengths = wavelet.from_bytes(file.read_bytes())
    whole = matrix.ids()
    assert len(names) == len(lengths) and int(lengths.sum()) == matrix.n == len(whole)
    assert [matrix.access(i) for i in range(0, matrix.n, 97)] == whole[::97].tolist()


def test_wavelet_matrix():
    rng = np.random.default_rng(4)
    for n, top in ((0, 10), (1, 1), (700, 3), (5000, 50_257), (1300, 100_000)):
        ids = (rng.integers(0, top, n) ** 2 % top).astype(np.uint16 if top < 65_536 else np.uint32)
        bits = max(1, (top - 1).bit_length())
        made = wavelet.WaveletMatrix.build(ids, bits)
        matrix, docs, lengths = wavelet.from_bytes(wavelet.to_bytes(made, [7, None], [n, 0]))
        assert docs == [7, None] and lengths.tolist() == [n, 0]
        assert matrix.ids().tolist() == ids.tolist()
        for token in {*ids[:5].tolist(), top - 1, 0, 1 << bits}:
            places = np.flatnonzero(ids == token).tolist()
            assert matrix.count(token) == len(places) and matrix.occurrences(token) == places
            assert matrix.rank(token, n // 2) == sum(x < n // 2 for x in places)
        with pytest.raises(IndexError):
            matrix.access(n)


def backoff(rows, order=3, factor=0.4):
    total, own = Counter(), []
    for t in rows:
        w = t.encode().split()
        c = Counter(tuple(w[j:j + n]) for n in range(1, order + 1) for j in range(len(w) - n + 1))
        own.append(c)
        total.update(c)
    words = sum(v for g, v in total.items() if len(g) == 1)
    for t, mine in zip(rows, own):
        w, log_s, shorter = t.encode().split(), 0.0, 0
        for j in range(len(w)):
            longest = min(order, j + 1)
            for n in range(longest, -1, -1):
                g = tuple(w[j - n + 1:j + 1])
                if n and total[g] > mine[g]:
                    below = words - len(w) if n == 1 else total[g[:-1]] - mine[g[:-1]]
                    log_s += (longest - n) * math.log(factor) + math.log((total[g] - mine[g]) / below)
                    break
                if not n:
                    log_s += longest * math.log(factor) - math.log(words - len(w) + 1)
            shorter += n < longest
        yield len(w), log_s, shorter


@pytest.mark.parametrize("order", [1, 2, 3])
def test_backoff_scores(spark, monkeypatch, order):
    monkeypatch.setattr(packed_counts, "BLOCK_BYTES", 20_000)
    monkeypatch.setattr(packed_counts, "BUCKET_KEYS", 3_000)
    docs = documents(spark)
    rows = docs.collect()
    want = sorted(zip([(r.doc_id is None, r.doc_id) for r in rows], backoff([r.text or "" for r in rows], order)), key=str)
    got = sorted([((r.doc_id is None, r.doc_id), (r.n_words, r.log_score, r.shortened)) for r in
                  lm_backoff.score(docs, order).collect()], key=str)
    assert len(got) == len(want)
    for (i, a), (j, b) in zip(got, want):
        assert i == j and a[0] == b[0] and a[2] == b[2] and a[1] == pytest.approx(b[1])


@pytest.mark.parametrize("order", [1, 3])
def test_scores_by_rows_are_the_scores(spark, order):
    docs = documents(spark)
    got, want = (sorted(f(docs, order).collect(), key=lambda r: (str(r.doc_id), r.n_words, r.shortened, r.log_score))
                 for f in (lm_backoff.score_by_rows, lm_backoff.score))
    assert len(got) == len(want) == docs.count()
    for a, b in zip(got, want):
        assert (a.doc_id, a.n_words, a.shortened) == (b.doc_id, b.n_words, b.shortened)
        assert a.log_score == pytest.approx(b.log_score) and a.mean_score == (b.mean_score and pytest.approx(b.mean_score))


def test_empty_tables(spark):
    none = documents(spark, []).limit(0)
    assert byte_bpe.decode(byte_bpe.encode(none, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0
    assert token_shards.read_shards(spark, token_shards.write_shards(none, P.path("byte_bpe_50k.json"))).count() == 0
    assert lm_backoff.score(none).count() == 0
    assert lm_backoff.score_by_rows(none).count() == 0
