"""Token counts of whole texts by a byte-level BPE tokenizer compiled to two deterministic transducers in cascade.

The splitter reads character classes and marks where the pre-tokenizer's matches start. It has STATES states, and
a mark is decided at most one character late. Texts are cut in chunks of CHUNK characters; a chunk's state map (from each
state it may be entered in to the state it is left in) is computed for all chunks at once, maps are composed by a parallel
prefix scan, and with the entry states known a second pass over the chunks gives the marks.

The counter reads the bytes of a match. Every prefix of a match has one last token, and a token follows another in an
encoding exactly if the pair, encoded by itself, gives those two; so the state after some bytes is the set of places where a token
that is not finished may have begun, each with the token that ended there and its count so far relative to now. A transition carries
the change of the count of tokens. States are made when they are first reached, by asking the library's model about
pairs; what a worker holds of them is bounded, and what is forgotten is made again.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 128
#: Characters taken at once; a longer text is taken in several runs.
RUN_CHARS = 2 << 20
#: Counts of matches that a worker remembers, and the longest of them.
REMEMBERED, SHORT = 500_000, 64
#: States of the counter that a worker holds, and pairs of tokens that it has asked the model about.
HELD_STATES, HELD_PAIRS = 400_000, 500_000

# Character classes: letters that end a contraction of one letter, the four letters of 're 've 'll, other letters, numbers, the
# apostrophe, other signs, the space, other white space, and the end of a text.
ONE, R, V, L, E, LETTER, NUMBER, QUOTE, SIGN, SPACE, WHITE, END = range(12)
# States: at a match's start; in letters, numbers, signs; after a space or other white space; after an apostrophe that starts
# a match, and then r, v or l.
BEGIN, IN_LETTERS, IN_NUMBERS, IN_SIGNS, AFTER_SPACE, AFTER_WHITE, AFTER_QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(10)
STATES = 10
_WIDTH = 16  # of the tables' rows


def splitter() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The splitter's tables by (class, state): next state, whether a match starts at this character, and whether one
    starts at the character before it after all."""
    letters, blanks = {ONE, R, V, L, E, LETTER}, {SPACE, WHITE}
    go = np.zeros((12, _WIDTH), np.uint8)
    here, late = np.zeros((12, _WIDTH), bool), np.zeros((12, _WIDTH), bool)

    def fresh(c: int) -> int:
        """State after a character that starts a match."""
        return (IN_LETTERS if c in letters else IN_NUMBERS if c == NUMBER else AFTER_QUOTE if c == QUOTE else IN_SIGNS if c == SIGN
                else AFTER_SPACE if c == SPACE else AFTER_WHITE if c == WHITE else BEGIN)

    def step(s: int, c: int) -> tuple[int, bool, bool]:
        if s == AFTER_QUOTE:
            if c == ONE:
                return BEGIN, False, False  # a contraction ends
            if c in (R, V, L):
                return {R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[c], False, False
            s = IN_SIGNS
        elif s in (QUOTE_R, QUOTE_V, QUOTE_L):
            if c == (L if s == QUOTE_L else E):
                return BEGIN, False, False
            nxt, at, _ = step(IN_LETTERS, c)
            return nxt, at, True  # the apostrophe stood alone
        if s in (AFTER_SPACE, AFTER_WHITE):
            if c in blanks:
                return fresh(c), False, False
            if c == END:
                return BEGIN, True, False
            if s == AFTER_WHITE:
                return fresh(c), True, True
            # the last space of a run belongs to what follows it, an apostrophe included
            return IN_SIGNS if c == QUOTE else fresh(c), False, True
        same = (s == IN_LETTERS and c in letters) or (s == IN_NUMBERS and c == NUMBER) or (
            s == IN_SIGNS and c in (SIGN, QUOTE))
        return (s, False, False) if same else (fresh(c), True, False)

    for c in range(12):
        for s in range(STATES):
            go[c, s], here[c, s], late[c, s] = step(s, c)
    return go.ravel(), here.ravel(), late.ravel()


GO, HERE, LATE = splitter()


def composed(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """State maps applied one after the other, row by row."""
    return np.take_along_axis(then, first.astype(np.intp), axis=1)


def entry_states(maps: np.ndarray) -> np.ndarray:
    """State in which each chunk is entered, the first in BEGIN: an exclusive prefix scan of the chunks' state maps."""
    scanned, reach = maps.copy(), 1
    while reach < len(scanned):
        scanned[reach:] = composed(scanned[:-reach], scanned[reach:])
        reach *= 2
    return np.concatenate([np.array([BEGIN], np.uint8), scanned[:-1, BEGIN]])


def match_starts(classes: np.ndarray) -> np.ndarray:
    """Places where matches start in a sequence of character classes; END classes count as matches of their own.

    Without an END at its end the sequence goes on: its last match may be longer, and a start of its last place missing.
    """
    n = len(classes)
    rows = np.full((-(-n // CHUNK), CHUNK), END, np.uint8)
    rows.ravel()[:n] = classes
    steps = np.ascontiguousarray(rows.T).astype(np.uint16) * _WIDTH
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (len(rows), 1))
    for at in steps:
        maps = GO[at[:, None] + maps]
    state = entry_states(maps)
    before = np.empty(steps.shape, np.uint16)
    for k, at in enumerate(steps):
        before[k] = at + state
        state = GO[before[k]]
    flat = before.T.ravel()
    marks = HERE[flat[:n]]
    marks[:-1] |= LATE[flat[1:n]]
    return np.flatnonzero(marks)


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it prints, else one from U+0100 on."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


def compile_classes(path: str) -> bytes:
    """Class of every code point (zlib), as the library itself splits: letters and numbers are the code points that one
    of today's Unicode tables calls so and that the library joins to a letter or number before them.

    Raises ValueError for a tokenizer that is not plain byte-level BPE.
    """
    import regex
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and not any(model.get(k) for k in (
        "dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        and spec.get("normalizer") is None
        and not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")))
    if not plain:
        raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    every = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000], "<u4").tobytes().decode("utf-32-le")
    out = np.full(0x110000, SIGN, np.uint8)
    for pattern, joins, kind in ((r"\p{L}", "a", LETTER), (r"\p{N}", "1", NUMBER)):
        found = regex.findall(pattern, every)
        for at in range(0, len(found), 1 << 14):
            part = found[at:at + (1 << 14)]
            starts = np.array([a for _, (a, _) in split("".join([f"\n{joins}{c}" for c in part]))])
            joined = np.ones(3 * len(part), bool)
            joined[starts] = False
            out[[ord(c) for c, j in zip(part, joined[2::3]) if j]] = kind
    out[[ord(c) for c in regex.findall(r"\s", every)]] = WHITE
    for chars, kind in (("stmd", ONE), ("r", R), ("v", V), ("l", L), ("e", E), ("'", QUOTE), (" ", SPACE)):
        out[[ord(c) for c in chars]] = kind
    return zlib.compress(out.tobytes())


class Counter:
    """The counter: a transducer over bytes whose transitions carry changes of the token count, made as it is used."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        added = {t.content: i for i, t in self.tok.get_added_tokens_decoder().items()}
        byte_of = {c: b for b, c in enumerate(self.letters)}
        #: the vocabulary as a tree: (node << 8 | byte) -> node, and the token that ends at a node
        self.tree: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        self.inner: set[int] = set()
        self.name: dict[int, str] = {}
        nodes = 1
        for word, i in self.tok.get_vocab(with_added_tokens=True).items():
            if word in added:
                continue
            node = 0
            for c in word:
                key = node << 8 | byte_of[c]
                self.inner.add(node)
                node = self.tree.get(key, 0)
                if not node:
                    node = self.tree[key] = nodes
                    nodes += 1
            self.ends[node] = i
            self.name[i] = word
        self.pairs: dict[int, bool] = {}
        self.known: dict[str, int] = {}
        self._begin()

    def _begin(self) -> None:
        """Hold the start state only."""
        self.states: list[tuple] = [((0, -1, 0),)]
        self.number = {self.states[0]: 0}
        #: (state << 8 | byte) -> (next state, change of the count)
        self.steps: dict[int, tuple[int, int]] = {}

    def follows(self, last: int, token: int) -> bool:
        """Whether the encoding of the two tokens' bytes is those tokens; last -1 stands for a match's start."""
        key = last << 32 | token
        fits = self.pairs.get(key)
        if fits is None:
            if len(self.pairs) > HELD_PAIRS:
                self.pairs.clear()
            want = [token] if last < 0 else [last, token]
            got = self.tok.model.tokenize("".join([self.name[i] for i in want]))
            fits = self.pairs[key] = [t.id for t in got] == want
        return fits

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        """Make the transition of a state by a byte."""
        token, change, begun = -1, 0, []
        for node, last, count in self.states[state]:
            node = self.tree.get(node << 8 | byte, 0)
            if not node:
                continue
            if token < 0:
                end = self.ends.get(node, -1)
                if end >= 0 and self.follows(last, end):
                    token, change = end, count + 1
            if node in self.inner:
                begun.append((node, last, count))
        if token < 0:
            raise ValueError("the vocabulary lacks a byte")
        after = (*[(node, last, count - change) for node, last, count in begun], (0, token, 0))
        to = self.number.get(after)
        if to is None:
            to = self.number[after] = len(self.states)
            self.states.append(after)
        made = self.steps[state << 8 | byte] = (to, change)
        return made

    def match(self, text: str) -> int:
        """Number of tokens of one match of the pre-tokenizer."""
        state = count = 0
        steps = self.steps
        for byte in text.encode():
            made = steps.get(state << 8 | byte)
            state, change = made if made is not None else self._step(state, byte)
            count += change
        return count

    def matches(self, texts: list[str]) -> list[int]:
        """Numbers of tokens of matches, those met before from memory."""
        counts = list(map(self.known.get, texts))
        if None in counts:
            if len(self.states) > HELD_STATES:
                self._begin()
            if len(self.known) > REMEMBERED:
                self.known.clear()
            known = self.known
            for i, c in enumerate(counts):
                if c is None:
                    word = texts[i]
                    c = known.get(word)
                    if c is None:
                        c = self.match(word)
                        if len(word) <= SHORT:
                            known[word] = c
                    counts[i] = c
        return counts


class Transducer:
    """Splitter and counter of a tokenizer file; ``classes`` as ``compile_classes`` gives them."""

    def __init__(self, path: str, classes: bytes):
        self.classes = np.frombuffer(zlib.decompress(classes), np.uint8)
        self.counter = Counter(path)
        added = sorted((t.content for t in self.counter.tok.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None

    def _classes(self, text: str) -> np.ndarray:
        return self.classes[np.frombuffer(text.encode("utf-32-le"), "<u4")]

    def _pieces(self, text: str) -> list[str]:
        """The text between the strings of added tokens; each such string is one token."""
        return self.added.split(text) if self.added else [text]

    def long(self, text: str) -> int:
        """Number of tokens of a text of any length, in runs that begin where a match is known to start."""
        count, at, size = 0, 0, RUN_CHARS
        while at < len(text):
            run = text[at:at + size]
            last = at + len(run) == len(text)
            classes = self._classes(run)
            starts = match_starts(np.append(classes, np.uint8(END)) if last else classes)
            if not last and len(starts) < 2:
                size *= 2  # one match fills the run
                continue
            bounds = starts.tolist()
            count += sum(self.counter.matches([run[a:b] for a, b in zip(bounds, bounds[1:])]))
            at, size = (len(text), size) if last else (at + bounds[-1], RUN_CHARS)
        return count

    def counts(self, texts: list[str]) -> list[int]:
        """Numbers of tokens of whole texts, taken together in runs of bounded length."""
        out = [0] * len(texts)
        held: list[tuple[int, str]] = []
        size = 0
        for i, text in enumerate(texts):
            pieces = self._pieces(text)
            out[i] += len(pieces) - 1
            for piece in pieces:
                if len(piece) > RUN_CHARS:
                    out[i] += self.long(piece)
                elif piece:
                    held.append((i, piece))
                    size += len(piece)
                    if size >= RUN_CHARS:
                        self._together(held, out)
                        held, size = [], 0
        if held:
            self._together(held, out)
        return out

    def _together(self, held: list[tuple[int, str]], out: list[int]) -> None:
        """Add the numbers of tokens of pieces of texts to ``out``."""
        run = "\0".join([p for _, p in held]) + "\0"
        ends = np.cumsum([len(p) + 1 for _, p in held]) - 1
        classes = self._classes(run)
        classes[ends] = END
        starts = match_starts(classes)
        bounds = starts.tolist()
        counts = np.array(self.counter.matches([run[a:b] for a, b in zip(bounds, [*bounds[1:], len(run)])]), np.int64)
        at_end = np.searchsorted(starts, ends)  # an END starts a match of its own
        counts[at_end] = 0
        total = np.cumsum(counts)[at_end]
        for (i, _), n in zip(held, np.diff(total, prepend=0).tolist()):
            out[i] += n


@lru_cache(maxsize=2)
def _transducer(path: str, classes: bytes) -> Transducer:
    return Transducer(path, classes)


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) of every row of ``docs``, as the tokenizers library counts by default.

    No begin or end token is counted; the string of an added token in a text is that one token. Null texts are empty and
    have no tokens; null ids stay, of any type; repeated rows count each; other columns are left out. The tokenizer is a
    byte-level BPE file that all workers can read; others raise ValueError. An empty table gives no rows.
    """
    classes = compile_classes(tokenizer_path)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        made = _transducer(tokenizer_path, classes)
        for batch in batches:
            at = 0
            for texts in _runs(batch.column(2)):
                n = pa.array(made.counts(texts), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), batch.column(1).slice(at, len(texts)), n],
                    names=["id", "n_bytes", "n_tokens"])
                at += len(texts)

    counted = rows.mapInArrow(run, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def _runs(column):
    """The texts of an Arrow column in runs of bounded length."""
    held, size = [], 0
    for t in column:
        held.append(t.as_py())
        size += len(held[-1])
        if size >= RUN_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held
