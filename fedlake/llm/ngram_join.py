"""N-gram Jaccard join: T-occurrence search with DivideSkip over inverted lists of word shingles.

Two documents link when their sets of word shingles have a Jaccard similarity of at least ``percent`` / 100.

1. Sets. Documents with the same set are one class (they link by themselves); only classes are searched.
2. Lists. Every shingle's number of documents is counted (``packed_counts``). A document of n shingles with fewer than
   ``ceil(percent n / 100)`` that another one has as well links with nothing. Shingles have one global order, rare ones
   first; classes that link share one of the first ``n - ceil(percent n / 100) + 1`` of each, so only those that
   more than one document has are put in inverted lists. A list is named by its smallest class, and classes that share a list form a *bucket*
   under that name. Every linked pair meets in a bucket.
3. Search. Classes are first searched against the index of their buckets' names, which joins most groups of near copies
   to one component at a cost of one row each. Every bucket that still holds several components is then searched in whole: all
   classes outside the name's component against all of the bucket, in blocks of bounded size.
   The search is ``Index.search``: T-occurrence by DivideSkip, followed by the exact test.
4. Components of the links, by ``components.components``.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fedlake.session import materialize

from . import packed_counts
from .components import components
from .memory import release, released
from .mixing import word_count

#: Bits of the hashes that documents are counted by, beyond those that number the words of the corpus.
SPARE_BITS = 10
#: Shingles in the index of a block, about.
BLOCK_TOKENS = 400_000
#: Weight of DivideSkip's choice of long lists.
MU = 0.01
REMEMBERED = 300_000
RUN_CHARS = 4 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


class Shingler:
    """Distinct shingle hashes of texts. Words are [^\\x20\\x09-\\x0D]+ with A-Z lower-cased."""

    def __init__(self, k: int):
        self.k = k
        self.known: dict[bytes, int] = {}

    def hashes(self, text: str) -> np.ndarray:
        """Sorted 64-bit hashes; fewer than ``k`` words are one shingle, no words are none."""
        words = text.encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self.known
        codes = list(map(known.get, words))
        if None in codes:
            if len(known) > REMEMBERED:
                known.clear()
            for i, c in enumerate(codes):
                if c is None:
                    codes[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
        w = np.array(codes, np.uint64)
        k = min(self.k, len(w))
        h = np.full(len(w) - k + 1, k, np.uint64)
        for j in range(k):
            h = h * np.uint64(0x9E3779B97F4A7C15) + w[j:len(w) - k + 1 + j]
            h ^= h >> np.uint64(30)
            h *= _M1
            h ^= h >> np.uint64(27)
            h *= _M2
            h ^= h >> np.uint64(31)
        return np.unique(h)


def needed(n: int, percent: int) -> int:
    """Shingles that a set of n shares at least with any set it links to."""
    return -(-percent * n // 100)


class Index:
    """Inverted lists of the sets of a block."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        self.sizes = [len(s) for s in sets]
        # places are numbered by size: sets of admissible size are a range
        self.order = sorted(range(len(sets)), key=lambda i: self.sizes[i])
        self.by_size = [self.sizes[i] for i in self.order]
        lists: dict[int, list[int]] = defaultdict(list)
        for place, i in enumerate(self.order):
            for t in sets[i].tolist():
                lists[t].append(place)
        self.lists = lists

    def search(self, q: np.ndarray) -> list[int]:
        """Numbers of the sets whose similarity with q is large enough.

        T-occurrence: T = needed(len(q)) of q's lists must hold a set. The longest lists are set aside; a heap merges the others, and where too few lists
        stand at one place it skips all of them to the next possible one; sets that reach T less the number of long
        lists are looked up in those by binary search.
        """
        n, lists = len(q), self.lists
        found = [x for t in q.tolist() if (x := lists.get(t))]
        threshold = max(1, needed(n, self.percent))
        if len(found) < threshold:
            return []
        lo = bisect_left(self.by_size, threshold)  # smaller sets cannot share so many
        hi = bisect_left(self.by_size, 100 * n // self.percent + 1)
        if lo >= hi:
            return []
        found.sort(key=len)
        n_long = min(threshold - 1, int(threshold / (MU * math.log2(len(found[-1]) + 1) + 1)))
        long, short = found[len(found) - n_long:], found[:len(found) - n_long]
        least = threshold - n_long
        heap = []
        for i, x in enumerate(short):
            at = bisect_left(x, lo)
            if at < len(x) and x[at] < hi:
                heap.append((x[at], i, at))
        heapq.heapify(heap)
        out = []
        while len(heap) >= least:
            place = heap[0][0]
            popped = []
            while heap and heap[0][0] == place:
                popped.append(heapq.heappop(heap))
            if len(popped) >= least:
                m = self.by_size[place]
                enough = -(-self.percent * (n + m) // (100 + self.percent))
                count, left = len(popped), n_long
                for x in reversed(long):
                    if count >= enough or count + left < enough:
                        break
                    at = bisect_left(x, place)
                    count += at < len(x) and x[at] == place
                    left -= 1
                if count >= enough:
                    out.append(self.order[place])
                target = place + 1
            else:
                # fewer than `least` lists can stand before the next candidate: take them off as well
                while heap and len(popped) < least - 1:
                    popped.append(heapq.heappop(heap))
                if not heap:
                    break
                target = max(heap[0][0], place + 1)
            for _, i, at in popped:
                x = short[i]
                at = bisect_left(x, target, at)
                if at < len(x) and x[at] < hi:
                    heapq.heappush(heap, (x[at], i, at))
        return out


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of bounded length with the place where each begins."""
    held, size, start = [], 0, 0
    for i, t in enumerate(batch.column(column)):
        held.append(t.as_py())
        size += len(held[-1])
        if size >= RUN_CHARS:
            yield start, held
            held, size, start = [], 0, i + 1
    if held:
        yield start, held


def _searched(rows: DataFrame, percent: int) -> DataFrame:
    """Links found in rows (key, role, rep, label, hashes): in each key the rows of role 0 are the index, those of role 1
    the queries. A link is kept if the labels differ. Rows of a key come together, index first."""
    def run(batches):
        key, index, members, sets = None, None, [], []
        out: list[tuple[int, int]] = []
        for batch in batches:
            for k, role, rep, label, h in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                if k != key:
                    key, index, members, sets = k, None, [], []
                h = np.frombuffer(h.as_py(), "<u8")
                if role == 0:
                    members.append((rep, label))
                    sets.append(h)
                    continue
                if index is None:
                    index, sets = Index(sets, percent), []
                for i in index.search(h):
                    other, its = members[i]
                    if other != rep and its != label:
                        out.append((rep, other))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
                out = []

    dealt = rows.select("key", "role", "rep", "label", "hashes").repartition("key").sortWithinPartitions("key", "role")
    return dealt.mapInArrow(lambda batches: released(run(batches)), "a long, b long").distinct()


def near_groups(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id_col, n_shingles, component_id).

    ``component_id`` is the smallest id reachable by links, the row's own if it has none. Null and empty texts
    have no shingles and link with nothing. A null id takes no part and has a null component.
    Rows that repeat an id are one document for linking, with the links of each of their texts. Other columns are
    left out, whatever their names. An empty table gives no rows. Shingles
    are compared by 64-bit hashes, and sets of an id that has several go by such a hash.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.sum(word_count(F.col("text"))).alias("words")).first()
    words = int(size["words"] or 0)
    n_blocks = packed_counts.n_blocks(size["bytes"] or 0)
    # counts only rank shingles, so two that share a shorter hash do no harm
    bits = min(64, words.bit_length() + SPARE_BITS)
    cut, shift = np.uint64(64 - bits), packed_counts.bucket_shift(words, bits)
    # both sides of the join below read this one exchange
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)).cast("int")).repartition(n_blocks, "block")

    def explode(t: pa.Table) -> pa.Table:
        shingler = Shingler(k)
        h = np.concatenate([shingler.hashes(x.as_py()) for x in t.column("text")])
        keys, counts = np.unique(h >> cut, return_counts=True)
        return packed_counts.to_rows(t.column("block")[0].as_py(), keys, counts, shift)

    def sketch(texts: pa.Table, counted: pa.Table) -> pa.Table:
        shingler = Shingler(k)
        sets = [shingler.hashes(x.as_py()) for x in texts.column("text")]
        totals = packed_counts.totals_of(counted)
        keys = np.unique(np.concatenate(sets) >> cut)
        marks, firsts = [], []
        for h in sets:
            least = needed(len(h), percent)
            docs_of = totals[np.searchsorted(keys, h >> cut)]
            order = np.argsort(docs_of, kind="stable")[:len(h) - least + 1]
            linked = len(h) and (docs_of > 1).sum() >= least
            marks.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
            firsts.append(h[order[docs_of[order] > 1]].view(np.int64) if linked else [])
        release()
        return pa.table({"id": texts.column("id"), "n": pa.array([len(h) for h in sets], pa.int64()),
                         "mark": pa.array(marks, pa.binary()), "first": pa.array(firsts, pa.list_(pa.int64()))})

    counted = packed_counts.counted(dealt.groupBy("block").applyInArrow(explode, packed_counts.EXPLODED))
    sketched = dealt.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(
        sketch, "id long, n long, mark binary, first array<long>")
    sketched, _ = materialize(sketched, "shingle_sketch")
    in_classes = sketched.where("n > 0 and id is not null")
    # ids that stand in several classes
    several, n_several = materialize(
        in_classes.select("id", "mark").distinct().groupBy("id").count().where("count > 1").select("id"), "ids_of_several")
    # n and first are functions of the set that mark stands for
    classes = in_classes.groupBy("mark").agg(F.min("id").alias("rep"), F.first("first").alias("first"))
    if n_several:
        # such an id names no class: its classes go by their sets
        classes = classes.join(several, F.col("rep") == F.col("id"), "left").select(
            "mark", F.when(F.col("id").isNotNull(), _set_name()).otherwise(F.col("rep")).alias("rep"), "first", F.col("rep").alias("least"))
    classes, _ = materialize(classes, "shingle_classes")

    postings = classes.select("rep", F.explode("first").alias("shingle"))
    lists = postings.groupBy("shingle").agg(F.min("rep").alias("name"), F.count(F.lit(1)).alias("length")).where("length > 1")
    lists, _ = materialize(lists, "shingle_lists")
    buckets = postings.join(lists, "shingle").groupBy("name", "rep").agg(F.max("length").alias("length"))
    buckets, n = materialize(buckets, "buckets")
    links, label = None, None
    if n:
        wanted = buckets.select("rep").distinct()
        if n_several:
            wanted = wanted.join(classes.select("rep", "least"), "rep").select(
                F.col("least").alias("id"), (F.col("rep") != F.col("least")).alias("several")).distinct()
        else:
            wanted = wanted.withColumnRenamed("rep", "id")
        links = _all_links(_sets(rows, wanted, k), buckets, percent)
    own = sketched.select("id", "n", "mark")
    of_class = classes.select("mark", "rep")
    if links is not None:
        label = components(links)
        of_class = of_class.join(label, F.col("rep") == F.col("node"), "left").select(
            "mark", F.coalesce("component", "rep").alias("rep"))
    of_class, _ = materialize(of_class, "class_components")
    member = own.join(of_class, "mark", "left").select("id", "n", F.coalesce("rep", "id").alias("component_id"))
    member, _ = materialize(member, "members")
    if n_several:  # an id that stands in several classes links them
        member = _united(member)
    return member.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                         F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each group of linked documents the one of the smallest id, with all its columns.

    Rows with a null id stay all; of rows that repeat an id one stays.
    """
    groups = near_groups(docs, k, percent, id_col, text_col)
    alone, _ = materialize(groups.where(F.col("component_id") == F.col(id_col)).select(
        F.col(id_col).alias("_id")), "near_stay")
    stay = alone.distinct().hint("merge")  # ids grow with the corpus: a shuffle join at every size
    kept = docs.alias("d").join(stay, F.col(f"d.{id_col}") == F.col("_id"), "left_semi")
    if alone.groupBy("_id").count().where("count > 1").limit(1).count():
        kept = kept.dropDuplicates([id_col])
    return kept.unionByName(docs.where(F.col(id_col).isNull()))


def _set_name():
    """A number for a class that its smallest id does not name, by its set."""
    return F.xxhash64("mark")


def _united(member: DataFrame) -> DataFrame:
    """Unite the components of rows that share an id, under the smallest id of each."""
    known = member.where("id is not null")
    joined = components(known.select(F.col("id").alias("a"), F.col("component_id").alias("b")))
    placed = known.select("id", "component_id").distinct().join(joined, F.col("component_id") == F.col("node"), "left").select(
        "id", F.coalesce("component", "component_id").alias("component"))
    placed, _ = materialize(placed.distinct(), "united")
    least = placed.groupBy("component").agg(F.min("id").alias("least"))
    of_id = placed.join(least, "component").select(F.col("id").alias("of"), "least")
    return member.join(of_id, F.col("id") == F.col("of"), "left").select(
        "id", "n", F.coalesce("least", "component_id").alias("component_id"))


def _sets(rows: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(rep, n, hashes): the sets of classes by the texts of the wanted ids. If wanted has a column ``several``, ids for which it
    is true have several sets, each under its own name."""
    by_set = "several" in wanted.columns

    def sets_of(batches):
        shingler, seen = Shingler(k), set()
        for batch in batches:
            for start, texts in _texts(batch, 1):
                h = [shingler.hashes(t).tobytes() for t in texts]
                for at in range(0, len(h), 256):
                    part = h[at:at + 256]
                    out = pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start + at, len(part)), pa.array([len(x) // 8 for x in part], pa.int64()),
                         pa.array(part, pa.binary())], names=["rep", "n", "hashes"])
                    if not by_set:
                        yield out
                        continue
                    # a set once, also if an id has several texts of it
                    marks = [xxhash.xxh3_128_digest(x) if x else None for x in part]
                    own = batch.column(2).slice(start + at, len(part)).to_pylist()
                    stay = [i for i, m in enumerate(marks) if m and not (own[i] and (m in seen or seen.add(m)))]
                    out = out.append_column("mark", pa.array([m if s else None for m, s in zip(marks, own)], pa.binary()))
                    yield out.take(pa.array(stay, pa.int64()))

    # a shuffle join at every size: texts that go on are few, but their ids grow with the corpus
    if not by_set:
        sets = rows.join(wanted.hint("merge"), "id", "left_semi").dropDuplicates(["id"])
        sets = sets.mapInArrow(lambda batches: released(sets_of(batches)), "rep long, n long, hashes binary")
    else:
        sets = rows.join(wanted.hint("merge"), "id").withColumn("_text", F.xxhash64("text")).dropDuplicates(["id", "_text"])
        sets = sets.select("id", "text", "several").mapInArrow(
            lambda batches: released(sets_of(batches)), "rep long, n long, hashes binary, mark binary").select(
            F.when(F.col("mark").isNotNull(), _set_name()).otherwise(F.col("rep")).alias("rep"), "n", "hashes")
    sets, _ = materialize(sets, "shingle_sets")
    return sets


def _all_links(sets: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """Links between classes that join everything that is linked."""
    # against the names of buckets: each class goes to its smallest, names in several parts of the index if many come
    home = buckets.groupBy("rep").agg(F.min(F.struct("name", "length")).alias("home")).select(
        "rep", F.col("home.name").alias("name"), F.col("home.length").alias("length"))
    parts = spread_parts(F.col("length"))
    queries = home.where("rep <> name").select("rep", "name", F.pmod(F.xxhash64("rep"), parts).cast("int").alias("part"))
    names = home.where("rep <> name").groupBy("name").agg(F.max("length").alias("length")).select(
        "name", F.explode(F.sequence(F.lit(0), (spread_parts(F.col("length")) - 1).cast("int"))).alias("part"))
    # several names share an index
    key = F.pmod(F.xxhash64("name", "part"), F.lit(1 << 14)).cast("string").alias("key")
    index = names.withColumnRenamed("name", "rep").withColumn("name", F.col("rep"))
    found = _searched(
        queries.join(sets, "rep").select(key, F.lit(1).alias("role"), "rep", F.lit(-1).cast("long").alias("label"), "hashes").union(
            index.join(sets, "rep").select(key, F.lit(0).alias("role"), "rep", F.lit(-2).cast("long").alias("label"), "hashes")),
        percent)
    found, _ = materialize(found, "links_to_names")
    label = components(found)

    # what is left: buckets with classes outside the component of their name
    def labelled(df, col, out):
        return df.join(label.select(F.col("node").alias(col), F.col("component").alias("_c")), col, "left").withColumn(
            out, F.coalesce("_c", F.col(col))).drop("_c")

    placed = labelled(labelled(buckets.select("name", "rep"), "rep", "label"), "name", "name_label")
    placed, _ = materialize(placed, "placed")
    open_names = placed.where("label <> name_label").select("name").distinct()
    inside = placed.join(open_names, "name", "left_semi").join(sets.select("rep", "n"), "rep")
    blocks = inside.groupBy("name").agg(F.ceil(F.sum("n") / BLOCK_TOKENS).cast("int").alias("blocks"))
    inside, _ = materialize(inside.join(blocks, "name"), "open_buckets")
    place = F.concat_ws(":", "name", "block").alias("key")
    members = inside.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks"))).select(place, F.lit(0).alias("role"), "rep", "label")
    outside = inside.where("label <> name_label").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(place, F.lit(1).alias("role"), "rep", "label")
    more = _searched(members.union(outside).join(sets.select("rep", "hashes"), "rep"), percent)
    more, _ = materialize(more, "links_in_buckets")
    return found.union(more)


def spread_parts(length):
    """Parts among which the classes of a list of so many are dealt out."""
    return F.ceil(length / 1000)
