"""Near-duplicate documents by order MinHash and banded alignment.

A document is its sequence of words (``common.words``).  Every run of five words is a
k-mer, labelled with how often it occurred before, so that repeats count.  For each
of ``SKETCHES`` hash functions the ``TAKEN`` labelled k-mers of least hash are taken
and kept in text order: the sketch.  Documents that agree in a sketch are candidates.
Two documents are linked if the Jaccard similarity of their labelled k-mers is at
least 0.8 and a banded alignment of their words finds an edit similarity of at least
0.8.  A pair of similarity 0.8 agrees in no sketch with probability below 1e-5 if its
longer text has more than ``SHORT`` k-mers (4e-6 for long texts).  Among shorter ones,
where sketches miss more, no pair is missed: they also enter by every ``SUBSET`` of the
least k-mers of which two texts of that similarity must share as many.

How it runs: equal word sequences are one text, represented once; of its copies a task
sends on only those that could be the one that stays.  Agreement in any
sketch joins texts into loose groups (by stars, so rows grow with the texts).  Each
loose group is checked in full: it is split into blocks of bounded size, each pair of
blocks is a task, all pairs of a task are compared by k-mers, and those that are not
connected yet by alignment.  Tasks return a spanning forest of the links they found.
Classes are the components of these links, so no link between texts is lost, and no
group is expanded into its pairs.

Defined cases: a null, empty or wordless text is a class of its own; fewer than five
words are one k-mer; the class id is the lowest doc_id of the class (null if all are
null); equal rows are of one class, of which one stays; an empty table gives an empty one;
a text of any length is sketched in parts of bounded memory; extra columns are kept, and
columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.common import col, trimmed, words, written
from tillflow.llm.components import connected_components

K = 5
SKETCHES, TAKEN = 24, 4
SIMILARITY = 0.8
#: Texts of so many k-mers at most are found by exact keys, of so many k-mers each.
SHORT, SUBSET = 20, 3
#: Texts that a task remembers, to pass over their copies.
REMEMBERED = 200_000
#: What a word is made of (see ``common.WORD_BYTES``).
WORD_CHARACTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
#: Texts of a block, on average: a task compares two blocks.
BLOCK = 512

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_GOLD = 0x9E3779B97F4A7C15
_SEEDS = np.array([(_GOLD * (2 * j + 3)) & 0xFFFFFFFFFFFFFFFF | 1 for j in range(SKETCHES)], np.uint64)
_PLACES = np.array([pow(_GOLD | 1, j + 1, 1 << 64) for j in range(K)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


class WordHashes:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, bound: int = 250_000):
        self.seen: dict[bytes, int] = {}
        self.bound = bound

    def __call__(self, w: list[bytes]) -> np.ndarray:
        seen = self.seen
        fresh = set(w).difference(seen)
        if fresh:
            if len(seen) + len(fresh) > self.bound:
                seen.clear()
                fresh = set(w)
            for x in fresh:
                seen[x] = int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "big")
        return np.fromiter(map(seen.__getitem__, w), np.uint64, len(w))


def labelled_kmers(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the k-mers in text order, each mixed with its number of earlier
    occurrences; fewer than ``k`` words make one k-mer."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64)
    m = max(1, n - k + 1)
    out = np.zeros(m, np.uint64)
    for j in range(min(k, n)):
        out += hashes[j:j + m] * _PLACES[j]
    out = _mixed(out)
    order = np.argsort(out, kind="stable")
    ranked = out[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    if not new.all():
        start = np.maximum.accumulate(np.where(new, np.arange(m), 0))
        times = np.empty(m, np.uint64)
        times[order] = (np.arange(m) - start).astype(np.uint64)
        out = np.where(times > 0, _mixed(out + times * np.uint64(_GOLD)), out)
    return out


def order_sketches(kmers: np.ndarray, sketches: int = SKETCHES, taken: int = TAKEN) -> np.ndarray:
    """For each hash function, the least k-mers in text order, as one number."""
    n = len(kmers)
    if n == 0:
        return np.zeros(0, np.int64)
    step = max(1, (1 << 20) // n)  # bounded memory for long texts
    out = np.empty(sketches, np.uint64)
    for a in range(0, sketches, step):
        seeds = _SEEDS[a:a + step]
        h = kmers[None, :] * seeds[:, None]
        h ^= h >> np.uint64(32)
        h *= _MIX
        if n > taken:
            least = np.sort(np.argpartition(h, taken, axis=1)[:, :taken], axis=1)
        else:
            least = np.broadcast_to(np.arange(n), (len(seeds), n))
        key = seeds.copy()
        for j in range(least.shape[1]):
            key = _mixed(key * _MIX + kmers[least[:, j]])
        out[a:a + step] = key
    return out.view(np.int64)


@cache
def _subsets(prefix: int, size: int) -> np.ndarray:
    return np.array(list(combinations(range(prefix), size)), np.int64)


def short_keys(kmers: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Keys of which any two short texts of that similarity share one.

    Such texts have ``least`` k-mers in common, as many as the similarity takes of the
    longer one.  The first ``SUBSET`` of them, in order of their hashes, are among the
    first n - least + ``SUBSET`` of a text of n."""
    n = len(kmers)
    if not 0 < n <= SHORT:
        return np.zeros(0, np.int64)
    least = int(np.ceil(similarity * n - 1e-9))
    size = min(SUBSET, least)
    first = np.sort(kmers)[:n - least + size]
    key = np.full(1, _GOLD, np.uint64)
    for column in _subsets(len(first), size).T:
        key = _mixed(key * _MIX + first[column])
    return key.view(np.int64)


def edit_distance_within(a, b, most: int) -> int:
    """Edits (insert, delete, replace) between two sequences, or -1 if over ``most``.

    Only diagonals that ``most`` edits can reach are followed: for each number of
    edits, the furthest place on each diagonal of the band."""
    la, lb = len(a), len(b)
    if abs(la - lb) > most:
        return -1
    goal = lb - la
    far: dict[int, int] = {}
    for e in range(most + 1):
        now: dict[int, int] = {}
        for d in range(-e, e + 1):
            if not -la <= d <= lb:
                continue
            # places in a: after a replace, an insert into a, a delete from a
            x = 0 if e == 0 else max(far.get(d, -2) + 1, far.get(d - 1, -2), far.get(d + 1, -2) + 1)
            if x < 0:
                continue
            x = min(x, la, lb - d)
            while x < la and x + d < lb and a[x] == b[x + d]:
                x += 1
            now[d] = x
        if now.get(goal, -1) >= la:
            return e
        far = now
    return -1


# -- sketches --------------------------------------------------------------------

def text_key(w: list[bytes]) -> bytes | None:
    """128-bit digest of a sequence of words; none for no words."""
    return hashlib.blake2b(b" ".join(w), digest_size=16).digest() if w else None


def _sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes, done = WordHashes(), set()
    for part in parts:
        keys, sketches = [], []
        for cell in part.column("text"):
            w = words(cell.as_py())
            key = text_key(w)
            keys.append(key)
            if key is None or key in done:  # a copy seen in this task: its first has the sketch
                sketches.append(None)
                continue
            if len(done) < REMEMBERED:
                done.add(key)
            kmers = labelled_kmers(hashes(w))
            sketches.append(np.concatenate((order_sketches(kmers), short_keys(kmers))))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sketches, pa.list_(pa.int64()))],
            names=["doc_id", "key", "sketches"])


def _first_copies(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the key of ``_text``, and passes over copies of a text of which this task gave
    out one of an id as low: neither the text nor the lowest id of a class is lost."""
    lowest: dict[bytes, int | None] = {}
    for part in parts:
        taken, keys = [], []
        for at, (cell, id_) in enumerate(zip(part.column("_text"), part.column("_id").to_pylist())):
            key = text_key(words(cell.as_py()))
            if key is None:
                continue
            if key in lowest:
                before = lowest[key]
                if id_ is None or before is not None and before <= id_:
                    continue
                lowest[key] = id_
            elif len(lowest) < REMEMBERED:
                lowest[key] = id_
            taken.append(at)
            keys.append(key)
        if taken:
            part = part.take(pa.array(taken, pa.int64()))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, pa.binary())],
                                             names=[*part.schema.names, "_key"])


def first_copies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` as a struct ``_row``, with ``_id``, ``_text`` and ``_key``, without rows that
    have no words and without most copies (see ``_first_copies``)."""
    own = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("_row"),
                      col(doc_id).cast("bigint").alias("_id"), col(text).cast("string").alias("_text"))
    return own.mapInArrow(trimmed(_first_copies),
                          T.StructType([*own.schema.fields, T.StructField("_key", T.BinaryType())]))


# -- checking loose groups ---------------------------------------------------------

class Forest:
    """Union of links; remembers those that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x == y:
            return False
        self.up[max(x, y)] = min(x, y)
        return True


def linked_pairs(texts: list[list[bytes]], side: list[int] | None, similarity: float = SIMILARITY
                 ) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among ``texts``; with ``side`` (0 or 1 for each
    text) only pairs across the sides are compared."""
    hashes = WordHashes()
    kmers = [labelled_kmers(hashes(w)) for w in texts]
    sizes = np.array([len(x) for x in kmers])
    owner = np.repeat(np.arange(len(texts)), sizes)
    _, ids = np.unique(np.concatenate(kmers), return_inverse=True)
    order = np.argsort(ids, kind="stable")
    starts = np.searchsorted(ids[order], np.arange(ids.max() + 2))
    postings = owner[order]
    shared = np.diff(starts) > 1
    begin = np.cumsum(np.concatenate(([0], sizes)))
    sides = None if side is None else np.array(side)
    forest = Forest(len(texts))
    for i in range(len(texts)):
        own = ids[begin[i]:begin[i + 1]]
        own = own[shared[own]]
        if not len(own):
            continue
        lists = [postings[starts[t]:starts[t + 1]] for t in own.tolist()]
        both = np.bincount(np.concatenate(lists), minlength=len(texts))
        ok = both >= similarity * (sizes + sizes[i] - both) - 1e-9
        ok[:i + 1] = False
        if sides is not None:
            ok &= sides != sides[i]
        for j in np.flatnonzero(ok).tolist():
            if forest.root(i) == forest.root(j):
                continue
            a, b = texts[i], texts[j]
            if edit_distance_within(a, b, int((1 - similarity) * max(len(a), len(b)) + 1e-9)) >= 0:
                forest.join(i, j)
                yield i, j


def _check(group: pa.Table) -> pa.Table:
    """Links of one pair of blocks: columns i, j, block, key, text."""
    keys = group.column("key").to_pylist()
    texts = [words(t) for t in group.column("text").to_pylist()]
    i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
    side = None if i == j else [int(b == j) for b in group.column("block").to_pylist()]
    got = list(linked_pairs(texts, side))
    return pa.table({"a": pa.array([keys[x] for x, _ in got], pa.binary()),
                     "b": pa.array([keys[y] for _, y in got], pa.binary())})


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(rows, texts): rows has ``doc_id`` and ``key`` of every document; texts has, for each
    ``key``, ``class_key`` and ``class_id``, the lowest doc_id of the class."""
    own = docs.select(col(doc_id).cast("bigint").alias("doc_id"), col(text).cast("string").alias("text"))
    rows = written(own.mapInArrow(trimmed(_sketch), "doc_id bigint, key binary, sketches array<bigint>"))
    ids = rows.where("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    agree = (rows.where("sketches IS NOT NULL")
             .select(F.explode("sketches").alias("sketch"), "key"))
    least = (agree.groupBy("sketch").agg(F.min("key").alias("low"), F.max("key").alias("high"))
             .where("low <> high").select(F.col("sketch").alias("s"), "low"))
    loose_links = (agree.join(least, F.col("sketch") == F.col("s")).where("key <> low")
                   .select(F.col("key").alias("a"), F.col("low").alias("b")).distinct())
    loose = connected_components(loose_links)  # node, component
    sizes = loose.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    loose = (loose.join(sizes, "component")
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))))
    texts = first_copies(own, "doc_id", "text").select("_key", "_text")
    one_each = (loose.join(texts, F.col("node") == F.col("_key"))
                .groupBy("node", "component", "blocks", "block").agg(F.first("_text").alias("text")))
    # Each text meets every block of its group: its own, and one task for each other.
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    dealt = one_each.select("component", "block", other.alias("o"), F.col("node").alias("key"), "text").select(
        "component", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "key", "text")
    links = dealt.groupBy("component", "i", "j").applyInArrow(_check, "a binary, b binary")
    members = connected_components(links)
    named = (ids.join(members, F.col("key") == F.col("node"), "left")
             .select("key", "doc_id", F.coalesce("component", "key").alias("class_key")))
    lowest = named.groupBy("class_key").agg(F.min("doc_id").alias("class_id"))
    return rows.select("doc_id", "key"), named.select("key", "class_key").join(lowest, "class_key")


def near_duplicate_report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, kept (whether it is the document of its class that stays)."""
    rows, texts = classes(docs, **options)
    own = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("class_id"))
    return (rows.join(texts.withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left")
            .select("doc_id", own.alias("class_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id"))))


def without_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, that of the lowest doc_id (of rows that share it and
    the class, one); wordless documents stay."""
    _, texts = classes(docs, doc_id=doc_id, text=text)
    alone = docs.where(~F.coalesce(col(text).cast("string").rlike(WORD_CHARACTER), F.lit(False)))
    one = (first_copies(docs, doc_id, text).select("_row", "_id", "_key")
           .join(texts.withColumnRenamed("key", "k"), F.col("_key") == F.col("k"))
           .where(F.col("_id").eqNullSafe(F.col("class_id")))
           .dropDuplicates(["class_key"]).select("_row.*"))
    return one.unionByName(alone)
