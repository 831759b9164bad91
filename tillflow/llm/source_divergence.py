"""How far the sources of a language differ, and by which terms (exact integers).

Terms are runs of letters and non-ASCII characters, A-Z lower-cased.  A language keeps
the terms of at least ``MIN_DOCS`` of its documents.  A source's share of a term is
``1 + floor(SCALE * (count + 2) / (N + 2 V))``; the divergence of two shares is
``floor((p - q)^2 / (p + q))``.  The report compares every source with each other
source of its language (sums over all kept terms) and names the terms it uses most
above its language.

How it runs (late string materialization):

1. A pass over the texts counts documents by (language, term) in bounded tables
   (``HELD`` entries) and gives rows of a 64-bit digest and a count.  Only those are
   shuffled; they tell which digests have enough documents.
2. A second pass counts occurrences by (language, source, term) for the digests that
   pass a bitmap of the first result (``BITMAP_BITS`` whatever the input; a fuller one
   lets more through to the exact join).  Its rows are digests and counts; a term's
   string is written once for each table that held it, in a column that counting does
   not read.
3. The lowest and highest string of a digest are one unless terms collide.  Terms of
   colliding digests, and no others, are counted again by string, so results do not
   depend on the digest.
4. Strings are joined to the report's rows last, after the tenth value of a group is
   known (terms that tie with it included).

Sums over pairs: for two sources a and b, a term that neither has adds a constant; what
the terms of a alone add depends on their shares only, so it comes from the histogram
of a's shares; terms of both are compared in tasks of one bucket of terms and two
blocks of ``BLOCK`` sources, which return a sum for each pair of sources.  A term's
pairs are never rows.

Defined cases: null text, language or source count as ''; a group without terms is
compared like any other; a language that keeps no term gives pairs of value 0 and no
terms; equal rows are documents of their own; texts of any length are counted in pieces
cut between terms; an empty table gives no rows; other columns are ignored; ties are in
order of the item's UTF-8 bytes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from hashlib import blake2b
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import col, pieces, written

MIN_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
#: Entries of a task's table of counts, at most; beyond it is written and begun anew.
HELD = 1_000_000
#: Words that a task gathers before it counts them.
STEP = 2_000_000
#: Bits of the bitmap of digests with enough documents: 8 MB, whatever the input.
BITMAP_BITS = 1 << 26
#: Sources in a block, and terms in a bucket on average: a task compares two blocks.
BLOCK = 256
BUCKET_TERMS = 4096

#: A letter's byte stays (A-Z as a-z), as do those of non-ASCII characters; others part terms.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

_DOCS = pa.schema([("lang", pa.string()), ("digest", pa.int64()), ("docs", pa.int64())])
_CELLS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("digest", pa.int64()), ("n", pa.int64()),
                    ("docs", pa.int64()), ("term", pa.string())])
_CELLS_SQL = "lang string, source string, digest long, n long, docs long, term string"


def digest64(term: bytes) -> int:
    return int.from_bytes(blake2b(term, digest_size=8).digest(), "little", signed=True)


def _numbered(data: bytes, number: dict) -> np.ndarray:
    """The terms of a text by their number, in order."""
    got = []
    for piece in pieces(data.translate(TERM_BYTES)):
        found = piece.split()
        got.append(np.fromiter(map(number.__getitem__, found), np.int64, len(found)))
    return got[0] if len(got) == 1 else np.concatenate(got)


def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def _tables(parts: Iterable[pa.RecordBatch], held: int, documents: bool) -> Iterator[tuple]:
    """Counts by (other columns, term) of rows whose last column is a text, in tables of
    about ``held`` entries: (groups, terms, group of an entry, term of an entry, count).
    Counted are occurrences, or documents."""
    def begun():
        return defaultdict(count().__next__), defaultdict(count().__next__), np.zeros((2, 0), np.int64), []

    groups, number, (keys, counts), new = begun()
    waiting = 0

    def settled() -> tuple[np.ndarray, np.ndarray]:
        more, times = np.unique(np.concatenate(new), return_counts=True)
        return _merged(np.concatenate([keys, more]), np.concatenate([counts, times]))

    for part in parts:
        *names, text = part.columns
        for group, data in zip(zip(*[c.to_pylist() for c in names]), text.cast(pa.binary()).to_pylist()):
            found = _numbered(data, number)
            new.append((np.unique(found) if documents else found) + (groups[group] << 32))
            waiting += len(found)
            if waiting >= STEP:
                (keys, counts), new, waiting = settled(), [], 0
                if len(keys) >= held:
                    yield list(groups), list(number), keys >> 32, keys & 0xFFFFFFFF, counts
                    groups, number, (keys, counts), new = begun()
    if groups:
        keys, counts = settled() if new else (keys, counts)
        yield list(groups), list(number), keys >> 32, keys & 0xFFFFFFFF, counts


def _digests(terms: list[bytes], digest: Callable[[bytes], int]) -> np.ndarray:
    return np.fromiter(map(digest, terms), np.int64, len(terms))


def _in_bitmap(digests: np.ndarray, bitmap) -> np.ndarray:
    at = digests & (BITMAP_BITS - 1)
    return (np.frombuffer(bitmap.value, np.uint8)[at >> 3] >> (at & 7) & 1).astype(bool)


def _document_counts(held: int, digest: Callable[[bytes], int]) -> Callable:
    """Task: documents by language and term, as digests."""
    def counted(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, terms, group, term, docs in _tables(parts, held, documents=True):
            langs = pa.array([lang for lang, in groups], pa.string())
            yield from pa.Table.from_arrays(
                [langs.take(pa.array(group)), pa.array(_digests(terms, digest)[term]), pa.array(docs)],
                schema=_DOCS).to_batches(max_chunksize=50_000)

    return counted


def _cell_counts(held: int, digest: Callable[[bytes], int], bitmap) -> Callable:
    """Task: occurrences by language, source and term for digests in the bitmap, and each
    such term's string once; a row without a digest for each language and source."""
    def counted(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, terms, group, term, n in _tables(parts, held, documents=False):
            digests = _digests(terms, digest)
            passing = _in_bitmap(digests, bitmap)
            here = passing[term]
            langs, sources = (pa.array([g[k] for g in groups], pa.string()) for k in (0, 1))
            yield from _rows(lang=langs, source=sources)
            yield from _rows(digest=digests[passing],
                             term=pa.array([terms[k] for k in np.flatnonzero(passing)], pa.binary()).cast(pa.string()))
            at = pa.array(group[here])
            yield from _rows(lang=langs.take(at), source=sources.take(at), digest=digests[term[here]], n=n[here])

    return counted


def _string_counts(held: int, digest: Callable[[bytes], int], bitmap, documents: bool) -> Callable:
    """Task: occurrences, or documents, by language, source and string, for the digests in
    the bitmap."""
    def counted(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, terms, group, term, n in _tables(parts, held, documents):
            digests = _digests(terms, digest)
            here = _in_bitmap(digests, bitmap)[term]
            langs, sources = (pa.array([g[k] for g in groups], pa.string()) for k in (0, 1))
            at, strings = pa.array(group[here]), pa.array(terms, pa.binary()).cast(pa.string())
            yield from _rows(lang=langs.take(at), source=sources.take(at), digest=digests[term[here]],
                             term=strings.take(pa.array(term[here])), **{"docs" if documents else "n": n[here]})

    return counted


def _rows(**columns) -> Iterator[pa.RecordBatch]:
    size = len(next(iter(columns.values())))
    whole = pa.Table.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _CELLS],
        schema=_CELLS)
    yield from whole.to_batches(max_chunksize=50_000)


def bitmap_of(digests: DataFrame) -> bytes:
    """The bits ``digest`` modulo ``BITMAP_BITS``; pieces of 4 KB reach the driver."""
    at = F.pmod(F.col("digest"), F.lit(BITMAP_BITS))
    found = (digests.select(F.floor(at / 32768).cast("int").alias("piece"), (at % 32768).alias("bit"))
             .groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")))
    out = bytearray(BITMAP_BITS // 8)
    for r in found.toLocalIterator():
        out[r["piece"] * 4096:(r["piece"] + 1) * 4096] = r["bits"]
    return bytes(out)


def _share(count: str, whole: str) -> str:
    """SQL for the share of ``count`` in ``whole``; null if ``whole`` is 0."""
    return (f"1 + cast({SCALE} as decimal(10,0)) * cast({count} + 2 as decimal(20,0)) "
            f"div cast(nullif({whole}, 0) as decimal(20,0))")


def _gap(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})"


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _common_terms(frame: pd.DataFrame) -> pd.DataFrame:
    """What the terms that two sources share add to their sum beyond what each adds by
    itself, for all pairs of sources of two blocks (or of one) in one bucket of terms."""
    lang, i, j = frame["lang"].iloc[0], int(frame["i"].iloc[0]), int(frame["j"].iloc[0])
    frame = frame.sort_values(["digest", "variant", "number"], na_position="first")
    number, p, p0 = (frame[c].to_numpy(np.int64) for c in ("number", "p", "p0"))
    digest, variant = frame["digest"].to_numpy(np.int64), frame["variant"].fillna("").to_numpy(object)
    new = np.ones(len(frame), dtype=bool)
    new[1:] = (digest[1:] != digest[:-1]) | (variant[1:] != variant[:-1])
    term = np.cumsum(new)
    first, second = number - i * BLOCK, number - j * BLOCK
    sums = np.zeros((BLOCK, BLOCK), dtype=np.int64)
    # Rows of one term are neighbours in order of the source: compare at growing distance.
    for d in range(1, 2 * BLOCK):
        near = np.flatnonzero(term[d:] == term[:-d]) if d < len(term) else ()
        if not len(near):
            break
        far = near + d
        pair = (first[near] < BLOCK) & (second[far] >= 0) & (first[near] >= 0) & (second[far] < BLOCK)
        a, b = near[pair], far[pair]
        more = _gaps(p[a], p[b]) - _gaps(p[a], p0[b]) - _gaps(p0[a], p[b]) + _gaps(p0[a], p0[b])
        np.add.at(sums, (first[a], second[b]), more)
    a, b = np.nonzero(sums)
    return pd.DataFrame({"lang": lang, "a": a + i * BLOCK, "b": b + j * BLOCK, "x": sums[a, b]})


def divergence_report(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source",
                      min_docs: int = MIN_DOCS, top: int = TOP, held: int = HELD,
                      digest: Callable[[bytes], int] = digest64) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` holds every other source of
    the language, part ``term`` the ``top`` terms a source uses above its language."""
    spark = docs.sparkSession
    read = docs.select(*[F.coalesce(col(c).cast("string"), F.lit("")).alias(a)
                         for c, a in ((lang, "lang"), (source, "source"), (text, "text"))])
    # Digests with enough documents: a language's terms, and others that share their digest.
    enough = written(read.select("lang", "text").mapInArrow(
        _document_counts(held, digest), "lang string, digest long, docs long")
        .groupBy("lang", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs))
    passing = spark.sparkContext.broadcast(bitmap_of(enough))
    counted = written(read.mapInArrow(_cell_counts(held, digest, passing), _CELLS_SQL))
    by_digest = (counted.where("digest is not null and lang is not null").groupBy("lang", "source", "digest")
                 .agg(F.sum("n").alias("n")).withColumn("variant", F.lit(None).cast("string")))
    candidates = by_digest.join(enough.select("lang", "digest"), ["lang", "digest"], "left_semi")
    names = written(counted.where("term is not null").select("digest", "term").distinct()
                    .groupBy("digest").agg(F.min("term").alias("low"), F.max("term").alias("high")))
    colliding = names.where("low <> high").select("digest")
    if colliding.isEmpty():
        cells = candidates
    else:
        again = spark.sparkContext.broadcast(bitmap_of(colliding))
        apart = (read.mapInArrow(_string_counts(held, digest, again, False), _CELLS_SQL)
                 .unionByName(read.mapInArrow(_string_counts(held, digest, again, True), _CELLS_SQL))
                 .join(colliding, "digest", "left_semi")
                 .groupBy("lang", "source", "digest", F.col("term").alias("variant"))
                 .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
        whole = F.sum("docs").over(Window.partitionBy("lang", "digest", "variant"))
        apart = apart.withColumn("whole", whole).where(F.col("whole") >= min_docs)
        cells = candidates.join(colliding, "digest", "left_anti").unionByName(
            apart.select("lang", "source", "digest", "variant", "n"))
    term = Window.partitionBy("lang", "digest", "variant")
    cells = cells.select("lang", "source", "digest", "variant", "n", F.sum("n").over(term).alias("total"))

    # Sources of a language, numbered, with their sums.
    kept = written(cells)
    per_lang = (kept.groupBy("lang", "digest", "variant").agg(F.max("total").alias("total"))
                .groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("whole")))
    per_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = (counted.where("digest is null").select("lang", "source").distinct()
              .join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left")
              .select("lang", "source", F.coalesce("size", F.lit(0)).alias("size"),
                      F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("whole", F.lit(0)).alias("whole"))
              .withColumn("p0", F.expr(_share("0L", "size + 2 * v")))
              .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1))
    groups = written(groups)
    scored = written(kept.join(groups, ["lang", "source"])
                     .withColumn("p", F.expr(_share("n", "size + 2 * v")))
                     .withColumn("q", F.expr(_share("total", "whole + 2 * v")))
                     .select("lang", "source", "number", "digest", "variant", "p", "p0", "q"))
    return _pairs(groups, scored).unionByName(_terms(scored, names, top))


def _pairs(groups: DataFrame, scored: DataFrame) -> DataFrame:
    one = groups.select("lang", F.col("number").alias("a"), F.col("p0").alias("a0"), "v")
    other = groups.select("lang", F.col("number").alias("b"), F.col("p0").alias("b0"))
    # A constant for terms that neither has; then what a's terms add, by their shares.
    bare = one.join(other, "lang").where("a <> b").select(
        "lang", "a", "b", F.expr(f"coalesce(v * ({_gap('a0', 'b0')}), 0)").alias("x"))
    shares = scored.groupBy("lang", F.col("number").alias("a"), F.col("p0").alias("a0"), "p").agg(
        F.count("*").alias("k"))
    own = shares.join(other, "lang").where("a <> b").groupBy("lang", "a", "b").agg(
        F.sum(F.expr(f"k * ({_gap('p', 'b0')} - {_gap('a0', 'b0')})")).alias("x"))
    # Terms of both.
    terms = scored.select("lang", "digest").distinct().count()
    buckets = terms // BUCKET_TERMS + 1
    blocks = groups.groupBy("lang").agg(F.floor(F.max("number") / BLOCK).alias("last"))
    cells = (scored.join(blocks, "lang")
             .withColumn("block", F.floor(F.col("number") / BLOCK))
             .withColumn("bucket", F.pmod(F.hash("digest"), F.lit(buckets)))
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("last").cast("int"))))
             .select("lang", "bucket", F.least("block", "with").cast("int").alias("i"),
                     F.greatest("block", "with").cast("int").alias("j"),
                     "number", "digest", "variant", "p", "p0"))
    both = cells.groupBy("lang", "bucket", "i", "j").applyInPandas(
        _common_terms, "lang string, a long, b long, x long")
    half = own.unionByName(both.select("lang", F.col("a").cast("int"), F.col("b").cast("int"), "x"))
    swapped = half.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "x")
    total = bare.unionByName(half).unionByName(swapped).groupBy("lang", "a", "b").agg(F.sum("x").alias("value"))
    named = groups.select("lang", F.col("number").alias("a"), "source")
    items = groups.select("lang", F.col("number").alias("b"), F.col("source").alias("item"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return total.join(named, ["lang", "a"]).join(items, ["lang", "b"]).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))


def _terms(scored: DataFrame, names: DataFrame, top: int) -> DataFrame:
    above = scored.where("p > q").select("lang", "source", "digest", "variant", F.expr(_gap("p", "q")).alias("value"))
    # The value of the last rank, from digests; then strings for rows that reach it.
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    least = (above.select("lang", "source", "value").withColumn("r", F.row_number().over(best)).where(F.col("r") <= top)
             .groupBy("lang", "source").agg(F.min("value").alias("least")))
    reach = above.join(least, ["lang", "source"]).where("value >= least")
    named = reach.join(names, "digest").withColumn("item", F.coalesce("variant", "low"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return named.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
