"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Each source gets a target number of words; each of its documents then has the same
expected number of copies, target / size of the source, at most 2.  Documents are
put in order of size within their source, the expected copies are summed along that
order, one random offset (a digest of seed and source) is added, and a document is
emitted once for each integer boundary that its share of the sum crosses.  As the
expected copies of a source's documents are equal, the prefix sum at a document is
its rank times that number, so no rounding adds up.

How it runs: the rank is built from counts.  Documents are grouped by source, size
class and chunk (a digest of the id; chunks hold ``CHUNK_ROWS`` rows on average, so a
source with a third of all rows is many groups); rows are numbered inside a group,
and groups are offset by prefix sums over their counts.  Only the sums by source
pass through one task: a row for each source.

Defined cases: a null text has size 0; a null source is a source, last in order;
a source without words has target 0; equal rows are taken in turn; added columns
stay in the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillflow.llm.common import col, whole_row

CHUNK_ROWS = 20_000
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def unit(*parts: Column) -> Column:
    """A number from 0 up to 1, drawn by digest."""
    return F.conv(F.substring(F.md5(F.concat_ws("#", *parts)), 1, 8), 16, 10).cast("bigint") / F.lit(2.0 ** 32)


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size) -> with ``target``: shares by weight, in order of source,
    capped at ``most`` times the size; what a cap leaves over is shared again.

    A source is capped at the common price per weight at which all caps fit: sources
    are sorted by cap over weight, and the price is found from prefix sums."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (k + 1).cast("int"))
    s = (sizes.withColumn("w", weight).withColumn("cap", (F.col("source_size") * most).cast("double"))
         .withColumn("ratio", F.col("cap") / F.col("w")))
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    s = s.withColumn("price", (F.sum("source_size").over(whole) * F.lit(share)
                               - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after))
    # The first source, by ratio, that its share doesn't fill sets the price for all.
    s = s.withColumn("level", F.min(F.when(F.col("price") <= F.col("ratio"), F.struct("ratio", "price")))
                     .over(whole)["price"])
    return s.select("source", "source_size",
                    F.least("cap", F.coalesce(F.col("level") * F.col("w"), "cap")).alias("target"))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        seed: str = "mix", keep: Column | None = None, **options) -> DataFrame:
    """``row`` (all columns, or ``keep``), ``size``, ``source_size``, ``target`` of its
    source and ``copies`` for every document."""
    d = docs.select((whole_row(docs) if keep is None else keep).alias("row"),
                    col(doc_id).cast("string").alias("id"), col(source).cast("string").alias("source"),
                    n_words(col(text).cast("string")).alias("size"))
    rows = docs.count()
    chunks = rows // CHUNK_ROWS + 1
    # Classes of sizes that differ by an eighth at most.
    size_class = F.when(F.col("size") > 0, F.floor(F.log2(F.col("size").cast("double")) * 6) + 1).otherwise(0)
    d = d.withColumn("class", size_class.cast("int")).withColumn(
        "chunk", F.floor(unit(F.lit(seed), F.coalesce("id", F.lit(""))) * chunks).cast("int"))

    group = ["source", "class", "chunk"]
    counts = d.groupBy(*group).agg(F.count("*").alias("n"), F.sum("size").alias("words"))
    classes = counts.groupBy("source", "class").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))
    targets = source_targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), **options)
    earlier = [Window.unboundedPreceding, -1]
    classes = classes.withColumn("class_before", F.coalesce(F.sum("n").over(
        Window.partitionBy("source").orderBy("class").rowsBetween(*earlier)), F.lit(0)))
    same = lambda a, b, names: [a[c].eqNullSafe(b[c]) for c in names]
    c1 = counts.select(*group, "n")
    c2 = classes.select(F.col("source").alias("s2"), F.col("class").alias("k2"), "class_before")
    t = targets.select(F.col("source").alias("s3"), "source_size", "target")
    offsets = (c1.withColumn("chunk_before", F.coalesce(F.sum("n").over(
        Window.partitionBy("source", "class").orderBy("chunk").rowsBetween(*earlier)), F.lit(0)))
        .join(c2, F.col("source").eqNullSafe(F.col("s2")) & (F.col("class") == F.col("k2")))
        .join(t, F.col("source").eqNullSafe(F.col("s3")))
        .select(F.col("source").alias("so"), F.col("class").alias("ko"), F.col("chunk").alias("co"),
                (F.col("class_before") + F.col("chunk_before")).alias("before"), "source_size", "target"))

    inside = F.row_number().over(Window.partitionBy(*group).orderBy("size", "id"))
    d = d.withColumn("inside", inside).join(
        offsets, F.col("source").eqNullSafe(F.col("so")) & (F.col("class") == F.col("ko"))
        & (F.col("chunk") == F.col("co")))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = unit(F.lit(seed), F.lit("offset"), F.coalesce("source", F.lit("")))
    rank = F.col("before") + F.col("inside")
    copies = F.floor(rank * each + offset) - F.floor((rank - 1) * each + offset)
    return d.select("row", "size", "source_size", "target", copies.cast("bigint").alias("copies"))


def mixture_report(docs: DataFrame, *, doc_id: str = "doc_id", **options) -> DataFrame:
    got = mix(docs, doc_id=doc_id, keep=F.struct(col(doc_id).alias("doc_id")), **options)
    return got.select("row.doc_id", "size", "source_size", "target",
                      (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: the columns of ``docs``, each row as often as it was drawn."""
    got = mix(docs, **options).where("copies > 0")
    return got.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
