"""Mixing sources to target weights with native distributed prefix sums.

Every document gets a hash-random key. Small rows (source, key, size) are range-sorted within their sources:
the ranges are cut by the data, through the middle of equal rows too, so a source or a text that holds a third
of all rows is sorted by a third of the tasks. One sum per range and source is prefix-summed per source, and a
running sum inside each range completes the position of every word. The budget of a source is then cut
at its exact word; sources whose budget exceeds their size repeat whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import stored, whole_text

#: A product of two sums of words has more digits than a long.
WIDE = "decimal(38,0)"

WORD = r"[^\x20\x09-\x0D]+"
#: The sources' weights in turn, by code point of the source.
WEIGHTS = (5, 2, 1)
#: No source is taken more often than this.
MOST_EPOCHS = 3
#: Copies of one row that a task writes out.
COPIES = 1 << 10


def words(column: str = "text") -> Column:
    return F.regexp_count(whole_text(column), F.lit(WORD)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, most=MOST_EPOCHS) -> DataFrame:
    """Target per source, for rows (source, source_size): all words shared by weight under a cap.

    Sources ordered by cap per weight are capped from the front: a source is above its cap exactly if
    what remains after all earlier caps, shared by the remaining weights, exceeds it. That condition
    is monotone along the order, so one pass of prefix sums gives the fixpoint of resharing.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long")
    caps = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    along = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    rest = along.rowsBetween(0, Window.unboundedFollowing)
    everything = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = caps.select(
        "*",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(rest).alias("weights_left"),
    )
    above = F.col("left").cast(WIDE) * F.col("weight").cast("int") > F.col("cap").cast(WIDE) * F.col("weights_left").cast("int")
    placed = placed.withColumn("capped", above)
    # Uncapped sources share what the first uncapped one finds.
    share = F.struct("left", "weights_left")
    shared = placed.withColumn("share", F.first(F.when(~F.col("capped"), share), ignorenulls=True).over(everything))
    return shared.select(
        "source",
        "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double"))
        .otherwise(F.col("share.left").cast("double") * F.col("weight") / F.col("share.weights_left"))
        .alias("target"),
    )


def _tie(docs: DataFrame) -> Column:
    return F.struct(*(c for c in ("lang", "n_chars") if c in docs.columns), F.lit(0))


def _key() -> Column:
    """The random key of a document, from its id and text."""
    return F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|"), whole_text()))


def _source() -> Column:
    """Null sorts last and joins like any other source."""
    return F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))


def dealt(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Small rows of all documents with the number of their range along source and key."""
    sized = docs.select("doc_id", _source().alias("source"), words().alias("size"), _key().alias("key"), _tie(docs).alias("tie"))
    # The number parts rows that are equal in all the rest, which are interchangeable.
    order = ["source", "key", "doc_id", "tie", "_row"]
    sized = sized.withColumn("_row", F.monotonically_increasing_id())
    sized = sized.repartitionByRange(ranges, *order) if ranges else sized.repartitionByRange(*order)
    return stored(sized.withColumn("range", F.spark_partition_id()), "mix-ranges")


def _taken(docs: DataFrame) -> DataFrame:
    """doc_id, source, key, tie, size, source_size, target and taken for every row."""
    rows = dealt(docs)
    sums = stored(rows.groupBy("source", "range").agg(F.sum("size").alias("range_size")), "range-sizes")
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(sums.groupBy("source").agg(F.sum("range_size").alias("source_size")))
    ranges = sums.select(
        "source", "range", F.coalesce(F.sum("range_size").over(along), F.lit(0)).alias("before_range")
    ).join(targets, "source")
    inside = Window.partitionBy("range", "source").orderBy("key", "doc_id", "tie", "_row")
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("in_range", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(ranges, ["range", "source"])
    budget = F.floor("target")
    epochs = F.coalesce(F.floor(F.try_divide(budget, F.col("source_size"))), F.lit(0))
    rest = budget - epochs * F.col("source_size") - F.col("before_range") - F.col("in_range")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return placed.select("doc_id", "source", "key", "tie", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target and taken (words, repeats counted) for every row.

    A null text has size 0 and a null source is a source of its own, last in order. Repeated rows are
    documents of their own; rows equal in id, text, lang and n_chars are interchangeable, so their order
    does not show. An empty table gives an empty result. Other columns are not read.
    """
    name = F.when(F.col("source").startswith("0"), F.substr(F.col("source"), F.lit(2)))
    return _taken(docs).select("doc_id", name.alias("source"), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Whole documents as often as the mix takes them, cut at the document boundary nearest to the budget.

    A document taken 2.3 times comes twice and one taken 2.5 times comes three times; documents without
    words (size 0) come once. Rows keep the columns of ``docs``. Rows equal in id, text, lang, source and n_chars are
    interchangeable: together they come as often as the mix takes them all, in the form whose other columns come
    first.
    """
    copies = F.when(F.col("size") == 0, 1).otherwise(F.round(F.try_divide(F.col("taken"), F.col("size"))).cast("int"))
    same = ["key", "source", "tie"]
    wanted = _taken(docs).groupBy(*same).agg(F.count(F.lit(1)).alias("rows"), F.sum(copies).alias("copies"))
    wanted = stored(wanted.where("copies > 0").toDF("k", "s", "t", "rows", "copies"), "mix-copies")
    rows = docs.select(F.struct(*docs.columns).alias("row"), _key().alias("key"), _source().alias("source"), _tie(docs).alias("tie"))
    rows = rows.join(wanted, (F.col("key") == F.col("k")) & (F.col("source") == F.col("s")) & F.col("tie").eqNullSafe(F.col("t")))
    single = rows.where("rows = 1").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    # Equal rows may be any number: one of them is written out by as many tasks as its copies need.
    equal = rows.where("rows > 1").groupBy(*same).agg(F.min("row").alias("row"), F.first("copies").alias("copies"))
    last = F.expr(f"(copies - 1) div {COPIES}").cast("int")
    equal = equal.select("row", "copies", F.explode(F.sequence(F.lit(0), last)).alias("slice")).repartition("row", "slice")
    size = F.least(F.lit(COPIES), F.col("copies") - F.col("slice") * COPIES).cast("int")
    equal = equal.select("row", F.explode(F.sequence(F.lit(1), size)))
    return single.select("row.*").unionByName(equal.select("row.*"))
