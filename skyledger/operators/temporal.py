"""Joins by time, for keys of any size: nothing here holds, windows or sorts a whole key in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from skyledger.sources.scratch import stored


def asof_join(left: DataFrame, right: DataFrame, key: tuple[str, str], time: tuple[str, str], ties: tuple[str, ...] = (), prefix: str = "right_") -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` of its key at or before its time, null where there is none.

    Both sides are dealt together by ranges of key and time, so a key with most of the rows spans as many tasks as it needs. A row looks back within its
    own range; what the ranges before it hold of its key comes as one row for each range and key. Of rows of ``right`` at the same time, the last by ``ties``
    counts. Rows with a null key or time match nothing. ``key``, ``time``: the columns' names on the left and on the right. The right side's columns
    come with ``prefix``.
    """
    rows = right.select([F.col(c).alias(f"{prefix}{c}") for c in right.columns]).where(F.col(prefix + key[1]).isNotNull() & F.col(prefix + time[1]).isNotNull())
    tie = F.struct(*[F.col(prefix + c) for c in ties]) if ties else F.struct(F.lit(0).alias("none"))
    later = rows.select(F.col(prefix + key[1]).alias("k"), F.col(prefix + time[1]).alias("t"), F.lit(0).alias("side"), tie.alias("tie"), F.struct(*rows.columns).alias("r"))
    own = left.select(F.col(key[0]).alias("k"), F.col(time[0]).alias("t"), F.lit(1).alias("side"), F.struct(*left.columns).alias("l"))
    both = own.unionByName(later, allowMissingColumns=True)
    ranged = stored(both.repartitionByRange("k", "t", "side", "tie").withColumn("part", F.spark_partition_id()), "asof")
    at = F.struct("t", "tie")
    spans = ranged.where("k IS NOT NULL").groupBy("k", "part").agg(F.max_by("r", F.when(F.col("r").isNotNull(), at)).alias("last"))
    before = F.last("last", ignorenulls=True).over(Window.partitionBy("k").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = spans.select("k", "part", before.alias("carried")).where("carried IS NOT NULL")
    here = F.last("r", ignorenulls=True).over(Window.partitionBy("part", "k").orderBy("t", "side", "tie").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = ranged.withColumn("here", here).where("side = 1").join(carried, ["k", "part"], "left")
    match = F.when(F.col("t").isNotNull() & F.col("k").isNotNull(), F.coalesce("here", "carried"))
    return found.select("l.*", match.alias("m")).select(*left.columns, *[F.col("m")[c].alias(c) for c in rows.columns])


def interval_join(left: DataFrame, right: DataFrame, on: list[str], left_span: tuple[Column, Column], right_span: tuple[Column, Column], width: int) -> DataFrame:
    """Pairs with equal ``on`` whose spans of whole numbers, both ends included, overlap. The sides share no other column names.

    Spans lie in bins of ``width``; one that crosses an edge goes to each bin it touches, and a pair counts in the bin where its overlap begins, so
    it comes out once. Bins are join keys, so a long key is spread over its bins. Choose a width near the longer side's usual length: a span goes to
    length / width bins. Spans that are null or end before they begin match nothing.
    """

    def binned(side: DataFrame, span: tuple[Column, Column], name: str) -> DataFrame:
        kept = side.withColumns({f"_{name}_from": span[0].cast("long"), f"_{name}_to": span[1].cast("long")}).where(F.col(f"_{name}_from") <= F.col(f"_{name}_to"))
        bin_of = lambda c: F.floor(F.col(f"_{name}_{c}") / width)
        return kept.withColumn("_bin", F.explode(F.sequence(bin_of("from"), bin_of("to"))))

    begins = F.greatest("_left_from", "_right_from")
    pairs = binned(left, left_span, "left").join(binned(right, right_span, "right"), [*on, "_bin"])
    found = pairs.where((begins <= F.least("_left_to", "_right_to")) & (F.floor(begins / width) == F.col("_bin")))
    return found.drop("_bin", *[f"_{s}_{e}" for s in ("left", "right") for e in ("from", "to")])
