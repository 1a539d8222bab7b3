"""Differences between two sets of predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prediction_diff(mine: DataFrame, theirs: DataFrame, key: tuple[str, ...] = ("symbol", "date"), value: str = "value", tolerance: float = 1e-5) -> DataFrame:
    """One row: rows compared, bit-identical rows, largest absolute difference and its key, rows that only one side has, and
    whether the sets agree within the tolerance (a missing row is a disagreement). One shuffle of each side."""
    joined = mine.select(*key, F.col(value).alias("_a"), F.lit(True).alias("_in_a")).join(theirs.select(*key, F.col(value).alias("_b"), F.lit(True).alias("_in_b")), list(key), "full")
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    far = F.when(both, F.abs(F.col("_a") - F.col("_b")))
    made = joined.agg(
        F.count_if(both).alias("compared"), F.count_if(both & (F.col("_a") == F.col("_b"))).alias("identical"), F.max(far).alias("max_abs_diff"),
        F.max_by(F.struct(*key), F.struct(far.alias("far"), *key)).alias("_worst"), F.count_if(F.col("_in_b").isNull()).alias("only_in_first"), F.count_if(F.col("_in_a").isNull()).alias("only_in_second"),
    )
    agree = (F.col("only_in_first") + F.col("only_in_second") == 0) & (F.coalesce("max_abs_diff", F.lit(0.0)) <= tolerance)
    return made.select("compared", "identical", "max_abs_diff", *[F.col("_worst")[k].alias(f"worst_{k}") for k in key], "only_in_first", "only_in_second", agree.alias("agree"))


def missing_rows(mine: DataFrame, theirs: DataFrame, key: tuple[str, ...] = ("symbol", "date")) -> DataFrame:
    """Keys of the first set that the second lacks."""
    return mine.select(*key).join(theirs.select(*key), list(key), "left_anti")
