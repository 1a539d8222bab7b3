"""Sketches of prediction sets: a few hundred values for each partition and output, from which counts, extremes, means,
quantiles and numbers of symbols of any union of partitions follow without reading a payload.

Sketches are Spark's own mergeable ones. A quantile's rank is off by at most ``RANK_ERROR`` of all rows, a number of symbols by
at most ``DISTINCT_ERROR`` of itself, each in 99 of 100 cases; counts and extremes are exact, means but for rounding.
"""

from __future__ import annotations

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.sources.files import file_system
from skyledger.sources.predictions import OutputError, inspect_output

#: Sizes of the sketches, and the errors that go with them: 2.296 / k^0.9021, and 2.6 standard errors of 1.04 / sqrt(2^lgk).
QUANTILE_K, DISTINCT_LGK = 400, 12
RANK_ERROR, DISTINCT_ERROR = 2.296 / QUANTILE_K**0.9021, 2.6 * 1.04 / 2 ** (DISTINCT_LGK / 2)
FOLDER = "_sketches"
PARTITION = ("year", "month", "prefix")


def partition_sketches(predictions: DataFrame) -> DataFrame:
    """A row for each (year, month, prefix) and output (from 0): n_rows, least, most, total, and two sketches. Rows are
    aggregated where they are read; only sketches are exchanged. Null and non-finite values take no part."""
    values = predictions.select(*PARTITION, "symbol", F.posexplode("y").alias("output", "v"))
    fine = values.where(F.col("v").isNotNull() & ~F.isnan("v") & (F.abs("v") < float("inf")))
    return fine.groupBy(*PARTITION, "output").agg(
        F.count("*").alias("n_rows"), F.min("v").alias("least"), F.max("v").alias("most"), F.sum("v").alias("total"),
        F.kll_sketch_agg_double("v", QUANTILE_K).alias("values"), F.hll_sketch_agg("symbol", DISTINCT_LGK).alias("symbols"),
    )


def merged(sketches: DataFrame, *by: str, quantiles: tuple[float, ...] = (0.5,)) -> DataFrame:
    """The union of the partitions' sketches for each of ``by``: n_rows, least, most, mean, quantiles (an array), n_symbols."""
    grouped = sketches.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"), F.min("least").alias("least"), F.max("most").alias("most"), (F.sum("total") / F.sum("n_rows")).alias("mean"),
        F.kll_merge_agg_double("values").alias("_values"), F.hll_sketch_estimate(F.hll_union_agg("symbols")).alias("n_symbols"),
    )
    at: Column = F.kll_sketch_get_quantile_double("_values", F.array(*[F.lit(float(q)) for q in quantiles]))
    return grouped.withColumn("quantiles", at).drop("_values")


def keep_sketches(spark: SparkSession, output: str) -> DataFrame:
    """Sketches of a finished run, kept in its folder by year; a run that has them is not read again. Tasks that fail leave no
    sketches behind: without its mark of success a folder is written anew."""
    if inspect_output(output) is None:
        raise OutputError("io", output, "there is no finished run")
    folder = f"{output.rstrip('/')}/{FOLDER}"
    fs, at = file_system(f"{folder}/_SUCCESS")
    if fs.get_file_info(at).type != pafs.FileType.File:
        made = partition_sketches(spark.read.format("predictions").load(output))
        made.coalesce(max(1, spark.sparkContext.defaultParallelism // 4)).write.partitionBy("year").mode("overwrite").parquet(folder)
    return spark.read.parquet(folder)
