"""Scratch tables in the folder that driver and executors share: they cut lineage, and outlive executors."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []


@lru_cache(maxsize=1)
def _temporary() -> str:
    made = tempfile.mkdtemp(prefix="skyledger-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return f"file://{made}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``; a temporary folder takes its place where Spark is one local process. What is there when
    the program ends is removed."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{(found or _temporary()).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session may be gone
            target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
