"""What the operators share: the folder all executors see, tables that cut lineage, and Arrow helpers."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=1)
def _temporary() -> str:
    made = tempfile.mkdtemp(prefix="skyledger-")
    atexit.register(shutil.rmtree, made, ignore_errors=True)
    return f"file://{made}"


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Where it is unset and Spark runs in one local process, a temporary folder takes its place (removed at exit); on a
    cluster without the setting the SQL warehouse is used if it lies in a shared store; a machine-local folder is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return _temporary()
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if "://" not in warehouse or warehouse.startswith("file:"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return warehouse.rstrip("/") + "/_skyledger"


_made: list[tuple[SparkSession, str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; what is there when the program ends is removed."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@atexit.register
def _clean() -> None:
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session may be gone
            remove(spark, path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: a cut in the lineage that outlives executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made._stored_at = path
    return made


def dropped(*tables: DataFrame) -> None:
    """Deletes tables of ``stored`` that nothing reads any more."""
    for df in tables:
        remove(df.sparkSession, df._stored_at)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes ``path`` through Hadoop's file system layer, whatever store it is in."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches cut to at most ``rows`` rows, so that what a task holds beside its input stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def field_at(df: DataFrame, name: str) -> int:
    """The place of a column, by the session's rule for upper and lower case; for Arrow batches, which know columns by place.
    A name that is none, or stands for several columns, is Spark's own error."""
    df[name]  # noqa: B018
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    return next(i for i, c in enumerate(df.columns) if c == name or not exact and c.lower() == name.strip("`").lower())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
