"""The current row of each key as a stream of changes, for listings that are restated at any later time.

``streaming.scoring.latest_rows_stream`` forgets a key with its window of event time; here a key's last listing is kept in
state of its own until it has not been restated for a time to live. A listing that replaces another comes out as two changes,
the one before with ``-`` and the new one with ``+``, so sums and counts over the changes stay right. State is a row a key.

Keyed state costs calls of Python for every key of a batch. ``restated_rows_merged`` gives the same changes for batches of
many keys: there the current listings are a table that Spark merges each batch into.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor
from pyspark.sql.types import StructField, StructType, StringType

from skyledger.operators.resolve import KEY

#: The store that keyed state needs.
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Restated(StatefulProcessor):
    """Keeps the listing of a key that comes last by ``order``; of equal ones the first to come stays."""

    def __init__(self, key: tuple[str, ...], kept: StructType, order: list[str], ttl_ms: int | None):
        self.kept, self.ttl_ms = kept, ttl_ms
        self.place = [kept.names.index(c) for c in order]
        self.change = Row(*key, "change", *kept.names)

    def init(self, handle) -> None:
        self.current = handle.getValueState("current", self.kept, self.ttl_ms)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        names, place = self.kept.names, self.place
        before = tuple(self.current.get()) if self.current.exists() else None
        last = before
        for row in rows:  # one at a time: a key may have any number
            held = tuple(row[c] for c in names)
            if last is None or [held[i] for i in place] > [last[i] for i in place]:
                last = held
        if last is not None and last != before:
            self.current.update(last)
            if before is not None:
                yield self.change(*key, "-", *before)
            yield self.change(*key, "+", *last)

    def close(self) -> None:
        pass


def restated_rows_stream(listings: DataFrame, order: list[str], ttl_ms: int | None = None, key: tuple[str, ...] = KEY) -> DataFrame:
    """Changes (the key, ``change``, the other columns) of the current listing of each key, for output mode ``append``. ``ttl_ms``: how long after
    its last change a key is known, in processing time; a listing that comes later is taken for a new key's. Rows whose ``order`` holds a
    null are left out: they come before or after nothing. A null in the key is a key like others; a column named ``change`` is refused."""
    refuse_own(listings, "change")
    set_state_store(listings.sparkSession)
    kept = StructType([f for f in listings.schema if f.name not in key])
    change = StructType([*[listings.schema[k] for k in key], StructField("change", StringType()), *kept])
    known = listings.dropna(subset=order)
    return known.groupBy(*key).transformWithState(Restated(key, kept, order, ttl_ms), change, "Append", "None" if ttl_ms is None else "ProcessingTime")


def restated_rows_merged(listings: DataFrame, order: list[str], path: str, key: tuple[str, ...] = KEY) -> DataStreamWriter:
    """The changes of ``restated_rows_stream`` without a time to live, to start: they come as Parquet below ``path``/changes with the number of their
    ``batch``; the stream's checkpoint lies below ``path`` too. A batch costs as much as its rows and the keys known so far, of which two tables are
    kept, after the last batch and the one before. A batch that has to run again reads the table before it and overwrites what it wrote, so each
    change is there once."""
    refuse_own(listings, "change", "batch")
    rest = [c for c in listings.columns if c not in key]

    def merge(batch: DataFrame, number: int) -> None:
        table = lambda n: f"{path}/current/{n % 2}"
        rows = batch.dropna(subset=order).select(*key, F.struct(*rest).alias("_row"), F.lit(False).alias("_known"))
        if number:
            known = batch.sparkSession.read.parquet(table(number - 1))
            rows = known.select(*key, "_row", F.lit(True).alias("_known")).unionByName(rows)
        place = [F.col("_row")[c] for c in order]
        last = F.max_by(F.struct("_row", "_known"), F.struct(*place, "_known")).alias("_last")  # of equal ones the known one stays
        before = F.max_by("_row", F.when(F.col("_known"), F.struct(*place))).alias("_before")
        merged = rows.groupBy(*key).agg(last, before).select(*key, "_last._row", "_last._known", "_before")
        merged.write.mode("overwrite").parquet(table(number))
        new = batch.sparkSession.read.parquet(table(number)).where("NOT _known")
        both = F.array(F.struct(F.lit("-").alias("change"), F.col("_before").alias("row")), F.struct(F.lit("+").alias("change"), F.col("_row").alias("row")))
        changes = new.select(*key, F.explode(both).alias("_c")).where("_c.row IS NOT NULL").select(*key, "_c.change", "_c.row.*")
        changes.write.mode("overwrite").parquet(f"{path}/changes/batch={number}")

    return listings.writeStream.foreachBatch(merge).option("checkpointLocation", f"{path}/state")


def refuse_own(listings: DataFrame, *names: str) -> None:
    for name in names:
        if name in listings.columns:
            raise ValueError(f"the listings have a column '{name}' of their own")


def set_state_store(spark: SparkSession) -> None:
    spark.conf.set(*STATE_STORE)
