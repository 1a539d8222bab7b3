"""Last-writer-wins resolution and the partition layout, as DataFrame operators.

All take one row for each listing of a (symbol, date) in a shard index. ``order`` columns give a total order of listings,
from the oldest publication on. Catalyst combines them before the shuffle, and a filter on key columns passes below it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from skyledger.functions import columns as C
from skyledger.sources.scratch import stored

KEY = ("symbol", "date")
#: Datasets that a task follows at a time.
CHUNK_ROWS = 200_000


def flatten_shards(manifests: DataFrame) -> DataFrame:
    """A row for each shard of (pub_seq, shards), numbered within its manifest."""
    return manifests.select("pub_seq", F.posexplode("shards").alias("shard_seq", "shard")).select("pub_seq", "shard_seq", "shard.*")


def flatten_rows(indexes: DataFrame, *carry: str) -> DataFrame:
    """A row for each listing of (…, rows), numbered within its index."""
    return indexes.select(*carry, F.posexplode("rows").alias("idx_seq", "listed")).select(*carry, "idx_seq", "listed.*")


def latest_rows(listings: DataFrame, order: list[str], key: tuple[str, ...] = KEY) -> DataFrame:
    """The last listing of each key."""
    rest = [c for c in listings.columns if c not in key]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    return listings.groupBy(*key).agg(last).select(*key, *[F.col("_last")[c].alias(c) for c in rest])


def superseded_rows(listings: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    """How many listings a later one replaced: over all listings, before any filter."""
    per_key = listings.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("superseded_rows"))


def partition_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"year": F.year("date"), "month": F.month("date"), "prefix": C.prefix_for_symbol(F.col("symbol"))})


def with_ordinals(rows: DataFrame) -> DataFrame:
    """Adds ``row``: the place among the rows of the partition in order of symbol and date, from 0."""
    order = Window.partitionBy("year", "month", "prefix").orderBy(*KEY)
    return rows.withColumn("row", (F.row_number().over(order) - 1).cast("long"))


def partition_summary(rows: DataFrame) -> DataFrame:
    """Rows of each partition, in order of year, month and prefix."""
    return rows.groupBy("year", "month", "prefix").agg(F.count("*").alias("row_count")).orderBy("year", "month", "prefix")


def snapshot_chain(manifests: DataFrame, head: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """dataset_id and depth from the head back, of (dataset_id, previous_dataset_id); chains of any length. A loop ends where it comes back.

    Datasets are dealt by ranges of their ids, and a task follows each to where its chain leaves the task's chunk. The datasets at which a chain enters a
    chunk, few where ids follow the chain and at most all, are reached from the head by doubling; from there each chunk numbers its own. A dataset of
    several predecessors is followed to each of them, and the depths are the least.
    """
    before = F.col("previous_dataset_id")
    links = manifests.where("dataset_id IS NOT NULL").groupBy(F.col("dataset_id").alias("at"))
    steps = links.agg(F.min(before).alias("to"), F.coalesce(F.min(before) != F.max(before), F.lit(False)).alias("fork"))
    made = StructType([*steps.schema, StructField("chunk", LongType()), StructField("leaves", steps.schema["to"].dataType), StructField("steps", LongType())])
    chunks = stored(steps.repartitionByRange("at").sortWithinPartitions("at").mapInArrow(lambda batches: _followed(batches, chunk_rows), made), "chunks")
    far = chunks.where("leaves IS NOT NULL").select("at", F.col("leaves").alias("to"), "steps")
    start = chunks.where(F.col("at") == head).select("at", F.lit(0).cast("long").alias("depth"))
    entries, forks = far.select(F.col("to").alias("at")).union(start.select("at")), chunks.where("fork").select("at")
    several = not forks.isEmpty()
    if several:
        forked = manifests.where(before.isNotNull()).select(F.col("dataset_id").alias("at"), before.alias("to"), F.lit(1).cast("long").alias("steps")).join(forks, "at", "left_semi")
        entries, far = entries.union(forked.select("to")), far.unionByName(forked)
    jumps = stored(far.join(stored(entries.distinct(), "entries"), "at", "left_semi"), "jumps")
    reached = _reached(jumps, start, several)
    numbered = chunks.select("at", "to", "fork", "chunk").join(reached, "at", "left").groupBy("chunk")
    return numbered.applyInArrow(_numbered, StructType([StructField("dataset_id", steps.schema["at"].dataType), StructField("depth", IntegerType())]))


def _reached(jumps: DataFrame, start: DataFrame, several: bool) -> DataFrame:
    """What jumps (at, to, steps) reach from ``start`` (at, depth), with the least depth. Each round knows the jumps of 2^k steps of ``jumps`` and takes
    them from all that is reached, so the rounds grow with the logarithm of the longest way. ``several``: some have more than one jump, so ways meet again."""
    reached, found = start, None
    while True:
        further = reached.join(jumps, "at").select(F.col("to").alias("at"), (F.col("depth") + F.col("steps")).alias("depth"))
        reached = stored(reached.union(further).groupBy("at").agg(F.min("depth").alias("depth")), "chain")
        before, found = found, reached.agg(F.count("*"), F.sum(F.col("depth").cast("decimal(38,0)"))).first()
        if found == before:
            return reached
        far = jumps.select(F.col("at").alias("to"), F.col("to").alias("beyond"), F.col("steps").alias("more"))
        jumps = jumps.join(far, "to").select("at", F.col("beyond").alias("to"), (F.col("steps") + F.col("more")).alias("steps"))
        jumps = stored(jumps.groupBy("at", "to").agg(F.min("steps").alias("steps")) if several else jumps, "jumps")


def _next(rows: pa.Table) -> np.ndarray:
    """Where each row's predecessor lies among the rows; -1 where it is none of them, and before and behind a fork."""
    fork = rows["fork"].to_numpy()
    place = pc.fill_null(pc.index_in(rows["to"], value_set=rows["at"].combine_chunks()), -1).to_numpy()
    return np.where(fork | (place < 0) | fork[place], -1, place)


def _followed(batches: Iterator[pa.RecordBatch], chunk_rows: int) -> Iterator[pa.RecordBatch]:
    """The rows in chunks, each with the dataset outside its chunk (or the fork) that its chain leads to, if any, and the steps to there."""
    held, chunk = [], TaskContext.get().partitionId() << 32

    def follow() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        beyond = _next(rows)
        n, ends = len(beyond), beyond < 0
        last, steps = np.where(ends, np.arange(n), beyond), np.where(ends, 0, 1)
        for _ in range(n.bit_length()):
            steps, last = steps + steps[last], last[last]
        leaves = pa.array(np.where(ends[last] & ~rows["fork"].to_numpy()[last], last, -1))  # others go round within the chunk
        leaves = rows["to"].combine_chunks().take(pc.if_else(pc.less(leaves, 0), pa.scalar(None, pa.int64()), leaves))
        columns = [*[c.combine_chunks() for c in rows.columns], pa.array(np.full(n, chunk)), leaves, pa.array(steps + 1)]
        return pa.RecordBatch.from_arrays(columns, names=[*rows.column_names, "chunk", "leaves", "steps"])

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= chunk_rows:
            yield follow()
            held, chunk = [], chunk + 1
    if any(b.num_rows for b in held):
        yield follow()


def _numbered(rows: pa.Table) -> pa.Table:
    """The rows of a chunk that the chain holds, with their depths, of which those where it enters are given."""
    given, beyond = rows["depth"].to_pylist(), _next(rows).tolist()
    depths: list[int | None] = [None] * len(given)
    for depth, i in sorted((d, i) for i, d in enumerate(given) if d is not None):
        while i >= 0 and (depths[i] is None or depths[i] > depth):
            depths[i] = depth
            i, depth = beyond[i], depth + 1
    made = pa.table({"dataset_id": rows["at"], "depth": pa.array(depths, pa.int32())})
    return made.filter(pc.is_valid(made["depth"]))


def semantic_mismatches(manifests: DataFrame, head: Column) -> DataFrame:
    """How many manifests differ from the head's semantics."""
    return manifests.agg(F.count_if(F.struct("observation_extension", "input_count", "feature_fingerprint") != head).alias("mismatches"))


def crosscheck(entries: DataFrame, listed: DataFrame) -> DataFrame:
    """Entries of manifests (path, rowCount, bytes) against what indexes list (path, row): one row for each path of either side."""
    counts = listed.groupBy("path").agg(F.count("*").alias("listed"), F.max("row").alias("last"))
    found = entries.select("path", F.col("rowCount").alias("declared"), "bytes").join(counts, "path", "full")
    agree = F.coalesce((F.col("declared") == F.col("listed")) & (F.col("last") == F.col("listed") - 1), F.lit(False))
    return found.select("path", "declared", "listed", "bytes", agree.alias("agree"))


def duplicates(rows: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once, and how often."""
    return rows.groupBy(*columns).agg(F.count("*").alias("n")).where("n > 1")


def ordinal_faults(listings: DataFrame, shard: list[str], ordinal: str, row_count: Column) -> DataFrame:
    """Shards whose listings name a row out of range or twice, with the number of such listings."""
    per_row = listings.groupBy(*shard, ordinal).agg(F.count("*").alias("n"), F.max(row_count).alias("rows"))
    fault = F.when(F.col(ordinal) >= F.col("rows"), F.col("n")).otherwise(F.col("n") - 1)
    return per_row.groupBy(*shard).agg(F.sum(fault).cast("long").alias("faults")).where("faults > 0")


def split_refused(scored: DataFrame, outputs: str = "y") -> tuple[DataFrame, DataFrame]:
    """Rows whose outputs are all finite, and the others with the reason."""
    bad = F.filter(outputs, lambda v: ~C.is_finite(v))[0]
    text = F.when(F.isnan(bad), "NaN").when(bad > 0, "inf").otherwise("-inf")
    kept, left = scored.where(C.all_finite(F.col(outputs))), scored.where(~C.all_finite(F.col(outputs)))
    return kept, left.withColumn("reason", F.concat(F.lit("non-finite output "), text))
