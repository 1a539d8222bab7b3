"""Versioned observation archives as a Spark data source.

The driver walks the chain (``chain``), whose size goes with the number of files. Everything that goes with the number of rows is done
in tasks. A (symbol, date) lives in one (year, month, prefix) partition, so most partitions are resolved by the task that reads their indexes,
without a shuffle; a task takes several small ones. Of a partition with more than SPLIT_ROWS listings, each shard's index is read by a task of its
own, which sorts its listings; the sorted listings are dealt by ranges of symbol and date, and merged there, so that no task holds more than its range.

``open_archive`` has all indexes checked this way and raises the fault that comes first in chain order. Where it is given a folder to keep listings
in, the scan reads those: no index is opened twice, and a partition is cut into as many tasks as its payload needs. Then a payload is
hashed by one of the tasks that read it, so a query that stops early (a limit) may not have checked every payload of a partition that was cut;
a query that reads all rows has.
"""

from __future__ import annotations

import hashlib
import json
import os
import pickle
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from contextlib import nullcontext
from dataclasses import dataclass, field
from datetime import date as Date
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, StringStartsWith

from skyledger.functions.values import MarketDate, number_text, prefix_for_symbol, sha256_hex
from skyledger.operators.network import EngineError, Predictor, load_creature
from skyledger.sources.chain import BYTES_PER_VALUE, Semantics, Shard, by_partition, chain_shards, first_repeated, snapshot
from skyledger.sources.files import ArchiveError, file_system, read_bytes, write_bytes
from skyledger.sources.indexes import Keeper, Kept, cut, latest, read_kept, read_listings, within

#: Without a model; with one, ``y`` takes the place of ``x``.
SCHEMA = "year int, month int, prefix string, row long, symbol string, date date, exchange string, alias string, x array<float>, fault string"
#: Values in a batch that is read, so that wide rows make short batches; payload that small partitions share a task for.
BATCH_VALUES = 2_000_000
TASK_BYTES = 64 << 20
#: Payload of one partition that a task holds at a time; larger partitions are read by ranges.
HELD_BYTES = 256 << 20
#: Listings that a task resolves at a time; a partition with more is merged from sorted runs by several tasks.
SPLIT_ROWS = 250_000

Key = tuple[int, int, str]


@dataclass
class Partition:
    year: int
    month: int
    prefix: str
    row_count: int
    #: Where its listings are kept, if they are, and the orders of the shards that hold its rows.
    kept: list[Kept] = field(default_factory=list, repr=False)
    needed: list[int] = field(default_factory=list, repr=False)

    @property
    def key(self) -> Key:
        return self.year, self.month, self.prefix

    @property
    def id(self) -> str:
        return f"{self.year:04}/{self.month:02}/{self.prefix}"


@dataclass
class Archive:
    """A resolved snapshot: what the driver needs to know of it."""

    fingerprint_root: str
    dataset_id: str
    dataset_chain: list[str]
    semantics: Semantics
    shards: list[Shard] = field(repr=False)
    partitions: list[Partition] = field(repr=False)
    superseded_rows: int
    first: MarketDate | None = None
    last: MarketDate | None = None
    #: The folder that its listings are kept in.
    keep: str | None = None

    @property
    def row_count(self) -> int:
        return sum(p.row_count for p in self.partitions)


def read_payload(root: str, shard: Shard, width: int) -> np.ndarray:
    """All rows of a shard, after its size and hash are checked."""
    path = f"{root}/{shard.path}"
    try:
        data = read_bytes(path)
    except OSError as e:
        raise ArchiveError("io", path, str(e)) from None
    if len(data) != shard.bytes:
        raise ArchiveError("corrupt", path, f"size {len(data)}, expected {shard.bytes}")
    if (found := sha256_hex(data)) != shard.sha256:
        raise ArchiveError("hash", path, f"SHA-256 {found}, expected {shard.sha256}")
    return np.frombuffer(data, "<f4").reshape(-1, width)


def check_payload(root: str, shard: Shard) -> None:
    """Size and hash of a shard, in bounded memory."""
    path, found, size = f"{root}/{shard.path}", hashlib.sha256(), 0
    try:
        with file_system(path)[0].open_input_stream(file_system(path)[1], compression=None) as source:
            while part := source.read(8 << 20):
                found.update(part)
                size += len(part)
    except OSError as e:
        raise ArchiveError("io", path, str(e)) from None
    if size != shard.bytes:
        raise ArchiveError("corrupt", path, f"size {size}, expected {shard.bytes}")
    if found.hexdigest() != shard.sha256:
        raise ArchiveError("hash", path, f"SHA-256 {found.hexdigest()}, expected {shard.sha256}")


def _refuse_non_finite(root: str, shards: dict[int, Shard], rows: pa.Table, values: np.ndarray) -> None:
    with np.errstate(all="ignore"):
        if np.isfinite(values.sum()):  # a sum of finite values may overflow, so only this much is quick
            return
    bad = ~np.isfinite(values)
    if bad.any():
        i, column = (int(x[0]) for x in np.nonzero(bad))
        symbol, date = rows["symbol"][i].as_py(), MarketDate.from_epoch_days(rows["date"][i].as_py())
        raise ArchiveError("corrupt", f"{root}/{shards[rows['shard'][i].as_py()].path}", f"value {column} of {symbol} on {date} is {number_text(float(values[i, column]))}")


def gather(root: str, shards: dict[int, Shard], rows: pa.Table, width: int, step: int, checks: Iterable[int] | None = None) -> Iterator[np.ndarray]:
    """The observations of the listings, ``step`` rows at a time. All payloads are checked before any row is, in the order in which rows first
    need them; ``checks``: only these are, as other tasks check the others. Payloads that would not fit in memory are read by ranges."""
    order, number = rows["shard"].to_numpy(), rows["row"].to_numpy()
    seen, at = np.unique(order, return_index=True)
    needed = seen[np.argsort(at)].tolist()
    if checks is None and sum(shards[o].bytes for o in needed) <= HELD_BYTES:
        out = np.empty((len(order), width), np.float32)
        for o in needed:
            own = np.flatnonzero(order == o)
            out[own] = read_payload(root, shards[o], width)[number[own]]
        _refuse_non_finite(root, shards, rows, out)
        yield from (out[low : low + step] for low in range(0, len(order), step))
        return
    for o in needed if checks is None else checks:
        check_payload(root, shards[o])
    row_bytes = width * BYTES_PER_VALUE
    for low in range(0, len(order), step):
        part = rows.slice(low, step)
        out = np.empty((part.num_rows, width), np.float32)
        for o in np.unique(order[low : low + step]).tolist():
            own = np.flatnonzero(order[low : low + step] == o)
            own = own[np.argsort(number[low + own], kind="stable")]
            spots = number[low + own]
            fs, path = file_system(f"{root}/{shards[o].path}")
            try:
                with fs.open_input_file(path) as source:
                    edges = [0, *(np.flatnonzero(np.diff(spots) != 1) + 1).tolist(), len(spots)]
                    for a, b in zip(edges, edges[1:]):  # rows that lie side by side are one read
                        data = source.read_at((b - a) * row_bytes, int(spots[a]) * row_bytes)
                        if len(data) != (b - a) * row_bytes:
                            raise ArchiveError("corrupt", f"{root}/{shards[o].path}", f"size is less than {shards[o].bytes}")
                        out[own[a:b]] = np.frombuffer(data, "<f4").reshape(-1, width)
            except OSError as e:
                raise ArchiveError("io", f"{root}/{shards[o].path}", str(e)) from None
        _refuse_non_finite(root, shards, part, out)
        yield out


def _fault(order: int, e: ArchiveError) -> str:
    return json.dumps([order, e.kind, e.path, e.detail])


_SUMMARY = "year int, month int, prefix string, task int, n long, replaced long, fault string, file string, start long, shards array<int>"
_SUMMARY_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32())]


def _summary(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_SUMMARY_TYPES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SUMMARY_TYPES)], names=[x.split()[0] for x in _SUMMARY.split(", ")])


def _resolved(spark: SparkSession, root: str, groups: list[tuple[Key, list[Shard]]], semantics: Semantics, first: MarketDate | None, last: MarketDate | None, keep: str | None) -> DataFrame:
    """Partitions that a task resolves by itself: a row (_SUMMARY) for each."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list]:
        held, n = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                key, entries = json.loads(text)
                shards = [Shard(**e) for e in entries]
                rows = sum(s.row_count for s in shards)
                if held and n + rows > SPLIT_ROWS:
                    yield held
                    held, n = [], 0
                held.append((key, shards))
                n += rows
        if held:
            yield held

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with Keeper(keep) if keep else nullcontext() as keeper:
            for held in chunks(batches):
                listings, faults = read_listings(root, [(i, s) for i, (_, shards) in enumerate(held) for s in shards], semantics)
                rows, gone = latest(listings)
                replaced = np.bincount(gone, minlength=len(held))
                rows = within(rows, first, last)
                edges = np.searchsorted(rows["part"].to_numpy(), np.arange(len(held) + 1))
                out = []
                for i, (key, _) in enumerate(held):
                    n = int(edges[i + 1] - edges[i])
                    own = rows.slice(int(edges[i]), n)
                    kept = keeper.add(own) if keeper and n else None
                    out.append((*key, 0, n, int(replaced[i]), _fault(*faults[i]) if i in faults else None, kept and kept.file, kept and kept.start, pc.unique(own["shard"]).to_pylist()))
                yield _summary(out)

    texts = [(json.dumps([key, [s.__dict__ for s in shards]]),) for key, shards in groups]
    return spark.createDataFrame(texts, "g string").mapInArrow(check, _SUMMARY)  # in as many tasks as there are cores


_RUN = "year int, month int, prefix string, symbol string, date int, shard int, at int, row long, exchange string, alias string, fault string"
_RUN_ORDER = ["year", "month", "prefix", "symbol", "date", "shard", "at"]


def sorted_runs(spark: SparkSession, root: str, shards: list[Shard], semantics: Semantics) -> DataFrame:
    """The listings of each shard, in order of symbol and date; a task reads one shard. A shard at fault is one row with its fault."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                s = shards[i]
                listings, faults = read_listings(root, [(0, s)], semantics)
                listings = listings.append_column("at", pa.array(np.arange(listings.num_rows, dtype=np.int32))).sort_by([(c, "ascending") for c in ("symbol", "date", "at")])
                n = 1 if faults else listings.num_rows
                made = {"year": pa.array([s.year] * n, pa.int32()), "month": pa.array([s.month] * n, pa.int32()), "prefix": pa.array([s.prefix] * n, pa.string())}
                if faults:
                    made |= {"shard": pa.array([s.order], pa.int32()), "fault": pa.array([_fault(*faults[0])])}
                else:
                    made |= {c: listings[c].combine_chunks() for c in ("symbol", "date", "shard", "at", "row", "exchange", "alias")}
                kinds = [("year", pa.int32()), ("month", pa.int32()), ("prefix", pa.string()), ("symbol", pa.string()), ("date", pa.int32()), ("shard", pa.int32()), ("at", pa.int32()), ("row", pa.int64()), ("exchange", pa.string()), ("alias", pa.string()), ("fault", pa.string())]
                table = pa.table([made.get(c, pa.nulls(n, t)) for c, t in kinds], names=[c for c, _ in kinds])
                yield from table.to_batches(max_chunksize=20_000)

    return spark.range(0, len(shards), 1, max(1, len(shards))).mapInArrow(read, _RUN)


def equal_to_next(rows: pa.Table, columns: list[str]) -> np.ndarray:
    """Whether each row but the last has the values of the next one in the columns."""
    same = np.ones(max(0, rows.num_rows - 1), bool)
    for c in columns:
        x = rows[c].combine_chunks()
        same &= pc.equal(x[1:], x[:-1]).to_numpy(zero_copy_only=False)
    return same


def merged(runs: DataFrame, tasks: int, first: MarketDate | None, last: MarketDate | None, keep: str) -> DataFrame:
    """The listings that count of sorted runs, kept in files: a row (_SUMMARY) for each piece of a partition. Listings of one symbol and date
    lie in one range, where the last of them wins; a task holds a batch at a time."""
    ranged = runs.repartitionByRange(tasks, *_RUN_ORDER[:5]).sortWithinPartitions(*_RUN_ORDER)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        found: dict[Key, list] = {}
        with Keeper(keep) as keeper:
            over: pa.Table | None = None  # the last listing so far: the next batch may hold one that replaces it

            def keep_rows(rows: pa.Table) -> None:
                differs = ~equal_to_next(rows, _RUN_ORDER[:3])
                edges = [0, *(np.flatnonzero(differs) + 1).tolist(), rows.num_rows]
                for low, high in zip(edges, edges[1:]):
                    if low == high:
                        continue
                    own = rows.slice(low, high - low)
                    key = tuple(own[c][0].as_py() for c in _RUN_ORDER[:3])
                    counted = within(own, first, last)
                    listed = counted.append_column("part", pa.array(np.zeros(counted.num_rows, np.int32))).select(["part", "symbol", "date", "exchange", "alias", "shard", "row"])
                    held = found.setdefault(key, [0, None, set()])
                    piece = keeper.add(listed)
                    held[0] += piece.n
                    held[1] = piece if held[1] is None else held[1]
                    held[2].update(pc.unique(listed["shard"]).to_pylist())

            gone: dict[Key, int] = defaultdict(int)
            for batch in batches:
                rows = pa.Table.from_batches([batch])
                rows = rows if over is None else pa.concat_tables([over, rows])
                if rows.num_rows > 1:
                    same = equal_to_next(rows, _RUN_ORDER[:5])
                    lost = rows.slice(0, rows.num_rows - 1).filter(pa.array(same))
                    for place in lost.select(["year", "month", "prefix"]).to_pylist():
                        gone[tuple(place.values())] += 1
                    keep_rows(rows.slice(0, rows.num_rows - 1).filter(pa.array(~same)))
                over = rows.slice(rows.num_rows - 1)
            if over is not None and over.num_rows:
                keep_rows(over)
            yield _summary([(*key, task, n, gone[key], None, piece.file, piece.start, sorted(needed)) for key, (n, piece, needed) in found.items()])

    return ranged.mapInArrow(merge, _SUMMARY)


def spark_path(path: str) -> str:
    return path if "://" in path else "file://" + os.path.abspath(path)


def open_archive(spark: SparkSession, root: str, dataset: str | None = None, first: MarketDate | None = None, last: MarketDate | None = None, keep: str | None = None) -> Archive:
    """Checks the whole snapshot's manifests and indexes and sums it up; reads no payload. ``keep``: a folder that driver and executors share, for the
    listings that count; its owner removes it."""
    root = root.rstrip("/")
    head, chain, semantics = snapshot(root, dataset)
    shards = chain_shards(chain)
    twice = first_repeated(shards)
    groups = by_partition(shards if twice is None else shards[: twice[0]])
    large = [g for g in groups if keep and sum(s.row_count for s in g[1]) > SPLIT_ROWS]
    names = {g[0] for g in large}
    rows = []
    if small := [g for g in groups if g[0] not in names]:
        rows += _resolved(spark, root, small, semantics, first, last, keep).collect()  # a row for each partition
    faults = [] if twice is None else [(twice[0], twice[1])]
    if large:
        path = f"{spark_path(keep)}/runs-{uuid.uuid4().hex}"
        sorted_runs(spark, root, [s for _, held in large for s in held], semantics).write.parquet(path)
        runs = spark.read.schema(_RUN).parquet(path)
        told = [r.fault for r in runs.where("fault IS NOT NULL").select("fault").collect()]  # a row for each shard at fault
        tasks = 1 + sum(s.row_count for _, held in large for s in held) // SPLIT_ROWS
        rows += merged(runs, tasks, first, last, keep).collect() if not told else []  # a row for each partition and range
        faults += [(order, ArchiveError(*parts)) for order, *parts in map(json.loads, told)]
    faults += [(order, ArchiveError(*parts)) for order, *parts in (json.loads(r.fault) for r in rows if r.fault is not None)]
    if faults:
        raise min(faults, key=lambda x: x[0])[1]
    found: dict[Key, Partition] = {}
    for r in sorted((r for r in rows if r.n), key=lambda r: (r.year, r.month, r.prefix.encode(), r.task)):
        p = found.setdefault((r.year, r.month, r.prefix), Partition(r.year, r.month, r.prefix, 0))
        p.row_count += r.n
        p.needed = sorted({*p.needed, *r.shards})
        p.kept += [Kept(r.file, r.start, r.n)] if r.file else []
    return Archive(root, head, [m["datasetId"] for _, m in chain], semantics, shards, list(found.values()), sum(r.replaced for r in rows), first, last, keep)


def _schema(model: str | None) -> str:
    return SCHEMA.replace("x array", "y array") if model else SCHEMA


@lru_cache(maxsize=1)
def _predictor(path: str, sha256: str | None, width: int, compiled: str | None) -> Predictor:
    if compiled is not None:
        return pickle.loads(read_bytes(compiled))
    creature = load_creature(path)
    if sha256 is not None and creature.sha256 != sha256:
        raise EngineError("creature", f"model {path} has changed since the run began")
    return Predictor(creature, width)


@dataclass
class Piece:
    """What a task reads of a partition: all of it, resolved from its shards' indexes (``kept`` is None), or kept listings."""

    key: Key
    shards: list[Shard]
    kept: list[Kept] | None = None
    #: The ordinal of the first listing, and the orders of the shards whose payload this task checks (None: all that it needs).
    low: int = 0
    checks: list[int] | None = None


@dataclass
class Work(InputPartition):
    """Pieces that share a task, and the dates of the snapshot."""

    pieces: list[Piece]
    semantics: Semantics
    first: MarketDate | None
    last: MarketDate | None


def dealt(sized: list[tuple[int, object]], tasks: int) -> list[list]:
    """Neighbours (size, thing) in groups of up to TASK_BYTES, so far as that leaves enough tasks."""
    target = min(TASK_BYTES, -(-sum(n for n, _ in sized) // max(1, tasks)))
    groups: list[list] = []
    filled = target
    for n, x in sized:
        if filled >= target:
            groups.append([])
            filled = 0
        groups[-1].append(x)
        filled += n
    return groups


def kept_work(archive: Archive, tasks: int) -> tuple[list[Work], list[Work]]:
    """How kept listings are read: partitions that share tasks, and pieces of those that are cut because of their rows or payload."""
    row_bytes = archive.semantics.input_count * BYTES_PER_VALUE
    whole, split = [], []
    for p in archive.partitions:
        shards = [archive.shards[o] for o in p.needed]
        if p.row_count <= SPLIT_ROWS and sum(s.bytes for s in shards) <= HELD_BYTES:
            whole.append((p.row_count * row_bytes, Piece(p.key, shards, p.kept)))
            continue
        step = min(SPLIT_ROWS, max(1, TASK_BYTES // row_bytes))
        lows = range(0, p.row_count, step)
        split += [Piece(p.key, shards, cut(p.kept, low, low + step), low, p.needed[i :: len(lows)]) for i, low in enumerate(lows)]
    bounds = archive.semantics, archive.first, archive.last
    return [Work(g, *bounds) for g in dealt(whole, tasks)], [Work([x], *bounds) for x in split]


class ObservationReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.dataset = options.get("dataset")
        self.first = MarketDate.parse(options["from"]) if options.get("from") else None
        self.last = MarketDate.parse(options["to"]) if options.get("to") else None
        self.faults_as_rows = options.get("faults") == "rows"
        self.least_tasks = int(options.get("tasks", "1"))
        self.model, self.model_sha256, self.compiled = options.get("model"), options.get("model_sha256"), options.get("compiled")
        #: What pushed filters leave, by column: allowed values, least and greatest value; and what symbols must begin with.
        self.only: dict[str, set] = {}
        self.least: dict[str, object] = {}
        self.most: dict[str, object] = {}
        self.begins: list[str] = []

    def _wanted(self, key: Key) -> bool:
        """Whether a partition can hold rows that the dates and pushed filters leave."""
        year, month, prefix = key
        own = {"year": year, "month": month, "prefix": prefix}
        inside = all(own[c] in v for c, v in self.only.items() if c in own) and all(own[c] >= v for c, v in self.least.items() if c in own) and all(own[c] <= v for c, v in self.most.items() if c in own)
        days = [(d.year, d.month) for d in self.only["date"]] if "date" in self.only else [(year, month)]
        low, high = self.least.get("date"), self.most.get("date")
        return (
            inside and (year, month) in days and (low is None or (year, month) >= (low.year, low.month)) and (high is None or (year, month) <= (high.year, high.month))
            and (self.first is None or (year, month) >= self.first[:2]) and (self.last is None or (year, month) <= self.last[:2])
            and ("symbol" not in self.only or prefix in {prefix_for_symbol(s) for s in self.only["symbol"]}) and all(prefix == prefix_for_symbol(b) for b in self.begins if b)
        )

    def _left(self, rows: pa.Table) -> pa.Table:
        """The listings that pushed filters leave."""
        day = lambda d: (d - Date(1970, 1, 1)).days
        mask = []
        if "symbol" in self.only:
            mask.append(pc.is_in(rows["symbol"], pa.array(sorted(self.only["symbol"]), pa.string())))
        if "date" in self.only:
            mask.append(pc.is_in(rows["date"], pa.array([day(d) for d in self.only["date"]], pa.int32())))
        mask += [pc.starts_with(rows["symbol"], b) for b in self.begins]
        mask += [pc.greater_equal(rows["date"], day(d)) for c, d in self.least.items() if c == "date"] + [pc.less_equal(rows["date"], day(d)) for c, d in self.most.items() if c == "date"]
        for m in mask[1:]:
            mask[0] = pc.and_(mask[0], m)
        return rows.filter(mask[0]) if mask else rows

    def partitions(self) -> list[Work]:
        _, chain, semantics = snapshot(self.root, self.dataset)
        shards = chain_shards(chain)
        if twice := first_repeated(shards):
            raise twice[1]
        sized = [(sum(s.bytes for s in held), Piece(key, held)) for key, held in by_partition(shards) if self._wanted(key)]
        groups = dealt(sized, self.least_tasks)
        return [Work(g, semantics, self.first, self.last) for g in groups] or [Work([], semantics, self.first, self.last)]

    def _listings(self, work: Work) -> Iterator[tuple[Piece, pa.Table | None, ArchiveError | None]]:
        """Each piece with its listings, numbered in their partition (``ordinal``), or with the fault of its indexes."""
        plain = [p for p in work.pieces if p.kept is None]
        at = {id(p): i for i, p in enumerate(plain)}
        listings, faults = read_listings(self.root, [(i, s) for i, p in enumerate(plain) for s in p.shards], work.semantics)
        resolved = within(latest(listings)[0], work.first, work.last)
        edges = np.searchsorted(resolved["part"].to_numpy(), np.arange(len(plain) + 1))
        for p in work.pieces:
            i = at.get(id(p))
            if i in faults:
                yield p, None, faults[i][1]
                continue
            rows = resolved.slice(int(edges[i]), int(edges[i + 1] - edges[i])) if i is not None else pa.concat_tables(read_kept(p.kept))
            yield p, self._left(rows.append_column("ordinal", pa.array(p.low + np.arange(rows.num_rows)))), None

    def read(self, partition: Work) -> Iterator[pa.RecordBatch]:
        width = out_width = partition.semantics.input_count
        predictor = None
        if self.model and partition.pieces:
            predictor = _predictor(self.model, self.model_sha256, width, self.compiled)
            out_width = predictor.output_count
        step = max(1, BATCH_VALUES // width)
        names = [n.split()[0] for n in _schema(self.model).split(", ")]
        held: list[tuple[Key, pa.Table, np.ndarray]] = []

        def batch(keys: list[Key], sizes: list[int], rows: pa.Table | None, x: pa.Array, fault: str | None = None) -> pa.RecordBatch:
            of = np.repeat(np.arange(len(keys)), sizes)
            place = [pa.array(np.array([k[c] for k in keys], np.int32)[of]) for c in (0, 1)] + [pa.array([k[2] for k in keys], pa.string()).take(pa.array(of))]
            kinds = {"ordinal": pa.int64(), "symbol": pa.string(), "date": pa.int32(), "exchange": pa.string(), "alias": pa.string()}
            own = [pa.nulls(len(of), t) if rows is None else rows[c].combine_chunks() for c, t in kinds.items()]
            own[2] = own[2].cast(pa.date32())
            return pa.RecordBatch.from_arrays([*place, *own, x, pa.array([fault] * len(of), pa.string())], names=names)

        def made() -> pa.RecordBatch:
            keys, rows, values = zip(*held)
            found = np.concatenate(values) if len(values) > 1 else values[0]
            flat = (predictor.activate(found) if predictor else found).reshape(-1)
            x = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * out_width), pa.array(flat))
            return batch(list(keys), [t.num_rows for t in rows], pa.concat_tables(rows), x)

        for piece, listings, fault in self._listings(partition):
            try:
                if fault:
                    raise fault
                at = 0
                for found in gather(self.root, {s.order: s for s in piece.shards}, listings, width, step, piece.checks):
                    held.append((piece.key, listings.slice(at, len(found)), found))
                    at += len(found)
                    if sum(len(v) for *_, v in held) >= step:
                        yield made()
                        held = []
            except ArchiveError as e:
                if not self.faults_as_rows:
                    raise
                if held:
                    yield made()
                    held = []
                yield batch([piece.key], [1], None, pa.nulls(1, pa.list_(pa.float32())), json.dumps([e.kind, e.path, e.detail]))
        if held:
            yield made()


class FilteredReader(ObservationReader):
    """A reader that filters reach. Spark 4.1 lets all scans of one ``load()`` in a query share what the last of them was given, so a load that is
    to be filtered in several ways must not be read through this: it is for loads with ``pushdown=true`` only."""

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Filters on the date, the symbol and the partition's own columns narrow what is read; Spark applies all of them again."""
        for f in filters:
            name = (getattr(f, "attribute", None) or ("",))[0]
            if name in ("date", "symbol", "prefix", "year", "month") and len(f.attribute) == 1:
                if isinstance(f, (EqualTo, In)):
                    values = set(f.value) if isinstance(f, In) else {f.value}
                    self.only[name] = values & self.only.get(name, values)
                elif isinstance(f, StringStartsWith) and name == "symbol":
                    self.begins.append(f.value)
                elif name in ("date", "year", "month"):
                    if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                        self.least[name] = max(self.least.get(name, f.value), f.value)
                    elif isinstance(f, (LessThan, LessThanOrEqual)):
                        self.most[name] = min(self.most.get(name, f.value), f.value)
            yield f


class ObservationSource(DataSource):
    """Format ``observations``. Reading: path; dataset, from, to; pushdown=true, by which filters on date, symbol, prefix, year and month narrow what is
    opened (``FilteredReader``: one scan a load); model (rows come out scored, so their observations never leave the task), compiled (the
    same model as the driver has compiled it, so that tasks need not), tasks (how many to aim for at
    least), and faults=rows to get faults as rows. Writing: see ``publish``."""

    @classmethod
    def name(cls) -> str:
        return "observations"

    def schema(self) -> str:
        return _schema(dict(self.options).get("model"))

    def reader(self, schema) -> ObservationReader:
        options = dict(self.options)
        return (FilteredReader if options.get("pushdown") == "true" else ObservationReader)(options)

    def writer(self, schema, overwrite: bool):
        from skyledger.sources.publish import ObservationWriter

        return ObservationWriter(dict(self.options), [f.name for f in schema.fields], overwrite)


def planned(spark: SparkSession, archive: Archive, work: list[Work], options: dict, then: Callable | None = None, schema: str | None = None) -> DataFrame:
    """A scan of kept listings, as ``kept_work`` has cut it: a task for each piece of work, which it finds in a file beside the listings. ``then`` takes
    the task's batches on to others, of ``schema``, within the task."""
    path, parts = f"{archive.keep}/plan-{uuid.uuid4().hex}", [pickle.dumps(w) for w in work]
    write_bytes(path, b"".join(parts))
    ends = np.cumsum([len(p) for p in parts])
    reader = ObservationReader({**options, "path": archive.fingerprint_root})

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                fs, at = file_system(path)
                with fs.open_input_file(at) as source:
                    low = int(ends[i - 1]) if i else 0
                    own = pickle.loads(source.read_at(int(ends[i]) - low, low))
                yield from reader.read(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return then(read(batches)) if then else read(batches)

    return spark.range(0, len(work), 1, max(1, len(work))).mapInArrow(run, schema or _schema(options.get("model")))
