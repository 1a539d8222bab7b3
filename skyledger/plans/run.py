"""A run: resolve a snapshot, score every row in range, publish predictions with their provenance.

The plan is a scan that scores, and a write, without a shuffle in between: each partition of the archive stays whole in its task.
"""

from __future__ import annotations

import json
import pickle
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from skyledger.functions.tables import register_tables
from skyledger.functions.values import MAX_DATASET_ID_BYTES, MarketDate, is_valid_dataset_id, utc_now
from skyledger.operators.network import ENGINE, ENGINE_SOURCE, ENGINE_VERSION, Creature, EngineError, Predictor, load_creature
from skyledger.sources.archive import Archive, ObservationSource, kept_work, open_archive, planned
from skyledger.sources.changes import ChangeSource
from skyledger.sources.files import ArchiveError, file_system, write_bytes
from skyledger.sources.predictions import RESEARCH_MODE, RUN_MANIFEST_SCHEMA, OutputError, Part, PredictionIdentity, PredictionSource, PredictionWriter, StagedRun, identity_options, inspect_output

TOOL, TOOL_VERSION = "skyledger", "0.1.0"
#: Exit codes.
OK, PARTIAL, USAGE, DATAERR, NOINPUT, CANTCREAT, IOERR = 0, 3, 64, 65, 66, 73, 74


class RequestError(Exception):
    """``kind``: empty_path, date_order or dataset_id."""

    def __init__(self, kind: str, message: str):
        super().__init__(kind, message)
        self.kind, self.message = kind, message

    def __str__(self) -> str:
        return self.message


@dataclass(frozen=True)
class PredictRequest:
    creature: str
    archive: str
    output: str
    dataset: str | None = None
    first: MarketDate | None = None
    last: MarketDate | None = None

    def validate(self) -> None:
        """The request's own consistency, in the order of its fields; no file is touched."""
        for flag in ("creature", "archive", "output"):
            if not getattr(self, flag):
                raise RequestError("empty_path", f"--{flag} is empty")
        if self.first is not None and self.last is not None and self.first > self.last:
            raise RequestError("date_order", f"--from {self.first} is after --to {self.last}")
        if self.dataset is not None and not is_valid_dataset_id(self.dataset):
            raise RequestError("dataset_id", f"--dataset '{self.dataset}' is not a dataset id (letters, digits, '.', '_', '-'; at most {MAX_DATASET_ID_BYTES} bytes)")


@dataclass(frozen=True)
class RunSummary:
    output: str
    manifest: dict
    already_complete: bool


def register(spark: SparkSession) -> None:
    """Makes the formats and table functions known to the session and lets filters reach the scan."""
    spark.dataSource.register(ObservationSource)
    spark.dataSource.register(PredictionSource)
    spark.dataSource.register(ChangeSource)
    register_tables(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def _options(faults_as_rows: bool, creature: Creature | None, compiled: str | None) -> dict[str, str]:
    options = {"faults": "rows" if faults_as_rows else None, "model": creature and creature.path, "model_sha256": creature and creature.sha256, "compiled": compiled}
    return {k: str(v) for k, v in options.items() if v is not None}


def _scan(spark: SparkSession, archive: Archive, options: dict[str, str]) -> DataFrame:
    """A scan of a snapshot without kept listings: each of its partitions lies whole in a task."""
    own = {"path": archive.fingerprint_root, "dataset": archive.dataset_id, "from": archive.first, "to": archive.last, "tasks": 2 * spark.sparkContext.defaultParallelism}
    return spark.read.format("observations").options(**options, **{k: str(v) for k, v in own.items() if v is not None}).load()


def _union(parts: list[DataFrame | None]) -> DataFrame:
    there = [p for p in parts if p is not None]
    return there[0] if len(there) == 1 else there[0].unionByName(there[1])


def observations(spark: SparkSession, archive: Archive, faults_as_rows: bool = False, creature: Creature | None = None, compiled: str | None = None) -> DataFrame:
    """The rows of a resolved snapshot. With a model they come out scored. Where the archive was opened with a folder for its listings, no
    index is read again, and large partitions are read by several tasks; otherwise each partition lies whole in a task."""
    register(spark)
    options = _options(faults_as_rows, creature, compiled)
    if archive.keep is None:
        return _scan(spark, archive, options)
    whole, split = kept_work(archive, 2 * spark.sparkContext.defaultParallelism)
    return _union([planned(spark, archive, w, options) if w or k and not whole else None for k, w in enumerate((whole, split))])


def scored(spark: SparkSession, archive: Archive, creature: Creature, compiled: str | None = None, then: Callable | None = None, schema: str | None = None) -> DataFrame:
    """Scan with the model pushed into it: wide rows are scored where they are decoded, and only outputs reach the JVM.
    ``operators.network.score`` gives the same values for rows of any other source. Every partition comes out whole in a task and in order: only of
    those that several tasks score are the outputs brought together, as they make one file. ``then`` (batches to batches of ``schema``) goes on
    with the outputs in the same task."""
    register(spark)
    options = _options(True, creature, compiled)
    taken = lambda df: df.mapInArrow(then, schema) if then else df
    names = ["year", "month", "prefix", "symbol", "date", "exchange", "y", "fault"]
    if archive.keep is None:
        return taken(_scan(spark, archive, options).select(*names))
    whole, split = kept_work(archive, 2 * spark.sparkContext.defaultParallelism)
    scan = planned(spark, archive, whole, options, then, schema) if whole or not split else None
    if split:
        split = planned(spark, archive, split, options).repartition("year", "month", "prefix").sortWithinPartitions("year", "month", "prefix", "row")
    return _union([scan if then or scan is None else scan.select(*names), taken(split.select(*names)) if split else None])


def publish(rows: Callable[[Callable, str], DataFrame], staged: StagedRun, manifest: dict, wrote: Callable[[int], None] = lambda n: None) -> None:
    """Writes scored rows where they are and publishes them: tasks write their partitions and answer with a record of each,
    the driver commits the answers. ``rows`` is given what a task does with its batches, and the schema of what comes of it.
    (``format("predictions")`` does the same through the data source API, at the price of a few more Python processes on the driver.)
    ``wrote`` hears, while tasks run, how many partitions have been written so far."""
    writer = PredictionWriter(identity_options(staged, manifest))
    done = SparkSession.active().sparkContext.accumulator(0)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = writer.write(batches)
        done.add(len(part.records))
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(asdict(part))])], names=["part"])

    over = threading.Event()

    def watch() -> None:
        while not over.wait(0.5):
            wrote(done.value)

    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        parts = [Part(**json.loads(r.part)) for r in rows(write, "part string").collect()]  # a row a task
    finally:
        over.set()
        watcher.join()
    writer.commit(parts)


def run(spark: SparkSession, request: PredictRequest, progress: Callable[[str], None] = lambda line: None) -> RunSummary:
    """Runs the request. Errors come in this order: request, model file, archive, fit of both, output, partitions."""
    request.validate()
    started, clock = utc_now(), time.monotonic()
    try:
        there = inspect_output(request.output) is not None
    except OutputError:
        there = True  # a run that is there, or in the way, is told of in its turn
    keep = None if there else f"{request.output.rstrip('/')}.listings-{uuid.uuid4().hex}"  # beside the output, gone with the run
    try:
        return _run(spark, request, progress, started, clock, keep)
    finally:
        if keep:
            fs, at = file_system(keep)
            if fs.get_file_info(at).type == pafs.FileType.Directory:
                fs.delete_dir(at)


def _run(spark: SparkSession, request: PredictRequest, progress: Callable[[str], None], started: str, clock: float, keep: str | None) -> RunSummary:
    with ThreadPoolExecutor(1) as side:  # the model is read while tasks check the indexes; its faults come first all the same
        model = side.submit(load_creature, request.creature)
        compiled = side.submit(lambda: Predictor(model.result(), model.result().export["input"]))
        try:
            archive = open_archive(spark, request.archive, request.dataset, request.first, request.last, keep)
        finally:
            creature = model.result()
        compiled.exception()
    predictor = Predictor(creature, archive.semantics.input_count, compiled.result() if compiled.exception() is None else None)
    s = archive.semantics
    identity = PredictionIdentity(creature.identity, s.input_count, predictor.output_count, s.observation_extension, s.feature_fingerprint, archive.dataset_id, ENGINE, ENGINE_VERSION)
    key = identity.key()
    first, last = (None if d is None else str(d) for d in (request.first, request.last))

    existing = inspect_output(request.output)
    if existing is not None:
        if (existing["key"], existing["from"], existing["to"]) == (key, first, last):
            progress(f"[{TOOL}] run {key} is complete in {request.output}; left as it is")
            return RunSummary(request.output, existing, True)
        raise OutputError("occupied", request.output, f"it holds run {existing['key']} for {existing['from'] or '*'}..{existing['to'] or '*'}")

    progress(
        f"[{TOOL}] {archive.row_count} rows in {len(archive.partitions)} partitions from dataset {archive.dataset_id} (extension {s.observation_extension}, {s.input_count} inputs); "
        f"creature {creature.identity} ({predictor.input_count} inputs, {predictor.output_count} outputs); engine {ENGINE} {ENGINE_VERSION}"
    )
    manifest = {
        "schema": RUN_MANIFEST_SCHEMA, "key": key, "identity": identity.fields(), "researchMode": RESEARCH_MODE, "toolVersion": TOOL_VERSION, "engineSource": ENGINE_SOURCE,
        "creaturePath": request.creature, "creatureInput": predictor.input_count, "archiveRoot": request.archive, "datasetChain": archive.dataset_chain, "from": first, "to": last,
        "supersededRows": archive.superseded_rows, "startedUTC": started,
    }
    n, told = len(archive.partitions), 0

    def wrote(done: int) -> None:
        nonlocal told
        while told + 100 <= min(done, n - 1):  # the last line is for the end of the run
            told += 100
            progress(f"[{TOOL}] {told}/{n} partitions written")

    staged = StagedRun.begin(request.output, identity)
    try:
        model_at = f"{staged.staging}/_model.{creature.sha256[:16]}"  # goes with the files of lost attempts
        write_bytes(model_at, pickle.dumps(predictor))
        publish(lambda then, schema: scored(spark, archive, creature, model_at, then, schema), staged, manifest, wrote)
    except OutputError:
        raise  # what a failed publication leaves is kept for inspection
    except Exception:
        staged.abandon()
        raise
    manifest = inspect_output(request.output)
    for r in manifest["refused"]:
        progress(f"[{TOOL}] refused {r['symbol']}@{r['date']}: {r['reason']}")
    wrote(n)
    if n:
        progress(f"[{TOOL}] {n}/{n} partitions written")
    seconds = time.monotonic() - clock
    progress(f"[{TOOL}] wrote {manifest['rowCount']} rows to {request.output} in {seconds:.1f}s ({manifest['rowCount'] / max(seconds, 1e-9):.0f} rows/s); {len(manifest['refused'])} refused")
    return RunSummary(request.output, manifest, False)


def exit_code(error: Exception) -> int:
    if isinstance(error, RequestError):
        return USAGE
    if isinstance(error, ArchiveError):
        return NOINPUT if error.kind == "io" else DATAERR
    if isinstance(error, EngineError):
        return NOINPUT if error.kind == "io" else DATAERR
    if isinstance(error, OutputError) and error.kind == "occupied":
        return CANTCREAT
    return IOERR
