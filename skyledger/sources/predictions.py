"""Prediction sets as a Spark data source: one ``.bin`` of doubles and one ``.index.json`` for each (year, month, prefix),
and a manifest that is written last.

Writers work in a staging folder beside the output. A task attempt writes under names of its own; the commit renames the
files of the attempts that count, writes the manifest, and moves the folder onto the output. So a lost or repeated task
leaves nothing behind, and an output folder is either whole or absent. (Stores without an atomic rename of folders only get
the manifest-last guarantee.)
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from skyledger.functions.values import MarketDate, number_text, sha256_hex, utc_now
from skyledger.sources.files import ArchiveError, Field, checked, file_system, pretty, read_bytes, read_json, write_bytes

#: Fixed values of the prediction format; the manifest's schema is this engine's own.
PREDICTION_INDEX_SCHEMA = "grq.predictions.partition/1"
RESEARCH_MODE = "retrospective_fixed_model"
BYTES_PER_OUTPUT = 8
RUN_MANIFEST_SCHEMA = "skyledger.run/1"

SCHEMA = "year int, month int, prefix string, row long, symbol string, date date, exchange string, y array<double>"


class OutputError(Exception):
    """``kind``: occupied or io."""

    def __init__(self, kind: str, path: str, detail: str):
        super().__init__(kind, path, detail)
        self.kind, self.path, self.detail = kind, path, detail

    def __str__(self) -> str:
        if self.kind == "occupied":
            return f"{self.path} is taken: {self.detail}"
        return f"cannot write {self.path}: {self.detail}"


@dataclass(frozen=True)
class PredictionIdentity:
    """What a set of predictions is keyed by. ``input_count`` is the archive's width."""

    creature_uuid: str
    input_count: int
    output_count: int
    observation_extension: int
    feature_fingerprint: str
    dataset_id: str
    engine: str
    engine_version: str

    def key(self) -> str:
        named = {
            "creature": self.creature_uuid, "inputs": self.input_count, "outputs": self.output_count, "extension": self.observation_extension, "features": self.feature_fingerprint,
            "width": self.input_count, "dataset": self.dataset_id, "engine": self.engine, "engineVersion": self.engine_version,
        }
        return sha256_hex("|".join([RESEARCH_MODE, *(f"{k}={v}" for k, v in named.items())]).encode())[:32]

    def fields(self) -> dict:
        """As JSON documents name them."""
        return {
            "creatureUUID": self.creature_uuid, "inputCount": self.input_count, "outputCount": self.output_count, "observationExtension": self.observation_extension,
            "featureFingerprint": self.feature_fingerprint, "datasetId": self.dataset_id, "engine": self.engine, "engineVersion": self.engine_version,
        }


_IDENTITY = (Field("creatureUUID", str), Field("inputCount", int), Field("outputCount", int), Field("observationExtension", int), Field("featureFingerprint", str), Field("datasetId", str), Field("engine", str), Field("engineVersion", str))
_RECORD = (Field("path", str), Field("rowCount", int), Field("payloadSha256", str))
_REFUSED = (Field("symbol", str), Field("date", str), Field("reason", str))
MANIFEST = (
    Field("schema", str), Field("key", str), Field("identity", dict), Field("researchMode", str), Field("toolVersion", str), Field("engineSource", str), Field("creaturePath", str), Field("creatureInput", int),
    Field("archiveRoot", str), Field("datasetChain", list), Field("from", str, optional=True), Field("to", str, optional=True), Field("partitions", list, of=_RECORD), Field("rowCount", int), Field("supersededRows", int),
    Field("refused", list, of=_REFUSED), Field("startedUTC", str), Field("finishedUTC", str),
)
INDEX = (
    Field("schema", str), Field("year", int), Field("month", int), Field("prefix", str), Field("outputCount", int), Field("payloadFile", str), Field("payloadBytes", int), Field("payloadSha256", str), Field("rowCount", int),
    Field("rows", list, of=(Field("symbol", str), Field("date", str), Field("exchange", str, optional=True), Field("row", int))),
)


def inspect_output(output: str) -> dict | None:
    """The manifest of a finished run, or None if there is nothing; OutputError for anything else."""
    fs, at = file_system(output)
    kind = fs.get_file_info(at).type
    if kind == pafs.FileType.NotFound:
        return None
    if kind != pafs.FileType.Directory:
        raise OutputError("io", output, "not a directory")
    if not fs.get_file_info(pafs.FileSelector(at)):
        return None
    try:
        text = read_bytes(f"{output}/manifest.json").decode()
    except (OSError, UnicodeDecodeError):
        raise OutputError("occupied", output, "it has no manifest.json") from None
    try:
        found = json.loads(text)
        checked({**found, "datasetChain": []} if isinstance(found, dict) else found, MANIFEST)
        checked(found["identity"], _IDENTITY)
    except (ValueError, RecursionError) as e:
        raise OutputError("occupied", output, f"its manifest.json is not a {RUN_MANIFEST_SCHEMA} manifest: {e}") from None
    if found["schema"] != RUN_MANIFEST_SCHEMA:
        raise OutputError("occupied", output, f"its manifest declares schema {json.dumps(found['schema'])}")
    return found


class StagedRun:
    """A run being written beside its output."""

    def __init__(self, output: str, staging: str, identity: PredictionIdentity):
        self.output, self.staging, self.identity, self.key = output, staging, identity, identity.key()

    @classmethod
    def begin(cls, output: str, identity: PredictionIdentity) -> StagedRun:
        parent, _, name = output.rstrip("/").rpartition("/")
        staging = f"{parent + '/' if parent or output.startswith('/') else ''}.{name}.partial-{os.getpid()}"
        try:
            fs, at = file_system(staging)
            if fs.get_file_info(at).type == pafs.FileType.Directory:
                fs.delete_dir(at)
            fs.create_dir(at, recursive=True)
        except OSError as e:
            raise OutputError("io", staging, str(e)) from None
        return cls(output, staging, identity)

    def write_partition(self, year: int, month: int, prefix: str, rows: list[tuple[str, str, str | None]], outputs: np.ndarray, attempt: str = "") -> tuple[dict | None, list[dict]]:
        """Writes the rows (symbol, date, exchange) whose outputs are finite; returns their record, None if there is none, and
        the refused rows. ``attempt`` is added to file names until the commit."""
        outputs = np.asarray(outputs, np.float32).reshape(len(rows), -1)
        fine = np.isfinite(outputs).all(axis=1)
        refused = [
            {"symbol": rows[i][0], "date": rows[i][1], "reason": f"non-finite output {number_text(float(outputs[i][~np.isfinite(outputs[i])][0]))}"} for i in np.flatnonzero(~fine).tolist()
        ]
        if not fine.any():
            return None, refused
        payload = outputs[fine].astype("<f8").tobytes()
        sha = sha256_hex(payload)
        listed = [{"symbol": s, "date": d, **({"exchange": e} if e is not None else {}), "row": n} for n, (s, d, e) in enumerate(rows[i] for i in np.flatnonzero(fine).tolist())]
        index = {
            "schema": PREDICTION_INDEX_SCHEMA, "key": self.key, **self.identity.fields(), "researchMode": RESEARCH_MODE, "year": year, "month": month, "prefix": prefix, "payloadFile": f"{prefix}.bin",
            "payloadBytes": len(payload), "payloadSha256": sha, "rowCount": len(listed), "rows": listed, "createdUTC": utc_now(),
        }
        folder = f"{self.staging}/{year:04}/{month:02}"
        try:
            fs, at = file_system(folder)
            fs.create_dir(at, recursive=True)
            write_bytes(f"{folder}/{prefix}.bin{attempt}", payload)
            write_bytes(f"{folder}/{prefix}.index.json{attempt}", pretty(index))
        except OSError as e:
            raise OutputError("io", folder, str(e)) from None
        return {"path": f"{year:04}/{month:02}/{prefix}", "rowCount": len(listed), "payloadSha256": sha}, refused

    def adopt(self, path: str, attempt: str) -> None:
        """Gives a partition's files their names."""
        fs, at = file_system(f"{self.staging}/{path}")
        for end in (".bin", ".index.json"):
            fs.move(f"{at}{end}{attempt}", f"{at}{end}")

    def finish(self, manifest: dict) -> str:
        """Writes the manifest and moves the run onto an absent or empty output; what fails here leaves the staging folder."""
        try:
            write_bytes(f"{self.staging}/manifest.json", pretty(manifest))
            fs, at = file_system(self.output)
            if fs.get_file_info(at).type == pafs.FileType.Directory:
                if fs.get_file_info(pafs.FileSelector(at)):
                    raise OSError("the directory is not empty")
                fs.delete_dir(at)
            fs.move(file_system(self.staging)[1], at)
        except OSError as e:
            raise OutputError("io", self.output, str(e)) from None
        return self.output

    def abandon(self) -> None:
        fs, at = file_system(self.staging)
        if fs.get_file_info(at).type == pafs.FileType.Directory:
            fs.delete_dir(at)


def order_of(path: str) -> tuple:
    year, month, prefix = path.split("/")
    return int(year), int(month), prefix.encode()


@dataclass
class Part(WriterCommitMessage):
    """What a task wrote, refused and could not read, by partition."""

    attempt: str
    records: list
    refused: list
    faults: list


class PredictionWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.staged = StagedRun(options["output"], options["path"], PredictionIdentity(**json.loads(options["identity"])))
        self.manifest = json.loads(options["manifest"])
        self.mark = uuid.uuid4().hex[:8]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        """Rows (year, month, prefix, symbol, date, exchange, y, fault), each partition whole and in order of symbol and date."""
        from pyspark import TaskContext

        done = Part(f".{self.mark}-{TaskContext.get().taskAttemptId()}", [], [], [])
        held: list[tuple] = []
        values: list[np.ndarray] = []
        last: tuple | None = None

        def flush() -> None:
            if held:
                record, refused = self.staged.write_partition(*last, held, np.concatenate(values), done.attempt)
                where = f"{last[0]:04}/{last[1]:02}/{last[2]}"
                done.records += [record] if record else []
                done.refused += [(where, r) for r in refused]
            held.clear()
            values.clear()

        for batch in iterator:
            get = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            days = get["date"].cast(pa.int32()).to_pylist()
            outputs = get["y"].flatten().to_numpy(zero_copy_only=False).reshape(-1, self.staged.identity.output_count)
            at = 0
            for i, (key, symbol, exchange, fault) in enumerate(zip(zip(*(get[c].to_pylist() for c in ("year", "month", "prefix"))), get["symbol"].to_pylist(), get["exchange"].to_pylist(), get["fault"].to_pylist())):
                if key != last:
                    flush()
                    last = key
                if fault is not None:
                    done.faults.append((f"{key[0]:04}/{key[1]:02}/{key[2]}", json.loads(fault)))
                    continue
                held.append((symbol, str(MarketDate.from_epoch_days(days[i])), exchange))
                values.append(outputs[at])
                at += 1
        flush()
        return done

    def commit(self, messages: list) -> None:
        """Fails, with the faults in ``_faults.json``, if a partition could not be read; otherwise publishes the run."""
        parts = [m for m in messages if m is not None]
        if faults := sorted((f for m in parts for f in m.faults), key=lambda x: order_of(x[0])):
            write_bytes(f"{self.staged.staging}/_faults.json", pretty({"faults": faults}))
            raise ArchiveError(*faults[0][1])
        paths = [r["path"] for m in parts for r in m.records]
        if len(set(paths)) < len(paths):
            raise OutputError("io", self.staged.staging, "the rows of a partition came in several tasks")
        for m in parts:
            for r in m.records:
                self.staged.adopt(r["path"], m.attempt)
        self.remove_others()
        records = sorted((r for m in parts for r in m.records), key=lambda r: order_of(r["path"]))
        refused = [r for _, r in sorted((x for m in parts for x in m.refused), key=lambda x: order_of(x[0]))]
        made = {**self.manifest, "partitions": records, "rowCount": sum(r["rowCount"] for r in records), "refused": refused, "finishedUTC": utc_now()}
        self.staged.finish({f.name: made[f.name] for f in MANIFEST})

    def remove_others(self) -> None:
        """Files of attempts that do not count."""
        fs, at = file_system(self.staged.staging)
        for x in fs.get_file_info(pafs.FileSelector(at, recursive=True)):
            if x.type == pafs.FileType.File and not x.base_name.endswith((".bin", ".index.json")):
                fs.delete_file(x.path)

    def abort(self, messages: list) -> None:
        """The caller removes the staging folder, once it has looked for faults."""


@dataclass
class Indexes(InputPartition):
    paths: list


class PredictionReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")

    def partitions(self) -> list[Indexes]:
        manifest = inspect_output(self.root)
        if manifest is None:
            raise OutputError("io", self.root, "there is no finished run")
        return [Indexes([r["path"]]) for r in manifest["partitions"]] or [Indexes([])]

    def read(self, partition: Indexes) -> Iterator[pa.RecordBatch]:
        for at in partition.paths:
            path = f"{self.root}/{at}.index.json"
            index = read_json(path, INDEX)
            if index["schema"] != PREDICTION_INDEX_SCHEMA:
                raise ArchiveError("schema", path, f"declares schema {json.dumps(index['schema'])}")
            data = read_bytes(f"{self.root}/{at.rpartition('/')[0]}/{index['payloadFile']}")
            n, width = index["rowCount"], index["outputCount"]
            if not len(data) == index["payloadBytes"] == n * width * BYTES_PER_OUTPUT or len(index["rows"]) != n:
                raise ArchiveError("corrupt", path, f"the payload is {len(data)} bytes; its index declares {index['payloadBytes']}")
            if sha256_hex(data) != index["payloadSha256"]:
                raise ArchiveError("hash", path, "the payload does not have its hash")
            rows = index["rows"]
            y = np.frombuffer(data, "<f8").reshape(n, width)[[r["row"] for r in rows]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([index["year"]] * n, pa.int32()), pa.array([index["month"]] * n, pa.int32()), pa.array([index["prefix"]] * n), pa.array([r["row"] for r in rows], pa.int64()), pa.array([r["symbol"] for r in rows]),
                 pa.array([MarketDate.parse(r["date"]).epoch_days() for r in rows], pa.int32()).cast(pa.date32()), pa.array([r["exchange"] for r in rows], pa.string()),
                 pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(y.reshape(-1)))],
                names=[x.split()[0] for x in SCHEMA.split(", ")],
            )


class PredictionSource(DataSource):
    """Format ``predictions``. Reading: path, a finished run. Writing is for ``plans.run``: path (staging), output, identity,
    manifest."""

    @classmethod
    def name(cls) -> str:
        return "predictions"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> PredictionReader:
        return PredictionReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> PredictionWriter:
        return PredictionWriter(dict(self.options))


def identity_options(staged: StagedRun, manifest: dict) -> dict[str, str]:
    return {"path": staged.staging, "output": staged.output, "identity": json.dumps(asdict(staged.identity)), "manifest": json.dumps(manifest)}
