"""Publishing observations as a dataset of an archive, as a data source.

    rows.write.format("observations").mode("append").options(dataset="d7", extension=116, fingerprint="f00d", width=64).save(root)

Rows are (symbol, date, x) with exchange and alias where they are known. A task writes a shard for each partition that its rows lie in, and another
one whenever SHARD_BYTES of payload are there, under names of its own attempt. The commit lists the shards of the attempts that count in the manifest
and moves the pointer last, so readers see a dataset whole or not at all, and lost, repeated or speculative attempts leave nothing that is listed.
The head that the writer began with must still be the newest: of two writers at once, the second is refused and can be run again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSourceArrowWriter, WriterCommitMessage

from skyledger.functions.values import MarketDate, is_valid_dataset_id, number_text, sha256_hex
from skyledger.operators.resolve import partition_columns
from skyledger.sources.chain import BYTE_ORDER, DATASET_MANIFEST_SCHEMA, POINTER, SHARD_INDEX_SCHEMA
from skyledger.sources.files import ArchiveError, file_system, pretty, read_json, write_bytes
from skyledger.sources.indexes import canonical, prefixes

#: Payload of a shard, and payload that a task holds for all of its open partitions.
SHARD_BYTES, OPEN_BYTES = 64 << 20, 256 << 20


def semantics_fields(width: int, extension: int, fingerprint: str) -> dict:
    return {"byteOrder": BYTE_ORDER, "observationExtension": extension, "inputCount": width, "featureFingerprint": fingerprint}


def write_shard(root: str, name: str, written: dict, year: int, month: int, prefix: str, listed: list[tuple], values: np.ndarray) -> dict:
    """Writes a partition's rows (symbol, date, exchange, and alias if there is one) with their values as a shard; returns its entry for the manifest."""
    folder, place = f"{year:04}/{month:02}/{prefix}", {"prefix": prefix, "year": year, "month": month}
    fs, at = file_system(f"{root}/{folder}")
    fs.create_dir(at, recursive=True)
    payload = np.asarray(values, "<f4").tobytes()
    entry = {"path": f"{folder}/{name}.bin", "sha256": sha256_hex(payload), "bytes": len(payload), "rowCount": len(listed), **place}
    rows = [{**{k: v for k, v in zip(("symbol", "date", "exchange", "alias"), row) if v is not None}, "row": i} for i, row in enumerate(listed)]
    index = {"schema": SHARD_INDEX_SCHEMA, **written, **place, "shardFile": f"{name}.bin", "shardBytes": len(payload), "shardSha256": entry["sha256"], "rowCount": len(rows), "rows": rows}
    write_bytes(f"{root}/{folder}/{name}.bin", payload)
    write_bytes(f"{root}/{folder}/{name}.index.json", pretty(index))
    return entry


def write_manifest(root: str, dataset: str, previous: str | None, written: dict, entries: list[dict]) -> None:
    """Publishes shards as a dataset, and makes it the newest."""
    fs, at = file_system(f"{root}/datasets")
    fs.create_dir(at, recursive=True)
    write_bytes(f"{root}/datasets/{dataset}.json", pretty({"schema": DATASET_MANIFEST_SCHEMA, "datasetId": dataset, **written, "shards": sorted(entries, key=lambda e: e["path"]), "previousDatasetId": previous}))
    write_bytes(f"{root}/latest.json", pretty({"datasetId": dataset}))


def newest(root: str) -> str | None:
    """The dataset that the archive's pointer names, None if there is no archive yet."""
    fs, at = file_system(f"{root}/latest.json")
    return None if fs.get_file_info(at).type == pafs.FileType.NotFound else read_json(f"{root}/latest.json", POINTER)["datasetId"]


@dataclass
class Shards(WriterCommitMessage):
    """The entries of what a task attempt wrote."""

    entries: list


class ObservationWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, columns: list[str], overwrite: bool):
        if overwrite:
            raise ValueError("an archive only grows: use mode append")
        self.root, self.dataset, self.width = options["path"].rstrip("/"), options["dataset"], int(options["width"])
        self.written = semantics_fields(self.width, int(options["extension"]), options["fingerprint"])
        if not is_valid_dataset_id(self.dataset):
            raise ValueError(f"{self.dataset!r} can't be a dataset's id")
        if self.root.split("/")[-2:] != [options["extension"], options["fingerprint"]]:
            raise ValueError(f"{self.root} should end in {options['extension']}/{options['fingerprint']}")
        if missing := {"symbol", "date", "x"} - set(columns):
            raise ValueError(f"rows lack {', '.join(sorted(missing))}")
        self.columns, self.head, self.mark = columns, newest(self.root), uuid.uuid4().hex[:8]
        self._refuse_taken()

    def _refuse_taken(self) -> None:
        fs, at = file_system(f"{self.root}/datasets/{self.dataset}.json")
        if fs.get_file_info(at).type != pafs.FileType.NotFound:
            raise ValueError(f"the archive has a dataset {self.dataset} already")

    def _checked(self, batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray, list, list, np.ndarray]:
        """Symbols, days, exchanges, aliases and values of a batch; ValueError for rows that no reader would take."""
        get = dict(zip(self.columns, batch.columns))
        symbol, x = get["symbol"].cast(pa.string()), get["x"]
        if symbol.null_count or get["date"].null_count or x.null_count or not pc.all(canonical(symbol), min_count=0).as_py():
            raise ValueError("every row needs a date, values, and a symbol without outer white space")
        if not pc.all(pc.equal(x.value_lengths(), self.width), min_count=0).as_py():
            raise ValueError(f"every row needs {self.width} values")
        values = x.flatten().to_numpy(zero_copy_only=False).astype("<f4").reshape(-1, self.width)
        if not np.isfinite(values).all():
            i, column = (int(v[0]) for v in np.nonzero(~np.isfinite(values)))
            raise ValueError(f"value {column} of {symbol[i]} is {number_text(float(values[i, column]))}")
        days = get["date"].cast(pa.date32()).cast(pa.int32()).to_numpy()
        none = [None] * len(symbol)
        return symbol, days, get["exchange"].to_pylist() if "exchange" in get else none, get["alias"].to_pylist() if "alias" in get else none, values

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Shards:
        from pyspark import TaskContext

        name, done = f"{self.dataset}-{self.mark}-{TaskContext.get().taskAttemptId()}", Shards([])
        held: dict[tuple, list] = {}
        size: dict[tuple, int] = {}

        def flush(key: tuple) -> None:
            parts = held.pop(key)
            del size[key]
            symbols, days, exchanges, aliases = ([v for p in parts for v in p[i]] for i in range(4))
            order = sorted(range(len(symbols)), key=lambda i: (symbols[i].encode(), days[i]))
            listed = [(symbols[i], str(MarketDate.from_epoch_days(days[i])), exchanges[i], aliases[i]) for i in order]
            done.entries.append(write_shard(self.root, f"{name}-{len(done.entries):05}", self.written, *key, listed, np.concatenate([p[4] for p in parts])[order]))

        for batch in iterator:
            symbol, days, exchanges, aliases, values = self._checked(batch)
            month = days.astype("datetime64[D]").astype("datetime64[M]").astype(np.int64) + 1970 * 12
            prefix = prefixes(symbol).to_pylist()
            symbols, groups = symbol.to_pylist(), {}
            for i, key in enumerate(zip((month // 12).tolist(), (month % 12 + 1).tolist(), prefix)):
                groups.setdefault(key, []).append(i)
            for key, own in groups.items():
                held.setdefault(key, []).append(([symbols[i] for i in own], days[own].tolist(), [exchanges[i] for i in own], [aliases[i] for i in own], values[own]))
                size[key] = size.get(key, 0) + 4 * self.width * len(own)
                if size[key] >= SHARD_BYTES:
                    flush(key)
            while sum(size.values()) > OPEN_BYTES:
                flush(max(size, key=size.get))
        for key in sorted(held):
            flush(key)
        return done

    def commit(self, messages: list) -> None:
        entries = [e for m in messages if m is not None for e in m.entries]
        if newest(self.root) != self.head:
            self.abort(messages)
            raise ArchiveError("corrupt", f"{self.root}/latest.json", f"another dataset was published since {self.head}")
        self._refuse_taken()
        write_manifest(self.root, self.dataset, self.head, self.written, entries)
        self._remove({e["path"].rpartition("/")[0] for e in entries}, {e["path"] for e in entries})

    def abort(self, messages: list) -> None:
        self._remove({e["path"].rpartition("/")[0] for m in messages if m is not None for e in m.entries}, set())

    def _remove(self, folders: set[str], listed: set[str]) -> None:
        """Files of this writer's attempts in the folders, but for those of listed shards."""
        for folder in folders:
            fs, at = file_system(f"{self.root}/{folder}")
            for x in fs.get_file_info(pafs.FileSelector(at)):
                if x.base_name.startswith(f"{self.dataset}-{self.mark}-") and f"{folder}/{x.base_name.removesuffix('.index.json').removesuffix('.bin')}.bin" not in listed:
                    fs.delete_file(x.path)


def write_archive(rows: DataFrame, root: str, dataset: str, width: int, extension: int, fingerprint: str) -> None:
    """Publishes rows (symbol, date, exchange, x) as a dataset. They are dealt by ranges of partition, symbol and date, so that a large
    partition becomes several shards, and rows of one symbol and date meet in one."""
    from skyledger.sources.archive import ObservationSource

    rows.sparkSession.dataSource.register(ObservationSource)
    order = ["year", "month", "prefix", "symbol", "date"]
    sorted_rows = partition_columns(rows.withColumn("date", F.col("date").cast("date"))).repartitionByRange(*order).sortWithinPartitions(*order).drop(*order[:3])
    options = {"dataset": dataset, "width": width, "extension": extension, "fingerprint": fingerprint}
    sorted_rows.write.format("observations").mode("append").options(**options).save(root)
