"""The publications of an archive as a feed of changes, in batch and as a stream.

    spark.readStream.format("observation_changes").load(root)

Every publication's own rows come out once, in the order of the chain, with the dataset's id and its ``publication`` number from 0 on; a
restated (symbol, date) comes again with a higher number, so the last of each is the snapshot. A stream's offset is the id of the newest dataset that
it has read and that one's number: after a restart it goes on with the publications behind it. The option ``most`` bounds the publications of a micro-batch.
A chain that no longer holds the dataset of an offset is an error, never a silent gap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from skyledger.sources.archive import SCHEMA, ObservationReader, Piece, Work, dealt
from skyledger.sources.chain import by_partition, chain_shards, first_repeated, snapshot
from skyledger.sources.files import ArchiveError
from skyledger.sources.publish import newest

CHANGES = "dataset string, publication long, " + SCHEMA.rpartition(", fault")[0]


@dataclass
class Change(InputPartition):
    dataset: str
    publication: int
    work: Work


class Feed:
    """The chain's publications from the oldest on, and the work of reading each."""

    def __init__(self, options: dict):
        self.options = options
        self.root, self.tasks = options["path"].rstrip("/"), int(options.get("tasks", "1"))

    def datasets(self, head: str | None) -> list[str]:
        return [] if head is None else [m["datasetId"] for _, m in reversed(snapshot(self.root, head)[1])]

    def changes(self, head: str, after: int) -> list[Change]:
        """What the publications up to ``head`` hold, from number ``after`` on. Only the chain is read, no index."""
        _, chain, semantics = snapshot(self.root, head)
        shards = chain_shards(chain)
        if twice := first_repeated(shards):
            raise twice[1]
        out = []
        for number, (path, manifest) in enumerate(reversed(chain)):
            if number >= after:
                own = by_partition([s for s in shards if s.manifest == path])
                for pieces in dealt([(sum(s.bytes for s in held), Piece(key, held)) for key, held in own], self.tasks):
                    out.append(Change(manifest["datasetId"], number, Work(pieces, semantics, None, None)))
        return out

    def rows(self, change: Change) -> Iterator[pa.RecordBatch]:
        for batch in ObservationReader({"path": self.root}).read(change.work):
            n = batch.num_rows
            first = [pa.array([change.dataset] * n), pa.array([change.publication] * n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*first, *batch.columns[:-1]], names=["dataset", "publication", *batch.schema.names[:-1]])


class ChangeReader(DataSourceReader, Feed):
    def partitions(self) -> list[Change]:
        head = self.options.get("dataset") or newest(self.root)
        return (self.changes(head, 0) if head else []) or [Change("", 0, Work([], None, None, None))]

    def read(self, partition: Change) -> Iterator[pa.RecordBatch]:
        yield from self.rows(partition) if partition.work.pieces else ()


class ChangeStream(DataSourceStreamReader, Feed):
    """Offsets: the id and number of the newest dataset that has been read; before the first one the id is null."""

    def __init__(self, options: dict):
        Feed.__init__(self, options)
        self.most = int(options.get("most", "0"))
        self.reached: dict | None = None

    def initialOffset(self) -> dict:
        return {"dataset": None, "publication": -1}

    def latestOffset(self) -> dict:
        found = self.datasets(newest(self.root))
        at = self.reached["publication"] if self.reached else -1
        if not found:
            return self.initialOffset()
        number = min(len(found) - 1, at + self.most) if self.most else len(found) - 1
        self.reached = {"dataset": found[number], "publication": number}
        return self.reached

    def partitions(self, start: dict, end: dict) -> list[Change]:
        if end["dataset"] is None:
            return []
        found = self.datasets(end["dataset"])
        for offset in (start, end):
            if offset["dataset"] is not None and found[offset["publication"] : offset["publication"] + 1] != [offset["dataset"]]:
                raise ArchiveError("corrupt", self.root, f"publication {offset['publication']} is not {offset['dataset']} any more")
        self.reached = end
        return self.changes(end["dataset"], start["publication"] + 1)

    def read(self, partition: Change) -> Iterator[pa.RecordBatch]:
        yield from self.rows(partition)

    def commit(self, end: dict) -> None:
        """An archive keeps its publications: there is nothing to let go."""


class ChangeSource(DataSource):
    """Format ``observation_changes``; options: path, tasks, most, and in batch dataset (the newest by default)."""

    @classmethod
    def name(cls) -> str:
        return "observation_changes"

    def schema(self) -> str:
        return CHANGES

    def reader(self, schema) -> ChangeReader:
        return ChangeReader(dict(self.options))

    def streamReader(self, schema) -> ChangeStream:
        return ChangeStream(dict(self.options))
