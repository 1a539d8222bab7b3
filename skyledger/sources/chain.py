"""The chain of publications that makes an archive, and what its manifests say.

An archive is a chain of publications under ``<root>/<extension>/<fingerprint>``: ``latest.json`` names the newest dataset,
each ``datasets/<id>.json`` lists the shards it added and names the dataset before it, and each shard is a ``.bin`` of
little-endian single-precision rows beside an ``.index.json`` that lists their symbols and dates. A later listing of a
(symbol, date) replaces an earlier one. The size of all this goes with the number of files, so the driver reads it.
"""

from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import dataclass

from skyledger.functions.values import is_valid_dataset_id
from skyledger.sources.files import ArchiveError, Field, read_json

#: Fixed values of the archive format.
SHARD_INDEX_SCHEMA = "grq.observations.shard/1"
DATASET_MANIFEST_SCHEMA = "grq.observations.dataset/1"
BYTE_ORDER = "little-endian"
BYTES_PER_VALUE = 4

U16, U8, U32 = (1 << 16) - 1, (1 << 8) - 1, (1 << 32) - 1
WRITTEN = (Field("schema", str), Field("byteOrder", str), Field("observationExtension", int, U32), Field("inputCount", int), Field("featureFingerprint", str))
PLACE = (Field("prefix", str), Field("year", int, U16), Field("month", int, U8))
POINTER = (Field("datasetId", str),)
MANIFEST = (*WRITTEN, Field("datasetId", str), Field("shards", list, of=(Field("path", str), Field("sha256", str), Field("bytes", int), Field("rowCount", int), *PLACE)), Field("previousDatasetId", str, optional=True))


@dataclass(frozen=True)
class Semantics:
    observation_extension: int
    input_count: int
    feature_fingerprint: str

    def __str__(self) -> str:
        return f"{self.observation_extension}/{self.feature_fingerprint} of width {self.input_count}"


@dataclass(frozen=True)
class Shard:
    """A manifest's entry; ``order`` grows from the oldest publication on."""

    order: int
    manifest: str
    path: str
    sha256: str
    bytes: int
    row_count: int
    prefix: str
    year: int
    month: int


def check_written(found: dict, path: str, schema: str) -> None:
    if found["schema"] != schema:
        raise ArchiveError("schema", path, f"schema is {json.dumps(found['schema'])}; only {schema} can be read")
    if found["byteOrder"] != BYTE_ORDER:
        raise ArchiveError("schema", path, f"byteOrder is {json.dumps(found['byteOrder'])}; only {BYTE_ORDER} can be read")


def semantics_of(found: dict) -> Semantics:
    return Semantics(found["observationExtension"], found["inputCount"], found["featureFingerprint"])


def read_chain(root: str, head: str) -> list[tuple[str, dict]]:
    """Paths and contents of the manifests from the head to the oldest."""
    chain: list[tuple[str, dict]] = []
    seen: set[str] = set()
    wanted, referrer = head, f"{root}/latest.json"
    while wanted is not None:
        if not is_valid_dataset_id(wanted):
            raise ArchiveError("corrupt", referrer, f"unusable as a dataset's file name: {json.dumps(wanted)}")
        if wanted in seen:
            raise ArchiveError("corrupt", referrer, f"leads back to dataset {wanted}, which comes before it")
        seen.add(wanted)
        path = f"{root}/datasets/{wanted}.json"
        manifest = read_json(path, MANIFEST)
        check_written(manifest, path, DATASET_MANIFEST_SCHEMA)
        if manifest["datasetId"] != wanted:
            raise ArchiveError("corrupt", path, f"is filed as {json.dumps(wanted)}, but its datasetId is {json.dumps(manifest['datasetId'])}")
        chain.append((path, manifest))
        wanted, referrer = manifest["previousDatasetId"], path
    return chain


def chain_semantics(root: str, chain: list[tuple[str, dict]]) -> Semantics:
    """What all manifests of the chain were written under; the last two parts of the root must name it."""
    if not chain:
        raise ArchiveError("corrupt", root, "no dataset to read")
    found = semantics_of(chain[0][1])
    if found.input_count < 1:
        raise ArchiveError("corrupt", root, "inputCount is 0: rows would have no values")
    for path, manifest in chain:
        if semantics_of(manifest) != found:
            raise ArchiveError("semantics", path, f"holds {semantics_of(manifest)}; the head of its chain holds {found}")
    if root.rstrip("/").split("/")[-2:] != [str(found.observation_extension), found.feature_fingerprint]:
        raise ArchiveError("semantics", root, f"the last two folders should be {found.observation_extension}/{found.feature_fingerprint}, by the dataset in it")
    return found


def chain_shards(chain: list[tuple[str, dict]]) -> list[Shard]:
    """All entries, oldest publication first, and in manifest order."""
    entries = [(path, entry) for path, manifest in reversed(chain) for entry in manifest["shards"]]
    return [Shard(i, path, e["path"], e["sha256"], e["bytes"], e["rowCount"], e["prefix"], e["year"], e["month"]) for i, (path, e) in enumerate(entries)]


def first_repeated(shards: list[Shard]) -> tuple[int, ArchiveError] | None:
    """The fault of the first shard that an earlier entry names already, with its place."""
    seen: set[str] = set()
    for shard in shards:
        if shard.path in seen:
            return shard.order, ArchiveError("corrupt", shard.manifest, f"lists {shard.path}, which an earlier entry of the chain has listed")
        seen.add(shard.path)
    return None


def by_partition(shards: list[Shard]) -> list[tuple[tuple[int, int, str], list[Shard]]]:
    found: dict[tuple[int, int, str], list[Shard]] = defaultdict(list)
    for s in shards:
        found[s.year, s.month, s.prefix].append(s)
    return sorted(found.items(), key=lambda x: (x[0][0], x[0][1], x[0][2].encode()))


def snapshot(root: str, dataset: str | None) -> tuple[str, list[tuple[str, dict]], Semantics]:
    head = dataset if dataset is not None else read_json(f"{root}/latest.json", POINTER)["datasetId"]
    chain = read_chain(root, head)
    return head, chain, chain_semantics(root, chain)
