"""Shard indexes as columns: their checks, the listings that count, and where those are kept for the scan.

A task reads the indexes of its shards once, lays their listings end to end as Arrow columns and checks all of them at a time.
Only where a check fails is the shard at fault gone through row by row, for the fault that comes first.

Listings that count are kept in files (``Kept``) in order of partition, symbol and date, so that the scan neither opens an index again
nor sorts, and can be cut anywhere. ``merged`` makes such files of sorted listings that come in any number of tasks, for partitions
that are too large for one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from skyledger.functions.values import WHITE_SPACE, DateError, MarketDate, is_canonical_symbol, is_safe_relative_path, prefix_for_symbol
from skyledger.sources.chain import BYTES_PER_VALUE, PLACE, SHARD_INDEX_SCHEMA, WRITTEN, Semantics, Shard, check_written, semantics_of
from skyledger.sources.files import ArchiveError, Field, file_system, read_json

INDEX = (
    *WRITTEN, *PLACE, Field("shardFile", str), Field("shardBytes", int), Field("shardSha256", str), Field("rowCount", int),
    Field("rows", list, of=(Field("symbol", str), Field("date", str), Field("exchange", str, optional=True), Field("alias", str, optional=True), Field("row", int))),
)
#: A listing: ``part`` is the place of its partition among those of the task, ``shard`` its shard's order, ``date`` in days since 1970.
LISTING = pa.schema([("part", pa.int32()), ("symbol", pa.string()), ("date", pa.int32()), ("exchange", pa.string()), ("alias", pa.string()), ("shard", pa.int32()), ("row", pa.int64())])
#: Rows of a batch in a file of kept listings; a scan reads whole batches.
KEPT_ROWS = 1 << 15


def read_index(root: str, shard: Shard, semantics: Semantics) -> dict:
    """A shard's index, checked against its manifest, with its rows as lists; the rows themselves are not checked yet."""
    if not is_safe_relative_path(shard.path):
        raise ArchiveError("corrupt", shard.manifest, f"points outside the archive: {json.dumps(shard.path)}")
    if not shard.path.endswith(".bin"):
        raise ArchiveError("corrupt", shard.manifest, f"payload without the ending .bin: {json.dumps(shard.path)}")
    path = f"{root}/{shard.path[:-4]}.index.json"
    index = read_json(path, INDEX, "rows")
    check_written(index, path, SHARD_INDEX_SCHEMA)

    def refuse(detail: str, kind: str = "corrupt"):
        raise ArchiveError(kind, path, detail)

    if semantics_of(index) != semantics:
        refuse(f"holds {semantics_of(index)}, unlike its chain", "semantics")
    if index["shardFile"] != shard.path.split("/")[-1]:
        refuse(f"shardFile is {json.dumps(index['shardFile'])}; it lies beside {shard.path}")
    n = index["rowCount"]
    if not len(index["rows"]["row"]) == n == shard.row_count:
        refuse(f"numbers of rows differ: rowCount {n}, listed {len(index['rows']['row'])}, in the manifest {shard.row_count}")
    size = n * semantics.input_count * BYTES_PER_VALUE
    if not index["shardBytes"] == size == shard.bytes:
        refuse(f"numbers of bytes differ: shardBytes {index['shardBytes']}, in the manifest {shard.bytes}, by rows and width {size}")
    if index["shardSha256"] != shard.sha256:
        refuse(f"shardSha256 is {index['shardSha256']}; in the manifest it is {shard.sha256}", "hash")
    if (index["year"], index["month"], index["prefix"]) != (shard.year, shard.month, shard.prefix):
        refuse(f"lies in {index['year']:04}/{index['month']:02}/{index['prefix']}; by the manifest in {shard.year:04}/{shard.month:02}/{shard.prefix}")
    return index


def refuse_rows(root: str, shard: Shard, rows: dict[str, list]) -> None:
    """Raises the fault of the first row of an index that has one."""
    used: set[int] = set()
    for symbol, text, number in zip(rows["symbol"], rows["date"], rows["row"]):

        def refuse(detail: str):
            raise ArchiveError("corrupt", f"{root}/{shard.path[:-4]}.index.json", detail)

        if not is_canonical_symbol(symbol):
            refuse(f"symbol with outer white space, or empty: {json.dumps(symbol)}")
        try:
            date = MarketDate.parse(text)
        except DateError as e:
            refuse(f"listing of {symbol}: {e}")
        if number >= shard.row_count or number in used:
            refuse(f"listing of {symbol} on {date}: row {number} is taken or beyond the last of {shard.row_count}")
        used.add(number)
        if (date.year, date.month, prefix_for_symbol(symbol)) != (shard.year, shard.month, shard.prefix):
            refuse(f"listing of {symbol} on {date} lies outside {shard.year:04}/{shard.month:02}/{shard.prefix}")


def days_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Days since 1970 and year * 12 + month - 1 of dates that all read YYYY-MM-DD and exist; ValueError otherwise."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if {len(t) for t in texts} != {10}:
        raise ValueError("another form")
    digits = np.array(texts, "S10").view(np.uint8).reshape(-1, 10).astype(np.int64) - 48  # UnicodeEncodeError is a ValueError
    own = np.delete(digits, (4, 7), axis=1)
    if not ((own >= 0) & (own <= 9)).all() or (digits[:, (4, 7)] != 45 - 48).any():
        raise ValueError("another form")
    year, month, day = own[:, :4] @ (1000, 100, 10, 1), own[:, 4:6] @ (10, 1), own[:, 6:] @ (10, 1)
    at = year * 12 + month - 1
    begins = lambda m: (m - 1970 * 12).astype("datetime64[M]").astype("datetime64[D]").astype(np.int64)
    first = begins(at)
    if ((month < 1) | (month > 12) | (day < 1) | (day > begins(at + 1) - first)).any():
        raise ValueError("no such day")
    return first + day - 1, at


def prefixes(symbol: pa.Array) -> pa.Array:
    """The partition letters of symbols."""
    first = pc.utf8_slice_codeunits(symbol, 0, 1)
    return pc.if_else(pc.and_(pc.string_is_ascii(first), pc.utf8_is_alnum(first)), pc.ascii_upper(first), "_")


def canonical(symbol: pa.Array) -> pa.Array:
    return pc.and_(pc.equal(pc.utf8_trim(symbol, WHITE_SPACE), symbol), pc.greater(pc.binary_length(symbol), 0))


def _columns(root: str, shards: list[tuple[int, Shard]], semantics: Semantics) -> pa.Table:
    """The listings of the shards (place of the partition, shard), in order; a ValueError or ArchiveError if any is at fault."""
    rows: dict[str, list] = {f.name: [] for f in INDEX[-1].of}
    for _, shard in shards:
        for name, values in read_index(root, shard, semantics)["rows"].items():
            rows[name] += values
    size = np.array([s.row_count for _, s in shards], np.int64)
    of = np.repeat(np.arange(len(shards)), size)
    symbol, number = pa.array(rows["symbol"], pa.string()), np.array(rows["row"], np.int64)
    days, month = days_of(rows["date"])
    prefix = prefixes(symbol)
    place = np.array([s.year * 12 + s.month - 1 for _, s in shards], np.int64)
    # The places in all shards, end to end: as many as there are rows, and all different.
    spot = number + np.repeat(np.cumsum(size) - size, size)
    if (
        (number >= size[of]).any() or len(np.unique(spot)) < len(spot) or (month != place[of]).any() or len({s.month for _, s in shards} - set(range(1, 13)))
        or not pc.all(pc.equal(prefix, pa.array([s.prefix for _, s in shards], pa.string()).take(pa.array(of))), min_count=0).as_py()
        or not pc.all(canonical(symbol), min_count=0).as_py()
    ):
        raise ValueError("a listing at fault")
    return pa.Table.from_arrays(
        [pa.array(np.array([p for p, _ in shards], np.int32)[of] if shards else np.zeros(0, np.int32)), symbol, pa.array(days.astype(np.int32)), pa.array(rows["exchange"], pa.string()), pa.array(rows["alias"], pa.string()),
         pa.array(np.array([s.order for _, s in shards], np.int32)[of] if shards else np.zeros(0, np.int32)), pa.array(number)], schema=LISTING,
    )


def read_listings(root: str, shards: list[tuple[int, Shard]], semantics: Semantics) -> tuple[pa.Table, dict[int, tuple[int, ArchiveError]]]:
    """The listings of all sound partitions, and of each other one (by its place) the order of its first shard at fault, and the fault."""
    try:
        return _columns(root, shards, semantics), {}
    except (ValueError, ArchiveError):
        pass
    faults: dict[int, tuple[int, ArchiveError]] = {}
    for part, shard in shards:
        if part not in faults:
            try:
                refuse_rows(root, shard, read_index(root, shard, semantics)["rows"])
            except ArchiveError as e:
                faults[part] = shard.order, e
    if not faults:
        raise ArchiveError("corrupt", root, "listings that no check tells apart")  # the two forms of the checks disagree
    return _columns(root, [(p, s) for p, s in shards if p not in faults], semantics), faults


def latest(listings: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The last listing of each symbol and date, by partition, symbol and date, and the partitions of those it replaced."""
    if listings.num_rows < 2:
        return listings, np.zeros(0, np.int32)
    ordered = listings.append_column("at", pa.array(np.arange(listings.num_rows)))
    ordered = ordered.take(pc.sort_indices(ordered, sort_keys=[(c, "ascending") for c in ("part", "symbol", "date", "at")])).combine_chunks()
    part, date, symbol = ordered["part"].to_numpy(), ordered["date"].to_numpy(), ordered["symbol"]
    same = (part[1:] == part[:-1]) & (date[1:] == date[:-1]) & pc.equal(symbol[1:], symbol[:-1]).to_numpy(zero_copy_only=False)
    return ordered.drop_columns(["at"]).filter(pa.array(np.append(~same, True))), part[:-1][same]


def within(listings: pa.Table, first: MarketDate | None, last: MarketDate | None) -> pa.Table:
    if first is not None:
        listings = listings.filter(pc.greater_equal(listings["date"], first.epoch_days()))
    if last is not None:
        listings = listings.filter(pc.less_equal(listings["date"], last.epoch_days()))
    return listings


@dataclass
class Kept:
    """Rows of a file of kept listings: ``n`` from ``start`` on."""

    file: str
    start: int
    n: int


@dataclass
class Keeper:
    """Writes kept listings to a file of its own, and says where each partition's lie."""

    folder: str
    file: str = field(default="", init=False)
    written: int = field(default=0, init=False)

    def __enter__(self):
        fs, at = file_system(self.folder)
        fs.create_dir(at, recursive=True)
        self.file = f"{self.folder}/{uuid.uuid4().hex}.arrow"  # attempts do not share files
        self.sink = pa.ipc.new_file(file_system(self.file)[0].open_output_stream(file_system(self.file)[1], compression=None), LISTING)
        self.held: list[pa.Table] = []
        return self

    def add(self, rows: pa.Table) -> Kept:
        made = Kept(self.file, self.written, rows.num_rows)
        self.held.append(rows)
        self.written += rows.num_rows
        if (n := sum(t.num_rows for t in self.held)) >= KEPT_ROWS:
            whole = pa.concat_tables(self.held).combine_chunks()
            self.sink.write_table(whole.slice(0, n // KEPT_ROWS * KEPT_ROWS), KEPT_ROWS)
            self.held = [whole.slice(n // KEPT_ROWS * KEPT_ROWS)]
        return made

    def __exit__(self, *error) -> None:
        if self.held:
            self.sink.write_table(pa.concat_tables(self.held).combine_chunks(), KEPT_ROWS)
        self.sink.close()


def read_kept(pieces: Iterable[Kept]) -> Iterator[pa.Table]:
    """The listings of the pieces, a batch of the file at a time."""
    for piece in pieces:
        fs, at = file_system(piece.file)
        with fs.open_input_file(at) as source:
            held = pa.ipc.open_file(source)
            low, high = piece.start, piece.start + piece.n
            for k in range(low // KEPT_ROWS, -(-high // KEPT_ROWS)):
                batch = held.get_batch(k)
                begin = k * KEPT_ROWS
                yield pa.Table.from_batches([batch.slice(max(0, low - begin), min(high, begin + batch.num_rows) - max(low, begin))])


def cut(pieces: list[Kept], low: int, high: int) -> list[Kept]:
    """Rows ``low`` to ``high`` of the pieces, which lie end to end."""
    out, at = [], 0
    for p in pieces:
        a, b = max(low, at), min(high, at + p.n)
        if a < b:
            out.append(Kept(p.file, p.start + a - at, b - a))
        at += p.n
    return out
