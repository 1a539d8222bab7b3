"""WARC archives as a Spark data source, for reading and writing.

``spark.read.format("warc")`` plans files as partitions, takes predicates on record type and header fields, parses each
record's header first and skips the payload of records it does not want: gzip members that tell their own length (the
``sl`` extra field) are stepped over without decompressing the rest of them. Option ``payload=false`` skips all payloads;
``verify=true`` compares payloads with their digests.

``df.write.format("warc")`` writes one gzip member a record. Each task attempt writes files under names of its own; each
commit lists those that count in a ``_files-*.json`` of its own, so files of lost or repeated attempts are never read, and
appends, also concurrent ones, add to what is there. Mode overwrite removes the lists of earlier commits, then their files.

Files of other tools are read whole as well: plain ``.warc`` and ``.warc.gz``, in any folder below the path, with one record,
several, or part of one in a gzip member. What can't be read is an error, never left out.

Null payloads and texts count as empty. Files are reached through pyarrow's file systems, so any store that these know
will do.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage

from skyledger.llm.common import stored

SCHEMA = "record_id string, record_type string, target_uri string, date string, content_type string, payload_digest string, refers_to string, payload_bytes long, payload binary"
#: The WARC header field of each column.
FIELDS = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "content_type": "Content-Type", "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To"}
#: The list of one commit's files; a commit may also be an earlier version's, which has no number.
MANIFEST = re.compile(r"_files(-[0-9a-f]+)?\.json")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes after which a task starts another file, and bytes of payload in a batch that is read.
FILE_BYTES, BATCH_BYTES = 128 << 20, 4 << 20
#: Payloads that occur twice and may be broadcast (about 100 bytes each), and bits of the filter beyond that.
FIRSTS, FILTER_BITS = 100_000, 1 << 25
_HEADER_STEP = 2048
_HEAD_END = re.compile(rb"\r?\n\r?\n")


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def manifests(fs: pafs.FileSystem, root: str) -> list[str]:
    """The paths of the lists of all commits."""
    found = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    return sorted(x.path for x in found if x.type == pafs.FileType.File and MANIFEST.fullmatch(x.base_name))


def listed(fs: pafs.FileSystem, path: str) -> list[str]:
    with fs.open_input_stream(path) as source:
        return json.loads(source.read())["files"]


def member(data: bytes) -> bytes:
    """``data`` as a gzip member whose extra field tells its compressed and its full length."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    end = struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    if max(len(body) + 32, len(data)) >> 32:  # the field only holds 32 bits
        return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + end
    extra = b"sl" + struct.pack("<HII", 8, len(body) + 32, len(data))
    return b"\x1f\x8b\x08\x04\x00\x00\x00\x00\x00\xff" + struct.pack("<H", len(extra)) + extra + body + end


def record(row: dict) -> bytes:
    """One WARC record. A payload goes into an HTTP response; a revisit has that response's head only."""
    payload = row["payload"] or b""
    kind = row["record_type"] or "response"
    full = payload if kind != "revisit" else b""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: {row.get('content_type') or 'text/html; charset=utf-8'}\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    lines = {
        "WARC-Type": kind, "WARC-Record-ID": row["record_id"], "WARC-Date": row.get("date") or "1970-01-01T00:00:00Z", "WARC-Target-URI": row.get("target_uri"),
        "WARC-Payload-Digest": "sha1:" + digest(payload), "WARC-Refers-To": row.get("refers_to"), "WARC-Profile": REVISIT_PROFILE if kind == "revisit" else None,
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(head) + len(full)),
    }
    clean = lambda v: "".join(c if c not in "\r\n" else " " for c in v)
    text = "WARC/1.1\r\n" + "".join(f"{k}: {clean(v)}\r\n" for k, v in lines.items() if v is not None) + "\r\n"
    return text.encode() + head + full + b"\r\n\r\n"


#: Names that task attempts give to files.
OWN = re.compile(r"part-\d{5,}-\d+-[0-9a-f]{8}-\d{4,}\.warc\.gz")


def _archives(fs: pafs.FileSystem, root: str) -> list[str]:
    """The archives below a folder, at any depth, but for names that begin with a dot or an underscore. Archives in a form
    that can't be read are an error."""
    found = [x.path[len(root.rstrip("/")) + 1 :] for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if x.type == pafs.FileType.File]
    found = [x for x in found if ".warc" in x.rpartition("/")[2] and not any(p[:1] in "._" for p in x.split("/"))]
    if other := [x for x in found if not x.endswith((".warc", ".warc.gz"))]:
        raise ValueError(f"{root}/{min(other)}: neither .warc nor .warc.gz")
    return sorted(found)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool = False):
        self.path, self.overwrite = path, overwrite
        self.attempt = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        task = TaskContext.get()
        try:
            for batch in iterator:
                names = batch.schema.names
                for values in zip(*(c.to_pylist() for c in batch.columns)):
                    if out is None or size > FILE_BYTES:
                        if out is not None:
                            out.close()
                        files.append(f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{self.attempt[:8]}-{len(files):04d}.warc.gz")
                        out, size = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), 0
                    data = member(record(dict(zip(names, values))))
                    out.write(data)
                    size += len(data)
        finally:
            if out is not None:
                out.close()
        return Written(files)

    def commit(self, messages: list) -> None:
        fs, root = file_system(self.path)
        fs.create_dir(root, recursive=True)
        earlier = manifests(fs, root)
        if not earlier and not self.overwrite:
            # Archives that other tools have put here count as a commit of their own.
            mine = {x for m in messages if m for x in m.files}
            others = [x for x in _archives(fs, root) if x not in mine and not OWN.fullmatch(x)]
            if others:
                self._list(fs, root, uuid.uuid4().hex, others)
        self._list(fs, root, self.attempt, [x for m in messages if m for x in m.files])
        if self.overwrite:
            old = [x for path in earlier for x in listed(fs, path)]
            for path in earlier:
                fs.delete_file(path)
            for name in old:
                if fs.get_file_info(f"{root}/{name}").type == pafs.FileType.File:
                    fs.delete_file(f"{root}/{name}")

    def _list(self, fs: pafs.FileSystem, root: str, number: str, files: list[str]) -> None:
        """Writes a list under another name first, so that it is never read in part."""
        with fs.open_output_stream(f"{root}/_staged-{number}") as out:
            out.write(json.dumps({"files": sorted(files)}).encode())
        fs.move(f"{root}/_staged-{number}", f"{root}/_files-{number}.json")

    def abort(self, messages: list) -> None:
        fs, root = file_system(self.path)
        for name in (x for m in messages if m for x in m.files):
            fs.delete_file(f"{root}/{name}")


@dataclass
class Files(InputPartition):
    names: list


def _header(text: bytes) -> dict[str, str]:
    """The fields of a header. Lines end at line feeds alone, whatever else a value holds; a line that begins with a blank goes on with the one
    before. The first value of a field counts; blanks around it do not belong to it."""
    out: dict[str, str] = {}
    for line in re.split(rb"\r?\n", re.sub(rb"\r?\n[ \t]+", b" ", text))[1:]:
        name, _, value = line.partition(b":")
        if name.strip():
            out.setdefault(name.strip().decode("utf-8", "replace").lower(), value.strip(b" \t").decode("utf-8", "replace"))
    return out


class Unpacked:
    """The bytes of an open file, plain or in gzip members, from ``held`` on; reads and skips forwards only."""

    def __init__(self, source):
        self.source, self.held, self.raw = source, b"", source.read(1 << 16)
        self.plain = self.raw[:2] != b"\x1f\x8b"
        self.unzip = None  # of the member that is being read
        #: Of that member: where it begins in the file, its compressed and full length where it tells them, and how much of it has come out.
        self.began, self.told, self.came = 0, None, 0

    def _pull(self) -> bool:
        """Reads on in the file."""
        more = self.source.read(1 << 18)
        self.raw += more
        return bool(more)

    def more(self, most: int = 1 << 20) -> bool:
        """Adds what comes next to ``held``; false at the end of the file."""
        if self.plain:
            if not self.raw and not self._pull():
                return False
            self.held, self.raw = self.held + self.raw, b""
            return True
        while True:
            if self.unzip is None:
                while len(self.raw) < 22 and self._pull():
                    pass
                if not self.raw.strip(b"\0\r\n"):
                    if self._pull():
                        continue
                    return False
                if self.raw[:2] != b"\x1f\x8b":
                    raise ValueError("not a gzip member")
                self.began, self.came, self.unzip = self.source.tell() - len(self.raw), 0, zlib.decompressobj(31)
                self.told = struct.unpack("<II", self.raw[16:24]) if self.raw[3:4] == b"\x04" and self.raw[12:16] == b"sl\x08\0" and len(self.raw) >= 24 else None
            if not self.raw and not self._pull():
                raise ValueError("a record ends early")
            out = self.unzip.decompress(self.raw, most)
            self.raw = self.unzip.unconsumed_tail
            if self.unzip.eof:
                self.raw, self.unzip = self.unzip.unused_data, None
            self.came += len(out)
            if out:
                self.held += out
                return True

    def take(self, n: int) -> bytes:
        parts, size = [], 0
        while size < n:
            if not self.held and not self.more():
                raise ValueError("a record ends early")
            parts.append(self.held[: n - size])
            self.held = self.held[len(parts[-1]) :]
            size += len(parts[-1])
        return b"".join(parts)

    def skip(self, n: int) -> None:
        """Like ``take``, without keeping the bytes, and without reading them where the file or the member tells how long they are."""
        part = min(n, len(self.held))
        self.held, n = self.held[part:], n - part
        if self.plain and n > len(self.raw):
            to = self.source.tell() + n - len(self.raw)
            if to > self.source.size():
                raise ValueError("a record ends early")
            self.source.seek(to)
            self.raw, n = b"", 0
        elif n and self.unzip is not None and self.told and self.told[1] in (self.came + n, self.came + n + 4):
            # The rest of the member is this record, so the next one begins where the member ends.
            to = self.began + self.told[0]
            if to > self.source.size():
                raise ValueError("a record ends early")
            at = to - (self.source.tell() - len(self.raw))
            if at <= len(self.raw):
                self.raw = self.raw[at:]
            else:
                self.source.seek(to)
                self.raw = b""
            self.unzip, n = None, 0
        while n:
            if not self.held and not self.more():
                raise ValueError("a record ends early")
            part = min(n, len(self.held))
            self.held, n = self.held[part:], n - part


def records(source, wants, head_only: bool = False) -> Iterator[tuple[dict[str, str], bytes | None, int]]:
    """Header, block and length of the block of every record of an open file; the block is None, and not decoded, where
    ``wants(header)`` is false. ``head_only``: of the blocks only what stands before an empty line, or 64 KB, is read.

    Records follow each other by their Content-Length, whether members hold one, several or parts of one, or the file is
    plain. What is no record, or lacks its length or its end, is an error.
    """
    data = Unpacked(source)
    while True:
        data.held = data.held.lstrip(b"\r\n")
        while not data.held:
            if not data.more(_HEADER_STEP):
                return
            data.held = data.held.lstrip(b"\r\n")
        while not (found := _HEAD_END.search(data.held)):
            if not b"WARC/".startswith(data.held[:5]) and data.held.strip(b"\0"):
                raise ValueError(f"not a WARC record: {data.held[:40]!r}")
            if not data.more(_HEADER_STEP):
                if not data.held.strip(b"\0"):
                    return
                raise ValueError("a record ends early")
        if not data.held.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {data.held[:40]!r}")
        header = _header(data.held[: found.start()])
        data.held = data.held[found.end() :]
        length = header.get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            raise ValueError(f"{header.get('warc-record-id')}: a record without a Content-Length")
        n, block = int(length), None
        if wants(header):
            if head_only:
                while not _HEAD_END.search(data.held) and len(data.held) < min(n, 1 << 16) and data.more(_HEADER_STEP):
                    pass
                block = data.take(min(n, len(data.held)))
                data.skip(n - len(block))
            else:
                block = data.take(n)
        else:
            data.skip(n)
        yield header, block, n


def _payload(block: bytes, size: int, header: dict[str, str]) -> tuple[bytes, int]:
    """The payload in a block of ``size`` bytes, of which ``block`` is what was read, and the length of the full payload: for
    revisits what their HTTP head tells, else what the block holds."""
    if not header.get("content-type", "").startswith("application/http"):
        return block, size
    head, gap, body = block.partition(b"\r\n\r\n")
    told = [x.partition(b":")[2].strip() for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if told and told[0].isdigit() and header.get("warc-type") == "revisit":
        return body, int(told[0])
    return body, size - len(head) - len(gap)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes equality, membership and prefixes of header fields; hands back the rest."""
        for f in filters:
            name = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if name in FIELDS and name != "content_type" and name != "payload_digest" and isinstance(f, (EqualTo, EqualNullSafe, In, StringStartsWith, IsNotNull)):
                kind = {EqualTo: "in", EqualNullSafe: "in", In: "in", StringStartsWith: "starts", IsNotNull: "some"}[type(f)]
                self.tests.append((FIELDS[name].lower(), kind, [f.value] if isinstance(f, (EqualTo, EqualNullSafe, StringStartsWith)) else list(getattr(f, "value", ()))))
            else:
                yield f

    def wants(self, header: dict[str, str]) -> bool:
        for field, kind, values in self.tests:
            value = header.get(field)
            if kind == "in" and value not in values or kind == "some" and value is None or kind == "starts" and not (value or "").startswith(values[0]):
                return False
        return True

    def partitions(self) -> list[Files]:
        fs, root = file_system(self.path)
        if fs.get_file_info(root).type == pafs.FileType.File:
            return [Files([root])]
        commits = manifests(fs, root)
        names = sorted({x for path in commits for x in listed(fs, path)}) if commits else _archives(fs, root)
        return [Files([f"{root}/{x}"]) for x in names] or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.path)
        types = [pa.string()] * 7 + [pa.int64(), pa.binary()]
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        rows: list[tuple] = []
        size = 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for name in partition.names:
            with fs.open_input_file(name) as source:
                for header, block, length in records(source, self.wants, head_only=not self.payload and not self.verify):
                    if block is None:
                        continue
                    payload, full = _payload(block, length, header)
                    told = header.get("warc-payload-digest", "")
                    if self.verify and header.get("warc-type") == "response" and told.startswith("sha1:") and told != "sha1:" + digest(payload):
                        raise ValueError(f"{header.get('warc-record-id')}: the payload does not have its digest")
                    rows.append((*(header.get(FIELDS[c].lower()) for c in names[:7]), full, payload if self.payload else None))
                    size += len(payload)
                    if size > BATCH_BYTES or len(rows) >= 5000:
                        yield made()
                        rows, size = [], 0
        if rows:
            yield made()


class WarcDataSource(DataSource):
    """Format ``warc``; options: path, payload, verify."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    """Makes the format known to the session and lets predicates reach it."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def deduplicated(pages: DataFrame, page_id: str, url: str, html: str, least_bytes: int = 0) -> DataFrame:
    """The records of an archive of the pages: of equal payloads of at least ``least_bytes`` bytes, the one with the smallest
    id is a response and the others are revisits of it. Rows without an id, and rows that repeat the smallest, are responses.

    Payloads count as equal by SHA-1 and length. Only payloads that occur twice take part in the join. Up to FIRSTS of them
    are broadcast; of more, a table of FILTER_BITS bits, also of bounded size, tells which rows may be among them, and only
    these rows are shuffled.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("id"), F.col(url).cast("string").alias("target_uri"), F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size"))
    firsts = rows.where(F.col("size") >= least_bytes).groupBy("sha", "size").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    firsts = stored(firsts.select("sha", "size", "first"), "firsts")
    if firsts.count() <= FIRSTS:
        rows = rows.join(F.broadcast(firsts), ["sha", "size"], "left")
    else:
        bit = F.pmod(F.xxhash64("sha", "size"), F.lit(FILTER_BITS))
        places = {"word": F.shiftright(bit, 6), "at": F.pmod(bit, F.lit(64)).cast("int")}
        words = firsts.withColumns(places).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"))
        words = F.broadcast(stored(words, "filter"))  # FILTER_BITS / 64 rows at most
        seen = rows.withColumns(places).join(words, "word", "left")
        may = F.coalesce(F.getbit("bits", F.col("at")) == 1, F.lit(False))
        columns = ["sha", "size", "id", "target_uri", "payload"]
        alone = seen.where(~may).select(*columns, F.lit(None).cast("long").alias("first"))
        rows = seen.where(may).select(*columns).join(firsts, ["sha", "size"], "left").select(*columns, "first").union(alone)
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    again = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return rows.select(
        name("id").alias("record_id"), F.when(again, "revisit").otherwise("response").alias("record_type"), "target_uri", F.lit(None).cast("string").alias("date"),
        F.lit("text/html; charset=utf-8").alias("content_type"), F.lit(None).cast("string").alias("payload_digest"), F.when(again, name("first")).alias("refers_to"),
        F.col("size").cast("long").alias("payload_bytes"), "payload",
    )
