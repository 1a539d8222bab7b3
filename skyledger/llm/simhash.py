"""Near-duplicate documents by SimHash, their fingerprints matched by deletion-variant signatures.

1. Fingerprint: each bit is that of most of a text's word shingles, repeats included, under XXH64.
2. Signatures: a fingerprint is cut into SEGMENTS segments. Where two differ in at most DISTANCE = 4 bits, one of three segments
   differs in at most one, or two each would make six. Each segment gives a variant for each of its bits, with that bit a wildcard;
   two segments that differ in at most one bit share a variant. So each fingerprint is indexed under 64 keys, and an equality-join of
   the keys meets every pair.
3. Verification: the join is a sort of the keys over all tasks and a pass over their runs, where members are compared by
   whole fingerprints. A pair counts in the first key that it shares, and of the members of a key only the links of a spanning forest come out,
   so neither copies nor large groups of near copies are expanded into pairs.
4. A run longer than a block, or one that spans tasks, is compared within its blocks there. After the components of these links,
   keys whose members are still in several components are dealt anew, each pair of blocks as a group of bounded size of its own.

Copies share a fingerprint and are one node. Nothing of all fingerprints goes to the driver.

Null and empty texts, and texts without words, have the fingerprint zero, which is linked like any other; texts with fewer words than a
shingle have one of all of them. Rows of one id are one document, linked through each of its texts. A row without an id has a fingerprint, links
nothing, and has a null component. Columns other than id and text are ignored. Long texts are hashed in parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import dropped, stored
from skyledger.llm.neardup import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
#: Width in bits of each segment, from the lowest bit up.
SEGMENTS = (22, 21, 21)
#: Members of a key that are compared at a time; rows of a task that are looked at together; bytes of a text that are hashed at a time.
BLOCK_MEMBERS, CHUNK_ROWS, PART_BYTES = 4096, 1 << 18, 1 << 20
#: Runs of so few members are compared all at once, over all runs.
SHORT_RUN = 12
_GAP = re.compile(rb"[\x20\x09-\x0D]")
_LOW = np.array([low for low, width in zip(accumulate((0, *SEGMENTS)), SEGMENTS) for _ in range(width)], np.uint64)
_SEGMENT = np.array([((1 << width) - 1) << low for low, width in zip(accumulate((0, *SEGMENTS)), SEGMENTS) for _ in range(width)], np.uint64)
_WILD = _SEGMENT & ~(np.uint64(1) << np.arange(64, dtype=np.uint64))


def _parts(data: bytes) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PART_BYTES and (gap := _GAP.search(data, at + PART_BYTES)):
        yield data[at : gap.start()]
        at = gap.start()
    yield data[at:] if at else data


def shingle_hashes(data: bytes, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a lower-cased text, some at a time."""
    hashed, last, any_yet = xxhash.xxh64_intdigest, [], False
    for part in _parts(data):
        words = last + part.split()  # bytes.split: at spaces and \t to \r
        last = words[max(0, len(words) - size + 1) :]
        if len(words) >= size:
            any_yet = True
            ends = list(accumulate((len(w) + 1 for w in words), initial=0))
            line = b" ".join(words)
            yield np.array([hashed(line[a : b - 1], SEED) for a, b in zip(ends, ends[size:])], "<u8")
    if last and not any_yet:
        yield np.array([hashed(b" ".join(last), SEED)], "<u8")


def fingerprint(text: str | None) -> int:
    """The fingerprint as an unsigned integer."""
    n, count = 0, np.zeros(64, np.int64)
    for h in shingle_hashes((text or "").encode("utf-8", "surrogatepass").lower()):  # bytes.lower: A to Z only
        n += len(h)
        for at in range(0, len(h), 1 << 16):
            count += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """id and fp, the fingerprint as a signed long, of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made.view(np.int64))], names=["id", "fp"])

    return docs.mapInArrow(run, "id long, fp long")


def signatures(prints: DataFrame) -> DataFrame:
    """key and fp for each one-wildcard variant of each fingerprint; a key ends in the place of its wildcard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            keys = ((fp[:, None] & _WILD) >> _LOW) << np.uint64(6) | np.arange(64, dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32).reshape(-1)), pa.array(np.repeat(fp, 64).view(np.int64))], names=["key", "fp"])

    return prints.select("fp").mapInArrow(run, "key int, fp long")


def first_shared(difference: np.ndarray) -> np.ndarray:
    """The place of the wildcard of the first key that two fingerprints share, by what they differ in; 64 if they share none."""
    out = np.full(difference.shape, 64, np.uint64)
    for low in sorted({int(x) for x in _LOW}, reverse=True):
        own = difference & _SEGMENT[low]
        n = np.bitwise_count(own)
        out = np.where(n == 0, np.uint64(low), np.where(n == 1, np.bitwise_count(own - np.uint64(1)).astype(np.uint64), out))
    return out


def _linked(difference: np.ndarray, place: np.ndarray | int) -> np.ndarray:
    near = np.bitwise_count(difference) <= DISTANCE
    near[near] = first_shared(difference[near]) == (place if isinstance(place, int) else place[near])
    return near


def forest(fp: np.ndarray, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the members of a key."""
    left, one, other = fp, [], []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            at = reached.pop()
            near = _linked(left ^ at, place)
            if near.any():
                new = left[near]
                one.append(np.full(len(new), at))
                other.append(new)
                reached += list(new)
                left = left[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *one]), np.concatenate([none, *other])


def runs_of(key: np.ndarray, fp: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Links within the runs of sorted keys, and the keys whose runs are longer than a block."""
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(starts, len(key)))
    one, other, long = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], []
    short = np.repeat(size <= SHORT_RUN, size)
    for lag in range(1, min(SHORT_RUN, int(size.max(initial=0)))):
        at = np.flatnonzero((key[lag:] == key[:-lag]) & short[lag:])
        at = at[_linked(fp[at] ^ fp[at + lag], (key[at] & 63).astype(np.uint64))]
        one.append(fp[at])
        other.append(fp[at + lag])
    for k in np.flatnonzero(size > SHORT_RUN).tolist():
        low, high = int(starts[k]), int(starts[k] + size[k])
        if high - low > block:
            long.append(int(key[low]))
        for at in range(low, high, block):
            a, b = forest(fp[at : min(high, at + block)], int(key[low] & 63))
            one.append(a)
            other.append(b)
    return np.concatenate(one), np.concatenate(other), long


#: What a row of ``matched`` is: a link (a, b), a key longer than a block, or a key at either end of a task, which may go on in another.
LINK, LONG, EDGE = 0, 1, 2


def matched(keyed: DataFrame, block: int, chunk: int) -> DataFrame:
    """kind, key, a, b of rows (key, fp) sorted in each task by key; ``block``: members compared at a time, ``chunk``: rows held."""

    def made(kind: int, keys: list[int], a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        n = len(keys) if keys else len(a)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(keys or [0] * n, pa.int32()), *(pa.array(x.view(np.int64) if len(x) else np.zeros(n, np.int64)) for x in (a, b))], names=["kind", "key", "a", "b"]
        )

    none = np.zeros(0, np.uint64)

    def found(key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        a, b, long = runs_of(key, fp, block)
        if len(a):
            yield made(LINK, [], a, b)
        if long:
            yield made(LONG, long, none, none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp, held, ends = [], [], 0, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            ends = [*ends[:1], int(key[0]), int(key[-1])] if not ends else [ends[0], int(key[-1])]
            held_key.append(key)
            held_fp.append(fp)
            held += len(key)
            if held >= chunk:
                key, fp = np.concatenate(held_key), np.concatenate(held_fp)
                cut = int(np.searchsorted(key, key[-1]))  # the last run may go on
                if not cut:  # one run alone: it is compared by blocks, whatever comes
                    yield made(LONG, [int(key[-1])], none, none)
                    cut = len(key)
                yield from found(key[:cut], fp[:cut])
                held_key, held_fp, held = [key[cut:]], [fp[cut:]], len(key) - cut
        if held:
            yield from found(np.concatenate(held_key), np.concatenate(held_fp))
        if ends:
            yield made(EDGE, sorted({ends[0], ends[-1]}), none, none)

    return keyed.mapInArrow(run, "kind int, key int, a long, b long")


def across(rows: DataFrame) -> DataFrame:
    """Links (a, b) between components within a key, of rows (key, size, fp, label): each pair of blocks is a group of its own."""
    blocks = rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK_MEMBERS)).withColumn("own", F.pmod(F.xxhash64("fp"), "blocks"))
    dealt = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "fp", "label")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")

    def group(key: int, parts: list[tuple]) -> tuple[list, list]:
        own, fp, label = (np.concatenate(x) for x in zip(*parts))
        fp, one, other = fp.view(np.uint64), [], []
        several = own.min() != own.max()  # pairs within one block belong to that block's own group
        label = np.unique(label, return_inverse=True)[1]
        for x in range(len(fp)):
            may = (label != label[x]) & (own > own[x] if several else np.arange(len(fp)) > x)
            y = np.flatnonzero(may)
            y = y[_linked(fp[y] ^ fp[x], key & 63)]
            for kind in set(label[y].tolist()):  # a link to each component that is reached, which then is the same
                one.append(fp[x])
                other.append(fp[y[label[y] == kind][0]])
            label[np.isin(label, label[y])] = label[x]
        return one, other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None

        def done() -> Iterator[pa.RecordBatch]:
            one, other = group(last[0], held)
            if one:
                yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (one, other)], names=["a", "b"])

        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if not batch.num_rows:
                continue
            where = np.stack(columns[:3])
            cut = [0, *(np.flatnonzero((where[:, 1:] != where[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for low, high in zip(cut, cut[1:]):
                name = tuple(int(x) for x in where[:, low])
                if name != last and last is not None:
                    yield from done()
                    held = []
                last = name
                held.append(tuple(c[low:high] for c in columns[3:]))
        if held:
            yield from done()

    return dealt.mapInArrow(run, "a long, b long")


def links(prints: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """fp and label of every fingerprint that is linked with another; ``prints``: each fingerprint once, ``more``: links from elsewhere."""
    keyed = signatures(prints)
    found = stored(matched(keyed.repartitionByRange("key", "fp").sortWithinPartitions("key", "fp"), BLOCK_MEMBERS, CHUNK_ROWS), "matches")
    edges = found.where(F.col("kind") == LINK).select("a", "b")
    edges = edges if more is None else edges.union(more)
    labels = components(edges)
    ends = found.where(F.col("kind") == EDGE).groupBy("key").agg(F.count("*").alias("tasks")).where("tasks > 1").select("key")
    open_keys = found.where(F.col("kind") == LONG).select("key").union(ends).distinct()
    rows = keyed.join(open_keys, "key", "left_semi").join(labels.toDF("fp", "label"), "fp", "left").select("key", "fp", F.coalesce("label", "fp").alias("label"))
    rows = stored(rows, "open")
    mixed = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).where("low <> high")
    late = stored(across(rows.join(mixed.select("key", "size"), "key")), "links")
    if not late.isEmpty():
        labels = components(edges.union(late))
    labels = stored(labels.toDF("fp", "label"), "labels")
    dropped(found, rows, late)
    return labels


def near_duplicates(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each row: doc_id, fingerprint (16 hexadecimal digits), component_id (the smallest id reachable), kept."""
    rows = stored(fingerprints(df.select(F.col(doc).cast("long").alias("id"), F.col(text).cast("string").alias("text"))), "prints")
    known = rows.where("id IS NOT NULL")
    prints = stored(known.groupBy("fp").agg(F.min("id").alias("rep")), "distinct")
    several = known.groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("last")).where("a <> last").select("id", "a")
    labels = links(prints, known.join(several, "id").select("a", F.col("fp").alias("b")))
    rooted = prints.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    smallest = rooted.groupBy("label").agg(F.min("rep").alias("component_id"))
    component = stored(rooted.select("fp", "label").join(smallest, "label").select("fp", "component_id"), "components")
    dropped(prints, labels)
    made = rows.join(component, "fp", "left").withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))
    return made.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", kept.alias("kept"))
