"""Near-duplicate documents by HyperMinHash.

1. Sketch: each text's word shingles are hashed; a hash picks one of REGISTERS buckets, and each bucket keeps of its smallest
   value only the number of leading zeros and MANTISSA further bits. Empty buckets borrow from others by fixed probes.
   A sum of mixed hashes stands for the whole set, so copies of one set form a class and only its first document goes on.
2. Bands: BANDS groups of ROWS registers are hashed to keys. The keys are sorted over all tasks by range, so a key that
   holds a large share of all rows spreads over as many tasks as it needs; in each run of a key every document is paired
   with the first one.
3. Screen: pairs whose sizes alone rule a link out fall out, and of pairs of sets with at least ``EXACT_BELOW`` shingles
   those whose Jaccard index, estimated from equal registers and corrected for chance collisions, is below ``SCREEN``; the
   estimate of smaller sets is too wide to screen by. The rest is verified on the full sets.
4. Components of verified links; then, in each key that still holds several components, all pairs across components are
   screened and verified in blocks of bounded size, so that no link depends on which document a run began with.

Every step is a join, an aggregate or a sorted scan over tables in the shared folder; nothing of all documents goes to the
driver; tables go as soon as nothing reads them. Texts beyond a few MB are hashed in parts, so that a task's memory is a small
multiple of its longest text. A pair of Jaccard 0.75 shares no band with a probability of 3e-7, and less above that.

Null and empty texts have an empty set and are linked with nothing. Rows of one id are one document, linked through each of its texts;
``n_shingles`` and ``set_id`` are those of the row's own text. Rows that repeat an id and a text are compared once, and come back as many times as
they came. A row without an id keeps a null component and is kept. Columns other than id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import dropped, stored

SHINGLE, PERCENT = 5, 75
BANDS, ROWS, MANTISSA, VALUE_BITS = 40, 4, 10, 40
REGISTERS = BANDS * ROWS
SCREEN, EXACT_BELOW = 0.5, 512
BLOCK_BYTES = 1_000_000
#: Members of one key that are compared with each other at a time.
BLOCK_MEMBERS = 512
#: Sets of up to so many shingles go along with their registers: no other set can link with one below EXACT_BELOW.
CARRIED = 100 * EXACT_BELOW // PERCENT
_EMPTY = np.uint64(1 << 63)


@lru_cache(maxsize=1)
def _random() -> dict[str, np.ndarray]:
    draw = np.random.default_rng(7_340_033)
    odd = lambda n: draw.integers(0, 1 << 64, n, np.uint64) | np.uint64(1)
    far = odd(1 << 12)
    far[0] = 1  # words of up to 4096 bytes hash alike, whatever long words lie beside them
    return {"byte": odd(256), "place": odd(4096), "far": far, "word": odd(64), "probe": draw.integers(0, REGISTERS, (96, REGISTERS))}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and how many words each text has. Words end at spaces and \\t to \\r."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.concatenate([[True], gap[:-1]])
    starts, ends = np.flatnonzero(~gap & before), np.flatnonzero(gap & ~before)
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    if not len(starts):
        return np.zeros(0, np.uint64), n_words
    at = np.flatnonzero(~gap)
    lengths = ends - starts
    place = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    value = _byte_values(data[at], place)
    total = np.add.reduceat(value, np.cumsum(lengths) - lengths)
    return mix(total + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), n_words


def _byte_values(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    r = _random()
    value = r["byte"][data] * r["place"][place & 4095]
    if place.max(initial=0) > 4095:
        value *= r["far"][(place >> 12) & 4095] * (np.uint64(2) * (place >> 24).astype(np.uint64) + np.uint64(1))
    return value


def long_word_hashes(text: bytes) -> Iterator[np.ndarray]:
    """The hashes of the words of one text, as ``word_hashes`` has them, BLOCK_BYTES at a time; words may be longer than that."""
    total, length = np.zeros(1, np.uint64), 0  # of the word that goes on from the part before
    for at in range(0, len(text), BLOCK_BYTES):
        data = np.frombuffer(text, np.uint8, min(BLOCK_BYTES, len(text) - at), at)
        gap = (data == 32) | ((data >= 9) & (data <= 13))
        begins = ~gap & np.concatenate([[True], gap[:-1]])
        starts = np.flatnonzero(begins)
        ends = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]])) + 1
        lengths = ends - starts
        sums = np.zeros(0, np.uint64)
        if len(starts):
            goes_on = length if starts[0] == 0 else 0
            place = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            place[: lengths[0]] += goes_on
            sums = np.add.reduceat(_byte_values(data[~gap], place), np.cumsum(lengths) - lengths)
        if length:
            if len(starts) and starts[0] == 0:
                sums[:1] += total
                lengths[0] += length
            else:
                sums, lengths = np.concatenate([total, sums]), np.concatenate([[length], lengths])
        total, length = np.zeros(1, np.uint64), 0
        if len(ends) and ends[-1] == len(data):
            total, length, sums, lengths = sums[-1:].copy(), int(lengths[-1]), sums[:-1], lengths[:-1]
        yield mix(sums + lengths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if length:
        yield mix(total + np.array([length], np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    keys = _random()["word"]
    count = max(0, len(words) - size + 1)
    out = np.full(count, size, np.uint64)
    for j in range(size):
        out += words[j : j + count] * keys[j]
    return mix(out)


def _short(words: np.ndarray) -> np.ndarray:
    """The one shingle of fewer words than a shingle has; none of no words."""
    keys = _random()["word"]
    return mix(np.array([len(words)], np.uint64) + (words * keys[: len(words)]).sum(dtype=np.uint64)) if len(words) else np.zeros(0, np.uint64)


def long_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """The set of one long text, in parts that share ``size - 1`` words."""
    parts, last = [], np.zeros(0, np.uint64)
    for words in long_word_hashes(text):
        words = np.concatenate([last, words])
        parts.append(np.unique(_rolled(words, size)))
        last = words[max(0, len(words) - size + 1) :]
        if len(parts) > 8:
            parts = [np.unique(np.concatenate(parts))]
    whole = np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)
    return whole if len(whole) else _short(last)


def shingle_sets(texts: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's shingles; a text with fewer words has one of all of them."""
    data = [t.encode("utf-8", "surrogatepass").lower() for t in texts]  # bytes.lower: A to Z only
    short = [t if len(t) <= 2 * BLOCK_BYTES else b"" for t in data]
    words, n = word_hashes(short)
    rolled = _rolled(words, size)
    out, at = [], 0
    for whole, part, k in zip(data, short, n.tolist()):
        if len(whole) > len(part):
            out.append(long_set(whole, size))
        elif k >= size:
            out.append(np.unique(rolled[at : at + k - size + 1]))
        else:
            out.append(_short(words[at : at + k]))
        at += k
    return out


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The compressed registers of each set, a row each; sets without members have zeros."""
    n = np.array([len(s) for s in sets])
    low = np.full((len(sets), REGISTERS), _EMPTY)
    if n.sum():
        v = mix(np.concatenate(sets) + np.uint64(0x632BE59BD9B4E019))
        bucket = ((v >> np.uint64(VALUE_BITS)) * np.uint64(REGISTERS) >> np.uint64(64 - VALUE_BITS)).astype(np.int64)
        np.minimum.at(low.reshape(-1), np.repeat(np.arange(len(sets)), n) * REGISTERS + bucket, v & np.uint64((1 << VALUE_BITS) - 1))
    full, some = low.copy(), n > 0
    probes = [*_random()["probe"], *((np.arange(REGISTERS) + s) % REGISTERS for s in range(1, REGISTERS))]
    for probe in probes:
        empty = (full == _EMPTY) & some[:, None]
        if not empty.any():
            break
        full = np.where(empty, low[:, probe], full)
    part, exponent = np.frexp(np.where(full == _EMPTY, 1, full).astype(np.float64))
    zeros = np.where(full == 0, VALUE_BITS + 1, VALUE_BITS - exponent)
    mantissa = np.where(full == 0, 0, (part * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    return np.where(some[:, None], zeros * (1 << MANTISSA) + mantissa, 0).astype("<u2")


@lru_cache(maxsize=1)
def _chance() -> np.ndarray:
    """How likely registers of disjoint sets are equal, by the base-2 logarithms of their sizes."""
    edge = np.concatenate([[0.0], *[2.0**-z * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA)) for z in range(VALUE_BITS, 0, -1)], [1.0]])
    cell = np.array([-np.diff(np.exp(-max(1.0, 2.0**k / REGISTERS) * edge)) for k in range(40)])
    return cell @ cell.T


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard index from the share of equal registers, corrected for chance collisions; a and b: a row a set."""
    chance = _chance()[np.minimum(39, np.log2(np.maximum(n_a, 1)).astype(int)), np.minimum(39, np.log2(np.maximum(n_b, 1)).astype(int))]
    return ((a == b).mean(axis=-1) - chance) / (1 - chance)


def may_link(estimates: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether pairs go on to their full sets: their sizes allow a link, and the estimate does where it is narrow."""
    least, most = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    return (100 * least >= PERCENT * most) & ((least < EXACT_BELOW) | (estimates >= SCREEN))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str], list[int]]]:
    """Ids, texts and times in blocks of bounded bytes."""
    ids: list = []
    texts: list[str] = []
    times: list[int] = []
    size = 0
    for batch in batches:
        for number, text, n in zip(*(batch.column(c).to_pylist() for c in range(3))):
            if texts and size + len(text or "") > BLOCK_BYTES:
                yield ids, texts, times
                ids, texts, times, size = [], [], [], 0
            ids.append(number)
            texts.append(text or "")
            times.append(n)
            size += len(text or "")
    if texts:
        yield ids, texts, times


def sketches(docs: DataFrame) -> DataFrame:
    """id, n_shingles, two sums that stand for the set, the registers, and times, of (id, text, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, times in _blocks(batches):
            sets = shingle_sets(texts)
            sums = [[int(mix(s + np.uint64(salt)).sum(dtype=np.uint64).view(np.int64)) for s in sets] for salt in (1, 0xD1342543DE82EF95)]
            made = registers(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(x, pa.int64()) for x in sums), pa.array([x.tobytes() for x in made], pa.binary()), pa.array(times, pa.int64())],
                names=["id", "n", "set_a", "set_b", "registers", "times"],
            )

    return docs.mapInArrow(run, "id long, n long, set_a long, set_b long, registers binary, times long")


def full_sets(docs: DataFrame) -> DataFrame:
    """id and the whole set of shingle hashes, of (id, text, times)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, _ in _blocks(batches):
            sets = shingle_sets(texts)
            values = pa.array(np.concatenate(sets).view(np.int64)) if sets else pa.array([], pa.int64())
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(offsets, values)], names=["id", "members"])

    return docs.mapInArrow(run, "id long, members array<long>")


def run_heads(keyed: DataFrame) -> DataFrame:
    """Of rows (key, id) sorted in each task: a row for each id and the first id of its key's run (head false), and the
    first ids of the first and last run of each task (head true), by which runs over several tasks are joined up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key = last_first = None
        edge = []
        for batch in batches:
            key, number = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(key):
                continue
            begins = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
            at = np.maximum.accumulate(np.where(begins, np.arange(len(key)), -1))
            first = np.where(at >= 0, number[at], last_first if last_first is not None else 0)
            if last_key is None:
                edge.append((key[0], first[0]))
            last_key, last_first = key[-1], first[-1]
            pair = first != number
            yield pa.RecordBatch.from_arrays([pa.array(key[pair]), pa.array(number[pair]), pa.array(first[pair]), pa.array(np.zeros(int(pair.sum()), bool))], names=["key", "id", "first", "head"])
        if last_key is not None:
            edge.append((last_key, last_first))
            edge = list(dict.fromkeys(edge))
            yield pa.RecordBatch.from_arrays([pa.array([int(k) for k, _ in edge]), pa.array([int(f) for _, f in edge]), pa.array([int(f) for _, f in edge]), pa.array([True] * len(edge))], names=["key", "id", "first", "head"])

    return keyed.mapInArrow(run, "key long, id long, first long, head boolean")


def screened(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    """The pairs (a, b) that may link, with the estimate; sketch: id, n, registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in (2, 3))
            n_a, n_b = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            made = estimate(x, y, n_a, n_b)
            keep = np.flatnonzero(may_link(made, n_a, n_b))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep)), batch.column(1).take(pa.array(keep)), pa.array(made[keep])], names=["a", "b", "estimate"])

    joined = pairs.join(sketch.toDF("a", "n_a", "r_a"), "a").join(sketch.toDF("b", "n_b", "r_b"), "b")
    return joined.select("a", "b", "r_a", "r_b", "n_a", "n_b").mapInArrow(run, "a long, b long, estimate double")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are links by their full sets."""
    joined = pairs.select("a", "b").join(sets.toDF("a", "s_a"), "a").join(sets.toDF("b", "s_b"), "b")
    common = joined.select("a", "b", F.size("s_a").alias("n_a"), F.size("s_b").alias("n_b"), F.size(F.array_intersect("s_a", "s_b")).alias("common"))
    return common.where(100 * F.col("common").cast("long") >= PERCENT * (F.col("n_a").cast("long") + F.col("n_b") - F.col("common"))).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """id and label of every node of the edges (a, b); label: the smallest node it can reach.

    Each round hooks every node to its smallest neighbour, follows that twice, and contracts the edges; the number of
    rounds grows with the logarithm of the longest path.
    """
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hook = stored(both.groupBy("a").agg(F.min("b").alias("p")).select("a", F.least("a", "p").alias("p")), "hooks")
        step = hook.join(hook.toDF("p", "q"), "p").select("a", F.col("q").alias("p"))
        step = stored(step.join(hook.toDF("p", "q"), "p").select("a", F.col("q").alias("p")), "steps")
        moved = edges.join(step.toDF("a", "x"), "a").join(step.toDF("b", "y"), "b").where("x <> y")
        before, edges = edges, stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        dropped(before, hook)
        if labels is None:
            found, labels = step, step.toDF("id", "label")
        else:
            labels = stored(labels.join(step.toDF("label", "q"), "label", "left").select("id", F.coalesce("q", "label").alias("label")), "labels")
            dropped(found, step)
            found = labels
    return labels if labels is not None else edges.toDF("id", "label")


def _common(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many members a sorted set shares with each of the others."""
    values = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, values), len(one) - 1)
    ends = np.cumsum([len(x) for x in others])
    return np.diff(np.concatenate([[0], np.cumsum(one[at] == values)[ends - 1]]))


def across(open_rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of different labels within a key that link (sure) or may link (not sure, both beyond CARRIED shingles), of
    rows (key, size, id, label, registers, n, members); members: the set, where it has at most CARRIED shingles.

    A key's rows are dealt to blocks, and each pair of blocks is a group of bounded size of its own. Of the keys that a pair
    shares, the one of the lowest band screens it. Small sets are verified here, so that of pairs that no estimate can screen
    only links come out; large sets, which it screens well, are not sent along.
    """
    blocks = open_rows.withColumn("blocks", F.ceil(F.col("size") / BLOCK_MEMBERS)).withColumn("own", F.pmod(F.xxhash64("id"), "blocks"))
    dealt = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "label", "registers", "n", "members"
    )
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "own")

    def group(band: int, rows: list[tuple]) -> list[tuple]:
        own, number, label, held, n, members = zip(*rows)
        own, number, label, n = map(np.array, (own, number, label, n))
        table = np.frombuffer(b"".join(held), "<u2").reshape(-1, REGISTERS)
        several = own[0] != own[-1]  # pairs within one block belong to that block's own group
        found = []
        for x in range(len(rows)):
            y = np.flatnonzero((label != label[x]) & ((own > own[x]) if several else (np.arange(len(rows)) > x)))
            if not len(y):
                continue
            y = y[may_link(estimate(table[y], table[x], n[y], n[x]), n[y], n[x])]
            if len(y):
                equal = (table[y] == table[x]).reshape(len(y), BANDS, ROWS).all(axis=2)
                y = y[equal.argmax(axis=1) == band]
            small = y[(n[y] <= CARRIED) & (n[x] <= CARRIED)]
            if len(small):
                shared = _common(members[x], [members[k] for k in small])
                small = small[100 * shared >= PERCENT * (n[x] + n[small] - shared)]
            for part, sure in ((small, True), (y[(n[y] > CARRIED) | (n[x] > CARRIED)], False)):
                found += [(int(min(number[x], v)), int(max(number[x], v)), sure) for v in number[part]]
        return found

    def made(found: list[tuple]) -> pa.RecordBatch:
        a, b, sure = zip(*found)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(sure)], names=["a", "b", "sure"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            found: list[tuple] = []
            lists = batch.column(8)
            offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy().view(np.uint64)
            for k, (key, i, j, *row) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(8)))):
                if (key, i, j) != last:
                    if len(held) > 1:
                        found += group(last[0] & 63, held)
                    held, last = [], (key, i, j)
                held.append((*row, values[offsets[k] : offsets[k + 1]].copy()))
            if found:
                yield made(found)
        if len(held) > 1 and (found := group(last[0] & 63, held)):
            yield made(found)

    return dealt.mapInArrow(run, "a long, b long, sure boolean")


def once(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, text, times) with each text of an id once, and how often it came; and the ids that several rows bear. Only rows of such ids are shuffled."""
    again = stored(docs.where("id IS NOT NULL").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id"), "repeated")
    if again.isEmpty():
        return docs.withColumn("times", F.lit(1).cast("long")), again
    rows = stored(docs.join(again, "id", "left_semi").groupBy("id", "text").agg(F.count("*").alias("times")), "texts")
    return docs.join(again, "id", "left_anti").select("id", "text", F.lit(1).cast("long").alias("times")).union(rows), again


def near_duplicates(df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each row: doc_id, n_shingles, set_id (the smallest id with an equal set), component_id, kept."""
    docs, again = once(df.select(F.col(doc).cast("long").alias("id"), F.col(text).cast("string").alias("text")))
    sketch = stored(sketches(docs), "sketches")
    copies = sketch.where("n > 0 AND id IS NOT NULL").groupBy("set_a", "set_b", "n").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    copies = stored(copies.where("copies > 1").select("set_a", "set_b", "n", "rep"), "copies")
    classed = sketch.join(copies, ["set_a", "set_b", "n"], "left").withColumn("rep", F.coalesce("rep", "id"))
    classed = stored(classed.select("id", "n", "rep", "times", F.when(F.expr("n > 0 AND id = rep"), F.col("registers")).alias("registers")), "classes")
    dropped(sketch, copies)
    reps = classed.where("registers IS NOT NULL").select("id", "n", "registers")
    repeated = not again.isEmpty()
    own = None  # links of an id with the first ids of its texts' sets
    if repeated:
        reps = stored(reps.distinct(), "reps")  # texts of an id may have one set
        own = stored(classed.where("n > 0 AND id IS NOT NULL AND id <> rep").join(again, "id", "left_semi").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct(), "own")

    def key(band):
        """A hash of the band's registers whose low six bits are the band."""
        hashed = F.xxhash64(band, F.substring("registers", band * (2 * ROWS) + 1, F.lit(2 * ROWS)))
        return F.shiftleft(F.shiftright(hashed, 6), 6).bitwiseOR(band.cast("long"))

    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), key)
    keyed = reps.select("id", F.explode(keys).alias("key")).select("key", "id")
    runs = stored(run_heads(keyed.repartitionByRange("key", "id").sortWithinPartitions("key", "id")), "runs")
    heads = runs.where("head").select("key", "id")
    joint = heads.groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("tasks")).where("tasks > 1").select("key", "first")
    stars = stored(runs.where("NOT head").select("key", "id", "first").union(heads.join(joint, "key").where("id <> first").select("key", "id", "first")), "stars")
    dropped(runs)

    pairs = stored(screened(stars.select(F.col("id").alias("a"), F.col("first").alias("b")).distinct(), reps), "pairs")
    needed = stars.select("id").union(stars.select(F.col("first").alias("id"))).distinct()
    sets = full_sets(docs.join(needed, "id", "left_semi").select("id", "text", "times"))
    sets = stored(sets.distinct() if repeated else sets, "sets")
    best = stored(pairs.groupBy("a").agg(F.max_by("b", F.struct("estimate", -F.col("b"))).alias("b")), "best")
    links = stored(verified(best, sets), "links")
    links = links if own is None else links.union(own)
    labels = components(links)

    def labelled(rows: DataFrame, column: str, name: str) -> DataFrame:
        """Adds the label of the id in ``column``, itself if it has no link."""
        return rows.join(labels.toDF(column, name), column, "left").withColumn(name, F.coalesce(name, column))

    rest = labelled(labelled(pairs.join(best, ["a", "b"], "left_anti"), "a", "x"), "b", "y").where("x <> y")
    more = stored(verified(rest, sets), "links")
    dropped(pairs, best)
    if not more.isEmpty():
        links = links.union(more)
        labels = components(links)

    members = labelled(stars.select("key", "id").union(stars.select("key", F.col("first").alias("id"))).distinct(), "id", "label")
    members = stored(members.select("key", "id", "label"), "members")
    dropped(stars)
    mixed = members.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size")).where("low <> high AND size > 2")
    mixed = stored(mixed.select("key", "size"), "mixed")
    if not mixed.isEmpty():
        small = sets.where(F.size("members") <= CARRIED)
        rows = members.join(mixed, "key").join(reps, "id").join(small, "id", "left")
        found = stored(across(rows.select("key", "size", "id", "label", "registers", "n", "members")), "found")
        more = stored(found.where("sure").select("a", "b").union(verified(found.where("NOT sure").select("a", "b").distinct(), sets)), "links")
        if not more.isEmpty():
            links = links.union(more)
            labels = components(links)

    dropped(members, mixed, sets)
    out = classed.select("id", "n", "rep", "times").join(stored(labels, "labels").toDF("rep", "label"), "rep", "left")
    if repeated:
        out = out.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    component = F.when(F.col("id").isNull(), None).when(F.col("n") > 0, F.coalesce("label", "rep")).otherwise(F.col("id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("rep").alias("set_id"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
