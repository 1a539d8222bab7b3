"""Harmonic packing of token streams into fixed-size sequences.

Lengths fall into reciprocal-capacity classes: class k holds pieces of exactly ``capacity // k`` tokens, and every bin of
class k takes exactly k pieces, so each worker fills bins on its own, in one pass, without a shuffle. A document is cut
into the fewest pieces whose lengths are class sizes. What is left in a worker's open bins at the end (fewer than one bin
of each class) is laid end to end into full sequences, and the rest into sequences whose lengths are powers of two, which
need no padding.

Null text counts as empty; every document, an empty one too, ends with ``eos_id``. Rows with equal or null ids are packed
like any others.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from skyledger.llm.bpe import splitter
from skyledger.llm.common import slices
from skyledger.llm.words import WordMemory, as_bytes

BLOCK_ROWS = 1024


@lru_cache(maxsize=4)
def cuts(capacity: int) -> list[int]:
    """For each length below ``capacity``, the first piece of a cut into the fewest class sizes."""
    sizes = sorted({capacity // k for k in range(1, capacity + 1)})
    fewest, first = [0], [0]
    for n in range(1, capacity):
        best, take = min((fewest[n - s] + 1, -s) for s in itertools.takewhile(lambda s: s <= n, sizes))
        fewest.append(best)
        first.append(-take)
    return first


def pieces(length: int, capacity: int) -> Iterator[int]:
    """Lengths of a document's pieces, in order."""
    first = cuts(capacity)
    while length >= capacity:
        yield capacity
        length -= capacity
    while length:
        yield first[length]
        length -= first[length]


class Bins:
    """A worker's open bins. A piece is (document, start, ids, tokens of the document)."""

    def __init__(self, capacity: int, worker: int):
        self.capacity, self.open = capacity, {}
        self.sequence = itertools.count(worker << 40)

    def add(self, piece: tuple) -> list[tuple]:
        """The rows of the bin that the piece fills, if it fills one."""
        size = len(piece[2])
        held = self.open.setdefault(size, [])
        held.append(piece)
        if len(held) < self.capacity // size:
            return []
        del self.open[size]
        return self._rows(held, self.capacity // size)

    def _rows(self, held: list[tuple], k: int) -> list[tuple]:
        number, at, rows = next(self.sequence), 0, []
        for doc, start, ids, total in held:
            rows.append((doc, start, len(ids), ids.tobytes(), total, number, at, k))
            at += len(ids)
        return rows

    def rest(self) -> list[tuple]:
        """Rows of what is left: full sequences, then powers of two; their class is 0."""
        left = [p for size in sorted(self.open, reverse=True) for p in self.open[size]]
        self.open = {}
        total = sum(len(p[2]) for p in left)
        rooms = [self.capacity] * (total // self.capacity) + [1 << b for b in reversed(range(self.capacity.bit_length())) if total % self.capacity >> b & 1]
        rows, held = [], []
        room = rooms[:1] and rooms.pop(0)
        for doc, start, ids, tokens in left:
            while len(ids):
                held.append((doc, start, ids[:room], tokens))
                start, room, ids = start + len(ids[:room]), room - len(ids[:room]), ids[room:]
                if not room:
                    rows += self._rows(held, 0)
                    held, room = [], rooms and rooms.pop(0)
        return rows


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    made.encode_special_tokens = True  # their strings in a text are ordinary text
    return made


@lru_cache(maxsize=2)
def _token_bytes(path: str) -> np.ndarray:
    """How many bytes of text each id of a byte-level vocabulary stands for."""
    names = _tokenizer(path).get_vocab(with_added_tokens=False)
    table = np.zeros(max(names.values(), default=-1) + 1, np.int64)
    for name, number in names.items():
        table[number] = len(name)  # such a vocabulary writes every byte as one letter
    return table


def encode_words(words: list[str], path: str, together: int = 64) -> list[bytes]:
    """Ids of each word. Words of a space and letters stay apart when joined, so many of them share one call; the bytes
    that tokens stand for tell where each word ends. The others are encoded one by one."""
    model, found = _tokenizer(path), dict[str, bytes]()
    plain = [w for w in words if w[0] == " " and w[1:].isalpha()]
    groups = [plain[at : at + together] for at in range(0, len(plain), together)]
    for group, coded in zip(groups, model.encode_batch_fast(["".join(g) for g in groups], add_special_tokens=False)):
        ids = np.array(coded.ids, "<u4")
        ends = np.cumsum([len(w.encode()) for w in group])
        upto = np.cumsum(_token_bytes(path)[ids])
        cut = np.searchsorted(upto, ends)
        if cut[-1] == len(ids) - 1 and (upto[cut] == ends).all():
            data, low = ids.tobytes(), 0
            for word, high in zip(group, (4 * (cut + 1)).tolist()):
                found[word] = data[low:high]
                low = high
    rest = [w for w in words if w not in found]
    for at in range(0, len(rest), 10_000):
        part = rest[at : at + 10_000]
        found.update(zip(part, as_bytes([x.ids for x in model.encode_batch_fast(part, add_special_tokens=False)])))
    return [found[w] for w in words]


@lru_cache(maxsize=2)
def _memory(path: str) -> WordMemory:
    return WordMemory(lambda words: encode_words(words, path))


def tokenise(texts: list[str], path: str, pattern: str | None) -> list[np.ndarray]:
    """Ids of every text by ``tokenizers``. ``pattern``: how the vocabulary splits words; each word is encoded once."""
    model = _tokenizer(path)
    if pattern is None:
        return [np.array(x.ids, "<u4") for x in model.encode_batch_fast(texts, add_special_tokens=False)]
    return [np.frombuffer(x, "<u4") for x in _memory(path)(map(splitter(pattern), texts))]


def pack(df: DataFrame, doc: str, text: str, tokenizer: str, *, capacity: int = 2048, eos_id: int = 1, pattern: str | None = None) -> DataFrame:
    """Packs all rows; one row per piece: doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset, class_k (0: laid end to end). Each id of a document lies in exactly one piece.

    ``capacity`` must be a power of two. ``pattern``: the vocabulary's own word pattern, if words never depend on what
    surrounds them; without it every text is encoded whole.
    """
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    schema = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, class_k int"
    types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32()]
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(capacity, TaskContext.get().partitionId())
        end = np.array([eos_id], "<u4")

        def made(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in slices(batches, BLOCK_ROWS):
            rows: list[tuple] = []
            for number, ids in zip(batch.column(0).to_pylist(), tokenise([t or "" for t in batch.column(1).to_pylist()], tokenizer, pattern)):
                ids, start = np.concatenate([ids, end]), 0
                for size in pieces(len(ids), capacity):
                    part = ids[start : start + size]
                    rows += bins.add((number, start, part if size == capacity else part.copy(), len(ids)))
                    start += size
            if rows:
                yield made(rows)
        if rows := bins.rest():
            yield made(rows)

    return df.select(df[doc].cast("long"), df[text].cast("string")).mapInArrow(run, schema)
