"""Byte-level BPE by merge replay.

The words of a block of documents form a small corpus of distinct words. An inverted index leads from each mergeable
token pair to the places where it stands; merges are replayed in rank order over all words at once, and each merge
touches only its two neighbours. Blocks are independent, so the stage needs no shuffle and no state but a bounded cache
of words (``words``).

Null text counts as empty; an empty text has no ids. Repeated rows and extra columns pass through unchanged.
"""

from __future__ import annotations

import base64
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from skyledger.llm.common import field_at, slices
from skyledger.llm.words import WordMemory, as_bytes

#: Letters and digits that Unicode 16 added to Unicode 15.1, as first and last code points.
UNICODE_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D40, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7),
    (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x116D0, 0x116E3), (0x11BC0, 0x11BE0), (0x11BF0, 0x11BF9), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16130, 0x16139), (0x16D40, 0x16D6C), (0x16D70, 0x16D79), (0x18CFF, 0x18CFF), (0x1CCF0, 0x1CCF9),
    (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5FA),
]
#: The classes of the pattern within the first 256 code points, for which the quicker ``re`` does.
NEAR = {r"\p{L}": r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", r"\p{N}": r"0-9\xb2\xb3\xb9\xbc-\xbe", r"\s": r"\t\n\x0b\x0c\r \x85\xa0"}
FAR = re.compile("[^\x00-\xff]")
#: Documents coded at a time.
BLOCK_ROWS = 2048


class Splitter:
    """Cuts a text into the matches of a pattern, with letters and digits as in Unicode 16, whatever ``regex`` knows."""

    def __init__(self, pattern: str):
        self.plain = regex.compile(pattern)
        near = pattern
        for kind, own in NEAR.items():  # within a class the members, elsewhere a class of its own
            near = re.sub(r"(\[[^]]*)" + re.escape(kind), lambda m, own=own: m[1] + own, near)
            near = near.replace(kind, f"[{own}]")
        self.near = re.compile(near.replace(r"\S", f"[^{NEAR[chr(92) + 's']}]"))
        known = regex.compile(r"[\p{L}\p{N}]")
        added = {c for a, b in UNICODE_16 for c in range(a, b + 1)}
        self.newer = frozenset(
            chr(c)
            for c in range(0x80, sys.maxunicode + 1)
            if unicodedata.category(chr(c)) not in ("Cs", "Co")
            and known.match(chr(c))
            and unicodedata.category(chr(c))[0] not in "LN"
            and c not in added
        )
        lowest = min(self.newer, default=chr(sys.maxunicode))
        self.far = re.compile(f"[{lowest}-{chr(sys.maxunicode)}]")
        newer = regex.escape("".join(sorted(self.newer)), special_only=True)
        strict = pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])")
        for kind in (r"\p{L}", r"\p{N}"):
            strict = re.sub(re.escape(kind) + r"(?=\+)", lambda _, k=kind: rf"(?:(?![{newer}]){k})", strict)
        self.strict = regex.compile(strict) if self.newer else self.plain

    def __call__(self, text: str) -> list[str]:
        if FAR.search(text) is None:
            return self.near.findall(text)
        if not self.far.search(text) or self.newer.isdisjoint(text):
            return self.plain.findall(text)
        return self.strict.findall(text)


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Splitter:
    return Splitter(pattern)


class MergeReplay:
    """Encoder over ranks: id of each token = its rank; a pair merges if its bytes together are a token."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.shift = max(1, len(self.bytes_of)).bit_length()
        self.first = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        get = ranks.get
        merge: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    merge[a << self.shift | b] = rank
        self.pairs = np.array(sorted(merge), np.int64)
        self.pair_rank = np.array([merge[x] for x in self.pairs.tolist()], np.int64)

    def rank_of(self, pairs: np.ndarray) -> np.ndarray:
        """The rank of what each pair merges to, or -1."""
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.pair_rank[at], -1)

    def alone(self, word: bytes) -> list[int]:
        """One word by repeated lowest-rank, leftmost merges: a heap of pairs, and for each place its neighbours."""
        token = self.first[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(token)), -1], list(range(-1, len(token) - 1))
        want = [-1] * len(token)  # of each place, the rank of the pair that starts there
        heap: list[tuple[int, int]] = []

        def note(at: int) -> None:
            a, b = token[at], token[after[at]] if after[at] >= 0 else -1
            want[at] = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1) if a >= 0 and b >= 0 else -1
            if want[at] >= 0:
                heappush(heap, (want[at], at))

        for at in range(len(token)):
            note(at)
        while heap:
            rank, at = heappop(heap)
            if want[at] != rank:
                continue
            gone = after[at]
            token[at], after[at], want[gone] = rank, after[gone], -1
            if after[at] >= 0:
                before[after[at]] = at
            after[gone] = -2  # stands in a token now
            note(at)
            if before[at] >= 0:
                note(before[at])
        return [t for t, a in zip(token, after) if a != -2]

    def corpus(self, words: list[bytes]) -> list[list[int]]:
        """Ids of every word, by one replay of the merges over all of them in rank order."""
        found: list[list[int]] = [[self.ranks[w]] if w in self.ranks else [] for w in words]
        todo = [i for i, w in enumerate(words) if not found[i] and w]
        if not todo:
            return found
        text = b"".join(words[i] for i in todo)
        lengths = np.fromiter((len(words[i]) for i in todo), np.int64, len(todo))
        ends = np.cumsum(lengths)
        starts = ends - lengths
        n, shift = len(text), self.shift
        token = self.first[np.frombuffer(text, np.uint8)]
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1], before[starts] = -1, -1
        want = np.full(n, -1, np.int64)  # of each place, the rank of the pair that starts there
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def note(places: np.ndarray) -> np.ndarray:
            """Enters the pairs that start at the places into the index; returns their ranks."""
            ranks = self.rank_of(token[places] << shift | token[after[places]])
            want[places] = ranks
            can = np.flatnonzero(ranks >= 0)
            if len(can):
                order = can[np.argsort(ranks[can], kind="stable")]
                sorted_ranks, sorted_places = ranks[order], places[order]
                cut = [0, *(np.flatnonzero(np.diff(sorted_ranks)) + 1).tolist(), len(order)]
                for low, high in zip(cut, cut[1:]):
                    r = int(sorted_ranks[low])
                    if r not in index:
                        index[r] = []
                        heappush(heap, r)
                    index[r].append(sorted_places[low:high])
            return ranks

        note(np.flatnonzero(after >= 0))
        odd: list[np.ndarray] = []
        while heap:
            r = heappop(heap)
            held = index.pop(r)
            p = np.unique(np.concatenate(held)) if len(held) > 1 else np.sort(held[0])
            p = p[want[p] == r]
            if not len(p):
                continue
            q = after[p]
            if len(p) > 1 and (meet := q[:-1] == p[1:]).any():  # runs such as aaaa: the leftmost pairs merge
                first = np.concatenate([[True], ~meet])
                nth = np.arange(len(p)) - np.maximum.accumulate(np.where(first, np.arange(len(p)), 0))
                p = p[nth % 2 == 0]
                q = after[p]
            right = after[q]
            inner = right >= 0
            old = token[right[inner]]
            token[p], token[q], want[q], want[p] = r, -1, -1, -1
            after[p] = right
            before[right[inner]] = p[inner]
            changed = token[right[inner]] != old
            if changed.any():  # between two merges at once, the leftmost of them comes first
                late = self.rank_of(np.int64(r) << shift | old[changed])
                odd.append(p[inner][changed][(late >= 0) & (late < r)])
            left = before[p]
            touched = np.concatenate([p[inner], left[left >= 0]])
            if len(touched):
                touched = np.unique(touched)
                ranks = note(touched)
                odd.append(touched[(ranks >= 0) & (ranks < r)])
        alive = token >= 0
        ids = token[alive].tolist()
        upto = np.cumsum(alive)[ends - 1].tolist()
        low = 0
        for i, high in zip(todo, upto):
            found[i] = ids[low:high]
            low = high
        # A merge of lower rank became possible late: the order within the word is then decided by the word alone.
        for w in {int(x) for x in np.searchsorted(ends, np.concatenate([*odd, np.zeros(0, np.int64)]), side="right")}:
            found[todo[w]] = self.alone(words[todo[w]])
        return found

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str) -> MergeReplay:
    """The ranks of a vocabulary file, lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return MergeReplay({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})


@lru_cache(maxsize=2)
def _memory(path: str, pattern: str) -> WordMemory:
    coder = load(path)
    return WordMemory(lambda words: as_bytes(coder.corpus([w.encode("utf-8", "surrogatepass") for w in words])))


def encode_texts(texts: list[str], path: str, pattern: str) -> list[bytes]:
    """Ids of every text as little-endian unsigned 32-bit integers."""
    return _memory(path, pattern)(map(splitter(pattern), texts))


def encode(df: DataFrame, text: str, path: str, pattern: str, ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """Adds ``ids``: the text's token ids, little-endian unsigned 32-bit, as binary; with ``decoded`` also their bytes.

    Columns of these names that ``df`` has already are replaced. No shuffle: each task encodes its own rows.
    """
    out = df.drop(ids, *([decoded] if decoded else []))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema] + [f"`{ids}` binary"] + [f"`{decoded}` binary"] * bool(decoded))

    at = field_at(out, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_ROWS):
            made = encode_texts([t or "" for t in batch.column(at).to_pylist()], path, pattern)
            columns = [*batch.columns, pa.array(made, pa.binary())]
            if decoded:
                columns.append(pa.array([load(path).decode(np.frombuffer(x, "<u4").tolist()) for x in made], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, ids, *([decoded] if decoded else [])])

    return out.mapInArrow(run, schema)


def decode(df: DataFrame, ids: str, path: str, decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded``: the bytes that the ids stand for; null ids give null."""
    out = df.drop(decoded)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema] + [f"`{decoded}` binary"])

    at = field_at(out, ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_ROWS):
            made = [None if x is None else load(path).decode(np.frombuffer(x, "<u4").tolist()) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, decoded])

    return out.mapInArrow(run, schema)
