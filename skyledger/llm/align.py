"""Alignment of the tokens of two vocabularies over a corpus.

The texts of a whole Arrow batch lie end to end, with each document's place in bytes. One count of bytes (``bincount``) over the ends of
both vocabularies' tokens tells where either has an end (a link: the one token of each that covers the bytes before it) and where both
have (a cut between groups). Running sums of these marks, taken at the documents' ends, give each document's numbers; no document is
looked at by itself.

How often a pair of ids is linked corpus-wide is counted from one row for each pair of a batch, so the links themselves are never
shuffled: a batch sends its distinct pairs, gets their totals back, and meets its documents, which hold their links as places in
the batch's list of pairs. A pair that every batch has costs a row a batch.

Texts that are null or empty, or that either vocabulary does not give back byte for byte, have no tokens: zeros, and an empty digest.
Repeated rows count each, and so do rows without an id. Other columns are ignored, whatever their names. A batch is cut to BLOCK_BYTES of
text; a longer text is a batch of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.bpe import splitter
from skyledger.llm.common import stored
from skyledger.llm.packing import _tokenizer, encode_words
from skyledger.llm.words import WordMemory, as_bytes

BLOCK_BYTES = 3_000_000
#: Words of each vocabulary that a worker remembers.
TASK_WORDS = 150_000
#: A pair of ids as one number: the second vocabulary's id, and below it the first one's.
ID_BITS = 24
#: Where the second vocabulary's words begin: none of its pieces has a space behind another letter.
_PIECE_WORD = re.compile(r" +[^ ]*")


@lru_cache(maxsize=1)
def _letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes are themselves, the others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """The bytes of each id, their lengths, and each id as text before the marks that may follow it."""

    def __init__(self, tokens: list[bytes], inner: str, last: str):
        self.tokens, self.lengths = tokens, np.array([len(t) for t in tokens], np.int64)
        self.written = [f"{i}{mark}".encode() for mark in (inner, last) for i in range(len(tokens))]


@lru_cache(maxsize=2)
def first_vocabulary(path: str) -> Vocabulary:
    names = _tokenizer(path).get_vocab(with_added_tokens=False)
    tokens, letters = [b""] * (max(names.values(), default=-1) + 1), _letters()
    for name, number in names.items():
        tokens[number] = bytes(letters[c] for c in name)
    return Vocabulary(tokens, ",", "|")


@lru_cache(maxsize=2)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=2)
def second_vocabulary(path: str) -> Vocabulary:
    model = _pieces(path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    return Vocabulary([bytes([int(x[3:5], 16)]) if model.is_byte(i) else x.replace("▁", " ").encode() for i, x in enumerate(names)], ",", ";")


def _encode_pieces(words: list[str], path: str) -> list[bytes]:
    """Ids of words that begin with a space, which the model itself puts before a text."""
    model, out = _pieces(path), []
    space = model.piece_to_id("▁")
    for at in range(0, len(words), 10_000):
        out += as_bytes([ids or [space] for ids in model.encode([w[1:] for w in words[at : at + 10_000]], num_threads=1)])
    return out


@lru_cache(maxsize=1)
def _memories(first: str, second: str) -> tuple[WordMemory, WordMemory]:
    one = WordMemory(lambda words: encode_words(words, first), TASK_WORDS)
    return one, WordMemory(lambda words: _encode_pieces(words, second), TASK_WORDS, beside=one)


def token_ids(texts: list[str], first: str, second: str, pattern: str) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Ids of texts that begin with a space under both vocabularies, word by word: no token of either crosses its words."""
    one, two = _memories(first, second)
    a = one(map(splitter(pattern), texts))
    b = two(map(_PIECE_WORD.findall, texts))
    return [np.frombuffer(x, "<u4") for x in a], [np.frombuffer(x, "<u4") for x in b]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str | None]]]:
    ids: list = []
    texts: list[str | None] = []
    size = 0
    for batch in batches:
        for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if texts and size + len(text or "") > BLOCK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
            ids.append(number)
            texts.append(text)
            size += len(text or "")
    if texts:
        yield ids, texts


def _upto(marks: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many marks lie within each document, by a running sum at the documents' ends."""
    sums = np.concatenate([[0], np.cumsum(marks)])
    return np.diff(np.concatenate([[0], sums[ends]]))


def aligned(texts: list[str | None], first: str, second: str, pattern: str) -> dict[str, list | np.ndarray]:
    """Of a batch of texts: n_a, n_b, n_groups, n_links and groups_sha256 of each, ``pairs`` with ``times`` (the distinct linked pairs and how
    often they are linked), and of each text's links their places in ``pairs``."""
    one, two = first_vocabulary(first), second_vocabulary(second)
    whole = [" " + t if t else "" for t in texts]
    a, b = token_ids(whole, first, second, pattern)
    none = np.zeros(0, "<u4")
    size = np.zeros(len(texts), np.int64)
    for i, text in enumerate(whole):
        data = text.encode("utf-8", "surrogatepass")
        if data and b"".join(map(one.tokens.__getitem__, a[i].tolist())) == data == b"".join(map(two.tokens.__getitem__, b[i].tolist())):
            size[i] = len(data)
        else:
            a[i] = b[i] = none
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a, b))
    ids_a, ids_b = (np.concatenate([none, *ids]).astype(np.int64) for ids in (a, b))
    ends_a, ends_b, docs = np.cumsum(one.lengths[ids_a]), np.cumsum(two.lengths[ids_b]), np.cumsum(size)
    marks = np.bincount(np.concatenate([ends_a, ends_b]), minlength=int(size.sum()) + 1)  # 1: one has an end, 2: both
    n_links, n_groups = _upto(marks[1:] > 0, docs), _upto(marks[1:] == 2, docs)
    at = np.flatnonzero(marks)
    pairs, places, times = np.unique(ids_b[np.searchsorted(ends_b, at)] << ID_BITS | ids_a[np.searchsorted(ends_a, at)], return_inverse=True, return_counts=True)
    # Groups: tokens in their order, each with the mark that follows it.
    cut = np.flatnonzero(marks == 2)
    group_a, group_b = np.searchsorted(cut, ends_a), np.searchsorted(cut, ends_b)
    before_a, before_b = np.searchsorted(group_b, group_a, "left"), np.searchsorted(group_a, group_b, "right")  # tokens of the other side
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    order[np.arange(len(ids_a)) + before_a] = ids_a + len(one.tokens) * (marks[ends_a] == 2)
    order[np.arange(len(ids_b)) + before_b] = 2 * len(one.tokens) + ids_b + len(two.tokens) * (marks[ends_b] == 2)
    written = one.written + two.written
    digests, low = [], 0
    for high in np.cumsum(n_a + n_b).tolist():
        digests.append(hashlib.sha256(b"".join(map(written.__getitem__, order[low:high].tolist()))[:-1]).hexdigest() if high > low else "")
        low = high
    return {"n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups_sha256": digests, "pairs": pairs, "times": times, "places": places.reshape(-1)}


_DOCUMENT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def batches_aligned(docs: DataFrame, first: str, second: str, pattern: str) -> DataFrame:
    """Of (id, text): a row for each document with its batch (``block``) and ``links``, the places of its links in the batch's pairs (little-endian,
    of two bytes where they fit, else of four), and one for each batch with ``pairs`` and ``times``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        for k, (ids, texts) in enumerate(_blocks(batches)):
            made = aligned(texts, first, second, pattern)
            n = len(ids)
            kind = "<u2" if len(made["pairs"]) <= 1 << 16 else "<u4"
            data, width = made["places"].astype(kind).tobytes(), int(kind[-1])
            cut = [0, *(np.cumsum(made["n_links"]) * width).tolist()]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([task + k] * (n + 1), pa.int64()), pa.array([*ids, None], pa.int64()), *(pa.array([*made[c].tolist(), None], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                    pa.array([*made["groups_sha256"], None], pa.string()), pa.array([*(data[x:y] for x, y in zip(cut, cut[1:])), None], pa.binary()),
                    pa.array([None] * n + [made["pairs"]], pa.list_(pa.int64())), pa.array([None] * n + [made["times"]], pa.list_(pa.int64())),
                ],
                names=["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "pairs", "times"],
            )

    return docs.mapInArrow(run, f"block long, {_DOCUMENT}, links binary, pairs array<long>, times array<long>")


def pair_totals(found: DataFrame) -> DataFrame:
    """pair, total (links corpus-wide) and best (no pair of its second id has more), of rows (pair, times)."""
    totals = stored(found.groupBy("pair").agg(F.sum("times").alias("total")), "totals")
    second = F.shiftright("pair", ID_BITS)
    most = totals.groupBy(second.alias("b")).agg(F.max("total").alias("most"))  # a row for each id of the second vocabulary
    return totals.join(most, second == most["b"]).select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def align(df: DataFrame, doc: str, text: str, first: str, second: str, pattern: str) -> DataFrame:
    """Of each row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256. ``first``: a byte-level vocabulary of ``tokenizers``,
    whose words ``pattern`` finds; ``second``: a ``sentencepiece`` one, which puts a space before each text."""
    docs = df.select(df[doc].cast("long").alias("id"), df[text].cast("string").alias("text"))
    held = stored(batches_aligned(docs, first, second, pattern), "aligned")
    listed = held.where("pairs IS NOT NULL").select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("place", "x")).select("block", "place", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    totals = pair_totals(listed.select("pair", "times"))
    known = listed.select("block", "place", "pair").join(totals, "pair").select(F.col("block").alias("of"), "place", "total", "best")
    documents = held.where("pairs IS NULL").select("block", *[c.split()[0] for c in _DOCUMENT.split(", ")], "links")
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]

    def summed(rows: pa.Table, pairs: pa.Table) -> pa.Table:
        order = np.argsort(pairs.column("place").to_numpy())
        total, best = pairs.column("total").to_numpy()[order], pairs.column("best").to_numpy(zero_copy_only=False)[order]
        kind = "<u2" if len(total) <= 1 << 16 else "<u4"
        n_best, count_sum = [], []
        for data in rows.column("links"):
            at = np.frombuffer(data.as_py(), kind)
            n_best.append(int(best[at].sum()))
            count_sum.append(int(total[at].sum()))
        return pa.table([*(rows.column(c) for c in names[:6]), pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())], names=names)

    made = documents.groupBy("block").cogroup(known.groupBy("of")).applyInArrow(summed, f"{_DOCUMENT}, n_best long, count_sum long")
    return made.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
