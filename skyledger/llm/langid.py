"""Language identification by hyperdimensional profiles.

Every letter class has a random vector of +1 and -1. The vector of an n-gram binds its letters: each letter's vector is
permuted (rotated) by its place and the results are multiplied. A text's profile bundles (sums) the vectors of all its
n-grams; a language's prototype bundles those of all its training texts. A text gets the language whose prototype has the
largest cosine with its profile.

Training gathers one vector a language (``dimensions`` numbers), summed in the tasks first; so the model is bounded by the
number of languages. Prediction is one pass without a shuffle, over whole texts.

A text that is null or has no letter is ``und`` with score 0. With no training text at all every text is ``und``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.bands import with_bands
from skyledger.llm.common import field_at, slices, stored

#: Letter classes: 0 is what stands between words, 1 to 26 are a to z, the others share the rest by code point.
CLASSES = 96
DIMENSIONS = 1024
SEED = 20_24
BLOCK_ROWS = 256
#: Letters counted at a time; longer texts are cut with an overlap of one n-gram, so that memory stays bounded.
BLOCK_LETTERS = 1_000_000
#: Cells of a table of texts by trigrams, trigrams whose vectors are formed at a time, and languages that a task counts at a time.
CELLS, BLOCK_GRAMS, HELD_LANGUAGES = 4_000_000, 4096, 16
UND = "und"
#: Random letters have a cosine of at most 0.15 with any language, texts of 100 characters and more one of at least 0.3 with theirs.
OUTER_COSINE = 0.25


@lru_cache(maxsize=1)
def _class_of() -> np.ndarray:
    """The letter class of every code point; upper and lower case are alike."""
    table = np.zeros(sys.maxunicode + 1, np.uint8)
    for c in range(sys.maxunicode + 1):
        letter = chr(c)
        if letter.isalpha():
            low = ord(letter.lower()[0])
            table[c] = low - 96 if 97 <= low <= 122 else 27 + low % (CLASSES - 27)
    return table


@lru_cache(maxsize=2)
def _letters(dimensions: int) -> list[np.ndarray]:
    """The vectors of the letter classes, rotated for the first, second and third place."""
    first = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), (CLASSES, dimensions))
    return [np.roll(first, 2, axis=1), np.roll(first, 1, axis=1), first]


def vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """The bound vectors of trigrams, a row each."""
    a, b, c = _letters(dimensions)
    return (a[grams // CLASSES**2] * b[grams // CLASSES % CLASSES] * c[grams % CLASSES]).astype(np.float32)


def counts(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of some texts in a row: the place of the first, their distinct trigrams, and how often each text has each (a row a text)."""
    codes = _class_of()[np.frombuffer("\x00".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) + 1 for t in texts])
    owner = np.concatenate([owner, owner[-1:]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] > 0) | (codes[:-1] > 0)  # one gap between words
    codes, owner = codes[keep].astype(np.int32), owner[keep]
    grams, owner = codes[:-2] * CLASSES**2 + codes[1:-1] * CLASSES + codes[2:], owner[1:-1]
    middle = codes[1:-1] > 0
    grams, owner = grams[middle], owner[middle]
    distinct = np.count_nonzero(np.bincount(grams, minlength=CLASSES**3)) if len(grams) else 0
    step = max(1, CELLS // max(1, distinct))
    for first in range(0, len(texts), step):
        rows = min(step, len(texts) - first)
        low, high = np.searchsorted(owner, [first, first + rows])
        part = grams[low:high]
        seen = np.flatnonzero(np.bincount(part, minlength=CLASSES**3)) if len(part) else np.zeros(0, np.int64)
        place = np.zeros(CLASSES**3, np.int32)
        place[seen] = np.arange(len(seen))
        yield first, seen, np.bincount((owner[low:high] - first).astype(np.int64) * len(seen) + place[part], minlength=rows * len(seen)).reshape(rows, len(seen)).astype(np.float32)


def parts(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """The texts, long ones cut, in groups of bounded size; with the place of each in the list."""
    places: list[int] = []
    group: list[str] = []
    size = 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text)), BLOCK_LETTERS):
            part = text[max(0, at - 2) : at + BLOCK_LETTERS]
            if size + len(part) > BLOCK_LETTERS and group:
                yield places, group
                places, group, size = [], [], 0
            places.append(i)
            group.append(part)
            size += len(part)
    if group:
        yield places, group


def bundle(weights: np.ndarray, grams: np.ndarray, dimensions: int) -> np.ndarray:
    """The sum of the trigrams' vectors by their weights, for each row of weights."""
    out = np.zeros((len(weights), dimensions), weights.dtype)
    for at in range(0, len(grams), BLOCK_GRAMS):
        out += weights[:, at : at + BLOCK_GRAMS] @ vectors(grams[at : at + BLOCK_GRAMS], dimensions).astype(weights.dtype, copy=False)
    return out


def profiles(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """The bundled vectors of the texts, a row each, over their whole lengths."""
    out = np.zeros((len(texts), dimensions), np.float32)
    for places, group in parts(texts):
        for first, seen, table in counts(group):
            if len(seen):
                np.add.at(out, places[first : first + len(table)], bundle(table, seen, dimensions))
    return out


def train(df: DataFrame, text: str, lang: str, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The prototype of each language in ``lang``, from all rows with a text and a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def made() -> Iterator[pa.RecordBatch]:
            for name, total in sums.items():
                seen = np.flatnonzero(total)
                vector = bundle(total[None, seen].astype(np.float64), seen, dimensions)[0]
                yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(np.arange(dimensions, dtype=np.int32)), pa.array(vector)], names=["lang", "d", "v"])
            sums.clear()

        for batch in slices(batches, BLOCK_ROWS):
            texts, names = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for name in dict.fromkeys(names):
                if name not in sums and len(sums) >= HELD_LANGUAGES:
                    yield from made()
                total = sums.setdefault(name, np.zeros(CLASSES**3, np.int64))
                for _, group in parts([t for t, x in zip(texts, names) if x == name]):
                    for _, seen, table in counts(group):
                        total[seen] += table.sum(axis=0, dtype=np.float64).astype(np.int64)
        yield from made()

    source = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(text).cast("string"), F.col(lang).cast("string"))
    summed = source.mapInArrow(run, "lang string, d int, v double").groupBy("lang", "d").agg(F.sum("v").alias("v"))
    model: dict[str, np.ndarray] = {}
    for row in summed.collect():  # languages x dimensions
        model.setdefault(row.lang, np.zeros(dimensions))[row.d] = row.v
    return {name: v / n for name, v in sorted(model.items()) if (n := np.linalg.norm(v))}


def predict(df: DataFrame, text: str, model: dict[str, np.ndarray], lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Adds the language and the cosine (0 where negative); columns of these names that ``df`` has are replaced."""
    names = sorted(model)
    table = np.array([model[x] for x in names], np.float32) if names else np.zeros((0, DIMENSIONS), np.float32)
    out = df.drop(lang_pred, score)
    at = field_at(out, text)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema] + [f"`{lang_pred}` string", f"`{score}` double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, BLOCK_ROWS):
            texts = [t or "" for t in batch.column(at).to_pylist()]
            best, top = [UND] * len(texts), np.zeros(len(texts))
            if names and texts:
                made = profiles(texts, table.shape[1])
                norm = np.linalg.norm(made, axis=1)
                cosine = made @ table.T / np.maximum(norm, 1e-9)[:, None]
                which = cosine.argmax(axis=1)
                for i in np.flatnonzero(norm > 0):
                    best[i], top[i] = names[which[i]], min(1.0, max(0.0, float(cosine[i, which[i]])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string()), pa.array(top)], names=[*batch.schema.names, lang_pred, score])

    return out.mapInArrow(run, schema)


def plausible(df: DataFrame, text: str, model: dict[str, np.ndarray]) -> DataFrame:
    """The rows of ``df`` whose text is like the language that it is predicted to be in: texts without letters go, those with a
    cosine below OUTER_COSINE, and those below the band of the rows of that language and length (see ``bands``; a length class
    is a power of two of characters). The predicted rows are stored, as the bands depend on all of them."""
    names = {c: f"_in_{i}" for i, c in enumerate(df.columns)}
    rows = predict(df.toDF(*names.values()), f"_in_{field_at(df, text)}", model, "_lang", "_score")
    size = F.floor(F.log2(F.greatest(F.length(f"_in_{field_at(df, text)}"), F.lit(1)))).cast("int")
    rows = stored(rows.withColumn("_length", F.coalesce(size, F.lit(0))), "predicted")
    found = F.col("_lang") != UND
    banded = with_bands(rows, [["_lang", "_length"], ["_lang"]], ["_score"], fit_on=found)
    fine = found & (F.col("_score") >= OUTER_COSINE) & (F.col("_score") >= F.coalesce("_score_low", F.lit(0.0)))
    return banded.where(fine).select(*names.values()).toDF(*names)


def held_out(doc: str) -> Column:
    """Whether crc32(id as text) mod 3 is 1: such rows are never learned from."""
    return F.coalesce(F.crc32(F.col(doc).cast("string").cast("binary")) % 3 == 1, F.lit(False))
