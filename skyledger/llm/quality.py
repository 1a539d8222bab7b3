"""Quality rules by tokeniser fertility.

Base counts of a text (words, symbols, repeated lines and windows) come with measures under two public vocabularies, one that
falls back to bytes and one made for many languages: characters a token under each, their ratio, the share of tokens that are
bytes, and the entropy of the tokens as a share of the most that so many tokens can have.

A text must lie within the outer bands of its script (``SCRIPTS``: what the vocabularies allow at all), and within bands that
are fitted to all rows of the table, for its language and length: see ``bands``. Languages are those of the ``lang`` column
that hold a thousandth of the rows; other rows go by the script of most of their letters. Lengths are powers of two of tokens,
so short texts, whose measures vary more, have wider bands of their own. In a table too small to fit any band the outer ones
decide alone.

Null and empty texts have no words: they fail the base rules. Texts are measured whole, row by row; repeated rows count each.
"""

from __future__ import annotations

import base64
import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.bands import with_bands
from skyledger.llm.common import field_at, slices, stored
from skyledger.llm.words import WordMemory, as_bytes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
BLOCK_ROWS = 128
#: Words remembered within a task; a worker that goes on to other stages keeps none.
TASK_WORDS = 150_000
#: Outer bands of each script: least and most characters a token under either vocabulary, largest share of byte tokens. A letter
#: beyond the vocabulary costs a token for each of its bytes in UTF-8, so even the rarest script has 1/4 of a character a token.
SCRIPTS: dict[str, tuple[float, float, float]] = {
    "Latin": (1.2, 8.0, 0.25),
    "Cyrillic": (0.8, 8.0, 0.25),
    "Greek": (0.4, 8.0, 0.6),
    "CJK": (0.3, 3.0, 0.9),
    "other": (0.25, 8.0, 0.9),  # scripts of which the vocabularies know next to no letter are out
    "none": (0.5, 8.0, 0.25),
}
#: Measures with fitted bands.
FITTED = ["chars_per_token", "chars_per_token_multi", "fertility_ratio", "relative_entropy"]
#: Set on the value that follows a word's tokens: how many tokens the second vocabulary has for it.
_MARK = 1 << 31


@lru_cache(maxsize=2)
def _pieces(path: str):
    """The vocabulary, and by id whether a piece stands for one byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, np.array([model.is_byte(i) for i in range(model.get_piece_size())])


@lru_cache(maxsize=2)
def _multi(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as found:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, found)}
    return tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=2)
def _memory(path: str, multi: str) -> WordMemory:
    def encode(words: list[str]) -> list[bytes]:
        out: list[bytes] = []
        count = _multi(multi).encode_ordinary
        for at in range(0, len(words), 10_000):
            part = words[at : at + 10_000]
            pieces = _pieces(path)[0].encode(part, num_threads=1)
            for ids, word in zip(pieces, part):
                ids.append(_MARK | len(count(" " + word)))
            out += as_bytes(pieces)
        return out

    return WordMemory(encode, TASK_WORDS)


def token_ids(texts: Iterable[list[str]], path: str, multi: str) -> list[tuple[np.ndarray, int]]:
    """Ids under the first vocabulary, and how many tokens the second has, of each list of words, a word at a time."""
    held = [np.frombuffer(x, "<u4") for x in _memory(path, multi)(texts)]
    return [(x[x < _MARK], int((x[x >= _MARK] - np.uint32(_MARK)).sum(dtype=np.int64))) for x in held]


def script(text: str) -> str:
    """The script of most letters of the text, ``none`` without letters."""
    count: dict[str, int] = {}
    for letter, n in ((c, text.count(c)) for c in set(text)):
        if letter.isalpha():
            name = unicodedata.name(letter, "").split(" ")[0]
            kind = {"LATIN": "Latin", "CYRILLIC": "Cyrillic", "GREEK": "Greek", "CJK": "CJK", "HIRAGANA": "CJK", "KATAKANA": "CJK", "HANGUL": "CJK"}.get(name, "other")
            count[kind] = count.get(kind, 0) + n
    return max(sorted(count), key=count.get, default="none")


def repeated_words(words: list[str], window: int = WINDOW) -> int:
    """How many words lie in windows that the text has twice or more; windows are compared as numbers of distinct words."""
    if len(words) <= window:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    if len(number) < 1 << 7:  # eight such numbers fit one integer exactly
        keys = np.zeros(len(words) - window + 1, np.int64)
        for j in range(window):
            keys = keys << (63 // window) | ids[j : len(words) - window + 1 + j]
    else:  # exact as well: pairs of numbers become one number, three times over for eight words
        keys, span = ids, 1
        while span < window:
            _, keys = np.unique(keys[: len(keys) - span] * (len(words) + 1) + keys[span:], return_inverse=True)
            span *= 2
    _, at, n = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(n[at] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge)[:-1] > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(lines) - len(set(lines))


def measure(texts: list[str | None], vocabulary: str, multi: str) -> dict[str, list]:
    """All measures of the texts."""
    blocks = [WORD.findall(t or "") for t in texts]
    _, is_byte = _pieces(vocabulary)
    out: dict[str, list] = {k: [] for k in COLUMNS}
    for text, words, (ids, n_multi) in zip(texts, blocks, token_ids(blocks, vocabulary, multi)):
        text = text or ""
        n, repeated, chars = len(words), repeated_words(words), sum(map(len, words))
        failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n
        _, each = np.unique(ids, return_counts=True)
        share = each / max(1, len(ids))
        fallback, entropy = float(is_byte[ids].mean()) if len(ids) else 0.0, float(-(share * np.log2(share)).sum()) if len(ids) else 0.0
        most = math.log2(max(2, len(ids)))
        row = (n, chars, len(SYMBOL.findall(text)), duplicate_lines(text), repeated, failed, len(ids), chars / max(1, len(ids)), chars / max(1, n_multi), n_multi / max(1, len(ids)), fallback, entropy / most, script(text), int(most))
        for k, v in zip(COLUMNS, row):
            out[k].append(v)
    return out


#: Columns that ``measured`` adds; ``rules`` adds ``kept`` and the edges of the bands as well.
COLUMNS = {
    "n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long", "base_failed": "boolean", "n_tokens": "long", "chars_per_token": "double",
    "chars_per_token_multi": "double", "fertility_ratio": "double", "byte_share": "double", "relative_entropy": "double", "script": "string", "length_class": "int",
}
EDGES = [f"{m}_{side}" for m in FITTED for side in ("low", "high")]
_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string()}


def measured(df: DataFrame, text: str, vocabulary: str, multi: str) -> DataFrame:
    """Adds COLUMNS to every row (columns of these names that ``df`` has are replaced). One Arrow stage."""
    out = df.drop(*COLUMNS, "kept", *EDGES)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema] + [f"{k} {v}" for k, v in COLUMNS.items()])
    at = field_at(out, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in slices(batches, BLOCK_ROWS):
                made = measure(batch.column(at).to_pylist(), vocabulary, multi)
                yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(made[k], _ARROW[v]) for k, v in COLUMNS.items())], names=[*batch.schema.names, *COLUMNS])
        finally:  # the words go with the task, the vocabularies stay with the worker
            _memory(vocabulary, multi).forget()

    return out.mapInArrow(run, schema)


def judged(rows: DataFrame, lang: str | None) -> DataFrame:
    """Adds ``kept`` and EDGES to measured rows, which should be stored: the bands are fitted to all that pass the base rules."""
    fine = ~F.col("base_failed")
    levels = [["script", "length_class"], ["script"]]
    if lang is not None:
        levels = [[lang, "script", "length_class"], [lang, "script"], *levels]
    low, high, most = (F.create_map(*[F.lit(x) for name, v in SCRIPTS.items() for x in (name, v[k])])[F.col("script")] for k in range(3))
    inside = fine & F.col("chars_per_token").between(low, high) & F.col("chars_per_token_multi").between(low, high) & (F.col("byte_share") <= most)
    banded = with_bands(rows, levels, FITTED, fit_on=fine)
    for m in FITTED:
        inside = inside & F.coalesce(F.col(m).between(F.col(f"{m}_low"), F.col(f"{m}_high")), F.lit(True))
    return banded.withColumn("kept", inside)


def rules(df: DataFrame, text: str, lang: str | None, vocabulary: str, multi: str, drop: tuple[str, ...] = ()) -> DataFrame:
    """Every row with its measures, the edges of its bands, and ``kept``, the verdict; columns in ``drop`` (the text, where it is
    not needed) go once the row is measured. The measured rows are stored: the bands depend on all of them."""
    return judged(stored(measured(df, text, vocabulary, multi).drop(*drop), "measured"), lang)
