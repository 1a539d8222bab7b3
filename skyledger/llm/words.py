"""A bounded memory of encoded words, which tokenisers that never merge across words share."""

from __future__ import annotations

import itertools
from array import array
from collections.abc import Callable, Iterable
from typing import ClassVar

#: Words remembered in each Python worker; beyond this the memory starts anew.
CACHE_WORDS = 300_000
#: New words encoded at a time.
BLOCK_WORDS = 100_000


class _Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


class WordMemory:
    """Encodes lists of words; each distinct word goes to ``encode`` once, as long as it is remembered.

    A text is held as the numbers of its words, so that its many strings need not live together. Only the memory that was
    used last, and those that it is used ``beside``, keep their words: a worker that goes on to another tokeniser does not hold both.
    """

    _last: ClassVar[list[WordMemory]] = []

    def __init__(self, encode: Callable[[list[str]], list[bytes]], most: int = CACHE_WORDS, beside: WordMemory | None = None):
        self.encode, self.most = encode, most
        self.team = beside.team if beside else []
        self.team.append(self)
        self.forget()

    def forget(self) -> None:
        self.number, self.coded = _Numbers(), []

    def __call__(self, texts: Iterable[list[str]]) -> list[bytes]:
        if WordMemory._last is not self.team:
            for other in WordMemory._last:
                other.forget()
            WordMemory._last = self.team
        get, held = self.number.__getitem__, []
        for words in texts:
            held.append(array("I", map(get, words)))
            if len(self.number) - len(self.coded) > BLOCK_WORDS:
                self._catch_up()
        self._catch_up()
        found = [b"".join(map(self.coded.__getitem__, numbers)) for numbers in held]
        if len(self.number) > self.most:
            self.forget()
        return found

    def _catch_up(self) -> None:
        while new := list(itertools.islice(self.number, len(self.coded), len(self.coded) + BLOCK_WORDS)):
            self.coded += self.encode(new)


def as_bytes(ids: list[list[int]], size: int = 4) -> list[bytes]:
    """Each list as little-endian unsigned integers of ``size`` bytes."""
    flat = array({2: "H", 4: "I"}[size], itertools.chain.from_iterable(ids)).tobytes()
    ends = [0, *itertools.accumulate(map(len, ids))]
    return [flat[size * a : size * b] for a, b in zip(ends, ends[1:])]
