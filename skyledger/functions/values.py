"""Dates, ids, hashes and error texts on the driver."""

from __future__ import annotations

import calendar
import hashlib
import re
from datetime import UTC, datetime
from typing import NamedTuple

MAX_DATASET_ID_BYTES = 128
_DATE = re.compile(r"([0-9]{4})-([0-9]{2})-([0-9]{2})", re.ASCII)
_DATASET_ID = re.compile(rf"[A-Za-z0-9._-]{{1,{MAX_DATASET_ID_BYTES}}}", re.ASCII)
#: The code points of Unicode's White_Space property.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


class DateError(ValueError):
    """A text that is no market date; ``kind`` is ``format`` or ``range``."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


def days_in_month(year: int, month: int) -> int:
    """0 for a month that does not exist; the Gregorian rule holds for all years, 0 too."""
    if not 1 <= month <= 12:
        return 0
    return 29 if month == 2 and year % 4 == 0 and (year % 100 != 0 or year % 400 == 0) else calendar.mdays[month]


class MarketDate(NamedTuple):
    """A UTC calendar day, from year 0 on; ordered by time."""

    year: int
    month: int
    day: int

    @classmethod
    def of(cls, year: int, month: int, day: int) -> MarketDate:
        if not 1 <= day <= days_in_month(year, month):
            raise DateError("range", f"there is no day {year:04}-{month:02}-{day:02}")
        return cls(year, month, day)

    @classmethod
    def parse(cls, text: str) -> MarketDate:
        """Exactly ``YYYY-MM-DD``."""
        found = _DATE.fullmatch(text)
        if not found:
            raise DateError("format", f"a date must read YYYY-MM-DD, not '{text}'")
        return cls.of(*map(int, found.groups()))

    def __str__(self) -> str:
        return f"{self.year:04}-{self.month:02}-{self.day:02}"

    def epoch_days(self) -> int:
        """Days since 1970-01-01, also for years that ``datetime`` lacks."""
        shift = 0 if self.year else 1  # the calendar repeats after 400 years of 146,097 days
        return datetime(self.year + 400 * shift, self.month, self.day).toordinal() - datetime(1970, 1, 1).toordinal() - 146_097 * shift

    @classmethod
    def from_epoch_days(cls, days: int) -> MarketDate:
        ordinal = days + datetime(1970, 1, 1).toordinal()
        shift = 0 if ordinal > 0 else 1
        at = datetime.fromordinal(ordinal + 146_097 * shift)
        return cls(at.year - 400 * shift, at.month, at.day)


def is_valid_dataset_id(text: str) -> bool:
    """Letters, digits, ``.``, ``_`` and ``-``, so that it can be a file name; never ``.`` or ``..``."""
    return text not in (".", "..") and _DATASET_ID.fullmatch(text) is not None


def is_safe_relative_path(text: str) -> bool:
    """Whether every segment names something below the folder it is relative to."""
    return "\\" not in text and not {"", ".", ".."} & set(text.split("/"))


def prefix_for_symbol(symbol: str) -> str:
    """The partition letter: the first character in upper case if it is an ASCII letter or digit, else ``_``."""
    first = symbol[:1]
    return first.upper() if first.isascii() and first.isalnum() else "_"


def is_canonical_symbol(symbol: str) -> bool:
    return bool(symbol) and symbol.strip(WHITE_SPACE) == symbol


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def format_utc(seconds: int) -> str:
    """``YYYY-MM-DDTHH:MM:SSZ`` of seconds since 1970."""
    return datetime.fromtimestamp(seconds, UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def utc_now() -> str:
    return format_utc(int(datetime.now(UTC).timestamp()))


def number_text(value: float) -> str:
    """A non-finite number as messages and manifests write it."""
    return "NaN" if value != value else "inf" if value > 0 else "-inf"
