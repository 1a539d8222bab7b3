"""The same functions as columns, evaluated by Spark itself.

Patterns end in ``\\z``: ``$`` would also match before a last line break.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.values import MAX_DATASET_ID_BYTES, WHITE_SPACE

_SPACE = "".join(f"\\x{{{ord(c):X}}}" for c in WHITE_SPACE)


def prefix_for_symbol(symbol: Column) -> Column:
    # The character is tested as it stands: some others have an ASCII upper case.
    return F.when(symbol.rlike(r"\A[0-9A-Za-z]"), F.upper(F.substring(symbol, 1, 1))).otherwise("_")


def is_valid_dataset_id(text: Column) -> Column:
    return text.rlike(rf"\A[A-Za-z0-9._-]{{1,{MAX_DATASET_ID_BYTES}}}\z") & ~text.isin(".", "..")


def is_safe_relative_path(text: Column) -> Column:
    return ~F.contains(text, F.lit("\\")) & ~F.exists(F.split(text, "/", -1), lambda s: s.isin("", ".", ".."))


def is_canonical_symbol(symbol: Column) -> Column:
    return (symbol != "") & ~symbol.rlike(rf"\A[{_SPACE}]") & ~symbol.rlike(rf"[{_SPACE}]\z")


def has_date_shape(text: Column) -> Column:
    return text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z")


def parse_date(text: Column) -> Column:
    """The date of an exact ``YYYY-MM-DD`` that is a calendar day, else null."""
    return F.when(has_date_shape(text), text.try_cast("date"))


def date_fault(text: Column) -> Column:
    """``format``, ``range``, or null for a date."""
    return F.when(~has_date_shape(text), "format").when(text.try_cast("date").isNull(), "range")


def format_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def days_in_month(date: Column) -> Column:
    return F.day(F.last_day(date))


def make_date(year: Column, month: Column, day: Column) -> Column:
    """Null for a day that does not exist."""
    return F.format_string("%04d-%02d-%02d", year, month, day).try_cast("date")


def partition_id(year: Column, month: Column, prefix: Column) -> Column:
    return F.format_string("%04d/%02d/%s", year, month, prefix)


def creature_uuid(sha256: Column) -> Column:
    return F.concat(F.lit("sha256:"), sha256)


def identity_key(creature: Column, inputs: Column, outputs: Column, extension: Column, features: Column, dataset: Column, engine: Column, version: Column) -> Column:
    """The digest that all predictions of one model, snapshot and engine share."""
    named = [("creature", creature), ("inputs", inputs), ("outputs", outputs), ("extension", extension), ("features", features), ("width", inputs), ("dataset", dataset), ("engine", engine), ("engineVersion", version)]
    text = F.concat_ws("|", F.lit("retrospective_fixed_model"), *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in named])
    return F.substring(F.sha2(text, 256), 1, 32)


def format_utc(seconds: Column) -> Column:
    """For sessions in UTC."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def is_finite(value: Column) -> Column:
    return ~F.isnan(value) & (F.abs(value) != float("inf"))


def all_finite(values: Column) -> Column:
    return F.forall(values, is_finite)


def widen(values: Column) -> Column:
    """Single to double precision, exactly."""
    return values.cast("array<double>")


def first_inputs(values: Column, count: int) -> Column:
    return F.slice(values, 1, count)


def date_range(date: Column, first: str | None = None, last: str | None = None) -> Column:
    """Inclusive; either side may be open."""
    found = F.lit(True)
    if first is not None:
        found = found & (date >= F.lit(first).cast("date"))
    if last is not None:
        found = found & (date <= F.lit(last).cast("date"))
    return found
