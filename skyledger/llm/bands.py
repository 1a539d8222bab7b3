"""Bands of plausible values, fitted to all rows of a table.

A measure's band within a group is its median, and ``WIDTH`` times the distance of its quartiles to either side; up to a
quarter of junk on a side leaves it where it is. Groups are tried from the finest to the coarsest: the first that holds
enough rows, LEAST_ROWS and a thousandth of the table, gives the band. So a level has at most a thousand groups, whatever
the table holds, and its bands may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_ROWS, MOST_GROUPS, WIDTH = 50, 1000, 4.0
#: Least distance of the quartiles, as a share of the median: a group of equal rows still has a band.
LEAST_SPREAD = 0.02


def with_bands(rows: DataFrame, levels: list[list[str]], measures: list[str], width: float = WIDTH, fit_on: Column | None = None) -> DataFrame:
    """Adds ``<measure>_low`` and ``<measure>_high``, null where no level has enough rows. ``rows`` should be stored, as every
    level reads it; ``fit_on``: rows that bands are fitted to, all by default. One small shuffle of partial aggregates a level."""
    source = rows if fit_on is None else rows.where(fit_on)
    least = max(LEAST_ROWS, -(-source.count() // MOST_GROUPS))
    out, names = rows, []
    for i, level in enumerate(levels):
        quartiles = [F.percentile_approx(m, [0.25, 0.5, 0.75], 10_000).alias(f"_q_{m}") for m in measures]
        known = source.groupBy(*level).agg(F.count("*").alias("_n"), *quartiles).where(F.col("_n") >= least)

        def edges(m: str, i: int = i) -> list[Column]:
            low, middle, high = (F.col(f"_q_{m}")[k] for k in range(3))
            spread = F.greatest(high - low, F.abs(middle) * LEAST_SPREAD) * width
            return [(middle - spread).alias(f"_{m}_low_{i}"), (middle + spread).alias(f"_{m}_high_{i}")]

        keys = [F.col(c).alias(f"_k_{c}") for c in level]
        table = F.broadcast(known.select(*keys, *[e for m in measures for e in edges(m)]))
        on = [out[c].eqNullSafe(F.col(f"_k_{c}")) for c in level]
        for k, c in enumerate(on[1:], 1):
            on[0] = on[0] & c
        out = out.join(table, on[0], "left").drop(*[f"_k_{c}" for c in level])
    for m in measures:
        for side in ("low", "high"):
            names.append(F.coalesce(*[F.col(f"_{m}_{side}_{i}") for i in range(len(levels))]).alias(f"{m}_{side}"))
    return out.select(*rows.columns, *names)
