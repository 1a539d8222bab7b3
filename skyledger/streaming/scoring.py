"""Structured Streaming forms of the batch operators.

Scoring has no state, so a stream takes the same Arrow stage as a batch. Resolution keeps, for each key, the last listing
seen within a watermark: a later listing of a key comes out as an update that replaces the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.operators.network import Predictor, score
from skyledger.operators.resolve import KEY


def score_stream(rows: DataFrame, predictor: Predictor, inputs: str = "x", outputs: str = "y") -> DataFrame:
    """Outputs of the rows of each micro-batch; nothing is shuffled."""
    return score(rows, predictor, inputs, outputs)


def latest_rows_stream(listings: DataFrame, order: list[str], time: str, delay: str, window: str, key: tuple[str, ...] = KEY) -> DataFrame:
    """The last listing of each key in each window of event time, for output mode ``update`` or ``append``. State of a window
    goes once the watermark passes it, so it is bounded by the keys of ``delay`` and ``window``."""
    rest = [c for c in listings.columns if c not in (*key, time)]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_last")
    grouped = listings.withWatermark(time, delay).groupBy(F.window(time, window).alias("window"), *key)
    return grouped.agg(last).select("window", *key, *[F.col("_last")[c].alias(c) for c in rest])
