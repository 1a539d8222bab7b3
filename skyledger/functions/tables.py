"""Table functions for SQL.

    SELECT * FROM score_archive(TABLE(rows) PARTITION BY (year, month, prefix) ORDER BY (symbol, date), 'model.json')

scores observations with the model that a path names: ``rows`` has year, month, prefix, symbol, date and x, and may have more
columns, which don't come out. Each partition is a call of its own, so ``row`` is the place among its rows with finite outputs, as
in a run; without PARTITION BY nothing is exchanged, and the places are those within a task. A row without a finite output comes
out without a place and outputs, with the reason in ``refused``. Rows without observations have no place, outputs or reason. An
empty table gives none.

A partition's rows come in Arrow batches and go out with each of them, so a large partition needs no more memory than a small
one. With PARTITION BY the rows are exchanged whole; ``plans.run`` scores an archive without that.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf

from skyledger.functions.values import number_text
from skyledger.operators.network import Predictor, load_creature
from skyledger.sources.files import file_system

#: Columns of a result; what a table must have.
SCORED = "year int, month int, prefix string, row long, symbol string, date date, y array<double>, refused string"
NEEDED = ("year", "month", "prefix", "symbol", "date", "x")


@lru_cache(maxsize=4)
def _compiled(path: str, changed: object, size: int, width: int) -> Predictor:
    return Predictor(load_creature(path), width)


def _model(path: str, width: int) -> Predictor:
    """The compiled model; a worker keeps it as long as the file stays what it was."""
    fs, at = file_system(path)
    info = fs.get_file_info(at)
    return _compiled(path, info.mtime_ns, info.size, width)


class ScoreArchive:
    def __init__(self):
        self.row, self.model = 0, None

    def eval(self, rows: pa.RecordBatch, model: pa.Array) -> Iterator[pa.Table]:
        get = {n: rows.column(i) for i, n in enumerate(rows.schema.names) if n in NEEDED}
        if lacking := [c for c in NEEDED if c not in get]:
            raise ValueError(f"the table of score_archive lacks {', '.join(lacking)}")
        x, n = get["x"], rows.num_rows
        there = np.asarray(x.is_valid())
        widths = np.asarray(x.value_lengths().drop_null())
        fine, reasons = np.zeros(n, bool), [None] * n
        y = np.empty((0, 1), np.float32)
        if len(widths):
            if self.model is None:
                self.model = _model(model[0].as_py(), int(widths[0]))
            if (widths != self.model.stride).any():
                raise ValueError(f"rows of {self.model.stride} and of {int(widths[widths != self.model.stride][0])} values")
            made = self.model.predict(x.flatten().to_numpy(zero_copy_only=False)).reshape(-1, self.model.output_count)
            finite = np.isfinite(made).all(axis=1)
            fine[there], y = finite, made[finite]
            for at, bad in zip(np.flatnonzero(there)[~finite].tolist(), made[~finite]):
                reasons[at] = f"non-finite output {number_text(float(bad[~np.isfinite(bad)][0]))}"
        place = self.row + np.cumsum(fine) - 1
        self.row += int(fine.sum())
        offsets = np.concatenate([[0], np.cumsum(fine * y.shape[1])]).astype(np.int32)
        outputs = pa.ListArray.from_arrays(pa.array(offsets), pa.array(y.astype(np.float64).reshape(-1)), mask=pa.array(~fine))
        held = {c: get[c] for c in NEEDED if c != "x"} | {"row": pa.array(place, pa.int64(), mask=~fine), "y": outputs, "refused": pa.array(reasons, pa.string())}
        yield pa.table({c.split()[0]: held[c.split()[0]] for c in SCORED.split(", ")})


def register_tables(spark: SparkSession) -> None:
    spark.udtf.register("score_archive", arrow_udtf(ScoreArchive, returnType=SCORED))
