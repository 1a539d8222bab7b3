"""Table functions, and sketches kept beside a run."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators import sketches
from skyledger.plans.run import PredictRequest, register, run
from skyledger.sources.predictions import OutputError
from tests.archives import MODEL, Fixture, drawn, expected, model_file, plain

CALL = "SELECT * FROM score_archive(TABLE({rows}) PARTITION BY (year, month, prefix) ORDER BY (symbol, date), {model})"
COLUMNS = "year int, month int, prefix string, symbol string, date date, x array<float>"


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    b = Fixture(folder / "archive", 4)
    publications = drawn(33, 2, 120, 4)
    for k, rows in enumerate(publications):
        b.add(f"d{k}", rows)
    request = PredictRequest(model_file(folder), str(b.root), str(folder / "run"))
    run(spark, request)
    return request, plain(publications)[0]


def test_a_statement_scores_an_archive_like_a_run(spark, published, monkeypatch):
    request, want = published
    register(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)  # a partition comes in several batches
    try:
        made = spark.sql(CALL, rows=spark.read.format("observations").load(request.archive), model=request.creature)
        found = sorted(map(tuple, made.drop("refused").collect()), key=lambda r: (*r[:2], r[2].encode(), r[3]))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ran = sorted(map(tuple, spark.read.format("predictions").load(request.output).select("year", "month", "prefix", "row", "symbol", "date", "y").collect()), key=lambda r: (*r[:2], r[2].encode(), r[3]))
    assert found == ran and [(*r[:5], str(r[5])) for r in found] == [w[:6] for w in want]
    assert np.allclose([r[6] for r in found], [expected(w[6]) for w in want], atol=1e-5)


def test_rows_that_have_no_outputs(spark, tmp_path):
    """A refused row takes no place, nor does one without observations; other columns stay behind."""
    register(spark)
    day = "2019-01-0"
    held = [("a", day + "1", [1, 2, 3, 4]), ("b", day + "2", [3e38, 0, 0, 3e38]), ("c", day + "3", None), ("d", day + "4", [4, 3, 2, 1])]
    rows = spark.createDataFrame([(2019, 1, "A", s, d, x) for s, d, x in [(s, d, x and [float(v) for v in x]) for s, d, x in held]], "year int, month int, prefix string, symbol string, date string, x array<float>")
    rows = rows.withColumn("date", F.col("date").cast("date")).withColumns({"y": F.lit("other"), "row": F.lit(-1)})
    hot = json.loads(json.dumps(MODEL))
    hot["synapses"][-1]["weight"] = 10.0  # the second output of b is beyond single precision
    made = {r.symbol: r for r in spark.sql(CALL, rows=rows, model=model_file(tmp_path, hot)).collect()}
    assert {s: r.row for s, r in made.items()} == {"a": 0, "b": None, "c": None, "d": 1}
    assert made["b"].y is None and made["b"].refused == "non-finite output inf" and (made["c"].y, made["c"].refused) == (None, None)
    assert len(made["a"].y) == 2 and made["a"].refused is None
    assert spark.sql(CALL, rows=rows.where("false"), model=model_file(tmp_path, hot)).count() == 0
    before = made["a"].y
    hot["neurons"][-1]["bias"] += 1.0
    (tmp_path / "model.json").write_text(json.dumps(hot))  # a worker that knows the file sees that it changed
    after = {r.symbol: r for r in spark.sql(CALL, rows=rows, model=str(tmp_path / "model.json")).collect()}["a"].y
    assert after[1] == pytest.approx(before[1] + 1) and after[0] == before[0]


def test_what_the_table_function_refuses(spark, tmp_path):
    register(spark)
    rows = spark.createDataFrame([(2019, 1, "A", "a", None, [1.0, 2.0, 3.0, 4.0]), (2019, 1, "A", "b", None, [1.0, 2.0, 3.0, 4.0, 5.0])], COLUMNS)
    with pytest.raises(Exception, match="rows of 4 and of 5 values"):
        spark.sql(CALL, rows=rows.coalesce(1), model=model_file(tmp_path)).collect()
    with pytest.raises(Exception, match="lacks x"):
        spark.sql(CALL, rows=rows.drop("x"), model=model_file(tmp_path)).collect()
    with pytest.raises(Exception, match="reads 4 values a row, more than the 2"):
        spark.sql(CALL, rows=rows.withColumn("x", F.slice("x", 1, 2)), model=model_file(tmp_path)).collect()


def test_sketches_of_a_run_are_kept_and_not_made_twice(spark, published, monkeypatch):
    request, want = published
    y = np.array([expected(w[6]) for w in want])
    kept = sketches.keep_sketches(spark, request.output)
    assert kept.count() == 2 * len({w[:3] for w in want})
    monkeypatch.setattr(sketches, "partition_sketches", lambda predictions: pytest.fail("the payloads are read again"))
    again = sketches.merged(sketches.keep_sketches(spark, request.output), "output", quantiles=(0.0, 0.5, 1.0)).orderBy("output").collect()
    for k, r in enumerate(again):
        assert (r.output, r.n_rows) == (k, len(want)) and abs(r.n_symbols - len({w[4] for w in want})) <= 1
        assert np.allclose([r.least, r.most, r.mean], [y[:, k].min(), y[:, k].max(), y[:, k].mean()], atol=1e-5)
        assert np.allclose([r.quantiles[0], r.quantiles[2]], [r.least, r.most]) and abs((y[:, k] <= r.quantiles[1] + 1e-5).mean() - 0.5) <= 0.02
    assert spark.read.format("predictions").load(request.output).count() == len(want)  # sketches are in nobody's way
    with pytest.raises(OutputError, match="no finished run"):
        sketches.keep_sketches(spark, request.archive + "/none")


def test_merged_sketches_keep_their_errors(spark):
    """60,000 rows in 30 partitions of very different sizes and values, a third of them in one."""
    draw = random.Random(5)
    sizes = [20_000, *([1] * 9), *[draw.randrange(500, 3500) for _ in range(20)]]
    parts = spark.createDataFrame([(k, n) for k, n in enumerate(sizes)], "k int, n int")
    rows = parts.select("k", F.explode(F.sequence(F.lit(1), "n")).alias("i"))
    value = (F.pmod(F.xxhash64("k", "i"), F.lit(10**6)) / 1e6 * (F.col("k") % 7 + 1)).alias("v")
    rows = rows.select(F.lit(2020).alias("year"), (F.col("k") % 12 + 1).alias("month"), F.col("k").cast("string").alias("prefix"), F.concat("k", F.lit("-"), (F.col("i") % 900).cast("string")).alias("symbol"), value)
    rows = rows.select("year", "month", "prefix", "symbol", F.array("v", F.lit(float("nan")), F.lit(None).cast("double")).alias("y")).cache()
    quantiles = (0.01, 0.25, 0.5, 0.9, 0.999)
    (r,) = sketches.merged(sketches.partition_sketches(rows), "output", quantiles=quantiles).collect()
    values = np.sort([x.v for x in rows.select(F.col("y")[0].alias("v")).collect()])
    assert (r.output, r.n_rows, r.least, r.most) == (0, len(values), values[0], values[-1])
    for q, found in zip(quantiles, r.quantiles):
        assert abs(np.searchsorted(values, found, side="right") / len(values) - q) <= 2 * sketches.RANK_ERROR
    exact = rows.select("symbol").distinct().count()
    assert abs(r.n_symbols - exact) <= 2 * sketches.DISTINCT_ERROR * exact
    assert sketches.merged(sketches.partition_sketches(rows.where("false")), "output").count() == 0
    rows.unpersist()
