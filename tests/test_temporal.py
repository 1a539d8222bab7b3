"""Joins by time against plain versions."""

import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from skyledger.operators.temporal import asof_join, interval_join
from skyledger.plans import queries


@pytest.mark.parametrize("keys, parts", [(1, 8), (40, 8), (3, 1)])
def test_asof_equals_a_plain_join(spark, keys, parts):
    """One key over all ranges, and many; ties, equal times, keys of one side alone, and nulls."""
    draw = random.Random(keys)
    key = lambda: None if draw.random() < 0.05 else f"k{draw.randrange(keys)}"
    time = lambda: None if draw.random() < 0.05 else draw.randrange(200)
    left = [(i, key(), time()) for i in range(400)] + [(400, "left only", 5)]
    right = [(i, key(), time(), i * 1.5) for i in range(300)] + [(300, "right only", 5, 0.0)]
    l, r = spark.createDataFrame(left, "id long, k string, t int"), spark.createDataFrame(right, "id long, who string, at int, v double")  # noqa: E741
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = {x.id: (x.right_id, x.right_v) for x in asof_join(l.repartition(3), r.repartition(3), ("k", "who"), ("t", "at"), ("id",)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = {}
    for i, k, t in left:
        match = max(((at, j, v) for j, who, at, v in right if None not in (k, t, at) and who == k and at <= t), default=(0, None, None))
        want[i] = match[1:]
    assert found == want


def test_intervals_equal_a_plain_join(spark):
    draw = random.Random(3)
    span = lambda: (draw.randrange(-50, 300), draw.randrange(0, 60))
    left, right = ([(i, draw.choice("ab"), low, None if i == 3 else low + n - (5 if i % 9 == 0 else 0)) for i, (low, n) in enumerate(span() for _ in range(80))] for _ in range(2))
    l = spark.createDataFrame(left, "i long, k string, a int, b int")  # noqa: E741
    r = spark.createDataFrame(right, "j long, k string, c int, d int")
    made = interval_join(l, r, ["k"], (F.col("a"), F.col("b")), (F.col("c"), F.col("d")), 16)
    inside = lambda rows: [x for x in rows if x[3] is not None and x[2] <= x[3]]
    want = sorted((x[0], y[0]) for x in inside(left) for y in inside(right) if x[1] == y[1] and max(x[2], y[2]) <= min(x[3], y[3]))
    assert sorted((x.i, x.j) for x in made.collect()) == want and len(want) > 100
    assert "NestedLoop" not in made._jdf.queryExecution().executedPlan().toString()


def test_event_moments_are_the_nearest_second(spark, tmp_path):
    """An order's span is 1 to 21,601 s on the first user's day: events half a second around either end, as the SQL rounds them."""
    moments = [0.499999, 0.5, 0.500001, 1.5, 7200.0, 21600.5, 21601.499999, 21601.5, 21602.5]
    con = duckdb.connect()
    con.execute("CREATE TABLE orders AS SELECT (SELECT min(k) FROM range(7, 2592000 * 7, 7) r(k) WHERE (k * 7919) % 2592000 = 1) AS o_orderkey, 150 AS o_custkey")
    con.execute("CREATE TABLE events (event_id BIGINT, user_id BIGINT, ts TIMESTAMP)")
    con.executemany("INSERT INTO events VALUES (?, 0, ?)", [(i, datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)) for i, s in enumerate(moments)])
    found = set()
    for i in range(len(moments)):  # each alone, as only the last one of an order comes out
        folder = tmp_path / str(i)
        folder.mkdir()
        con.execute(f"COPY orders TO '{folder}/orders.parquet'")
        con.execute(f"COPY (SELECT * FROM events WHERE event_id = {i}) TO '{folder}/events.parquet'")
        want = con.execute(queries.ORACLES["interval_events"].replace("FROM events", f"FROM events WHERE event_id = {i}")).fetchall()
        assert sorted(map(tuple, queries.interval_events(spark, str(folder)).collect())) == want, moments[i]
        found |= {i for _ in want}
    assert found == {2, 3, 4, 5, 6}
