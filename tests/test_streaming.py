import random
import time

import pytest
from pyspark.sql import functions as F

from skyledger.operators.network import Creature, Predictor, score
from skyledger.plans import queries
from skyledger.plans.run import register
from skyledger.sources.changes import ChangeStream
from skyledger.sources.files import ArchiveError
from skyledger.streaming import restated
from skyledger.streaming.restated import restated_rows_merged, restated_rows_stream
from skyledger.streaming.scoring import latest_rows_stream, score_stream
from tests.archives import MODEL, Fixture, drawn, plain


def test_a_stream_scores_like_a_batch(spark, tmp_path):
    rows = spark.range(40).select("id", F.array(*[(F.col("id") * k / 10).cast("float") for k in (1, 2, 3, 4)]).alias("x"))
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    predictor = Predictor(Creature("c", "", MODEL), 4)
    stream = spark.readStream.schema("id long, x array<float>").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    written = score_stream(stream, predictor).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
    query = written.trigger(availableNow=True).start(str(tmp_path / "out"))
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect()), key=lambda r: r[0]) == sorted(map(tuple, score(rows, predictor).collect()), key=lambda r: r[0])


def test_a_later_listing_replaces_an_earlier_one(spark, tmp_path):
    made = spark.createDataFrame([("A", "d", 1, 10), ("A", "d", 3, 30), ("A", "d", 2, 20), ("B", "d", 1, 1)], "symbol string, date string, seq int, v int").withColumn("ts", F.timestamp_seconds("seq"))
    made.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(made.schema).parquet(str(tmp_path / "in"))
    latest = latest_rows_stream(stream, ["seq"], "ts", "10 minutes", "1 hour")
    query = latest.writeStream.format("memory").queryName("latest").outputMode("complete").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert sorted((r.symbol, r.v) for r in spark.table("latest").collect()) == [("A", 30), ("B", 1)]


def test_the_feed_of_an_archive_goes_on_where_it_stopped(spark, tmp_path):
    """Each publication comes out once, whatever the restarts; the last of each key is the snapshot."""
    register(spark)
    b, publications = Fixture(tmp_path / "archive", 2), drawn(6, 5, 20, 2)

    def goes_on(**options):
        feed = spark.readStream.format("observation_changes").options(**options).load(str(b.root))
        written = feed.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state"))
        written.trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination(120)
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((r.publication, r.dataset, r.symbol, str(r.date), list(r.x)) for r in rows)

    want = []
    for k, rows in enumerate(publications):
        b.add(f"d{k}", rows)
        want += sorted((k, f"d{k}", s, d, v) for s, d, v in rows)
        if k in (0, 2, 3):
            assert goes_on() == want
            assert goes_on() == want  # nothing new
    assert goes_on(most=1) == want
    batch = spark.read.format("observation_changes").load(str(b.root))
    assert sorted((r.publication, r.dataset, r.symbol, str(r.date), list(r.x)) for r in batch.collect()) == want
    latest = batch.groupBy("symbol", "date").agg(F.max_by("x", "publication").alias("x")).collect()
    assert {(r.symbol, str(r.date)): list(r.x) for r in latest} == {(r[4], r[5]): r[6] for r in plain(publications)[0]}


def test_a_chain_that_was_rewritten_is_no_silent_gap(tmp_path):
    b = Fixture(tmp_path, 1)
    b.add("d0", [("A", "2019-01-01", [1])])
    b.add("d1", [("A", "2019-01-02", [2])])
    stream = ChangeStream({"path": str(b.root)})
    start, end = stream.latestOffset(), {"dataset": "d1", "publication": 1}
    assert start == end and stream.partitions(start, end) == []
    with pytest.raises(ArchiveError, match="not d9 any more"):
        stream.partitions({"dataset": "d9", "publication": 0}, end)
    assert ChangeStream({"path": str(tmp_path / "none")}).latestOffset() == {"dataset": None, "publication": -1}


LISTED = "symbol string, date string, seq int, v int"


def test_a_restatement_takes_its_predecessor_back(spark, tmp_path):
    """Random listings over restarts: what is left of the changes is the last listing of each key, and state is a row a key."""
    draw, everything = random.Random(4), []
    (tmp_path / "in").mkdir()
    stream = restated_rows_stream(spark.readStream.schema(LISTED).parquet(str(tmp_path / "in")), ["seq"])
    for k in range(4):
        # numbers are drawn without regard to time, so older listings come late; a key has many in one batch
        batch = [(draw.choice("ABCDE"), draw.choice(["d1", "d2"]), draw.randrange(1000), draw.randrange(99)) for _ in range(40)] + [(None, "d1", k, k), ("N", "d1", None, 1)]
        everything += batch
        spark.createDataFrame(batch, LISTED).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        query.awaitTermination(120)
        assert query.exception() is None
        left = {}
        for symbol, date, change, seq, v in spark.read.parquet(str(tmp_path / "out")).collect():
            left[symbol, date, seq, v] = left.get((symbol, date, seq, v), 0) + (1 if change == "+" else -1)
        most = {}
        for symbol, date, seq, v in everything:
            if seq is not None and seq > most.get((symbol, date), -1):
                most[symbol, date] = seq
        kept = {key: n for key, n in left.items() if n}
        assert set(kept.values()) == {1} and {(s, d): seq for s, d, seq, _ in kept} == most
        assert {(s, d, seq, v) for s, d, seq, v in kept} <= set(everything)
        assert sum(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress[-1:]) == len(most)


def test_a_key_is_forgotten_after_its_time_to_live(spark, tmp_path):
    listed = spark.createDataFrame([("A", "d", 5, 1)], LISTED)
    listed.write.parquet(str(tmp_path / "in"))
    stream = restated_rows_stream(spark.readStream.schema(LISTED).parquet(str(tmp_path / "in")), ["seq"], ttl_ms=1000)
    query = stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(processingTime="200 milliseconds").start(str(tmp_path / "out"))
    try:
        read = lambda: sorted((r.change, r.seq) for r in spark.read.schema("symbol string, date string, change string, seq int, v int").parquet(str(tmp_path / "out")).collect())
        end = time.monotonic() + 90
        while not (tmp_path / "out").exists() or not read():
            assert time.monotonic() < end and query.exception() is None
            time.sleep(0.2)
        time.sleep(2)
        listed.withColumn("seq", F.lit(3)).write.mode("append").parquet(str(tmp_path / "in"))  # older, but what came before is forgotten
        while len(read()) < 2:
            assert time.monotonic() < end and query.exception() is None
            time.sleep(0.2)
        assert read() == [("+", 3), ("+", 5)]
    finally:
        query.stop()


def test_listings_with_a_column_named_change_are_refused(spark, tmp_path):
    stream = spark.readStream.schema(LISTED + ", change string").parquet(str(tmp_path))
    with pytest.raises(ValueError, match="'change' of their own"):
        restated_rows_stream(stream, ["seq"])


def test_merged_batches_give_the_same_changes(spark, tmp_path):
    """Random listings over restarts, and batches that run again: what is left of the changes is the last listing of each key, none comes twice."""
    draw, most, told = random.Random(5), {}, []
    (tmp_path / "in").mkdir()
    stream = restated_rows_merged(spark.readStream.schema(LISTED).parquet(str(tmp_path / "in")), ["seq"], str(tmp_path))
    goes_on = lambda: stream.trigger(availableNow=True).start().awaitTermination(120)
    for k in range(4):
        batch = [(draw.choice("ABCDE"), draw.choice(["d1", "d2"]), draw.randrange(1000), draw.randrange(99)) for _ in range(40)]
        batch += [(None, "d1", k, k), ("N", "d1", None, 1), ("same", "d1", 7, k)]
        spark.createDataFrame(batch, LISTED).repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        before = dict(most)
        for symbol, date, seq, v in batch:
            if seq is not None and seq > most.get((symbol, date), (-1,))[0]:
                most[symbol, date] = (seq, v)
        for key in most:
            if most[key] != before.get(key):
                told += [(key, change, *listed[key][:1], k) for change, listed in (("-", before), ("+", most)) if key in listed]
        assert goes_on()
        if k % 2:  # as if the program had ended before the batch was committed
            for name in (f"{k}", f".{k}.crc"):
                (tmp_path / "state/commits" / name).unlink(missing_ok=True)
            assert goes_on()
        rows = spark.read.parquet(str(tmp_path / "changes")).collect()
        assert sorted(((r.symbol, r.date), r.change, r.seq, r.batch) for r in rows if r.symbol) == sorted(t for t in told if t[0][0])
        assert sorted((r.change, r.seq, r.batch) for r in rows if not r.symbol) == sorted(t[1:] for t in told if not t[0][0])
        assert {r.v for r in rows if r.symbol == "same"} == {0}


def test_the_query_of_restatements_calls_no_python_a_key(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(restated, "Restated", None)
    assert queries.restated_changes(spark, "/root/testdata/sf0.001").count() > 0
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    assert queries.restated_changes(spark, str(tmp_path)).count() == 0


def test_merged_listings_with_columns_of_the_changes_are_refused(spark, tmp_path):
    for name in ("change", "batch"):
        with pytest.raises(ValueError, match=f"'{name}' of their own"):
            restated_rows_merged(spark.readStream.schema(LISTED + f", {name} string").parquet(str(tmp_path)), ["seq"], str(tmp_path))
