"""Archives: what a reader gives of any chain, by whichever way it resolves it, and what it refuses."""

import json
import random

import numpy as np
import pytest
from pyspark.sql.datasource import EqualTo, In, LessThanOrEqual, StringStartsWith

from skyledger.functions.values import MarketDate
from skyledger.operators import resolve
from skyledger.operators.resolve import snapshot_chain, stored
from skyledger.plans.run import observations, register
from skyledger.sources import archive, indexes
from skyledger.sources.archive import FilteredReader, open_archive
from skyledger.sources.chain import chain_shards, snapshot
from skyledger.sources.files import ArchiveError
from skyledger.sources.publish import newest, write_archive
from tests.archives import EXTENSION, FINGERPRINT, Fixture, drawn, plain


def rows_of(df):
    return [(r.year, r.month, r.prefix, r.row, r.symbol, str(r.date), list(r.x)) for r in df.orderBy("year", "month", "prefix", "row").collect()]


def fault(spark, builder, **kwargs):
    with pytest.raises(ArchiveError) as e:
        open_archive(spark, str(builder.root), **kwargs)
    return e.value.kind


def built(tmp_path, publications, width):
    b = Fixture(tmp_path, width)
    for k, rows in enumerate(publications):
        b.add(f"d{k}", rows)
    return b


@pytest.mark.parametrize("kept, split", [(False, 250_000), (True, 250_000), (True, 40)])
def test_any_snapshot_of_a_chain_equals_a_plain_resolver(spark, tmp_path, monkeypatch, kept, split):
    """In tasks of their own, from kept listings, and merged from sorted runs by ranges; every head and several ranges of dates."""
    monkeypatch.setattr(archive, "SPLIT_ROWS", split)
    publications = drawn(11, 4, 90, 2)
    b = built(tmp_path, publications, 2)
    for n, bounds in ((4, ("", "9")), (1, ("", "9")), (3, ("2019-01-20", "2019-02-11")), (4, ("2019-02-28", "9")), (4, ("2020-01-01", "9"))):
        first, last = (MarketDate.parse(x) if len(x) > 1 else None for x in bounds)
        a = open_archive(spark, str(b.root), f"d{n - 1}", first, last, str(tmp_path / f"keep{n}{bounds[0]}") if kept else None)
        want, replaced = plain(publications[:n], *bounds)
        df = observations(spark, a)
        assert rows_of(df) == want and {r.exchange for r in df.collect()} <= {"XETR"}
        assert (a.superseded_rows, a.row_count, a.dataset_chain) == (replaced, len(want), [f"d{k}" for k in reversed(range(n))])
        assert [p.key for p in a.partitions] == sorted({r[:3] for r in want}, key=lambda k: (*k[:2], k[2].encode()))
    if split == 40:
        whole = open_archive(spark, str(b.root), keep=str(tmp_path / "again"))
        assert max(len(p.kept) for p in whole.partitions) > 1


def test_the_scan_opens_no_index_again(spark, tmp_path):
    publications = drawn(12, 3, 60, 2)
    b = built(tmp_path / "archive", publications, 2)
    a = open_archive(spark, str(b.root), keep=str(tmp_path / "keep"))
    for path in b.files(".index.json"):
        path.unlink()
    assert rows_of(observations(spark, a)) == plain(publications)[0]


def test_a_large_partition_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    """60,000 listings of one partition in two shards; the tasks resolve and read a bounded part each."""
    monkeypatch.setattr(archive, "SPLIT_ROWS", 10_000)
    days = [f"2019-03-{d + 1:02}" for d in range(30)]
    publications = [[(f"Q{i:04}", d, [k, i]) for i in range(step, 2000, step + 1) for d in days] for k, step in enumerate((0, 1))]
    b = built(tmp_path / "archive", publications, 2)
    a = open_archive(spark, str(b.root), keep=str(tmp_path / "keep"))
    (p,) = a.partitions
    assert p.row_count == 60_000 and a.superseded_rows == 30_000 and len(p.kept) > 3
    whole, split = archive.kept_work(a, 4)
    assert not whole and len(split) == 6 and max(sum(x.n for x in w.pieces[0].kept) for w in split) <= 10_000
    assert sorted(o for w in split for o in w.pieces[0].checks) == [0, 1]  # each payload is hashed by one of them
    assert rows_of(observations(spark, a)) == plain(publications)[0]
    b.files("d1.bin")[0].write_bytes(b"\0" * b.files("d1.bin")[0].stat().st_size)
    kinds = [json.loads(r.fault)[0] for r in observations(spark, a, faults_as_rows=True).where("fault IS NOT NULL").collect()]
    assert kinds == ["hash"]


def test_pushed_filters_open_few_folders_and_change_nothing(spark, tmp_path):
    publications = drawn(13, 3, 120, 1, months=4)
    b = built(tmp_path, publications, 1)
    register(spark)
    want = plain(publications)[0]
    load = lambda: spark.read.format("observations").option("pushdown", "true").load(str(b.root))
    for condition, wanted in [
        ("symbol = 'AA1'", lambda r: r[4] == "AA1"), ("symbol IN ('b0', '^X2', 'none')", lambda r: r[4] in ("b0", "^X2")), ("symbol LIKE 'A%'", lambda r: r[4][0] == "A"), ("prefix = '_' AND month > 2", lambda r: r[2] == "_" and r[1] > 2),
        ("date BETWEEN DATE'2019-02-05' AND DATE'2019-03-02'", lambda r: "2019-02-05" <= r[5] <= "2019-03-02"), ("date IN (DATE'2019-01-07', DATE'2019-04-09')", lambda r: r[5] in ("2019-01-07", "2019-04-09")), ("year = 2018", lambda r: False),
    ]:
        assert rows_of(load().where(condition)) == [r for r in want if wanted(r)], condition

    def keys(*filters):
        reader = FilteredReader({"path": str(b.root)})
        assert list(reader.pushFilters(list(filters))) == list(filters)
        return {p.key for w in reader.partitions() for p in w.pieces}

    assert keys(EqualTo(("symbol",), "AA1")) == {k for k in {r[:3] for r in want} if k[2] == "A"}  # one folder a month
    assert keys(In(("symbol",), ("b0", "^X2")), LessThanOrEqual(("month",), 1)) == {(2019, 1, "B"), (2019, 1, "_")}
    assert keys(StringStartsWith(("symbol",), "3"), EqualTo(("year",), 2019), EqualTo(("month",), 4)) == {(2019, 4, "3")}


def test_one_load_may_be_filtered_in_several_ways(spark, tmp_path):
    publications = drawn(14, 1, 60, 1)
    register(spark)
    rows = spark.read.format("observations").load(str(built(tmp_path, publications, 1).root))
    both = rows.where("prefix = 'A'").unionByName(rows.where("prefix = 'B'"))
    assert {r.prefix for r in both.collect()} == {"A", "B"}


def test_written_through_the_source(spark, tmp_path):
    """Publications by tasks: several shards a partition, each listed once; the chain grows by one dataset a write."""
    publications, root = drawn(15, 3, 150, 2), str(tmp_path / "116" / "f")
    for k, rows in enumerate(publications):
        df = spark.createDataFrame([(s, d, None if i % 3 else "X", v) for i, (s, d, v) in enumerate(rows)], "symbol string, date string, exchange string, x array<double>")
        if k != 1:
            write_archive(df.repartition(7), root, f"d{k}", 2, 116, "f")
        else:  # rows in any order, so that many tasks have rows of a partition
            options = {"dataset": "d1", "width": 2, "extension": 116, "fingerprint": "f"}
            df.withColumn("date", df.date.cast("date")).repartition(7).write.format("observations").mode("append").options(**options).save(root)
    a = open_archive(spark, root)
    assert rows_of(observations(spark, a)) == plain(publications)[0] and a.dataset_chain == ["d2", "d1", "d0"]
    listed = {s.path for s in a.shards}
    assert listed == {str(p.relative_to(root)) for p in (tmp_path / "116/f").rglob("*.bin")} and len(listed) > len({(s.manifest, s.year, s.month, s.prefix) for s in a.shards})


def test_a_lost_attempt_leaves_nothing_that_is_listed(spark, tmp_path):
    """The first attempt of each task writes its shards and fails; the second counts."""
    from skyledger.sources.publish import ObservationWriter

    root, rows = str(tmp_path / "116" / "f"), drawn(16, 1, 40, 2)[0]
    batch = lambda part: iter([spark.createDataFrame([(s, d, v) for s, d, v in part], "symbol string, date string, x array<double>").selectExpr("symbol", "CAST(date AS DATE) AS date", "x").toArrow().combine_chunks().to_batches()[0]])
    writer = ObservationWriter({"path": root, "dataset": "d0", "width": "2", "extension": "116", "fingerprint": "f"}, ["symbol", "date", "x"], False)

    class Context:
        attempt = 0

        def taskAttemptId(self):
            Context.attempt += 1
            return Context.attempt

    import pyspark

    held, pyspark.TaskContext.get = pyspark.TaskContext.get, classmethod(lambda cls: Context())
    try:
        writer.write(batch(rows))  # lost: its message never comes
        message = writer.write(batch(rows))
    finally:
        pyspark.TaskContext.get = held
    late = ObservationWriter({"path": root, "dataset": "d1", "width": "2", "extension": "116", "fingerprint": "f"}, ["symbol", "date", "x"], False)
    writer.commit([None, message])
    assert rows_of(observations(spark, open_archive(spark, root))) == plain([rows])[0]
    assert len(list((tmp_path / "116/f").rglob("*.bin"))) == len(message.entries)
    with pytest.raises(ArchiveError, match="another dataset was published"):
        late.commit([])
    assert newest(root) == "d0"


@pytest.mark.parametrize("row, told", [(("A", "2019-01-01", [1.0]), "needs 2 values"), ((" A", "2019-01-01", [1.0, 2.0]), "outer white space"), ((None, "2019-01-01", [1.0, 2.0]), "needs a date"), (("A", None, [1.0, 2.0]), "needs a date"), (("A", "2019-01-01", [1.0, float("nan")]), "value 1 of A is NaN")])
def test_rows_that_no_reader_would_take_are_not_written(spark, tmp_path, row, told):
    root = str(tmp_path / "116" / "f")
    with pytest.raises(Exception, match=told):
        write_archive(spark.createDataFrame([row], "symbol string, date string, x array<double>"), root, "d0", 2, 116, "f")
    assert newest(root) is None


def test_year_zero(spark, tmp_path):
    b = Fixture(tmp_path, 1)
    b.add("ds", [("A", "0000-02-29", [1])])
    assert observations(spark, open_archive(spark, str(b.root))).selectExpr("date_format(date, 'MM-dd') d", "year").collect()[0] == ("02-29", 0)


def test_payload_faults(spark, tmp_path):
    for kind, damage in (("hash", lambda p: p.write_bytes(b"\0" * 8)), ("corrupt", lambda p: p.write_bytes(b"\0")), ("io", lambda p: p.unlink())):
        b = Fixture(tmp_path / kind, 2)
        b.add("ds", [("A", "2019-08-30", [1, 2])])
        damage(b.files(".bin")[0])
        a = open_archive(spark, str(b.root), keep=str(tmp_path / "keep"))  # payloads are not read here
        (row,) = observations(spark, a, faults_as_rows=True).collect()
        assert json.loads(row.fault)[0] == kind and row.x is None
        with pytest.raises(Exception, match=f"archive {kind} fault"):
            observations(spark, a).collect()


#: Changes to an index that lists (A, 2019-08-30) as its only row, and the kind of the fault.
INDEX_FAULTS = [
    ("schema", {"schema": "x"}), ("schema", {"byteOrder": "big-endian"}), ("semantics", {"inputCount": 2}), ("semantics", {"featureFingerprint": "x"}), ("semantics", {"observationExtension": 1}), ("corrupt", {"rowCount": 2}),
    ("corrupt", {"shardFile": "x.bin"}), ("corrupt", {"shardBytes": 5}), ("hash", {"shardSha256": "0"}), ("corrupt", {"month": 9}), ("corrupt", {"prefix": "B"}), ("json", {"rows": 3}), ("json", {"year": -1}), ("json", {"year": 70000}),
    ("corrupt", {"rows": [{"symbol": "A", "date": "2019-8-30", "row": 0}]}), ("corrupt", {"rows": [{"symbol": "A", "date": "2019-08-30", "row": 1}]}), ("corrupt", {"rows": [{"symbol": " A", "date": "2019-08-30", "row": 0}]}),
    ("corrupt", {"rows": [{"symbol": "", "date": "2019-08-30", "row": 0}]}), ("corrupt", {"rows": [{"symbol": "A", "date": "2019-09-30", "row": 0}]}), ("corrupt", {"rows": [{"symbol": "B", "date": "2019-08-30", "row": 0}]}),
    ("corrupt", {"rows": []}), ("json", {"rows": [{"symbol": "A", "date": "2019-08-30"}]}),
]


def test_index_faults(spark, tmp_path):
    for n, (kind, change) in enumerate(INDEX_FAULTS):
        b = Fixture(tmp_path / str(n), 1)
        b.add("ds", [("A", "2019-08-30", [1])])
        path = b.files(".index.json")[0]
        b.edit(path, **change)
        _, chain, semantics = snapshot(str(b.root), None)
        listings, faults = indexes.read_listings(str(b.root), [(0, chain_shards(chain)[0])], semantics)
        assert (faults[0][1].kind, faults[0][1].path, listings.num_rows) == (kind, str(path), 0), change
        if n % 6 == 0:
            assert fault(spark, b) == kind
    b.edit(path, rows=[{"symbol": "A", "date": "2019-08-30", "row": 0}], unknown=1)
    assert open_archive(spark, str(b.root)).row_count == 1


def test_the_first_row_at_fault_is_told_of_whatever_comes_later(spark, tmp_path, monkeypatch):
    b = Fixture(tmp_path, 1)
    b.add("ds", [(f"A{i}", "2019-08-30", [i]) for i in range(9)])
    (path,) = b.files(".index.json")
    rows = json.loads(path.read_text())["rows"]
    for at, spoilt, told in ((7, {"date": "2019-08-32"}, "no day 2019-08-32"), (5, {"row": 3}, "row 3 is taken"), (2, {"symbol": "B"}, "lies outside"), (0, {"symbol": "\u2003A"}, "outer white space")):
        rows[at] |= spoilt
        b.edit(path, rows=rows)
        with pytest.raises(ArchiveError, match=told):
            open_archive(spark, str(b.root))
        with monkeypatch.context() as m:
            m.setattr(archive, "SPLIT_ROWS", 3)
            with pytest.raises(ArchiveError, match=told):
                open_archive(spark, str(b.root), keep=str(tmp_path / f"keep{at}"))


def test_dates_of_columns():
    good = ["2019-08-30", "0000-02-29", "1900-02-28", "2000-02-29", "9999-12-31", "1970-01-01"]
    days, months = indexes.days_of(good)
    assert days.tolist() == [MarketDate.parse(t).epoch_days() for t in good] and months.tolist() == [d.year * 12 + d.month - 1 for d in map(MarketDate.parse, good)]
    for bad in ("1900-02-29", "2019-13-01", "2019-00-10", "2019-04-31", "2019-04-00", "2019-4-010", "2019/04/01", "2019-04-1a", "２019-04-01", "2019-04-011"):
        with pytest.raises(ValueError):
            indexes.days_of([good[0], bad])


def test_the_first_fault_in_chain_order_is_raised(spark, tmp_path):
    b = Fixture(tmp_path, 1)
    b.add("ds1", [("Z", "2019-08-30", [1])])
    b.add("ds2", [("A", "2019-08-30", [1])])
    old, new = b.files("ds1.index.json")[0], b.files("ds2.index.json")[0]
    b.edit(new, schema="x")
    assert fault(spark, b) == "schema"
    b.edit(old, shardSha256="x")
    assert fault(spark, b) == "hash"


def test_manifest_faults(spark, tmp_path):
    def made(name, width=1):
        b = Fixture(tmp_path / name, width)
        b.add("ds1", [("A", "2019-08-30", [1] * width)])
        b.add("ds2", [("A", "2021-05-04", [1] * width)])
        return b, b.root / "datasets" / "ds1.json", b.root / "datasets" / "ds2.json"

    def shard(file, **changes):
        return [{**json.loads(file.read_text())["shards"][0], **changes}]

    for name, kind, change in [
        ("traversal", "corrupt", lambda b, old, new: b.edit(new, shards=shard(new, path="../x.bin"))),
        ("backslash", "corrupt", lambda b, old, new: b.edit(new, shards=shard(new, path="a\\x.bin"))),
        ("nobin", "corrupt", lambda b, old, new: b.edit(new, shards=shard(new, path="2021/05/A/x.dat"))),
        ("loop", "corrupt", lambda b, old, new: b.edit(old, previousDatasetId="ds2")),
        ("unsafe", "corrupt", lambda b, old, new: (b.root / "latest.json").write_text('{"datasetId": "../x"}')),
        ("unsafe2", "corrupt", lambda b, old, new: b.edit(new, previousDatasetId="..")),
        ("name", "corrupt", lambda b, old, new: b.edit(old, datasetId="other")),
        ("schema", "schema", lambda b, old, new: b.edit(old, schema="x")),
        ("order", "schema", lambda b, old, new: b.edit(new, byteOrder="x")),
        ("semantics", "semantics", lambda b, old, new: b.edit(old, featureFingerprint="x")),
        ("zero", "corrupt", lambda b, old, new: (b.edit(old, inputCount=0), b.edit(new, inputCount=0))),
        ("twice", "corrupt", lambda b, old, new: b.edit(new, shards=shard(old))),
        ("rows", "corrupt", lambda b, old, new: b.edit(new, shards=shard(new, rowCount=2))),
        ("bytes", "corrupt", lambda b, old, new: b.edit(new, shards=shard(new, bytes=2))),
        ("missing", "json", lambda b, old, new: new.write_text("{}")),
        ("text", "json", lambda b, old, new: new.write_text("[")),
        ("twicefield", "json", lambda b, old, new: (b.root / "latest.json").write_text('{"datasetId": "ds1", "datasetId": "ds2"}')),
        ("utf8", "io", lambda b, old, new: new.write_bytes(b"\xff")),
        ("gone", "io", lambda b, old, new: old.unlink()),
    ]:
        b, old, new = made(name)
        change(b, old, new)
        assert fault(spark, b) == kind, name


def test_the_root_must_name_the_semantics(spark, tmp_path):
    b = Fixture(tmp_path, 1)
    b.add("ds", [("A", "2019-08-30", [1])])
    (tmp_path / "9").mkdir()
    b.root = b.root.rename(tmp_path / "9" / FINGERPRINT)
    assert fault(spark, b) == "semantics"
    with pytest.raises(ArchiveError, match=f"should be {EXTENSION}/{FINGERPRINT}"):
        open_archive(spark, str(b.root))
    with pytest.raises(ArchiveError) as e:
        open_archive(spark, str(tmp_path / "absent"))
    assert e.value.kind == "io"


def test_large_payloads_are_read_by_ranges(tmp_path, monkeypatch):
    b = Fixture(tmp_path, 3)
    b.add("ds1", [(f"A{i}", "2019-08-30", [i, 0, 1]) for i in range(40)])
    b.add("ds2", [(f"A{i}", "2019-08-30", [i, 5, 1]) for i in range(0, 40, 3)])
    _, chain, semantics = snapshot(str(b.root), None)
    shards = {s.order: s for s in chain_shards(chain)}
    rows, _ = indexes.latest(indexes.read_listings(str(b.root), [(0, s) for s in shards.values()], semantics)[0])
    read = lambda checks=None: np.concatenate(list(archive.gather(str(b.root), shards, rows, 3, 7, checks)))
    whole = read()
    assert whole[:, 1].sum() == 5 * 14
    monkeypatch.setattr(archive, "HELD_BYTES", 10)
    assert np.array_equal(read(), whole) and np.array_equal(read([1]), whole)
    for kind, damage in (("hash", b"\0" * 480), ("corrupt", b"\0")):
        b.files("ds1.bin")[0].write_bytes(damage)
        with pytest.raises(ArchiveError) as e:
            read()
        assert e.value.kind == kind


def test_chains_of_any_length(spark):
    names = [f"n{i:03}" for i in range(300)]
    links = list(zip(names, [*names[1:], None]))
    df = spark.createDataFrame([*links, ("other", "n100"), ("x", "y"), ("y", "z"), ("z", "x"), ("gap", "missing")], "dataset_id string, previous_dataset_id string")
    of = lambda head: {r.dataset_id: r.depth for r in snapshot_chain(df, head).collect()}
    assert of("n000") == {n: i for i, n in enumerate(names)} and of("other") == {"other": 0} | {n: i + 1 for i, n in enumerate(names[100:])}
    assert of("y") == {"y": 0, "z": 1, "x": 2} and of("gap") == {"gap": 0} and of("absent") == {}


@pytest.mark.parametrize("rows, several", [(1, 0), (5, 4), (10_000, 4)])
def test_chains_over_chunks_of_any_size(spark, rows, several):
    """Random links with loops, branches, gaps, ends, repeated rows and some datasets of several predecessors, against a plain walk."""
    draw = random.Random(rows)
    names = [f"d{i}" for i in draw.sample(range(10**6), 40)]
    links = [*zip(names, names[1:]), (names[-1], names[10]), (names[3], names[4]), ("gap", "missing"), ("end", None), (None, names[2])]
    links += [(f"side{i}", draw.choice([*names, "end"])) for i in range(10)] + [(draw.choice(names), draw.choice(names)) for _ in range(several)]
    df = spark.createDataFrame(links, "dataset_id string, previous_dataset_id string").repartition(3)
    held = {a for a, _ in links}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        for head in (names[0], "side1"):
            want, now, depth = {}, {head}, 0
            while now:
                want |= dict.fromkeys(now, depth)
                now, depth = ({b for a, b in links if a in now} & held) - {None} - want.keys(), depth + 1
            found = snapshot_chain(df, head, rows).collect()
            assert {r.dataset_id: r.depth for r in found} == want and len(found) == len(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_chain_in_order_of_its_ids_is_followed_within_tasks(spark, monkeypatch):
    """What is stored for the rounds grows with the chunks, not with the chain."""
    kept = {}

    def counted(df, name):
        made = stored(df, name)
        kept.setdefault(name, []).append(made.count())
        return made

    monkeypatch.setattr(resolve, "stored", counted)
    df = spark.range(5000).selectExpr("'d' || id AS dataset_id", "CASE WHEN id > 0 THEN 'd' || (id - 1) END AS previous_dataset_id")
    found = snapshot_chain(df, "d4999").collect()
    assert sorted((r.dataset_id, r.depth) for r in found) == sorted((f"d{4999 - k}", k) for k in range(5000))
    assert kept["chunks"] == [5000] and max(kept["jumps"] + kept["chain"]) < 200
