import hashlib
import json
import os
import re
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest

from skyledger.__main__ import main
from skyledger.operators.compare import missing_rows, prediction_diff
from skyledger.functions.values import MarketDate
from skyledger.operators.network import EngineError
from skyledger.plans.run import PredictRequest, observations, register, run, scored
from skyledger.sources import archive
from skyledger.sources.files import ArchiveError
from skyledger.sources.predictions import OutputError, PredictionIdentity, StagedRun, inspect_output
from tests.archives import MODEL, Fixture, drawn, expected, model_file, place_of, plain

IDENTITY = PredictionIdentity("sha256:abc", 3, 1, 42, "quartz-7", "ds1", "e", "1")
PUBLICATIONS = drawn(21, 3, 70, 4)


def request(tmp_path, publications=None, width=4, export=MODEL, **kwargs):
    b = Fixture(tmp_path / "archive", width)
    for k, rows in enumerate(publications or PUBLICATIONS):
        b.add(f"ds{k + 1}", rows)
    return b, PredictRequest(model_file(tmp_path, export), str(b.root), str(tmp_path / "out" / "run"), **kwargs)


def leftovers(tmp_path):
    return os.listdir(tmp_path / "out") if (tmp_path / "out").exists() else []


@pytest.mark.parametrize("split", [250_000, 30])
def test_a_run_scores_the_rows_that_count(spark, tmp_path, monkeypatch, split):
    """Every output by the formula, every file by the manifest; also where several tasks score a partition."""
    monkeypatch.setattr(archive, "SPLIT_ROWS", split)
    b, r = request(tmp_path)
    want, replaced = plain(PUBLICATIONS)
    lines = []
    m = run(spark, r, lines.append).manifest
    found = spark.read.format("predictions").load(r.output).orderBy("year", "month", "prefix", "row").collect()
    assert [(x.year, x.month, x.prefix, x.row, x.symbol, str(x.date)) for x in found] == [w[:6] for w in want]
    assert np.allclose([x.y for x in found], [expected(w[6]) for w in want], atol=1e-5)
    counts = Counter(f"{w[0]:04}/{w[1]:02}/{w[2]}" for w in want)
    assert {p["path"]: p["rowCount"] for p in m["partitions"]} == counts and list(counts) == [p["path"] for p in m["partitions"]]
    assert (m["rowCount"], m["supersededRows"], m["datasetChain"], m["refused"]) == (len(want), replaced, ["ds3", "ds2", "ds1"], [])
    for p in m["partitions"]:
        index, payload = json.loads((tmp_path / "out/run" / f"{p['path']}.index.json").read_text()), (tmp_path / "out/run" / f"{p['path']}.bin").read_bytes()
        assert index["payloadSha256"] == p["payloadSha256"] == hashlib.sha256(payload).hexdigest() and index["payloadBytes"] == len(payload) == 16 * p["rowCount"]
    files = {str(x.relative_to(tmp_path / "out/run")) for x in (tmp_path / "out/run").rglob("*") if x.is_file()}
    assert files == {"manifest.json"} | {f"{p}{end}" for p in counts for end in (".bin", ".index.json")} and leftovers(tmp_path) == ["run"]
    assert inspect_output(r.output) == m and lines[-1].startswith(f"[skyledger] wrote {len(want)} rows")


def test_an_output_belongs_to_one_run(spark, tmp_path):
    b, r = request(tmp_path, PUBLICATIONS[:1])
    made = run(spark, r)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*")}
    other = tmp_path / "other.json"
    other.write_text(json.dumps({**MODEL, "output": 2}) + " ")  # the same network in another file is another model
    told = []
    assert run(spark, r, told.append).already_complete and run(spark, r).manifest == made.manifest and "left as it is" in told[0]
    b.add("late", [("Z1", "2019-05-05", [0, 0, 0, 0])])
    for changed in (r, replace(r, dataset="ds1", last=MarketDate(2019, 2, 1)), replace(r, dataset="ds1", creature=str(other))):
        with pytest.raises(OutputError) as e:
            run(spark, changed)
        assert e.value.kind == "occupied" and "it holds run" in str(e.value)
    assert run(spark, replace(r, dataset="ds1")).already_complete
    assert {p: p.stat().st_mtime_ns for p in (tmp_path / "out").rglob("*")} == before


@pytest.mark.parametrize("width", [4, 6, 3])
def test_archives_may_be_wider_than_the_model(spark, tmp_path, width):
    rows = [(s, d, [*v, *[99.0] * 9][:width]) for s, d, v in PUBLICATIONS[0]]
    b, r = request(tmp_path, [rows], width)
    if width < 4:
        with pytest.raises(EngineError, match="reads 4 values a row, more than the 3"):
            run(spark, r)
        assert not leftovers(tmp_path)
        return
    m = run(spark, r).manifest
    assert (m["identity"]["inputCount"], m["creatureInput"], m["identity"]["outputCount"]) == (width, 4, 2)
    found = {(x.symbol, str(x.date)): x.y for x in spark.read.format("predictions").load(r.output).collect()}
    assert all(np.allclose(found[s, d], expected(v), atol=1e-5) for s, d, v in PUBLICATIONS[0])


@pytest.mark.parametrize("split", [250_000, 30])
def test_a_bad_partition_fails_the_run(spark, tmp_path, monkeypatch, split):
    """The first one in partition order is told of, and nothing is left."""
    monkeypatch.setattr(archive, "SPLIT_ROWS", split)
    rows = [(s, d, v) for s, d, v in PUBLICATIONS[0]]
    last = max(range(len(rows)), key=lambda i: place_of(rows[i]))
    rows[last] = (*rows[last][:2], [0, 0, -float("inf"), 0])
    b, r = request(tmp_path, [rows])
    with pytest.raises(ArchiveError, match=f"value 2 of {re.escape(rows[last][0])} on {rows[last][1]} is -inf") as e:
        run(spark, r)
    assert e.value.kind == "corrupt" and not leftovers(tmp_path)
    shard = b.files(".bin")[0]
    shard.write_bytes(bytes(len(shard.read_bytes())))
    with pytest.raises(ArchiveError, match=re.escape(str(shard))) as e:
        run(spark, r)
    assert e.value.kind == "hash" and not leftovers(tmp_path)


def test_refused_rows_and_partial_exit(spark, tmp_path, capsys):
    """Rows whose outputs single precision can't hold are told of; a partition of such rows alone has no files."""
    far = {"input": 1, "output": 1, "forwardOnly": True, "neurons": [{"type": "output", "uuid": "o", "bias": 0, "squash": "IDENTITY"}], "synapses": [{"fromUUID": "input-0", "toUUID": "o", "weight": 3e38}]}
    signs = {"K": (1, 0.5, -1), "L": (5, -7), "M": (-0.25,)}
    rows = [(f"{k}{i}", f"2019-04-{i + 1:02}", [v]) for k, held in signs.items() for i, v in enumerate(held)]
    b, r = request(tmp_path, [rows], 1, far)
    args = ["predict", "--creature", r.creature, "--archive", r.archive, "--output", r.output]
    assert main(args, spark) == 3 and main(args, spark) == 3
    m = inspect_output(r.output)
    assert [(x["symbol"], x["reason"]) for x in m["refused"]] == [("L0", "non-finite output inf"), ("L1", "non-finite output -inf")]
    assert {p["path"]: p["rowCount"] for p in m["partitions"]} == {"2019/04/K": 3, "2019/04/M": 1} and not list((tmp_path / "out/run/2019/04").glob("L*"))
    assert capsys.readouterr().err.count("2 row(s) without a finite output") == 2


def test_exit_codes(spark, tmp_path):
    b, r = request(tmp_path, PUBLICATIONS[:1])
    (tmp_path / "full").mkdir()
    (tmp_path / "full/x").write_text("")
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd/manifest.json").write_text('{"schema": "other"}')
    (tmp_path / "empty").mkdir()

    def code(output="none", **changed):
        given = {"creature": r.creature, "archive": r.archive, "output": str(tmp_path / output)} | changed
        return main(["predict", *(x for k, v in given.items() for x in (f"--{k}", v))], spark)

    late = {"from": "2030-01-01"}
    assert code("late", **late) == 0 and code("late") == 73 and code("late", **late) == 0
    m = inspect_output(str(tmp_path / "late"))
    assert (m["partitions"], m["rowCount"], m["from"], m["to"]) == ([], 0, "2030-01-01", None)
    assert (code("full"), code("odd"), code("full/x")) == (73, 73, 74)
    assert code("empty", to="2019-01-31") == 0 and inspect_output(str(tmp_path / "empty"))["rowCount"] == sum(d <= "2019-01-31" for _, d, _ in PUBLICATIONS[0])
    assert code(dataset="../x") == 64 and code(**{"from": "2019-02-02", "to": "2019-02-01"}) == 64 and code(creature="") == 64
    assert code(creature="absent") == 66 and code(dataset="absent") == 66 and code(archive=str(tmp_path)) == 66
    with pytest.raises(SystemExit) as e:
        code(**{"from": "2019-2-01"})
    assert e.value.code == 2 and not (tmp_path / "none").exists()


def test_key_and_index_form(tmp_path):
    from hashlib import sha256

    text = "retrospective_fixed_model|creature=sha256:abc|inputs=3|outputs=1|extension=42|features=quartz-7|width=3|dataset=ds1|engine=e|engineVersion=1"
    assert IDENTITY.key() == sha256(text.encode()).hexdigest()[:32]
    staged = StagedRun.begin(str(tmp_path / "o"), IDENTITY)
    record, refused = staged.write_partition(2021, 5, "A", [("A", "2021-05-03", None), ("B", "2021-05-04", "X"), ("C", "2021-05-05", None)], np.array([1.5, np.nan, 2.5], np.float32))
    assert refused == [{"symbol": "B", "date": "2021-05-04", "reason": "non-finite output NaN"}] and record["rowCount"] == 2
    text = (tmp_path / f".o.partial-{os.getpid()}/2021/05/A.index.json").read_text()
    index = json.loads(text)
    assert list(index) == ["schema", "key", "creatureUUID", "inputCount", "outputCount", "observationExtension", "featureFingerprint", "datasetId", "engine", "engineVersion", "researchMode", "year", "month", "prefix", "payloadFile", "payloadBytes", "payloadSha256", "rowCount", "rows", "createdUTC"]
    assert index["rows"] == [{"symbol": "A", "date": "2021-05-03", "row": 0}, {"symbol": "C", "date": "2021-05-05", "row": 1}] and text.endswith("}\n")
    assert staged.write_partition(2021, 5, "Z", [("Z", "2021-05-03", None)], np.array([np.inf], np.float32))[0] is None
    staged.abandon()
    assert not os.listdir(tmp_path)


def test_the_plan_has_no_shuffle(spark, tmp_path):
    from skyledger.operators.network import Predictor, load_creature, score
    from skyledger.sources.archive import open_archive

    b, r = request(tmp_path)
    creature = load_creature(r.creature)
    for keep in (None, str(tmp_path / "keep")):
        a = open_archive(spark, r.archive, keep=keep)
        plan, apart = scored(spark, a, creature), score(observations(spark, a), Predictor(creature, 4))
        assert sorted((x.symbol, x.date, x.y) for x in plan.collect()) == sorted((x.symbol, x.date, x.y) for x in apart.collect())
        assert "Exchange" not in apart._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString() and plan.rdd.getNumPartitions() > 1


def test_prediction_diff(spark):
    register(spark)
    a = spark.createDataFrame([("A", "d", 1.0), ("B", "d", 2.0), ("C", "d", 3.0)], "symbol string, date string, value double")
    b = spark.createDataFrame([("A", "d", 1.0), ("B", "d", 2.5), ("D", "d", 3.0)], "symbol string, date string, value double")
    assert prediction_diff(a, b).collect()[0] == (2, 1, 0.5, "B", "d", 1, 1, False)
    assert prediction_diff(a, a).collect()[0].agree and missing_rows(a, b).collect() == [("C", "d")]
