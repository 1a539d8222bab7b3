import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.operators.network import Creature, EngineError, Predictor, activation_columns, load_creature, score
from tests.archives import MODEL, expected, model_file


def predictor(width=4, **changes):
    return Predictor(Creature("c", "0" * 64, {**MODEL, **changes}), width)


by_hand = expected


def random_network(seed=1, inputs=17, hidden=120, fan=5):
    draw = np.random.default_rng(seed)
    names = [f"input-{i}" for i in range(inputs)] + [f"n{i}" for i in range(hidden)]
    neurons = [{"type": "hidden", "uuid": f"n{i}", "bias": float(draw.normal()), "squash": ["TANH", "IDENTITY", "ReLU", "LOGISTIC"][i % 4]} for i in range(hidden)]
    synapses = [{"fromUUID": names[int(j)], "toUUID": f"n{i}", "weight": float(draw.normal()) / 2} for i in range(hidden) for j in draw.integers(0, inputs + i, fan)]
    outputs = [{"type": "output", "uuid": f"o{k}", "bias": 0.5, "squash": "IDENTITY"} for k in range(3)]
    synapses += [{"fromUUID": f"n{hidden - 1 - k}", "toUUID": f"o{k}", "weight": 1.5} for k in range(3)]
    return {"input": inputs, "output": 3, "forwardOnly": True, "neurons": neurons + outputs, "synapses": synapses}


def test_matches_the_formula():
    rows = np.random.default_rng(8).normal(size=(200, 4)).astype(np.float32) * 2
    assert np.allclose(predictor().activate(rows), [by_hand(r) for r in rows], atol=2e-6)


def test_rows_do_not_depend_on_their_batch():
    model = Predictor(Creature("c", "", random_network()), 20)
    rows = np.random.default_rng(0).normal(size=(1203, 20)).astype(np.float32)
    whole = model.predict(rows.reshape(-1)).reshape(-1, 3)
    for n in (1, 7, 16, 500):
        assert np.array_equal(np.concatenate([model.activate(rows[i : i + n]) for i in range(0, 1203, n)]), whole)
    assert np.array_equal(np.concatenate([model.activate_one(r) for r in rows[:203]]).reshape(-1, 3), whole[:203])


def test_extra_values_are_ignored():
    rows = np.random.default_rng(0).normal(size=(50, 7)).astype(np.float32)
    assert np.array_equal(predictor(7).predict(rows), predictor().predict(rows[:, :4].reshape(-1)))


def test_refusals(tmp_path):
    with pytest.raises(EngineError, match="reads 4 values a row, more than the 3") as e:
        predictor(3)
    assert e.value.kind == "wider_than_archive"
    with pytest.raises(EngineError, match="forwardOnly true") as e:
        predictor(forwardOnly=False)
    assert e.value.kind == "not_forward_only"
    with pytest.raises(EngineError, match="6 values do not make whole rows of 4"):
        predictor().predict(np.zeros(6))
    assert predictor().predict(np.zeros(0)).size == 0
    for name, change in [
        ("input", {"input": 0}), ("output", {"output": 0}), ("squash", {"neurons": [{**n, "squash": "COSINE"} for n in MODEL["neurons"]]}), ("outputs", {"output": 3}),
        ("cycle", {"synapses": [*MODEL["synapses"], {"fromUUID": "roof", "toUUID": "left", "weight": 1}]}), ("unknown", {"synapses": [{"fromUUID": "x", "toUUID": "left", "weight": 1}]}), ("forward", {"forwardOnly": None}),
    ]:
        with pytest.raises(EngineError) as e:
            Predictor(load_creature(model_file(tmp_path, {**MODEL, **change})), 4)
        assert e.value.kind == "creature", name
    (tmp_path / "latin").write_bytes(b"\xff{}")
    with pytest.raises(EngineError, match="no UTF-8"):
        load_creature(str(tmp_path / "latin"))
    with pytest.raises(EngineError) as e:
        load_creature(str(tmp_path / "absent"))
    assert e.value.kind == "io"


def test_spark_stage_equals_kernel_and_columns(spark):
    rows = np.random.default_rng(3).normal(size=(300, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)] + [(300, None)], "id long, x array<float>")
    made = score(df.withColumn("z", F.col("x")), predictor(), "x", "y")
    found = {r.id: r.y for r in made.collect()}
    assert found.pop(300) is None
    assert np.array_equal(np.array([found[i] for i in range(300)], np.float32).reshape(-1), predictor().predict(rows.reshape(-1)))
    assert "Exchange" not in made._jdf.queryExecution().sparkPlan().toString()
    columns = df.where("x IS NOT NULL").select("id", activation_columns(MODEL, F.col("x"), precise=False)[0].alias("v")).collect()
    assert all(abs(r.v - found[r.id][0]) < 1e-5 for r in columns)
    deep = {k: v for k, v in random_network(hidden=8, inputs=4).items()}
    double = df.where("x IS NOT NULL").select("id", *[c.alias(f"o{i}") for i, c in enumerate(activation_columns(deep, F.col("x")))]).collect()
    kernel = Predictor(Creature("c", "", deep), 4).activate(rows)
    assert all(np.allclose([r.o0, r.o1, r.o2], kernel[r.id], atol=1e-4) for r in double)
    json.dumps(deep)


def test_scoring_finds_columns_by_the_rules_of_the_session(spark):
    rows = [("s", [0.5, -1.0, 0.25, 2.0], 1), ("t", None, 2)]
    df = spark.createDataFrame(rows, "Y string, Obs array<float>, last int")
    found = {r.last: r for r in score(df, predictor(), "OBS", "y").collect()}
    assert score(df, predictor(), "OBS", "y").columns == ["last", "y"]
    assert np.allclose(found[1].y, by_hand(rows[0][1]), atol=1e-6) and found[2].y is None
