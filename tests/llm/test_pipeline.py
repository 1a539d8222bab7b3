"""The pipeline against a plain version of its stages, and the entry point's view of the subpackage."""

import numpy as np
import public_tokenizers
from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import langid, quality
from skyledger.llm.queries import ORACLES, QUERIES
from tests.llm.test_search import plain_components
from tests.llm.test_tokens import MULTI, PIECES, check_packing, plain_rules, plain_verdicts

SF = "/root/testdata/sf0.001"


def test_run_matches_plain_stages(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    made = quality.measure([r.text for r in docs.values()], PIECES, MULTI)
    rows = [Row(lang=r.lang, **{k: v[i] for k, v in made.items()}) for i, r in enumerate(docs.values())]
    kept = {i: r for (i, r), fine in zip(docs.items(), plain_verdicts(rows)) if fine}
    assert not any(plain_rules(r.text)[-1] for r in kept.values()) and len(kept) < len(docs)
    frame = spark.createDataFrame([r for r in kept.values()], spark.read.parquet(f"{SF}/documents.parquet").schema)
    model = langid.train(frame.where(~langid.held_out("doc_id")), "text", "lang")
    cosines = {}
    for i, r in kept.items():
        profile = langid.profiles([r.text])[0]
        cosines[i] = max((float(profile @ v) / max(1e-9, np.linalg.norm(profile)), k, int(np.log2(len(r.text)))) for k, v in model.items())
    for i, found in cosines.items():
        for group in (lambda c: c[1:], lambda c: c[1]):
            held = sorted(c[0] for c in cosines.values() if group(c) == group(found))
            if len(held) >= 50:
                low, middle, high = (held[-int(-len(held) * p // 1) - 1] for p in (0.25, 0.5, 0.75))
                if found[0] < middle - 4 * max(high - low, 0.02 * middle):
                    del kept[i]
                break
        if i in kept and found[0] < langid.OUTER_COSINE:
            del kept[i]
    components = plain_components([(i, r.text) for i, r in kept.items()])
    kept = {i: r for i, r in kept.items() if components[i][1] == i}
    found = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in found.select("doc_id").distinct().collect()} == set(kept)
    pieces = corpus_pipeline.packing.pack(frame.where(F.col("doc_id").isin(list(kept))), "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json")).collect()
    check_packing(pieces, [(i, r.text) for i, r in kept.items()])
    assert sum(r.length for r in pieces) == found.agg(F.sum("length")).collect()[0][0]


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_000, None, None, None, None), (10_001, "", "en", "s", 0), (None, None, None, None, None)], docs.schema)
    held = docs.limit(60).union(extra).union(docs.limit(3)).withColumns({c: F.lit(7) for c in ("kept", "score", "n_words", "lang_pred", "id", "label", "component_id")})
    columns = held.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        held = stage(spark, held, SF)
        assert held.columns == columns
    assert held.where("kept = 7 AND score = 7 AND n_words = 7").count() == held.count()
    ids = [r.doc_id for r in held.select("doc_id").collect()]
    assert 10_000 not in ids and None not in ids and ids
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_every_operator_has_one_query():
    import __spark_entry__

    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())
