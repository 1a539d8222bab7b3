"""Near-duplicates and exact top-k search."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import neardup, topk


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def plain_components(texts):
    sets = {i: shingles(t) for i, t in texts}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def family(draw, words, n, most):
    out = [list(words)]
    for _ in range(n - 1):
        copy = list(draw.choice(out))
        for _ in range(draw.randrange(most)):
            copy[draw.randrange(len(copy))] = f"x{draw.randrange(10**6)}"
        out.append(copy)
    return [" ".join(w) for w in out]


def test_matches_brute_force(spark):
    draw = random.Random(3)
    word = lambda: f"w{draw.randrange(5000)}"
    passage = " ".join(word() for _ in range(60))
    texts = [None, "", " \t\n", "one", "ONE", "one two three four", "one two three four", "One two  three four ", "a b c d e", "A b c d e", "É b c d e", "é b c d e", "x" * 9000, "a b c d e f"]
    for _ in range(12):
        texts += family(draw, [word() for _ in range(draw.randrange(6, 90))], draw.randrange(2, 9), 4)
    texts += family(draw, [word() for _ in range(70)], 60, 6)  # many that link only through others
    texts += [f"{passage} " + " ".join(word() for _ in range(draw.randrange(5, 60))) for _ in range(60)]
    texts += ["same text again and again and again"] * 40
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    df = spark.createDataFrame([(i, t, "old", 1) for i, t in rows], "doc_id long, text string, kept string, n_shingles int").repartition(5)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()}
    want = plain_components(rows)
    assert found == want
    assert {r.doc_id for r in neardup.near_duplicates(df).where("kept").collect()} == {i for i, (_, c) in want.items() if i == c}


def test_odd_tables(spark):
    schema = "doc_id long, text string"
    assert neardup.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (9, "A b c d e f"), (7, None)]
    found = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, schema)).collect())
    assert found == [(-1, 2, -1, True), (5, 2, 5, True), (5, 2, 5, True), (7, 0, 7, True), (9, 2, 5, False)]


def test_rows_that_repeat_an_id_are_compared_once(spark, monkeypatch):
    """Two ids of 3,000 rows each, and a document of several texts that brings two groups together."""
    a, b = "one two three four five six seven eight nine", "one two three four five six seven eight nine ten"
    rows = [(1, a), (2, b)] * 3000 + [(3, "x y z u v w"), (4, "x y z u v w"), (5, "p q r s t"), (4, "p q r s t"), (4, "P q r s t"), (6, ""), (6, "only here")]
    met = []
    screen = neardup.screened
    monkeypatch.setattr(neardup, "screened", lambda pairs, sketch: met.append((pairs.count(), sketch.count())) or screen(pairs, sketch))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = Counter((r.doc_id, r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect())
    assert found == Counter({(1, 5, 1): 3000, (2, 6, 1): 3000, (3, 2, 3): 1, (4, 2, 3): 1, (4, 1, 3): 2, (5, 1, 3): 1, (6, 0, 6): 1, (6, 1, 6): 1})
    assert met[0][0] <= 2 and met[0][1] <= 6


@pytest.mark.parametrize("words, texts", [(60, 90), (1100, 60)])  # the sets of the first go along, those of the second are joined
def test_blocks_of_a_large_key(spark, monkeypatch, words, texts):
    draw = random.Random(8)
    base = [f"w{i}" for i in range(words)]
    texts = family(draw, base, texts, words // 5)
    monkeypatch.setattr(neardup, "BLOCK_MEMBERS", 16)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(df).collect()} == plain_components(list(enumerate(texts)))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 60)] + [(5, 5), (3, 2)]
    found = {r.id: r.label for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 60)} | {2: 2, 3: 2}
    assert neardup.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketches_estimate_jaccard():
    draw = np.random.default_rng(1)
    for n in (3, 40, 2000):
        for share in (0.5, 0.75, 0.95):
            values = draw.integers(0, 1 << 64, (200, 2 * n), np.uint64)
            both = round(n * 2 * share / (1 + share))
            a = [np.unique(v[:n]) for v in values]
            b = [np.unique(np.concatenate([v[:both], v[n : 2 * n - both]])) for v in values]
            made = neardup.estimate(neardup.registers(a), neardup.registers(b), np.full(200, n), np.full(200, n))
            assert abs(made.mean() - both / (2 * n - both)) < 0.04
    apart = [np.unique(draw.integers(0, 1 << 64, 500, np.uint64)) for _ in range(400)]
    table = neardup.registers(apart)
    assert abs(neardup.estimate(table[:200], table[200:], np.full(200, 500), np.full(200, 500)).mean()) < 0.003


def test_links_of_small_sets_are_not_screened_out(spark):
    draw = np.random.default_rng(5)
    values = draw.integers(0, 1 << 64, (3000, 8), np.uint64)
    low = 0
    for a, b in ((4, 3), (8, 6)):
        x, y = (neardup.registers([np.sort(v[:k]) for v in values]) for k in (a, b))
        made = neardup.estimate(x, y, np.full(3000, a), np.full(3000, b))
        low += int((made < 0.6).sum())
        assert neardup.may_link(made, np.full(3000, a), np.full(3000, b)).all()
    assert low  # such estimates occur
    assert neardup.may_link(np.array([0.45, 0.9, 0.9]), np.array([600, 600, 3]), np.array([600, 600, 5])).tolist() == [False, True, False]
    # Eight words and seven of them: 4 and 3 shingles, J = 0.75, in families of their own.
    rows = []
    for i in range(1500):
        words = [f"{i}x{j}" for j in range(8)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[:7]))]
    found = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id // 2 * 2 for r in found)


def test_long_texts_are_hashed_in_parts(monkeypatch):
    import tracemalloc

    draw = np.random.default_rng(6)
    texts = [" ".join(map(str, draw.integers(0, 500, 900))), "x" * 9000 + " " + "y" * 5000 + "  z\ta b c d " + "w" * 7000, "é \n" * 3000, " " * 5000 + "a", "a b c" + " " * 6000, "q" * 20_000]
    whole = neardup.shingle_sets(texts)
    for size in (1, 7, 64, 1000, 4096):
        monkeypatch.setattr(neardup, "BLOCK_BYTES", size)
        for i in range(len(texts)) if size > 60 else (3, 4):
            assert np.array_equal(neardup.shingle_sets([texts[i], "b"])[0], whole[i]), (size, i)
    monkeypatch.undo()
    long = " ".join(map(str, draw.integers(0, 1 << 40, 2_000_000)))  # 26 MB, nearly all shingles distinct
    tracemalloc.start()
    (made,) = neardup.shingle_sets([long])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(made) > 1_990_000 and peak < 8 * len(long), peak / len(long)


def test_word_hashes_tell_words_apart():
    long = ["a" * 5000 + "b" + "a" * 5000, "a" * 4096 + "b" + "a" * 5904, "a" * 10001]
    hashes, n = neardup.word_hashes([x.encode() for x in [*long, "ab ba", "b a", ""]])
    assert n.tolist() == [1, 1, 1, 2, 2, 0] and len(set(hashes.tolist())) == 7


def plain_top(rows, k=5):
    usable = [(i, [int(np.floor(256 * np.float64(x))) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in dict((i, v) for i, v in usable if i % 50 == 0).items():
        scores = sorted((-sum(x * y for x, y in zip(a, v)), i) for i, v in usable if i != q and len(v) == len(a))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("spread", [0.0, 1.5])
def test_top_k_matches_brute_force(spark, spread):
    draw = np.random.default_rng(5)
    vectors = draw.normal(size=(700, 12)) * np.exp(spread * draw.normal(size=(700, 1)))
    vectors[300:420] = vectors[300]  # ties
    vectors[100:200] = np.abs(vectors[100:200]) @ np.diag([9, *[0.01] * 11])  # close to one direction
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1050, []), (1100, [1.0, None] + [0.0] * 10), (1150, [float("nan")] * 12), (1200, [float("inf")] * 12), (1250, [0.0] * 12), (1300, [1.0, 2.0]), (1301, [3.0, 4.0]), (None, [5.0] * 12)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    found = topk.top_k(df, "vec_id", "embedding", F.expr("vec_id % 50 = 0"))
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == plain_top(rows)


@pytest.mark.parametrize("outliers", [0, 1, 3])
def test_a_few_long_vectors_take_no_pruning_away(spark, monkeypatch, outliers):
    """Of 3,000 vectors of spread lengths under half meet queries, though some are far longer than the rest; one dimension has no query."""
    draw = np.random.default_rng(11)
    vectors = draw.normal(size=(3000, 16))
    vectors *= np.exp(draw.uniform(0, 3, size=(3000, 1))) / np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors[7 : 7 + outliers] *= 50 * np.exp(3) / np.linalg.norm(vectors[7 : 7 + outliers], axis=1, keepdims=True)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(3001, [1.0, 2.0, 3.0])]
    met, units = [], topk._units
    monkeypatch.setattr(topk, "_units", lambda work, k: met.append((work.where("NOT is_query").count(), work.where("is_query").count(), work.select(*topk.UNIT).distinct().count())) or units(work, k))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.top_k(df, "vec_id", "embedding", F.expr("vec_id % 50 = 0"))
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in found.collect()) == plain_top(rows)
    buckets = df.where("size(embedding) = 16").select(topk.quantised("embedding").alias("v")).select(F.floor(F.log(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))) / np.log(topk.BUCKET_RATIO))).distinct().count()
    (first, _, _), (others, asked, _) = met
    assert topk.LEAST_ROWS * 0.6 <= first <= topk.SEED_ROWS + 200 and others < 1500 and asked < 60 * buckets / 2


def test_top_k_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    ask = F.expr("vec_id % 50 = 0")
    assert topk.top_k(spark.createDataFrame([], schema), "vec_id", "embedding", ask).count() == 0
    assert topk.top_k(spark.createDataFrame([(0, [1.0])], schema), "vec_id", "embedding", ask).count() == 0
    rows = [(0, [1e9, 2.0]), (0, [1e9, 2.0]), (1, [-1e9, 3.0]), (2, [1e9, 1.0]), (2, [1e9, 1.0])]
    found = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(spark.createDataFrame(rows, schema), "vec_id", "embedding", ask).collect())
    best = (256 * 10**9) ** 2
    saturated = (1 << 63) - 1
    assert best > saturated and found == [(0, 1, 2, saturated), (0, 2, 2, saturated), (0, 3, 1, -(1 << 63))]


def test_prunings_lose_nothing():
    draw = np.random.default_rng(2)
    c = np.floor(draw.normal(size=(500, 8)) * 256)
    q = c[:20] + np.floor(draw.normal(size=(20, 8)) * 10)
    exact = (q @ c.T).astype(np.int64)
    for rank in (5, 1):
        floor = np.sort(exact, axis=1)[:, -rank].astype(float)
        found = topk.best_of(q, np.arange(1000, 1020), floor, c, np.arange(500), 5)
        for i in range(20):
            want = sorted(((-s, j) for j, s in enumerate(exact[i].tolist()) if s >= floor[i]))[:5]
            assert [(x[1], x[2]) for x in found if x[0] == 1000 + i] == [(j, -s) for s, j in want]
