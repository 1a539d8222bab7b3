"""Language identification and the quality classifier."""

import numpy as np
from pyspark.sql import functions as F

from skyledger.llm import cotrain, langid
from skyledger.llm.common import stored
from skyledger.llm.queries import op2_hyperdimensional_langid, op7_cotraining_quality

SF = "/root/testdata/sf0.01"


def test_held_out_texts_get_their_language(spark):
    found = op2_hyperdimensional_langid(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    rows = found.where(F.col("held_out") & (F.size(F.split("text", " ")) >= 10)).collect()
    assert len(rows) > 250 and sum(r.lang == r.lang_pred for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_profiles_are_sums_of_bound_vectors():
    a, b, c = langid._letters(langid.DIMENSIONS)
    code = lambda s: [0, *[ord(x) - 96 for x in s], 0]
    want = sum(a[p[i]] * b[p[i + 1]] * c[p[i + 2]] for p in map(code, ("the", "cat")) for i in range(len(p) - 2))
    assert np.array_equal(langid.profiles(["The  CAT!!"])[0], want.astype(np.float32))
    assert not langid.profiles([""]).any() and langid.profiles([]).shape == (0, langid.DIMENSIONS)


def test_long_texts_are_counted_in_parts(monkeypatch):
    text = "lorem ipsum dolor sit amet " * 400
    whole = langid.profiles([text, "x"])
    monkeypatch.setattr(langid, "BLOCK_LETTERS", 27 * 37)
    parts = langid.profiles([text, "x"])
    assert np.abs(parts - whole).max() <= 2 * (len(text) // (27 * 37) + 1) and np.array_equal(parts[1], whole[1])


def plain_profile(text):
    """A profile letter by letter: the sum over all trigrams around a letter of the products of three rotated vectors."""
    a, b, c = langid._letters(langid.DIMENSIONS)
    classes, out = [0], np.zeros(langid.DIMENSIONS)
    for letter in text:
        low = ord(letter.lower()[0]) if letter.isalpha() else -1
        now = 0 if low < 0 else low - 96 if 97 <= low <= 122 else 27 + low % (langid.CLASSES - 27)
        if now or classes[-1]:
            classes.append(now)
    if classes[-1]:
        classes.append(0)
    for x, y, z in zip(classes, classes[1:], classes[2:]):
        if y:
            out += a[x].astype(int) * b[y] * c[z]
    return out


def test_predictions_match_a_plain_version(spark):
    """The whole query, recomputed letter by letter: prototypes of the rows that are not held out, then cosines of all rows."""
    import zlib

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    made = {r.doc_id: plain_profile(r.text or "") for r in docs}
    model = {}
    for r in docs:
        if r.lang is not None and r.text is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            model[r.lang] = model.get(r.lang, 0) + made[r.doc_id]
    found = {r.doc_id: r for r in op2_hyperdimensional_langid(spark, sf).collect()}
    assert set(found) == set(made)
    for i, v in made.items():
        if not v.any():
            assert found[i].lang_pred == "und" and found[i].score == 0
            continue
        cosines = {k: v @ m / np.linalg.norm(v) / np.linalg.norm(m) for k, m in model.items()}
        best = max(cosines.values())
        assert abs(found[i].score - max(0, best)) < 1e-5 and cosines[found[i].lang_pred] > best - 1e-5
        assert found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_memory_is_bounded_on_many_scripts(monkeypatch):
    import tracemalloc

    draw = np.random.default_rng(3)
    texts = ["".join(map(chr, row)) for row in draw.integers(0x4E00, 0x9FFF, (256, 2000))]
    langid.profiles(["warm up"])
    tracemalloc.start()
    whole = langid.profiles(texts)
    langid.profiles(["".join(texts) * 40])  # 20 million letters in one text
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20, peak
    monkeypatch.setattr(langid, "CELLS", 50_000)
    assert np.abs(langid.profiles(texts[:20]) - whole[:20]).max() < 1e-3


def test_many_languages_are_counted_in_turns(spark, monkeypatch):
    rows = [(f"{a}{b}x {b}{a}y {a}{a}", f"{a}{b}") for a in "abcdef" for b in "uvwxyz"] * 3
    df = spark.createDataFrame(rows, "text string, lang string").repartition(2)
    model = langid.train(df, "text", "lang")
    for name in ("au", "fz"):
        want = plain_profile(f"{name}x {name[::-1]}y {name[0] * 2}")
        assert np.allclose(model[name], want / np.linalg.norm(want), atol=1e-6)
    assert len(model) == 36 > langid.HELD_LANGUAGES


def test_plausible_texts_stay(spark):
    import random

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("length(text) >= 200")
    draw = random.Random(4)
    odd = [(-i - 1, " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(80)), "en") for i in range(20)]
    odd += [(-100 - i, " ".join("".join(draw.sample(w, len(w))) for w in r.text.split()), r.lang) for i, r in enumerate(docs.limit(20).collect())]
    odd += [(-200, None, "en"), (-201, "12 34", "en")]
    both = docs.union(spark.createDataFrame(odd, docs.schema)).withColumn("_lang", F.lit("own"))
    kept = langid.plausible(both, "TEXT", langid.train(docs.where(~langid.held_out("doc_id")), "text", "lang"))
    assert kept.columns == both.columns and kept.where("_lang = 'own'").count() == kept.count()
    ids = {r.doc_id for r in kept.collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()} & {r.doc_id for r in docs.collect()}
    assert len(good & ids) >= 0.98 * len(good) and not {i for i in ids if i < 0}
    assert langid.plausible(both.limit(0), "text", {}).count() == 0


def test_odd_rows(spark):
    rows = [(1, "the cat and the hat", "en"), (2, None, "en"), (3, "", "en"), (4, "12 $$ 34", "de"), (5, "der hund und die katze", "de"), (5, "der hund und die katze", "de"), (None, "the dog", None), (7, "你好" * 30_000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("old"))
    model = langid.train(df, "text", "lang")
    assert sorted(model) == ["de", "en"]
    found = {(r.doc_id, r.text and r.text[:3]): r for r in langid.predict(df, "text", model).collect()}
    assert len(found) == 7 and found[1, "the"].lang_pred == "en" and found[5, "der"].lang_pred == "de" and found[None, "the"].lang_pred == "en"
    assert [found[k].lang_pred for k in ((2, None), (3, ""), (4, "12 "))] == ["und"] * 3 and found[2, None].score == 0
    assert langid.predict(df.limit(0), "text", model).count() == 0
    nothing = langid.train(df.limit(0), "text", "lang")
    assert nothing == {} and {r.lang_pred for r in langid.predict(df, "text", nothing).collect()} == {"und"}
    flags = {r.doc_id: r.h for r in df.select("doc_id", langid.held_out("doc_id").alias("h")).collect()}
    import zlib

    assert all(flags[i] == (zlib.crc32(str(i).encode()) % 3 == 1) for i in (1, 2, 3, 4, 5, 7)) and flags[None] is False


def test_classifier_on_labels_it_never_saw(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = cotrain.classify(docs, labels.where("doc_id % 3 <> 0")).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    assert len(rows) > 100 and sum(r.kept == (r.quality == 1) for r in rows) >= 0.95 * len(rows)
    assert op7_cotraining_quality(spark, SF).count() == docs.count()


def two_views(n, seed):
    """Documents whose quality shows, with noise, in their words and in their source; each alone is often wrong."""
    import random

    draw = random.Random(seed)
    rows, truth = [], {}
    for i in range(n):
        truth[i] = draw.random() < 0.5
        words = [draw.choice(["bad!", "shout", "WIN"] if (draw.random() < 0.72) != truth[i] else ["calm", "prose", "lines"]) if draw.random() < 0.1 else draw.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60)]
        source = draw.choice([f"good{k}" for k in range(12)] if (draw.random() < 0.85) == truth[i] else [f"poor{k}" for k in range(12)])
        rows.append((i, " ".join(words), "en", source, 300))
    return rows, truth


def plain_training(rows, label):
    """The same rounds over plain arrays; rows: features by id, label: of some ids."""
    import zlib

    ids = sorted(label, key=lambda i: (zlib.crc32(str(i).encode()), i))
    views = [np.array([rows[i][k] for i in ids], np.float64) for k in (0, 1)]
    rest = [np.array([rows[i][k] for i in rows if i not in label], np.float64) for k in (0, 1)]
    y, held = np.array([label[i] for i in ids], float), np.arange(len(ids)) % 4 == 3
    prior, own = float(y.mean()), ~held
    weights = [cotrain.fit(x[own], y[own]) for x in views]
    width = 2 * cotrain.SPAN / cotrain.BINS
    for k in range(1, cotrain.ROUNDS + 1):
        picked = []
        for known, x, w in zip(views, rest, weights):
            scale, offset = cotrain.calibration(known[held] @ w, y[held])
            z = scale * (x @ w) + offset
            cells = np.clip(np.floor((z + cotrain.SPAN) / width), 0, cotrain.BINS - 1).astype(int)
            most, side = cotrain.SHARE * k * len(z), {}
            for cls, share in ((1, prior), (0, 1 - prior)):
                order = sorted(set(cells.tolist()), reverse=bool(cls))
                cell, n = order[0], (cells == order[0]).sum()
                for new in order[1:]:
                    if (n := n + (cells == new).sum()) > most * share:
                        break
                    cell = new
                # The edge may lie anywhere up to the first cell that is not taken.
                if cls and (left := [c for c in order if c < cell]) and (cells >= cell).sum() <= most * share:
                    cell = left[0] + 1
                if not cls and (left := [c for c in order if c > cell]) and (cells <= cell).sum() <= most * share:
                    cell = left[0] - 1
                side[cls] = max(np.log(cotrain.SURE / (1 - cotrain.SURE)) + max(0, np.log(prior / (1 - prior))), cell * width - cotrain.SPAN) if cls else min(-np.log(cotrain.SURE / (1 - cotrain.SURE)) + min(0, np.log(prior / (1 - prior))), (cell + 1) * width - cotrain.SPAN)
            picked.append((np.flatnonzero((z >= side[1]) | (z <= side[0])), z))
        for _ in range(cotrain.STEPS):
            new = []
            for taker in (0, 1):
                at, z = picked[1 - taker]
                x, t = np.concatenate([views[taker][own], rest[taker][at]]), np.concatenate([y[own], (z[at] > 0).astype(float)])
                p = 1 / (1 + np.exp(-x @ weights[taker]))
                scale = np.concatenate([np.ones(own.sum()), np.full(len(at), own.sum() / max(1, len(at)))])
                move = np.linalg.solve((x * (scale * (p * (1 - p) + 1e-9))[:, None]).T @ x + np.eye(x.shape[1]), x.T @ (scale * (t - p)) - weights[taker])
                new.append(weights[taker] + move * min(1, 4 / np.linalg.norm(move)))
            weights = new
    return weights, [len(a) for a, _ in picked]


def test_training_matches_a_plain_version(spark):
    rows, truth = two_views(1500, 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = spark.createDataFrame([(i, int(truth[i])) for i in range(0, 1500, 10)], "doc_id long, quality int")
    features = stored(cotrain.featured(docs), "features")
    model = cotrain.train(features, labels)
    plain = {r.id: (np.frombuffer(r.content, np.float32), np.frombuffer(r.meta, np.float32)) for r in features.collect()}
    want, given = plain_training(plain, {i: int(truth[i]) for i in range(0, 1500, 10)})
    assert min(given) > 20
    for a, b in zip(model.weights, want):
        assert np.abs(a - b).max() < 1e-3 * max(1, np.abs(b).max())
    found = {r.doc_id: r for r in cotrain.scored(features, model).collect()}
    for i in range(1, 1500, 97):
        a, b = (s * float(plain[i][k] @ w.astype(float)) + o for k, (w, (s, o)) in enumerate(zip(model.weights, model.scales)))
        prior = sum(truth[j] for j in range(0, 1500, 10)) / 150
        assert abs(found[i].score - 1 / (1 + np.exp(-(a + b - np.log(prior / (1 - prior)))))) < 1e-6


def test_views_teach_each_other(spark):
    """Where few documents are labelled and neither view suffices, the rounds add to what the labels alone give."""
    gains = []
    for seed in (3, 4, 5):
        rows, truth = two_views(4000, seed)
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        labels = spark.createDataFrame([(i, int(truth[i])) for i in range(0, 4000, 100)], "doc_id long, quality int")
        features = stored(cotrain.featured(docs), "features")
        right = []
        for rounds in (0, cotrain.ROUNDS):
            found = cotrain.scored(features, cotrain.train(features, labels, rounds=rounds)).collect()
            right.append(sum(r.kept == truth[r.doc_id] for r in found if r.doc_id % 100) / 3960)
        gains.append(right)
    print(gains)
    assert all(b > a for a, b in gains) and sum(b - a for a, b in gains) > 0.03, gains


def test_classifier_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    docs = spark.createDataFrame([(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (2, "a", "en", "s", 1, "x"), (None, "b" * 100_000, "de", "s", -5, "x")], schema).withColumns({c: F.lit("x") for c in ("id", "label", "at", "v")})
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in cotrain.classify(docs, none).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    assert {r.score for r in cotrain.classify(docs, one).collect()} == {1.0}
    assert cotrain.classify(docs.limit(0), none).count() == 0
    two = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    assert cotrain.classify(docs, two).count() == 4
    many = spark.range(3000).selectExpr("7L AS doc_id", "'same words' AS text", "'en' AS lang", "'s' AS source", "10L AS n_chars").unionByName(docs.select("doc_id", "text", "lang", "source", "n_chars"))
    assert cotrain.classify(many, spark.createDataFrame([(7, 1), (1, 0), (2, 0)], "doc_id long, quality int"), max_labelled=2).count() == 3004
