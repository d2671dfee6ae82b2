"""Toxicity and quality on held-out documents."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.llm import pu, quality, toxicity


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(rng.randrange(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(900):
        toxic, good = rng.random() < 0.2, rng.random() < 0.7
        own = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        if toxic:
            own[3:5] = [rng.choice(["vilest", "rotter", "cretin"]), rng.choice(["vilest", "rotter", "cretin"])]
        docs.append((i, " ".join(own if good else [w + "###" for w in own]), "en", "s"))
        if i % 2 == 0:
            labels.append((i, int(good), int(toxic)))
    docs += [(1000, None, None, None), (1001, "", None, None)]
    labels += [(None, 1, 1), (2, None, None), (5000, 1, 1)]
    truth = {r[0]: r for r in labels}
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), truth


@pytest.mark.parametrize("kind, column", [(toxicity, 2), (quality, 1)])
def test_held_out_documents(tables, kind, column):
    docs, labels, truth = tables
    model = kind.learn(docs, labels)
    again = kind.learn(docs.repartition(3), labels.repartition(2))
    assert model.weights == again.weights
    scores = {r.doc_id: r.s for r in docs.select("doc_id", kind.score(model, F.col("text")).alias("s")).collect()}
    assert len(scores) == 902 and scores[1000] == scores[1001] and all(0 <= s <= 1 for s in scores.values())
    held = [i for i, r in truth.items() if i is not None and i < 900 and zlib.crc32(str(i).encode()) % kind.PARTS == kind.HELD_OUT and r[column] is not None]
    positive, negative = ([scores[i] for i in held if truth[i][column] == v] for v in (1, 0))
    auc = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative) / (len(positive) * len(negative))
    assert auc > 0.97


def test_nothing_to_learn_from(spark, tables):
    docs, labels, _ = tables
    model = toxicity.learn(docs, labels.limit(0))
    assert docs.limit(3).select(toxicity.score(model, F.col("text")).alias("s")).distinct().count() == 1
    assert toxicity.learn(docs.limit(0), labels.limit(0)).score({"x"}) <= 1


def test_fold_is_crc32_of_the_id(spark):
    rows = spark.range(50).select("id", pu.fold(F.col("id"), 3).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 3 for r in rows)


def test_every_part_of_a_long_run_bears_on_quality():
    clean, odd = "漢字仮名" * 15, "#a#9~b^" * 9
    assert quality.traits(clean * 50 + odd * 40) != quality.traits(clean * 50 + clean * 40)
    assert quality.traits("a1" * 3 + "#%" * 20) != quality.traits("a1" * 23)  # beyond the sixth mark
    assert quality.traits("plain words, as ever. NASA 12:30 x") == quality.traits("other words, so long. ESSO 99:11 y")


def plain_risk(theta, rows, prior):
    """(risk on positives, risk on negatives) by the definition; rows are (feature values, positive)."""
    losses = {True: ([], []), False: ([], [])}
    for values, positive in rows:
        f = sum(theta[k] * v for k, v in values.items()) + theta[-1]
        losses[positive][0].append(math.log1p(math.exp(-f)))
        losses[positive][1].append(math.log1p(math.exp(f)))
    mean = lambda x: sum(x) / len(x)
    return prior * mean(losses[True][0]), mean(losses[False][1]) - prior * mean(losses[True][1])


def plain_fit(rows, prior, width):
    """Adam over numeric derivatives of the risk; a negative second part is turned round."""
    theta = [0.0] * width + [math.log(prior / (1 - prior))]
    mean, square = [0.0] * (width + 1), [0.0] * (width + 1)
    for step in range(1, pu.ROUNDS + 1):
        sign = 1 if plain_risk(theta, rows, prior)[1] >= 0 else -1

        def goal(moved):
            own, other = plain_risk(moved, rows, prior)
            return own + sign * other + pu.DECAY / 2 * sum(t * t for t in moved[:-1])

        slope = []
        for k in range(width + 1):
            up, down = list(theta), list(theta)
            up[k] += 1e-5
            down[k] -= 1e-5
            slope.append((goal(up) - goal(down)) / 2e-5)
        for k, g in enumerate(slope):
            mean[k], square[k] = 0.9 * mean[k] + 0.1 * g, 0.999 * square[k] + 0.001 * g * g
            theta[k] -= pu.STEP * (mean[k] / (1 - 0.9**step)) / (math.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return theta


@pytest.mark.parametrize("prior", [0.3, 0.9])
def test_risk_is_minimised_as_by_a_plain_version(monkeypatch, prior):
    monkeypatch.setattr(pu, "ROUNDS", 60)
    rng = random.Random(3)
    rows = []
    for i in range(40):
        positive = i < 15
        rows.append(({k: 1.0 for k in range(3) if rng.random() < (0.8 if positive and k == 0 else 0.3)}, positive))
    row, column, value = zip(*((i, k, v) for i, (values, _) in enumerate(rows) for k, v in values.items()))
    bias, weights = pu._descend(np.array(row), np.array(column), np.array(value), np.array([p for _, p in rows]), prior, 3)
    assert np.allclose([*weights, bias], plain_fit(rows, prior, 3), atol=2e-3)
    own, other = plain_risk([*weights, bias], rows, prior)
    assert own + max(0, other) < sum(plain_risk([0, 0, 0, math.log(prior / (1 - prior))], rows, prior))


def test_features_weights_and_scores_equal_plain_ones(spark):
    """Counts, likelihood ratios and the choice of features by loops; scores by the formula."""
    rng = random.Random(4)
    docs = [(i, " ".join(rng.choice("abcdefgh") * (2 if rng.random() < (0.9 if i < 30 else 0.2) else 1) for _ in range(4)), i < 30) for i in range(90)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, positive boolean")
    model = pu.fit(frame, 0.3, lambda text: set((text or "").split()), scaled=False)
    sets = [(set(t.split()), p) for _, t, p in docs]
    clear = {}
    for name in set().union(*(x for x, _ in sets)):
        a, b = (sum(name in x for x, p in sets if p == side) for side in (True, False))
        share, z = (a + b) / 90, 0.0
        for seen, of in ((a, 30), (b, 60)):
            for n, chance in ((seen, share), (of - seen, 1 - share)):
                z += 2 * n * math.log(n / (of * chance)) if n else 0.0
        if a + b >= pu.LEAST and math.sqrt(z) >= pu.CLEAR:
            clear[name] = math.sqrt(z)
    assert clear and model.weights.keys() == clear.keys()
    names = sorted(clear, key=lambda x: (-clear[x], x))
    pairs = [(i, names.index(x)) for i, (own, _) in enumerate(sets) for x in sorted(own & clear.keys())]
    bias, weights = pu._descend(*map(np.array, zip(*pairs)), np.ones(len(pairs)), np.array([p for _, p in sets]), 0.3, len(names))
    assert math.isclose(model.bias, bias, abs_tol=1e-6) and np.allclose([model.weights[x] for x in names], weights, atol=1e-6)
    for own, _ in sets[:20]:
        assert math.isclose(model.score(own), 1 / (1 + math.exp(-bias - sum(weights[names.index(x)] for x in own & clear.keys()))), abs_tol=1e-6)


def test_repeated_rows_and_other_columns_stay(tables):
    docs, labels, _ = tables
    model = quality.learn(docs, labels)
    twice = docs.unionByName(docs).selectExpr("*", "1 AS positive", "'x' AS names", "2 AS score")
    rows = twice.withColumn("s", quality.score(model, F.col("text"))).collect()
    assert len(rows) == 2 * docs.count() and {(r.positive, r.names, r.score) for r in rows} == {(1, "x", 2)}
    both = quality.learn(docs.unionByName(docs).selectExpr("*", "1 AS positive", "'x' AS sets"), labels.unionByName(labels).selectExpr("*", "'y' AS text"))
    assert both.weights == model.weights
