"""The hash-prefix forest against brute force."""

import numpy as np
import pytest

from cardloom.llm import ann

SCHEMA = "vec_id long, embedding array<float>, score string"


def found(vectors, queries, k=20):
    rows = ann.nearest(vectors, queries, k).collect()
    out = {}
    for r in sorted(rows):
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


@pytest.mark.parametrize("clustered", [False, True])
def test_recall(spark, clustered, monkeypatch):
    monkeypatch.setattr(ann, "SEGMENT", 200)
    rng = np.random.default_rng(8)
    v = rng.normal(size=(1500, 16))
    if clustered:  # a third in one tight group, with lengths that differ
        v[:500] = v[0] + 0.05 * rng.normal(size=(500, 16))
        v *= rng.uniform(0.5, 2, size=(1500, 1))
    v = v.astype(np.float32)
    frame = spark.createDataFrame([(i, x.tolist(), "clash") for i, x in enumerate(v)], SCHEMA)
    got = found(frame, frame.where("vec_id % 20 = 0"))
    w = v.astype(float)
    hits = 0
    for q in range(0, 1500, 20):
        scores = w @ w[q]
        scores[q] = -np.inf
        best = np.argsort(-scores, kind="stable")[:20]
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        assert all(abs(s - scores[i]) < 1e-9 for _, i, s in got[q])
        hits += len({i for _, i, _ in got[q]} & set(best.tolist()))
    assert hits / (20 * 75) >= 0.93


def test_ties_and_rows_that_take_no_part(spark):
    rows = [(i, [1.0, 2.0], "") for i in (4, 2, 9, 7)] + [(9, [1.0, 2.0], ""), (0, [1.0, 1.0], ""), (1, None, ""), (3, [0.0, 0.0], ""), (5, [None, 1.0], ""), (6, [float("nan"), 1.0], ""), (8, [float("inf"), 1.0], ""), (None, [1.0, 1.0], ""), (10, [1.0], ""), (11, [], "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = found(frame, frame.where("vec_id IN (0, 3, 4, 10, 11)"), k=3)
    assert got == {0: [(1, 2, 3.0), (2, 4, 3.0), (3, 7, 3.0)], 4: [(1, 2, 5.0), (2, 7, 5.0), (3, 9, 5.0)]}
    assert found(frame.limit(0), frame) == {} and found(frame, frame.limit(0)) == {}


def test_depth_follows_likeness():
    assert ann.depths(0.99) > ann.depths(0.7) > ann.depths(0.3)
    assert ann.depths(-1.0)[0] == 0


def test_a_segment_that_many_queries_come_to_is_read_by_several_tasks(spark, monkeypatch):
    """Parts of a segment give what the whole gives; so do columns of doubles."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(600, 8)).astype(np.float32)
    frame = spark.createDataFrame([(i, x.tolist(), "") for i, x in enumerate(v)], SCHEMA)
    monkeypatch.setattr(ann, "SEGMENT", 100)
    whole = found(frame, frame)
    monkeypatch.setattr(ann, "BLOCK", 40)
    assert found(frame, frame) == whole
    double = frame.withColumn("embedding", frame.embedding.cast("array<double>"))
    assert {q: [(r, i) for r, i, _ in x] for q, x in found(double, double).items()} == {q: [(r, i) for r, i, _ in x] for q, x in whole.items()}
