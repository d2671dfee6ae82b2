"""Whitening against numpy on all vectors at once."""

import math

import numpy as np
import pytest

from cardloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, component int, n string"


def plain(vectors, components=16):
    """{row number: (n, deviation, whitened up to sign, explained)} of finite vectors of one length."""
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in fit])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    own = np.array([[(n * a - s) / n for a, s in zip(v, sums)] for v in x])
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    return n, deviations, own @ axes / np.sqrt(values), values / np.trace(covariance)


def rows_of(spark, vectors, ids=None):
    ids = range(len(vectors)) if ids is None else ids
    return spark.createDataFrame([(i, v, 1, "clash") for i, v in zip(ids, vectors)], SCHEMA).repartition(7)


@pytest.mark.parametrize("shift, dimensions", [(0.0, 20), (3e4, 20), (0.0, 5)])
def test_equals_numpy(spark, shift, dimensions):
    rng = np.random.default_rng(5)
    scales = np.linspace(3, 0.5, dimensions)
    vectors = (rng.normal(size=(400, dimensions)) * scales + shift).astype(np.float32)
    vectors = [*vectors.tolist(), *vectors[:50].tolist(), vectors[0].tolist(), vectors[0].tolist()]
    bad = [None, [], [math.nan] * dimensions, [math.inf] * dimensions, [None] * dimensions, [1.0] * (dimensions + 1)]
    got = whitening.whiten(rows_of(spark, vectors + bad)).toPandas()
    n, deviations, white, explained = plain(vectors)
    k = min(16, dimensions)
    assert n < len(vectors) and len(got) == len(vectors) * k and set(got["n"]) == {n}
    table = got.pivot(index="vec_id", columns="component", values="whitened").sort_index()
    assert list(table.index) == list(range(len(vectors))) and list(table.columns) == list(range(1, k + 1))
    signs = np.sign((table.to_numpy() * white).sum(axis=0))
    assert np.abs(table.to_numpy() * signs - white).max() < 1e-7
    assert got.drop_duplicates("vec_id").sort_values("vec_id")["deviation"].tolist() == deviations
    assert np.abs(got.drop_duplicates("component").sort_values("component")["explained"] - explained).max() < 1e-12
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_merging_equals_all_at_once():
    rng = np.random.default_rng(8)
    x = rng.integers(-500, 500, size=(97, 6)) + 1_000_000
    whole = whitening.moments(x)
    parts = [whitening.moments(p) for p in np.array_split(x, [1, 4, 50, 51])]
    held = parts[0]
    for p in parts[1:]:
        held = whitening.merged(held, p)
    assert held.n == 97 and held.sums == whole.sums == tuple(x.sum(axis=0).tolist())
    assert np.allclose(held.scatter, np.cov(x.T, bias=True) * 97, rtol=1e-12) and np.allclose(whole.scatter, held.scatter, rtol=1e-12)


def test_large_entries(spark):
    """Entries beyond a long are taken as the largest; what doesn't fit a long is null."""
    got = whitening.whiten(rows_of(spark, [[1e30, 0.0], [-1e30, 1.0], [0.0, 2.0], [5.0, 3.0]])).toPandas()
    assert len(got) == 4 and set(got["component"]) == {1} and got["deviation"].isna().sum() == 2  # the second is rounding beside the first
    assert np.isfinite(got["whitened"]).all()


def test_too_little_to_whiten(spark):
    assert whitening.whiten(rows_of(spark, [])).count() == 0
    assert whitening.whiten(rows_of(spark, [[1.0, 2.0], [1.0, 2.0]])).count() == 0
    got = whitening.whiten(rows_of(spark, [[1.0, 2.0], [2.0, 4.0], None], [None, 5, 6])).collect()
    assert [(r.vec_id, r.component, abs(round(r.whitened, 9)), round(r.explained, 9)) for r in sorted(got, key=lambda r: r.vec_id or 0)] == [(None, 1, 1.0, 1.0), (5, 1, 1.0, 1.0)]
