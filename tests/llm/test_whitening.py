"""Whitening against a dense eigendecomposition in numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest

from conftest import SMALL
from landfall.llm.queries import op11_whitening
from landfall.llm.whitening import Settings, fit_whitening, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, component string, n int"


def frame(spark, vectors, ids=None):
    rows = [
        (i if ids is None else ids[i], v, 0, "x", "c", 3)
        for i, v in enumerate(None if v is None else [None if c is None else float(c) for c in v] for v in vectors)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def usable(vectors, dims):
    return [
        (i, v) for i, v in enumerate(vectors)
        if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)
    ]


def expected(vectors, dims, components=16):
    """Eigenvalues, eigenvectors, and per usable row its number, deviation and centred vector."""
    rows = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in usable(vectors, dims)]
    distinct = sorted({tuple(x) for _, x in rows})
    n, sums = len(distinct), [sum(column) for column in zip(*distinct)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in distinct])
    values, q = np.linalg.eigh(centred.T @ centred / n)
    deviations = [(i, sum((n * c - s) ** 2 for c, s in zip(x, sums)), x) for i, x in rows]
    return n, sums, values[::-1][:components], q[:, ::-1][:, :components], values.sum(), deviations


def check(found, vectors, dims, ids=None, components=16, tolerance=1e-8):
    n, sums, values, q, trace, rows = expected(vectors, dims, components)
    kept = int((values > 1e-9 * values[0]).sum())
    by_row = {}
    for r in found:
        by_row.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    assert len(found) == kept * len(rows)
    for i, deviation, x in rows:
        mine = by_row[i if ids is None else ids[i], deviation]
        assert sorted(mine) == list(range(1, kept + 1))
    signs = None
    for i, deviation, x in rows:
        mine = by_row[i if ids is None else ids[i], deviation]
        got = np.array([mine[c][0].whitened for c in range(1, kept + 1)])
        centred = np.array([(n * c - s) / n for c, s in zip(x, sums)])
        want = centred @ q[:, :kept] / np.sqrt(values[:kept])
        if signs is None and np.abs(want).min() > 1e-3:
            signs = np.sign(want * got)
        if signs is not None:
            np.testing.assert_allclose(got * signs, want, atol=tolerance)
    for r in found:
        assert r.n == n and r.identity_error <= 1e-4
        assert r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)


def spectrum(n, dims, scales, seed=0):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    return (rng.standard_normal((n, dims)) * scales) @ turn + 3.0


@pytest.mark.parametrize("name", ["falling", "flat", "one large"])
def test_components_agree_with_a_dense_decomposition(spark, name):
    scales = {
        "falling": 4.0 * 0.93 ** np.arange(64), "flat": np.full(64, 1.0),
        "one large": np.r_[200.0, 30.0, np.full(62, 0.7)],
    }[name]
    vectors = [list(v) for v in spectrum(700, 64, scales)]
    check(whiten(frame(spark, vectors).repartition(3)).collect(), vectors, 64)


def test_odd_rows_are_left_out_and_copies_count_once(spark):
    good = [list(v) for v in spectrum(80, 6, np.arange(1, 7.0))]
    bad = [None, [], [1.0] * 5, [None, *[1.0] * 5], [math.nan, *[1.0] * 5], [math.inf, *[1.0] * 5]]
    vectors = [*good, *bad, *[good[0]] * 40]
    ids = [*range(80), *range(80, 86), *range(100, 139), None]
    found = whiten(frame(spark, vectors, ids)).collect()
    check(found, vectors, 6, ids)
    assert len(found) == 6 * 120 and sum(r.vec_id is None for r in found) == 6


def test_tied_and_missing_components(spark):
    corners = [[a, b, 0.0] for a in (-1.0, 1.0) for b in (-1.0, 1.0)]
    found = whiten(frame(spark, corners)).collect()
    assert {r.component for r in found} == {1, 2} and {r.explained for r in found} == {0.5}
    assert max(r.identity_error for r in found) < 1e-12


def test_single_vectors_and_empty_tables_give_no_rows(spark):
    assert whiten(frame(spark, [])).collect() == []
    one = whiten(frame(spark, [[1.0, 2.0]] * 5))
    assert one.collect() == [] and one.columns == whiten(frame(spark, [[0.0, 1.0], [2.0, 1.0]])).columns
    assert whiten(frame(spark, [None, []])).collect() == []


def test_huge_entries_have_a_defined_result(spark):
    vectors = [[3e38, 1.0], [-3e38, 2.0], [0.0, 5.0], [1.0, 4.0]]
    found = whiten(frame(spark, vectors)).collect()
    assert {r.component for r in found} == {1} and all(math.isfinite(r.whitened) for r in found)
    assert [r.deviation is None for r in found if r.component == 1] == [True, True, False, False]


def test_the_fit_is_certified(spark):
    vectors = [list(v) for v in spectrum(500, 80, 2.0 * 0.97 ** np.arange(80), seed=4)]
    model = fit_whitening(frame(spark, vectors), Settings(components=4, guard=4))
    assert model.vectors.shape == (80, 4)
    assert model.residual <= 1e-10 * model.values[0] and model.identity_error <= 1e-10


def test_the_query_covers_the_whole_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    found = op11_whitening(spark, SMALL).collect()
    check(found, [r.embedding for r in rows], 64, [r.vec_id for r in rows])
