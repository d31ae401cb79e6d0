"""Exact scatter and whitening, against whole-number arithmetic and a plain eigendecomposition."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tallyframe.llm import whitening

LONG = st.integers(-(2**63), 2**63 - 1)


def products(x):
    """Cross-products with a column of ones, in Python integers."""
    rows = [[int(v) for v in r] + [1] for r in x]
    return [[sum(r[i] * r[j] for r in rows) for j in range(len(rows[0]))] for i in range(len(rows[0]))]


@settings(max_examples=80, deadline=None)
@given(st.integers(1, 4).flatmap(lambda d: st.lists(st.lists(st.one_of(LONG, st.integers(-300, 300)), min_size=d, max_size=d), min_size=1, max_size=70)))
def test_scatter_is_exact(rows):
    x = np.array(rows, dtype=np.int64)
    assert whitening.scatter(x).tolist() == products(x)


def expected(vectors, components=4):
    """By row number: n, deviation, whitened (None without variance), explained; rows left out are missing."""
    whole = {}
    for k, v in enumerate(vectors):
        if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v):
            whole[k] = tuple(min(max(math.floor(256 * float(np.float32(c))), -(2**63)), 2**63 - 1) for c in v)
    out = {}
    for d in {len(x) for x in whole.values()}:
        fit = sorted({x for x in whole.values() if len(x) == d})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = {x: [n * a - s for a, s in zip(x, sums)] for x in fit}
        cov = np.array([[sum(c[i] * c[j] for c in centred.values()) / n**3 for j in range(d)] for i in range(d)])
        e, v = np.linalg.eigh(cov)
        e, v = e[::-1][:components], v[:, ::-1][:, :components]
        for k, x in whole.items():
            if len(x) == d:
                deviation = sum(c * c for c in centred[x])
                white = [None if e[m] <= max(e[0], 0) * d * 2.3e-16 else float(np.array([c / n for c in centred[x]]) @ v[:, m]) / math.sqrt(e[m]) for m in range(len(e))]
                trace = np.trace(cov)
                out[k] = (n, deviation if deviation < 2**63 else None, white, [max(float(y), 0) / trace if trace else None for y in e])
    return out


def assert_whitened(found, vectors):
    """found: rows of whiten with the row number as row.vec_id, each with its own vector."""
    wanted = expected(vectors)
    assert sorted(r.row.vec_id for r in found) == sorted(wanted)
    signs = {}
    for r in found:
        n, deviation, white, explained = wanted[r.row.vec_id]
        assert (r.n, r.deviation) == (n, deviation)
        assert len(r.whitened) == len(white) == len(r.explained)
        for m, (a, b) in enumerate(zip(r.whitened, white)):
            assert (a is None) == (b is None)
            if a is not None and abs(a) > 1e-3:
                assert signs.setdefault((len(r.row.embedding), m), np.sign(a) * np.sign(b)) == np.sign(a) * np.sign(b)
            if a is not None:
                assert abs(abs(a) - abs(b)) < 1e-6 * max(1, abs(b))
        for a, b in zip(r.explained, explained):
            assert (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-6)


def frame(spark, vectors):
    rows = [(k, None if v is None else [None if c is None else float(c) for c in v], "x", 1) for k, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, whitened string, n int")


def test_odd_vectors(spark):
    """Nulls, non-finite entries, repeated and huge vectors, several lengths, one without variance, clashing names."""
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=6).round(3).tolist() for _ in range(60)]
    vectors += [vectors[0]] * 20 + [None, [], [None] * 6, [float("nan")] * 6, [float("inf")] + [0.0] * 5, [-0.0] * 6, [0.0] * 6]
    vectors += [[1.0, 2.0], [3.0, 5.0], [2.0, 9.5], [7.0], [7.0]]
    found = whitening.whiten(spark, frame(spark, vectors)).collect()
    assert_whitened(found, vectors)
    assert all(r.identity_error < 1e-9 for r in found if len(r.row.embedding) > 1)
    assert all(r.identity_error is None and r.whitened == [None] for r in found if len(r.row.embedding) == 1)
    assert whitening.whiten(spark, frame(spark, vectors).limit(0)).collect() == []
    huge = [[1e30, -3.0, 0.5], [-1e38, 2.0, 1.0], [5.0, 4.0, 2.0], [1e17, 3.0, 2.0]]
    for r in whitening.whiten(spark, frame(spark, huge)).collect():
        assert (r.n, r.deviation) == expected(huge)[r.row.vec_id][:2]


def test_query(spark, sf):
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    ids = sorted(given)
    wanted = expected([given[i] for i in ids])
    found = entry.queries()["op12_whitening"](spark, sf)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    rows = found.collect()
    assert len(rows) == 4 * len(wanted)
    for r in rows:
        n, deviation, white, explained = wanted[ids.index(r.vec_id)]
        assert (r.n, r.deviation) == (n, deviation) and r.identity_error < 1e-9
        assert abs(r.whitened) == pytest.approx(abs(white[r.component - 1]), rel=1e-6, abs=1e-9)
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-9)
    # the whitened rows themselves are uncorrelated with unit variance
    distinct = {tuple(np.floor(256 * np.float64(given[r.vec_id])).astype(int)): r.vec_id for r in rows}
    table = np.array([[r.whitened for r in sorted(rows, key=lambda r: r.component) if r.vec_id == i] for i in distinct.values()])
    assert np.abs(np.cov(table.T, bias=True) - np.eye(4)).max() < 1e-9
    assert {r.component for r in found.select("component", F.lit(1)).collect()} == {1, 2, 3, 4}
