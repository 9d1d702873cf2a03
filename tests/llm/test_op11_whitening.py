from math import floor, inf, isfinite, nan

import numpy as np
import pytest
from conftest import SF

from gaugeline.llm import whitening as op
from gaugeline.llm.queries import QUERIES


def brute(rows, most=16):
    """(vec_id, component) -> n, deviation, whitened up to sign, explained; by plain float64."""
    usable = [(i, tuple(floor(64 * c) + 1_000_000 for c in v)) for i, v in rows
              if v and all(c is not None and isfinite(c) for c in v)]
    out = {}
    for length in {len(x) for _, x in usable}:
        own = [(i, x) for i, x in usable if len(x) == length]
        distinct = np.array(sorted({x for _, x in own}), object)
        n, total = len(distinct), distinct.sum(axis=0)
        away = (n * distinct - total).astype(float) / n
        values, vectors = np.linalg.eigh(away.T @ away / n)
        for i, x in own:
            difference = [n * a - s for a, s in zip(x, total)]
            z = np.array(difference, float) / n @ vectors[:, ::-1] / np.sqrt(np.maximum(values[::-1], 1e-300))
            for k in range(min(most, int((values > 1e-9 * values[-1]).sum()))):
                out.setdefault((i, k + 1), []).append(
                    (n, sum(d * d for d in difference), abs(z[k]), values[::-1][k] / values.sum()))
    return out


def check(found, rows):
    got = {}
    for r in found.collect():
        got.setdefault((r["vec_id"], r["component"]), []).append(
            (r["n"], r["deviation"], abs(r["whitened"]), r["explained"]))
        assert r["identity_error"] < 1e-9
    want = brute(rows)
    assert set(got) == set(want)
    for key, values in want.items():
        assert [v[:2] for v in sorted(got[key])] == [v[:2] for v in sorted(values)]
        assert np.allclose([v[2:] for v in sorted(got[key])], [v[2:] for v in sorted(values)],
                           rtol=1e-7, atol=1e-7)
    return got


def test_query_as_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in
            spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = check(QUERIES["op11_whitening"](spark, SF), rows)
    assert {k for _, k in got} == set(range(1, 17))


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(40, 5)).round(3)
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(100, base[0].tolist()), (100, base[0].tolist()), (None, base[1].tolist()), (101, None),
             (102, []), (103, [1.0, None, 0.0, 0.0, 0.0]), (104, [nan, 0.0, 0.0, 0.0, 0.0]), (105, [inf] * 5),
             (106, [0.0] * 5), (107, [2.0, 1.0]), (108, [1.0, 2.5]), (109, [4.0, 4.0]), (110, [7.0])]
    schema = "vec_id long, embedding array<double>, n long, component string"
    docs = spark.createDataFrame([(*r, None, "x") for r in rows], schema)
    got = check(op.whiten(docs), rows)
    assert (110, 1) not in got and (107, 2) in got and len(got[100, 1]) == 2
    assert op.whiten(docs.limit(0)).count() == 0
    assert op.whiten(docs.where("vec_id = 101")).count() == 0


def orthogonal(rng, d):
    q = np.linalg.qr(rng.normal(size=(d, d)))[0].astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(d) - q.T @ q) / 2
    return q


@pytest.mark.parametrize("values", [
    np.geomspace(50, 0.01, 24), np.repeat([9.0, 4.0, 1.0], 8),
    np.concatenate([[3.0], 2 + 1e-9 * np.arange(6), 1 + 1e-11 * np.arange(5), np.linspace(0.1, 0.9, 12)])])
def test_eigenvectors_of_separate_equal_and_clustered_values(values):
    values = np.sort(values)[::-1]
    q = orthogonal(np.random.default_rng(1), len(values))
    a = (q * values.astype(np.longdouble)) @ q.T
    got, x = op.eigenvectors(a)
    assert np.allclose(got, values, rtol=0, atol=1e-15 * values[0])
    wide = x.astype(np.longdouble)
    assert np.abs(wide.T @ wide - np.eye(len(x))).max() < 4e-16
    assert np.abs(a @ wide - wide * got).max() < 1e-15 * values[0]
    # Vectors whose value has no equal are those the matrix was made of.
    for k in range(len(values)):
        gap = np.abs(np.delete(values, k) - values[k]).min()
        if gap > 0:
            assert 1 - abs(float(wide[:, k] @ q[:, k])) < 1e-12
            assert np.abs(np.abs(wide[:, k]) - np.abs(q[:, k])).max() < 1e-15 + 1e-17 / gap


def test_float32_alone_would_not_do():
    values = np.sort(np.concatenate([2 + 1e-9 * np.arange(6), np.linspace(0.1, 0.9, 6)]))[::-1]
    q = orthogonal(np.random.default_rng(2), 12)
    a = (q * values.astype(np.longdouble)) @ q.T
    start = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    assert np.abs(np.abs(start) - np.abs(q)).max() > 1e-2
    assert np.abs(np.abs(op.eigenvectors(a)[1]) - np.abs(q)).max() < 1e-7


def test_product_is_exact_beyond_float64():
    a = np.array([[1, 1e-12, -1], [3.0, 1e-17, 2]], np.longdouble)
    b = np.array([[1, 1], [1e-8, 1], [1, 1 + np.finfo(np.longdouble).eps]], np.longdouble)
    assert np.abs(op.product(a, b) - a @ b).max() < 1e-19


def test_exact_deviation_where_64_bits_do_not_hold_it():
    model = op.Model(op.Mean(10 ** 13, np.array([10 ** 13, 5])), np.ones(1), np.ones((1, 2)), 1.0)
    assert model.deviations(np.array([[1, 0], [1_000_000, 0]])).to_pylist() == [25, None]
