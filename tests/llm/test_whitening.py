"""Whitened rows against an eigendecomposition in exact integers, ill-conditioned and dependent dimensions, odd rows."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

from roadtally.llm import whitening
from roadtally.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, n long, component string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 7, "clash") for i, v in rows], SCHEMA)


def integers(rows):
    return [[math.floor(64 * c) + 1_000_000 for c in v] for v in rows]


def checked(result, rows, components=32):
    """Compares a result with the covariance of the rows, computed exactly; returns the number of components."""
    x = integers(rows)
    n, d = len(x), len(x[0])
    totals = [sum(r[j] for r in x) for j in range(d)]
    differences = [[n * r[j] - totals[j] for j in range(d)] for r in x]
    exact = np.array([[Fraction(sum(r[i] * r[j] for r in differences), n**3) for j in range(d)] for i in range(d)])
    covariance = exact.astype(float)
    variances, axes = np.linalg.eigh(covariance)
    order = np.argsort(-variances)
    variances, axes = variances[order], axes[:, order]
    got = result.collect()
    found = max((r["component"] for r in got), default=0)
    assert len(got) == n * found and found <= components
    assert all(r["n"] == n and r["identity_error"] <= 1e-4 for r in got)
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], {})[r["component"]] = r
    values = np.array([[by_row[i][c + 1]["whitened"] for c in range(found)] for i in sorted(by_row)])
    deviations = [sum(v * v for v in r) for r in differences]
    assert [by_row[i][1]["deviation"] for i in sorted(by_row)] == [v if v < 1 << 63 else None for v in deviations]
    for c in range(found):
        share = by_row[min(by_row)][c + 1]["explained"]
        assert share == pytest.approx(variances[c] / np.trace(covariance), rel=1e-4)
    centred = np.array(differences, float) / n
    spread = np.cov(values.T, bias=True).reshape(found, found)
    assert np.abs(spread - np.eye(found)).max() < 1e-4
    # the axis of each component: rows of the covariance with the centred rows, of unit length up to the variance
    recovered = centred.T @ values / n
    for c in range(int((variances[:found] > 1e-6 * variances[0]).sum())):  # beyond, this recovery itself is inexact
        axis = recovered[:, c] / np.sqrt(variances[c])
        assert np.linalg.norm(covariance @ axis - variances[c] * axis) < 1e-6 * variances[0]
    return found


def test_plain_rows(spark):
    rng = random.Random(1)
    rows = [[rng.gauss(0, 1) * (j + 1) for j in range(6)] for _ in range(200)]
    assert checked(whitening.whiten(vectors(spark, list(enumerate(rows)))), rows) == 6
    assert checked(whitening.whiten(vectors(spark, list(enumerate(rows))), most=2), rows, 2) == 2


def test_widely_different_variances(spark):
    rng = random.Random(2)
    rows = []
    for _ in range(300):
        a, b, c = rng.gauss(0, 1e6), rng.gauss(0, 1e3), rng.gauss(0, 1)
        rows.append([a, a + b, a + b + c, a - c])
    found = checked(whitening.whiten(vectors(spark, list(enumerate(rows)))), rows)
    assert found in (3, 4)  # rounding to integers makes the fourth direction independent


def test_constant_and_dependent_dimensions(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(50):
        a, b = rng.randrange(100), rng.randrange(100)
        rows.append([a, 5.0, a, b, a + b])
    rows = [[float(v) for v in r] for r in rows]
    x = vectors(spark, list(enumerate(rows)))
    got = whitening.whiten(x).collect()
    assert {r["component"] for r in got} == {1, 2}
    assert all(r["identity_error"] < 1e-9 for r in got)
    assert {r["explained"] for r in got if r["component"] == 1}.pop() < 1
    assert checked(whitening.whiten(x), rows) == 2


def test_fewer_rows_than_dimensions_and_equal_rows(spark):
    rng = random.Random(4)
    rows = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(4)]
    assert checked(whitening.whiten(vectors(spark, list(enumerate(rows)))), rows) == 3
    assert whitening.whiten(vectors(spark, [(i, rows[0]) for i in range(9)])).collect() == []
    repeated = whitening.whiten(vectors(spark, [(i // 2, rows[i // 2]) for i in range(8)])).collect()
    assert len(repeated) == 8 * 3 and len({tuple(r) for r in repeated}) == 12


def test_rows_left_out(spark):
    good = [(i, [float(i % 5), float(i * i % 7), float(i)]) for i in range(20)]
    bad = [
        (100, None),
        (101, [1.0, None, 2.0]),
        (102, [1.0, math.nan, 2.0]),
        (103, [1.0, math.inf, 2.0]),
        (104, [1.0, -math.inf, 2.0]),
        (105, [1.0, 1e300, 2.0]),
        (106, []),
        (107, [1.0]),
    ]
    result = whitening.whiten(vectors(spark, good + bad))
    assert {r["vec_id"] for r in result.collect()} == set(range(20))
    checked(whitening.whiten(vectors(spark, good + bad)), [v for _, v in good])
    nameless = whitening.whiten(vectors(spark, [*good, (None, [9.0, 9.0, 9.0])])).collect()
    assert sum(r["vec_id"] is None for r in nameless) == 3


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    result = whitening.whiten(vectors(spark, rows))
    assert result.collect() == []
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_deviation_beyond_a_long_is_null(spark):
    rows = [(i, [float((1 << 40) * i), float(i % 3)]) for i in range(6)]
    got = whitening.whiten(vectors(spark, rows)).collect()
    assert got and {r["deviation"] for r in got} == {None}


def test_query(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    assert [r["vec_id"] for r in rows] == list(range(len(rows)))
    assert checked(QUERIES["op11_whitening"](spark, sf_dir), [r["embedding"] for r in rows]) == 32
