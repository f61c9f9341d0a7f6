"""Bit-sliced whitening against plain exact arithmetic."""

import random
from fractions import Fraction

import numpy as np
import pytest

from larder.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, n long, whitened string"


def vectors(spark, rows):
    return spark.createDataFrame([(k, v, 1, 7, "x") for k, v in rows], SCHEMA)


def plain(rows):
    """Whole numbers, their covariance and eigenvectors, without bit planes."""
    x = [[int(np.floor(np.float64(np.float32(c)) * 64)) + 1_000_000 for c in v] for _, v in rows]
    n, size = len(x), len(x[0])
    total = [sum(r[d] for r in x) for d in range(size)]
    centred = [[n * r[d] - total[d] for d in range(size)] for r in x]
    moment = [[Fraction(sum(r[d] * r[e] for r in centred), n**3) for e in range(size)] for d in range(size)]
    values, directions = np.linalg.eigh(np.array([[float(c) for c in row] for row in moment]))
    order = np.argsort(-values)
    return n, centred, values[order], directions[:, order]


def test_equals_plain_arithmetic(spark):
    dice = random.Random(3)
    mixing = np.array([[dice.gauss(0, 1) for _ in range(6)] for _ in range(6)])
    good = [(k, list(map(float, mixing @ [dice.gauss(0, 1) for _ in range(6)]))) for k in range(300)]
    good += [good[0], (5, [0.0] * 6), (None, [1.5] * 6), (901, [-3.0, 900.25, 0.0, 0.0, 0.0, 1e-30])]
    bad = [
        (1000, None),
        (1001, []),
        (1002, [1.0, None, 0.0, 0.0, 0.0, 0.0]),
        (1003, [float("nan")] + [0.0] * 5),
        (1004, [float("inf")] + [0.0] * 5),
        (1005, [1.0, 2.0]),
    ]
    out = whitening.whitened(vectors(spark, good + bad).repartition(5)).toPandas()
    n, centred, values, directions = plain(good)
    assert len(out) == n * 6 and set(out["n"]) == {n} and set(out["component"]) == set(range(1, 7))
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-6
    wanted = np.array([[float(Fraction(c, n)) for c in r] for r in centred]) @ directions / np.sqrt(values)
    expected = sorted((sum(c * c for c in r), *np.abs(y)) for r, y in zip(centred, wanted))
    table = out.assign(row=np.arange(len(out)) // 6)
    found = sorted(
        (int(g["deviation"].iloc[0]), *np.abs(g.sort_values("component")["whitened"])) for _, g in table.groupby("row")
    )
    assert [f[0] for f in found] == [e[0] for e in expected]
    assert np.allclose([f[1:] for f in found], [e[1:] for e in expected], atol=1e-9)
    assert np.allclose(sorted(set(out["explained"])), sorted(values / values.sum()), rtol=1e-6)


def test_signs_agree_within_a_component(spark):
    rows = [(k, [float(k), float(k % 3), 0.25]) for k in range(40)]
    out = whitening.whitened(vectors(spark, rows).repartition(4)).toPandas()
    assert set(out["component"]) == {1, 2}  # the constant dimension adds no component
    _, centred, values, directions = plain(rows)
    for k in (0, 1):
        mine = out[out["component"] == k + 1].sort_values("vec_id")["whitened"].to_numpy()
        theirs = (np.array(centred, float) / 40 @ directions / np.sqrt(np.abs(values) + 1e-300))[:, k]
        assert np.allclose(mine, theirs, atol=1e-9) or np.allclose(mine, -theirs, atol=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0]), (2, [1.0])]])
def test_nothing_varies(spark, rows):
    out = whitening.whitened(vectors(spark, rows))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_huge_entries_stay_exact(spark):
    rows = [(1, [3.0e38, 1.0]), (2, [-3.0e38, 2.0]), (3, [0.0, 4.0]), (4, [1.0e12, -1.0])]
    out = whitening.whitened(vectors(spark, rows)).toPandas()
    assert out["deviation"].isna().all() and out["identity_error"].iloc[0] < 1e-4
    assert out["whitened"].notna().all()


def test_counts_of_planes_are_products():
    dice = np.random.default_rng(1)
    above = dice.integers(0, 37, (1000, 4)).astype(np.uint64)
    seen = whitening.Moments(1000, [0] * 4, [int(v) for v in above.max(0)], [int(v) for v in above.sum(0)])
    sums = whitening.PlaneCounts(seen.planes, 4)
    for start in range(0, 1000, 300):
        sums.add(whitening.packed_planes(above[start : start + 300], seen.planes))
    weights = 1 << np.arange(sums.counts.shape[1])
    products = np.einsum("dwe,w->de", sums.counts, weights)
    assert (np.triu(products) == np.triu(above.astype(int).T @ above.astype(int))).all()
