"""Whitening against fractions and numpy: exact integers, covariance by definition, the given embeddings."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintner.llm import whitening
from vintner.llm.queries import op11_whitening
from vintner.llm.shared import table


def brute(vectors):
    """(n, deviations, covariance) in fractions."""
    x = [[int(np.floor(1024 * np.float64(c))) + 100_000 for c in v] for v in vectors]
    n, dims = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(dims)]
    centred = [[Fraction(r[d]) - Fraction(s[d], n) for d in range(dims)] for r in x]
    covariance = [[sum(c[i] * c[j] for c in centred) / n for j in range(dims)] for i in range(dims)]
    return n, [sum((n * r[d] - s[d]) ** 2 for d in range(dims)) for r in x], covariance, centred


def check(rows, vectors, by_id, components=8):
    n, deviations, covariance, centred = brute(vectors)
    cov = np.array([[float(v) for v in r] for r in covariance])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    dims = len(cov)
    assert len(rows) == n * min(components, dims)
    signs = {}
    for r in rows:
        i, k = by_id[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviations[i]
        assert r["explained"] == pytest.approx(e[k] / e.sum(), rel=1e-9)
        expected = float(np.array([float(c) for c in centred[i]]) @ v[:, k]) / np.sqrt(e[k])
        if abs(expected) > 0.1:
            signs.setdefault(k, np.sign(expected * r["whitened"]))
        assert signs.get(k, 1) * r["whitened"] == pytest.approx(expected, abs=1e-6)
        assert r["identity_error"] < 1e-9


def test_given_embeddings(spark):
    rows = op11_whitening(spark, "/root/testdata/sf0.001").collect()
    given = table(spark, "/root/testdata/sf0.001", "embeddings").collect()
    check(rows, [r["embedding"] for r in given], {r["vec_id"]: i for i, r in enumerate(given)})


def test_covariance_is_exact_at_any_offset(spark):
    """A large common part and strong correlation would cost digits if squares were not centred first."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 3))
    vectors = (base @ rng.normal(size=(3, 5)) * 0.01 + 5e6 + rng.normal(size=(300, 5)) * 0.01).tolist()
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").repartition(7)
    rows = whitening.on_grid(df)
    model = whitening.fit(rows)
    _, _, covariance, _ = brute(vectors)
    assert model.covariance.tolist() == [[float(v) for v in r] for r in covariance]
    check([r.asDict() | {"deviation": int(r["deviation"])} for r in whitening.whitened(df).collect()], vectors, dict(zip(range(300), range(300))))


def test_sums_of_any_size_are_exact():
    for size in (3, 10**6, 2**25, 2**31, 2**40):
        d = np.random.default_rng(size).integers(-size, size, (whitening.BLOCK, 4))
        exact = d.astype(object)
        out = whitening._square_sums(d)
        for i in range(4):
            assert out[i, i] == sum(int(v) ** 2 for v in exact[:, i])
            for j in range(i + 1, 4):
                assert out[i, j] == sum((int(a) + int(b)) ** 2 for a, b in zip(exact[:, i], exact[:, j], strict=True))


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, -3.0]), (2, None), (3, []), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0]), (8, [3.0, 0.25])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("n", "x", "component", "label")})
    out = whitening.whitened(df).collect()
    assert sorted(str(r["vec_id"]) for r in out) == sorted(["1", "1", "None", "8"] * 2)
    kept = [[1.0, 2.0], [1.0, 2.0], [0.5, -3.0], [3.0, 0.25]]
    n, deviations, _, _ = brute(kept)
    assert {int(r["deviation"]) for r in out} == set(deviations) and {r["n"] for r in out} == {4}
    assert whitening.whitened(df.filter("vec_id = 2")).collect() == [] == whitening.whitened(df.limit(0)).collect()
    same = whitening.whitened(df.filter("vec_id = 1")).collect()
    assert [(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in same] == [(None, None, None, 0)] * 4
    line = spark.createDataFrame([(i, [i * 0.5, i * 1.0]) for i in range(9)], "vec_id long, embedding array<double>")
    flat = whitening.whitened(line).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in flat) and flat[0]["identity_error"] < 1e-9
    huge = spark.createDataFrame([(1, [1e300, 1.0]), (2, [-1e300, 2.0])], "vec_id long, embedding array<double>")
    assert len(whitening.whitened(huge).collect()) == 4
