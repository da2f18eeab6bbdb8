import math

import numpy as np
import pyspark.sql.functions as F
import pytest

from mercato.llm.exact_whitening import (characteristic_polynomial, exact_products, largest_roots, null_vectors, polynomial_modulo,
                                         roots_above, whiten)
from mercato.llm.queries import op11_exact_whitening

SF = "/root/testdata/sf0.01"


def plain(rows):
    """(n, S, x) of clean rows, in Python integers."""
    x = [[math.floor(1024 * float(c)) + 100000 for c in v] for v in rows]
    n = len(x)
    return n, [sum(col) for col in zip(*x)], x


def test_modular_polynomial_of_known_matrices():
    p = 2147483647
    m = np.array([[2, 1, 0, 0], [1, 2, 0, 0], [0, 0, 5, 0], [0, 0, 0, 0]])  # a zero pivot; roots 3, 1, 5, 0
    assert polynomial_modulo(m, p).tolist() == [c % p for c in [0, -15, 23, -9, 1]]
    rng = np.random.default_rng(1)
    a = rng.integers(-9, 9, (7, 7))
    want = np.round(np.poly(a.astype(float)))[::-1].astype(int)
    assert polynomial_modulo(a, p).tolist() == [int(c) % p for c in want]


def test_polynomial_has_all_integer_coefficients(spark):
    rng = np.random.default_rng(2)
    b = rng.integers(-10 ** 9, 10 ** 9, (6, 4)).astype(object)
    scatter = (b @ b.T).tolist()  # rank 4 of 6
    poly = characteristic_polynomial(spark, scatter)
    assert poly[0] == poly[1] == 0 and poly[2] != 0 and poly[6] == 1 and poly[5] == -sum(scatter[i][i] for i in range(6))
    # p(t) is the determinant at integer places, by fraction-free elimination
    for t in (3, 10 ** 18):
        m = [[(t if i == j else 0) - scatter[i][j] for j in range(6)] for i in range(6)]
        sign, last = 1, 1
        for k in range(5):
            if m[k][k] == 0:
                s = next(i for i in range(k + 1, 6) if m[i][k])
                m[k], m[s], sign = m[s], m[k], -sign
            for i in range(k + 1, 6):
                for j in range(k + 1, 6):
                    m[i][j] = (m[i][j] * m[k][k] - m[i][k] * m[k][j]) // last
            last = m[k][k]
        assert sign * m[5][5] == sum(c * t ** k for k, c in enumerate(poly))


def test_roots_with_multiplicity_and_their_null_space():
    poly = [1]
    for r in (7, 7, 7, 4, 2, 0):
        poly = [a - r * b for a, b in zip([0, *poly], [*poly, 0])]
    assert [roots_above(poly, t) for t in (0, 2, 3, 4, 6, 7)] == [5, 4, 4, 3, 3, 0]
    found = largest_roots(poly, 4, 60)
    assert [(round(r / 2 ** s, 9), m) for r, m, s in found] == [(7.0, 3), (4.0, 1)]
    scatter = [[7 if i == j else 0 for j in range(6)] for i in range(6)]
    scatter[3][3], scatter[4][4], scatter[5][5] = 4, 2, 0
    v = np.array(null_vectors(scatter, found[0][0], found[0][2], 3, 240), float) / 2.0 ** 240
    assert np.allclose(v @ v.T, np.eye(3), atol=1e-14) and np.allclose(v[:, 3:], 0, atol=1e-15)


def test_products_are_exact():
    rng = np.random.default_rng(3)
    y = rng.integers(-2 ** 61, 2 ** 61, (50, 3))
    want = y.astype(object).T @ y.astype(object)
    assert (exact_products(y) == want).all()


def test_query_equals_a_plain_version(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    n, s, x = plain([r["embedding"] for r in rows])
    got = op11_exact_whitening(spark, SF).toPandas()
    assert len(got) == 8 * n and set(got["n"]) == {n} and got["identity_error"].max() < 1e-10
    deviation = {r["vec_id"]: sum((n * a - b) ** 2 for a, b in zip(v, s)) for r, v in zip(rows, x)}
    assert dict(zip(got["vec_id"], got["deviation"])) == deviation
    centred = np.array([[float(n * a - b) / n for a, b in zip(v, s)] for v in x])
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1], u[:, ::-1]
    want = np.abs(centred @ u[:, :8] / np.sqrt(e[:8]))
    white = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r["vec_id"] for r in rows]].to_numpy()
    assert np.abs(np.abs(white) - want).max() < 1e-9
    share = got.groupby("component")["explained"].agg(["min", "max"])
    assert (share["min"] == share["max"]).all() and np.allclose(share["min"], e[:8] / e.sum(), rtol=1e-9)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0, 0.0], "a"), (2, [0.0, 1.0, 0.0], "b"), (3, [0.0, 0.0, 1.0], "c"), (4, [1.0, None, 0.0], "d"), (5, None, "e"),
            (6, [nan, 0.0, 0.0], "f"), (7, [inf, 0.0, 0.0], "g"), (8, [1.0], "h"), (9, [], "i"), (None, [1.0, 1.0, 1.0], "j"), (3, [0.0, 0.0, 1.0], "k")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component string").withColumn("white", F.lit(1))
    got = whiten(table).toPandas()
    assert sorted(got["vec_id"].fillna(-1).astype(int).unique()) == [-1, 1, 2, 3] and set(got["n"]) == {5}
    assert len(got) == 5 * got["component"].max() and got["identity_error"].max() < 1e-10
    none = whiten(table.where("vec_id = 0"))
    assert none.count() == 0 and none.columns == list(got.columns)
    assert whiten(spark.createDataFrame([(1, [2.0, 2.0]), (2, [2.0, 2.0])], "vec_id long, embedding array<double>")).count() == 0
    assert whiten(spark.createDataFrame([(1, []), (2, [])], "vec_id long, embedding array<double>")).count() == 0


def test_equal_eigenvalues_and_large_entries(spark):
    rows = [(k, [float(s * (i == j)) for j in range(4)]) for k, (i, s) in enumerate((i, s) for i in range(4) for s in (3, -3))]
    got = whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), most=3).toPandas()
    assert set(got["component"]) == {1, 2, 3} and np.allclose(got["explained"], 0.25) and got["identity_error"].max() < 1e-10
    big = whiten(spark.createDataFrame([(1, [1e15, 0.0]), (2, [0.0, 5.0]), (3, [-1e15, 2.0])], "vec_id long, embedding array<double>")).toPandas()
    n, s, x = plain([[1e15, 0.0], [0.0, 5.0], [-1e15, 2.0]])
    want = {k + 1: str(sum((n * a - b) ** 2 for a, b in zip(v, s))) for k, v in enumerate(x)}
    assert dict(zip(big["vec_id"], big["deviation_text"])) == want and big["deviation"].isna().sum() >= 2
    assert big["identity_error"].max() < 1e-6
    with pytest.raises(Exception, match="passes 62 bits"):
        whiten(spark.createDataFrame([(1, [1e300])], "vec_id long, embedding array<double>")).count()
