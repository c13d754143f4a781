"""Whitening against exact fractions and double-precision linear algebra."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from vdjspark.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, x string, v int, component int"


def rows_of(vectors: list, first: int = 0) -> list[tuple]:
    return [(first + i, v, 1, "clash", 2, 3) for i, v in enumerate(vectors)]


def random_vectors(n: int, d: int, seed: int = 3) -> list[list[float]]:
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ np.diag(np.linspace(1, 0.2, d)) + 0.3
    return mixed.astype(np.float32).tolist()


def checked(rows: list, got: list, most: int = 8) -> None:
    good = [(k, v) for k, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in good]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    z = np.array([[n * r[i] - sums[i] for i in range(d)] for r in x], dtype=object)
    exact = [[Fraction(int((z[:, i] * z[:, j]).sum()), n**3) for j in range(d)] for i in range(d)]
    values, basis = np.linalg.eigh(np.array([[float(c) for c in r] for r in exact]))
    values, basis = values[::-1], basis[:, ::-1]
    k = min(most, d)
    assert sorted(((r.vec_id, r.component) for r in got), key=str) == sorted(((key, c + 1) for key, _ in good for c in range(k)), key=str)
    assert {r.n for r in got} == {n}
    for c in range(k):
        assert [*{r.explained for r in got if r.component == c + 1}] == [pytest.approx(values[c] / sum(float(exact[i][i]) for i in range(d)), rel=1e-9)]
    ids = [key for key, _ in good]
    if len(set(ids)) == n and None not in ids:
        at = {key: i for i, key in enumerate(ids)}
        for r in got:
            assert r.deviation == sum(int(v) ** 2 for v in z[at[r.vec_id]])
        made = np.zeros((n, k))
        for r in got:
            made[at[r.vec_id], r.component - 1] = r.whitened
        plain = (z.astype(float) / n) @ basis[:, :k] / np.sqrt(values[:k])
        for c in range(k):
            sign = np.sign(made[:, c] @ plain[:, c])
            np.testing.assert_allclose(made[:, c], sign * plain[:, c], rtol=1e-6, atol=1e-7)
        error = np.abs(np.cov(made.T, bias=True).reshape(k, k) - np.eye(k)).max()
        assert [*{r.identity_error for r in got}] == [pytest.approx(error, abs=1e-9)]
        assert error <= 1e-4


def test_matches_exact_fractions(spark):
    vectors = random_vectors(300, 12)
    big = rows_of(vectors, (1 << 53) + 1)
    bad = [(1, None, 1, "", 1, 1), (2, [None, *vectors[0][1:]], 1, "", 1, 1), (3, [float("nan"), *vectors[0][1:]], 1, "", 1, 1), (4, [float("inf"), *vectors[0][1:]], 1, "", 1, 1), (5, [], 1, "", 1, 1)]
    df = spark.createDataFrame(big + bad, SCHEMA).repartition(4)
    checked(big + bad, whitening.whiten(df).collect())


def test_null_ids_and_repeated_rows_stay(spark):
    rows = rows_of(random_vectors(30, 5))
    rows += [rows[0], rows[0], (None, rows[3][1], 1, "", 1, 1)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    checked(rows, got)
    same = {r.whitened for r in got if r.vec_id == 0 and r.component == 1}
    assert len(same) == 1


def test_few_dimensions_one_vector_and_none(spark):
    two = rows_of(random_vectors(40, 2))
    checked(two, whitening.whiten(spark.createDataFrame(two, SCHEMA)).collect())
    flat = [(i, [float(i), 1.0], 1, "", 1, 1) for i in range(5)]  # no variance in the second
    got = whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in got)
    assert all(r.identity_error < 1e-9 for r in got)
    one = whitening.whiten(spark.createDataFrame(rows_of([[0.5, 0.25]]), SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 2
    empty = whitening.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    assert empty.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_other_lengths_take_no_part_and_large_entries_stay_exact(spark):
    rows = rows_of(random_vectors(20, 3))
    odd = [(100, [1.0], 1, "", 1, 1), (101, [1.0, 2.0, 3.0, 4.0], 1, "", 1, 1)]
    assert {r.vec_id for r in whitening.whiten(spark.createDataFrame(rows + odd, SCHEMA)).collect()} == set(range(20))
    wide = [[2.0**40 + i, -(2.0**41)] for i in range(3)] + [[0.0, 1.0]]
    x = spark.createDataFrame([([int(c) for c in v],) for v in wide], "x array<long>")
    sums = whitening.square_sums(x, [5, -7])
    y = [[int(v[0]) - 5, int(v[1]) + 7] for v in wide]
    assert sums[0, 0] == sum(a * a for a, _ in y)
    assert sums[0, 1] == sum((a + b) ** 2 for a, b in y)
    assert sums[1, -1] == sum(b for _, b in y)
