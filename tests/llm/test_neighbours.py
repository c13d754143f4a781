"""Multiprobe hashing against brute force: rows, scores and ties, and its recall."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vdjspark.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, v int, cid string, score string, rank int"


def frame(spark, rows: list[tuple]):
    return spark.createDataFrame([(k, v, 1, 2, "c", "s", 3) for k, v in rows], SCHEMA).repartition(3)


def brute(rows: list[tuple], every: int, k: int) -> dict[tuple, list]:
    """(query, its place among rows) -> (score, key) lists, best first."""
    good = [(key, np.array(v, np.float32).astype(float)) for key, v in rows if v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    out = {}
    for i, (key, v) in enumerate(good):
        if key is not None and key % every == 0:
            scores = [(-float((v * w).sum()), other is None, other) for j, (other, w) in enumerate(good) if j != i]
            out[key, i] = [(-s, other) for s, none, other in sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k]]
    return out


def clustered(n: int, d: int, seed: int) -> list[list[float]]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, d))
    return (centres[rng.integers(0, 20, n)] + 0.3 * rng.normal(size=(n, d))).astype(np.float32).tolist()


def test_small_tables_are_exact(spark):
    vectors = clustered(60, 6, 1)
    rows = [((1 << 53) + 1 + i, v) for i, v in enumerate(vectors)]
    rows += [(5 * i, vectors[0]) for i in range(40)]  # many copies of one vector, some of them queries
    rows += [(None, vectors[0]), (None, vectors[1]), (None, None), (3, None), (10, [0.0] * 6), (15, [None] + vectors[0][1:]), (20, [float("nan")] * 6), (25, []), (30, [1.0, 2.0])]
    rows += [(35, vectors[2]), (35, vectors[2])]
    rows = [r for r in rows if r[1] is None or len(r[1]) != 2] + [(30, [1.0, 2.0])]
    want = sorted(sorted((q, rank + 1, key, round(score, 9)) for rank, (score, key) in enumerate(found)) for (q, _), found in brute([r for r in rows if not r[1] or len(r[1]) == 6], 5, 8).items())
    got = neighbours.search(frame(spark, rows), F.col("vec_id") % 5 == 0, k=8)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r[:3]) + (round(r[3], 9),) for r in got.collect()) == sorted(x for rows_ in want for x in rows_)


def test_few_or_no_candidates(spark):
    assert neighbours.search(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.search(frame(spark, [(0, [1.0, 0.0])]), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.search(frame(spark, [(0, None), (1, [0.0])]), F.col("vec_id") % 20 == 0).count() == 0
    got = neighbours.search(frame(spark, [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [1.0, 0.0])]), F.col("vec_id") % 20 == 0)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 2, 1.0), (0, 2, 1, -1.0)]


@pytest.mark.parametrize("tables", [1, 3])
def test_recall_with_small_buckets(spark, monkeypatch, tables):
    monkeypatch.setattr(neighbours, "PER_BUCKET", 20)
    monkeypatch.setattr(neighbours, "BLOCK", 100)
    rng = np.random.default_rng(5)
    vectors = [(np.array(v) * s).tolist() for v, s in zip(clustered(1200, 16, 2), rng.uniform(0.5, 1, 1200), strict=True)]
    rows = list(enumerate(vectors))
    got: dict[int, list] = {}
    for r in neighbours.search(frame(spark, rows), F.col("vec_id") % 20 == 0, k=10, tables=tables).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = brute(rows, 20, 10)
    assert set(got) == {q for q, _ in want}
    hits = sum(len({key for _, key in found} & {key for _, key, _ in got[q]}) for (q, _), found in want.items())
    assert hits >= 0.9 * 10 * len(want)
    for q, found in got.items():
        assert [r for r, _, _ in sorted(found)] == list(range(1, 11))
        assert all(s == pytest.approx(float(np.dot(np.float32(vectors[q]).astype(float), np.float32(vectors[key]).astype(float)))) for _, key, s in found)
        assert [s for _, _, s in sorted(found)] == sorted((s for _, _, s in found), reverse=True)


def test_queries_without_bound_meet_all_vectors(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PER_BUCKET", 4)
    rows = list(enumerate(clustered(400, 8, 3)))
    # one bucket is all that may be visited, so every query goes to all vectors
    got = neighbours.search(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5, first=1, most=1)
    found = sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect())
    assert found == sorted((q, i + 1, key) for (q, _), best in brute(rows, 20, 5).items() for i, (_, key) in enumerate(best))


def test_buckets_come_in_the_order_of_their_probability():
    rng = np.random.default_rng(2)
    choices = [sorted(((float(p), c) for c, p in enumerate(rng.random(n))), reverse=True) for n in (3, 1, 4, 2)]
    got = list(neighbours.best_first(choices))
    assert len({cells for _, cells in got}) == len(got) == 24
    ps = [p for p, _ in got]
    assert ps == sorted(ps, reverse=True)
    assert ps[0] == pytest.approx(math.prod(c[0][0] for c in choices))
