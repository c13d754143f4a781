"""Near strings that share blocks: many in one run, runs over several batches, and what is computed once."""

from __future__ import annotations

import random

import pytest

from vdjspark.jobs import registry
from vdjspark.operators import similarity as J

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(("most", "pairs", "many"), [(1, 50_000, 64), (1, 7, 2), (2, 7, 2), (3, 50_000, 64), (5, 20, 2)])
def test_crowded_runs_match_all_pairs(spark, monkeypatch, most, pairs, many):
    rng = random.Random(most)
    words = sorted({("AAAAé" if i % 50 == 0 else "AAAAA") + "".join(rng.choices("ACG", k=rng.choice((4, 6)))) for i in range(300)} | {"", "A", "C", "CG"})
    want = {(g, a, b, d) for g in ("x", None) for a in words for b in words if a < b and len(a) == len(b) and (d := sum(x != y for x, y in zip(a, b, strict=True))) <= most}
    rows = spark.createDataFrame([(g, s) for g in ("x", None) for s in words] + [("x", words[3]), ("y", words[4]), ("x", None)], "grp string, seq string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "31")
    before = J._near_runs

    def small(*args):  # also in the workers
        J.PAIRS, J.MANY = pairs, many
        return before(*args)

    monkeypatch.setattr(J, "_near_runs", small)
    try:
        got = [tuple(r) for r in J.hamming_pairs(rows, most, within=("grp",)).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(want) and set(got) == want


def test_pairs_over_more_than_a_slice(monkeypatch):
    import numpy as np

    monkeypatch.setattr(J, "PAIRS", 4)
    end = np.repeat([1, 12, 14], [1, 11, 2])
    got = [(int(x), int(y)) for a, b in J._later(np.arange(14), end) for x, y in zip(a, b, strict=True)]
    assert sorted(got) == [(i, j) for i in range(14) for j in range(i + 1, int(end[i]))]


def test_pairs_are_made_once(spark):
    text = {n: registry.QUERIES[n](spark, SF)._jdf.queryExecution().optimizedPlan().toString() for n in ("hamming_pairs", "nearest_neighbours", "prefix_pairs") if n in registry.QUERIES}
    assert "Join" not in text["hamming_pairs"] and text["hamming_pairs"].count("MapInArrow") == 2
    assert "MapInArrow" not in text["nearest_neighbours"]  # they are read from a written table
