"""Clones of reads against a plain count; what is moved and written for them."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vdjspark.functions import sequences as S
from vdjspark.jobs import alignments, registry  # noqa: F401 (alignments registers its queries)
from vdjspark.operators import clones as K


def test_clones_match_a_plain_count(spark):
    rng = random.Random(2)
    rows = [("".join(rng.choices("AC", k=rng.randrange(0, 5))), rng.choice(["V1", "V2", None])) for _ in range(400)]
    rows = [(s, v, [rng.randrange(0, 42) for _ in s]) for s, v in rows]
    want: dict[tuple, tuple[int, list[int]]] = {}
    for s, v, q in rows:
        n, most = want.get((s, v), (0, [0] * len(s)))
        want[s, v] = n + 1, [max(x) for x in zip(most, q, strict=True)]
    lists = spark.createDataFrame(rows, "seq string, v_call string, qual array<int>").repartition(7)
    text = lists.select("seq", "v_call", S.encode_quality(F.col("qual")).alias("qual_text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
    try:
        for reads in (lists, text):
            got = K.build(reads, ["seq", "v_call"]).collect()
            assert len(got) == len(want) and {(r.seq, r.v_call): (r["count"], list(r.qual)) for r in got} == want
            assert all(r.orig_count == r["count"] for r in got)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    with pytest.raises(PySparkException, match="Quality score"):
        K.build(spark.createDataFrame([("A", "K")], "seq string, qual_text string")).collect()


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["template_lines", "routed_clones"])
def test_reads_are_moved_once(spark, name):
    # nothing is written before, and each set of clones takes one shuffle
    text = plan(registry.QUERIES[name](spark, "/root/testdata/sf0.001"))
    sets = 2 if name == "routed_clones" else 1
    assert text.count("RepartitionByExpression") == sets and "Aggregate" not in text and "Window" not in text


def test_ranked_clones_are_written_as_bytes(spark, monkeypatch):
    written = []
    before = K.numbered
    monkeypatch.setattr(K, "numbered", lambda df, *a, **k: written.append(dict(df.dtypes)["qual"]) or before(df, *a, **k))
    rows = spark.createDataFrame([("A", 1, [7]), ("C", 2, [-5]), ("", 1, []), ("G", 3, None)], "seq string, count long, qual array<int>")
    got = [(r.seq, r.qual, r.sequence_id) for r in K.ranked(rows).orderBy("sequence_id").collect()]
    assert written == ["binary"] and got == [("G", None, 1), ("C", [-5], 2), ("", [], 3), ("A", [7], 4)]


def test_cells_of_letters_that_are_no_base(spark):
    rows = spark.createDataFrame([("ATGNNNéTGTTA",), (None,), ("AT",)], "s string")
    assert [r[0] for r in rows.select(S.translate_codons(F.col("s"))).collect()] == ["M??L", "", ""]
