"""Sums of pairs of reads by Arrow batches against the column functions; rows that meet those one place on."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vdjspark.functions import sequences as S
from vdjspark.jobs import registry
from vdjspark.operators import clones as K


def test_sums_match_the_columns(spark):
    rng = random.Random(5)

    def read(n: int) -> tuple:
        return "".join(rng.choices("ACGTNR", k=n)), "".join(chr(33 + rng.choice((0, 7, 41))) for _ in range(n)), rng.randrange(1, 4), rng.randrange(1, 9), rng.randrange(-3, 4)

    rows = spark.createDataFrame([(i, read(rng.randrange(7, 15)), read(rng.randrange(7, 15))) for i in range(80)], ", ".join(["i int", *(f"{x} struct<seq: string, qual_text: string, count: long, orig_count: long, refpos: int>" for x in "ab")]))

    def clone(side: str):
        x = F.col(side)
        made = K.frequencies_of.of_reads(x["seq"], S.decode_quality(x["qual_text"]), x["count"])
        return F.struct(made.alias("pfm"), *[x[c].alias(c) for c in ("count", "orig_count", "refpos")])

    differ = S.mismatch_quality(*[y for x in "ab" for y in (F.col(f"{x}.seq"), S.decode_quality(F.col(f"{x}.qual_text")))], F.col("a.refpos") - F.col("b.refpos"))
    want = rows.select("i", K.added(clone("a"), clone("b")).alias("s"), differ.alias("m")).select("i", "s.seq", S.encode_quality(F.col("s.qual")), "s.mutations", "m.hd", "m.sum_q", "m.max_q", "s.count", "s.orig_count", "s.refpos")
    got = rows.select("i", K.summed(F.col("a"), F.col("b")).alias("s")).select("i", "s.*")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    apart = rows.select(K.summed(F.col("a").withField("refpos", F.lit(90)), F.col("b")).alias("s"))
    with pytest.raises(PySparkException, match="gap"):
        apart.select("s.*").collect()


@pytest.mark.parametrize("size", [10_000, 2])
def test_rows_meet_those_one_place_on(spark, size):
    rows = [(1, 0, "a"), (1, 1, "b"), (1, 1, "c"), (1, 2, "d"), (1, 2, "e"), (1, 4, "f"), (2, 5, "g"), (None, 6, "h"), (1 << 60, 6, "i"), (1 << 60, 7, "j"), (2, None, "k")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
    try:
        got = K.with_next(spark.createDataFrame(rows, "g long, p int, v string"), "g", "p").select("a.v", "b.v").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(x + y for x, y in map(tuple, got)) == ["ab", "ac", "bd", "be", "cd", "ce", "ij"]


def test_offset_sums_take_no_join(spark):
    text = registry.QUERIES["offset_sums"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in text and text.count("RepartitionByExpression") == 1
