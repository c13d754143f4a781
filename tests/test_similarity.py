"""Similarity joins against all pairs: far distances, chosen strings, nearest without a radius; sums at an offset; adapters."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vdjspark.functions import frequencies
from vdjspark.functions import sequences as S
from vdjspark.operators import clones as K
from vdjspark.operators import demultiplex as D
from vdjspark.operators import similarity as J


def distance(a: str, b: str) -> int:
    return sum(x != y for x, y in zip(a, b, strict=True))


@pytest.fixture(scope="module")
def words() -> list[str]:
    rng = random.Random(3)
    out = {"", "A", "C", "AC", "acgt", "ACGT"}
    for n in (3, 9, 20, 20, 31):
        roots = ["".join(rng.choices("ACGTN", k=n)) for _ in range(4)]
        for root in roots:
            out.add(root)
            for _ in range(8):
                s = list(root)
                for i in rng.sample(range(n), min(n, rng.randrange(9))):
                    s[i] = rng.choice("ACGT")
                out.add("".join(s))
    return sorted(out)


@pytest.mark.parametrize("most", [2, 5, 7])
def test_pairs_match_all_pairs(spark, words, most):
    strings = spark.createDataFrame([(s,) for s in [*words, words[5], None]], "seq string")
    want = {(a, b): d for a in words for b in words if a < b and len(a) == len(b) and (d := distance(a, b)) <= most}
    got = [tuple(r) for r in J.hamming_pairs(strings, most).collect()]
    assert len(got) == len(want) and {(a, b): d for a, b, d in got} == want
    some = words[::7]
    got = [tuple(r) for r in J.hamming_pairs(strings, most, among=spark.createDataFrame([(s,) for s in some], "seq string")).collect()]
    assert sorted(got) == sorted((a, b, d) for (a, b), d in want.items() if a in some or b in some)


@pytest.mark.parametrize("part", [20_000, 5])
def test_nearest_without_a_radius(spark, words, part, monkeypatch):
    monkeypatch.setattr(J, "NEAREST_PART", part)
    rng = random.Random(1)
    far = [*words, *("".join(rng.choices("ACGT", k=40)) for _ in range(12))]  # nothing near them
    want = set()
    for s in far:
        others = [(distance(s, t), t) for t in far if t != s and len(t) == len(s)]
        want |= {(s, t, d) for d, t in others if d == min(others)[0]}
    got = [tuple(r) for r in J.nearest_neighbours(spark.createDataFrame([(s,) for s in [*far, far[0], None]], "seq string")).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert J.nearest_neighbours(spark.createDataFrame([("A",), ("AC",)], "seq string")).count() == 0


def clone_rows(spark, rows):
    made = K.with_frequencies(spark.createDataFrame(rows, "seq string, qual array<int>, count long, orig_count long, refpos int"))
    return made.select(F.struct(*made.columns).alias("x"))


def summed(spark, a, b):
    both = clone_rows(spark, [a]).withColumnRenamed("x", "a").crossJoin(clone_rows(spark, [b]).withColumnRenamed("x", "b"))
    return both.select(K.added(F.col("a"), F.col("b")).alias("s")).select("s.*").head()


def test_clones_are_added_where_their_anchors_meet(spark):
    got = summed(spark, ("ACCT", [30] * 4, 1, 1, 2), ("CGAAG", [30] * 5, 1, 3, 0))
    # the second begins two places to the right
    assert (got.seq, list(got.qual), got["count"], got.orig_count, got.refpos, got.mutations, got.bases) == ("ACCNAAG", [30, 30, 30, 0, 30, 30, 30], 2, 3, 2, 1, 9)
    left = summed(spark, ("AAGT", [40] * 4, 2, 2, 0), ("CCCTAAG", [30] * 3 + [40] * 4, 1, 1, 3))
    assert (left.seq, left.mutations) == ("CCCAAGT", 3)  # T under A, A under G, G under T
    touching = summed(spark, ("AC", [9, 9], 1, 1, 2), ("GT", [9, 9], 1, 1, 0))
    assert touching.seq == "ACGT"
    with pytest.raises(PySparkException, match="gap"):
        summed(spark, ("AC", [9, 9], 1, 1, 3), ("GT", [9, 9], 1, 1, 0))
    empty = spark.range(1).select(frequencies.called(frequencies.of_reads(F.lit(""), F.array().cast("array<int>"), F.lit(2))).alias("c")).head().c
    assert (empty.seq, empty.bases, empty.mutations) == ("", 0, 0)


def test_differences_at_an_offset(spark):
    q = lambda n: F.array(*[F.lit(i + 10) for i in range(n)])
    rows = spark.createDataFrame([("ACGT", "CGA", 1), ("CGA", "ACGT", -1), ("ACGT", "ACGT", 0), ("ACGT", "TT", 9), ("", "A", 0)], "a string, b string, o int")
    got = rows.select("a", "b", S.mismatch_quality(F.col("a"), q(4), F.col("b"), q(4), F.col("o")).alias("m")).collect()
    assert [(r.a, r.b, *r.m) for r in got] == [("ACGT", "CGA", 1, 12, 12), ("CGA", "ACGT", 1, 12, 12), ("ACGT", "ACGT", 0, 0, 0), ("ACGT", "TT", 0, 0, 0), ("", "A", 0, 0, 0)]


def test_every_place_of_an_adapter(spark):
    rng = random.Random(9)
    adapters = [D.Adapter("S1", "yACrNN"), D.Adapter("S2", "wGTnnnnnnnnnnnnW".replace("n", "y").replace("W", "w")), D.Adapter("S3", "ACGk")]
    reads = [(i, "".join(rng.choices("ACGTN", weights=(4, 4, 4, 4, 1), k=rng.randrange(0, 60)))) for i in range(60)] + [(99, None)]
    want = []
    for a in adapters:
        p = D.Pattern(a.pattern)
        at, seed = p.seed
        turned = ["".join(D.turned(c) for c in x) for x in reversed(p.allowed)]
        for rc, allowed, ahead, text in ((False, p.allowed, at, seed), (True, turned, len(turned) - at - len(seed), D.turned(seed))):
            for i, s in reads:
                hits = []
                for m in re.finditer(f"(?={text})", s or ""):
                    start = m.start() - ahead
                    if start >= 0 and start + len(allowed) <= len(s) and s[start + len(allowed) - 1] in allowed[-1]:
                        wrong = sum(c not in x for c, x in zip(s[start:], allowed, strict=False))
                        hits += [(wrong, start)] * (wrong <= 3)
                want += [(i, a.sample, rc, n + 1, wrong, start) for n, (wrong, start) in enumerate(sorted(hits))]
    got = D.adapter_hits(spark.createDataFrame(reads, "id long, seq string"), adapters, most=3)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want) and len(want) > 40
    assert not any(r.rc for r in D.adapter_hits(spark.createDataFrame(reads, "id long, seq string"), adapters, both_strands=False).collect())


def test_sets_of_clones(spark):
    one = spark.createDataFrame([("A", 1), ("C", 2)], "seq string, count long")
    more = spark.createDataFrame([("G", 3)], "seq string, count long")
    assert sorted(tuple(r) for r in K.with_clone(one, more).collect()) == [("A", 1), ("C", 2), ("G", 3)]
    with pytest.raises(PySparkException, match="there already: C"):
        K.with_clone(one, spark.createDataFrame([("C", 3)], "seq string, count long")).collect()
    assert tuple(K.totals(one.withColumn("mutations", F.lit(4))).head()) == (2, 3, 3, 8)
