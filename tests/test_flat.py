"""Counts by Arrow batches against the column functions on random alignments; what the queries' plans read once."""

from __future__ import annotations

import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vdjspark.functions import cigar as C
from vdjspark.functions import sequences as S
from vdjspark.jobs import alignments, registry, repertoire

SF = "/root/testdata/sf0.001"


def random_junctions(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        row = [i]
        for _ in "vj":
            cigar = "".join(f"{rng.randrange(6)}{rng.choice('MIDNSHP=X')}" for _ in range(rng.randrange(1, 8)))
            seq = "".join(rng.choices("ACGTNé", weights=(9, 9, 9, 9, 1, 1), k=rng.randrange(1, 30)))
            row.append((cigar, rng.randrange(0, 6), seq, "".join(chr(33 + rng.randrange(42)) for _ in seq)))
            row.append((rng.randrange(3, 20), "".join(rng.choices("ACGT", k=25))))
        size = rng.randrange(1, 9)
        rows.append((*row, "".join(rng.choices("ACGTN", k=size)), "".join(chr(33 + rng.randrange(42)) for _ in range(size)), rng.randrange(-2, 6), rng.randrange(-1, 12)))
    sam, ref = "struct<CIGAR: string, POS: int, SEQ: string, QUAL: string>", "struct<refpos: int, seq: string>"
    return spark.createDataFrame(rows, f"ordinal long, v {sam}, v_ref {ref}, j {sam}, j_ref {ref}, seq string, qual_text string, v_end int, j_start int")


def test_counts_match_the_columns(spark):
    rows = random_junctions(spark)
    errors, seen = [], []
    for side in "vj":
        at = F.col(f"{side}_ref.refpos")
        bounds = (at - 3, None) if side == "v" else (F.lit(0), at + 3)
        sam = [F.col(f"{side}.{c}") for c in ("CIGAR", "POS", "SEQ")]
        errors.append(rows.select(F.lit(side.upper()).alias("region"), F.length("seq").alias("seqlen"), C.error_stats(*sam, F.col(f"{side}_ref.seq"), *bounds).alias("s")).select("region", "seqlen", "s.n", "s.mm", "s.ins", "s.dels"))
        seen.append(rows.select(F.lit(side.upper()).alias("region"), F.explode(C.base_qualities(*sam, S.decode_quality(F.col(f"{side}.QUAL")), F.col(f"{side}_ref.seq"), *bounds)).alias("x")).select("region", "x.*"))
    want = errors[0].union(errors[1]).groupBy("region", "seqlen").agg(*[F.sum(c).alias(c) for c in ("n", "mm", "ins", "dels")])
    got = repertoire.alignment_stats(rows)
    assert sorted(map(tuple, got[0].collect())) == sorted(map(tuple, want.collect()))
    want = seen[0].union(seen[1]).groupBy("region", "q").agg(F.count("*").alias("n"), F.count_if("wrong").alias("mm"))
    by_quality = {(r.region, r.q): (r.n, r.mm) for r in want.collect()}
    assert {(r.region, r.q): (r.n, r.mm) for r in got[1].collect()} == by_quality and len(by_quality) > 40
    every = {(r.region, r.Q): (r.n, r.mm) for r in repertoire.all_qualities(got[1]).collect()}
    assert every == {(x, q): by_quality.get((x, q), (0, 0)) for x in "VJ" for q in range(42)}


def test_qualities_between_are_counted_in_the_same_pass(spark):
    rows = random_junctions(spark)
    want: dict[tuple[int, int], int] = {}
    for r in rows.collect():
        for base, q in list(zip(r.seq, r.qual_text, strict=True))[max(0, r.v_end) : max(0, r.j_start)]:
            key = len(r.seq), 0 if base == "N" else ord(q) - 33
            want[key] = want.get(key, 0) + 1
    assert {(r.seqlen, r.q): r.cnt for r in repertoire.statistics(rows)[2].collect()} == want


def test_places_match_the_columns(spark):
    rows = random_junctions(spark).select("ordinal", F.col("v.CIGAR").alias("c"), (F.col("v.POS") - 1).alias("ras"), F.col("v_ref.refpos").alias("t"))
    rows = rows.unionByName(spark.createDataFrame([(90, None, 1, 2), (91, "3M", None, 2), (92, "3M", 1, None), (93, "*", 1, 1)], rows.schema))
    span = C.intervals(F.col("c"), F.col("ras"))
    want = rows.select("ordinal", span["qas"], span["qae"], C.query_position(F.col("c"), F.col("ras"), F.col("t"))).collect()
    for fixed in (False, True):
        m = C.measured(F.col("c"), F.col("ras"), F.col("t"), fixed)
        assert sorted(map(tuple, rows.select("ordinal", m["qas"], m["qae"], m["at"]).collect())) == sorted(map(tuple, want))
    with pytest.raises(PySparkException, match="invalid CIGAR 3M4"):
        rows.select(C.measured(F.lit("3M4"), F.col("ras"))["qae"]).collect()


def executed(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_alignments_are_read_once(spark):
    # one pass for the reads, one for the counts
    assert executed(alignments.alignment_qualities(spark, SF)).count("MapInArrow") == 2
    assert executed(alignments.alignment_sums(spark, SF)).count("MapInArrow") == 2


def test_no_operation_is_placed_by_columns(spark):
    for name in ("alignment_sums", "alignment_qualities", "v_trimmed"):
        assert "regexp_extract_all" not in executed(registry.QUERIES[name](spark, SF))


def test_reads_are_the_letters_in_order(spark):
    text = [(3, "s", "Aé b-" * 40 + "zİK"), (None, None, "xyz"), (4, "t", None), (1 << 60, "u", "12 3"), (9, "u", "q" * 90)]
    docs = spark.createDataFrame(text, "doc_id long, source string, text string").coalesce(1)
    want = []
    for i, source, t in text:
        found = "".join(c for c in (t or "").lower() if "a" <= c <= "z")
        want += [(i, source, k // 45, found[k : k + 45].translate(str.maketrans(registry.LETTERS, registry.AS_BASES))) for k in range(0, len(found), 45)]
    assert [tuple(r) for r in registry.reads_of(docs).select("doc_id", "source", "tile", "seq").collect()] == want
