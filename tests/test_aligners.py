"""Aligner commands as processes of the partitions, with stub commands."""

from __future__ import annotations

import sys

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vdjspark.jobs import repertoire
from vdjspark.operators import aligners as A
from vdjspark.sources import sequence_files as files

#: Places each read at the first allele that holds its first 8 (V) or last 8 (J) bases; reads the index that the build made.
STUB = """
import sys
index, region = sys.argv[1:3]
alleles = open(index).read().split()
print("@HD\\tVN:1.0")
while head := sys.stdin.readline():
    seq, _, qual = [sys.stdin.readline().strip("\\n") for _ in range(3)]
    seed, hit = (seq[:8] if region == "V" else seq[-8:]), None
    for name, ref in zip(alleles[::2], alleles[1::2]):
        if len(seed) == 8 and seed in ref:
            hit = (name[1:], ref.index(seed))
            break
    name = head[1:].strip()
    if not hit:
        print(name, 4, "*", 0, 0, "*", "*", 0, 0, seq, qual, sep="\\t")
    elif region == "V":
        print(name, 0, hit[0], hit[1] + 1, 9, f"8M{len(seq) - 8}S", "*", 0, 0, seq, qual, sep="\\t")
    else:
        print(name, 0, hit[0], hit[1] + 1, 9, f"{len(seq) - 8}S8M", "*", 0, 0, seq, qual, sep="\\t")
"""


@pytest.fixture
def stub(tmp_path):
    (tmp_path / "stub.py").write_text(STUB)
    return lambda region: A.Command(f"{sys.executable} {tmp_path}/stub.py %(index_fn)s {region}", "cp %(ref_fn)s %(index_fn)s")


def alleles_of(spark):
    return spark.createDataFrame([("TRBV1*01", "AACCGGTTAACC"), ("TRBV2*01", "ACGTACGTTTTT"), ("TRBJ1*01", "GGGGCCCCAAAA")], "name string, seq string")


def test_reads_meet_both_aligners(spark, stub):
    rows = [(0, "a b", "AACCGGTT" + "CAT" + "GGGGCCCC"), (1, "c", "ACGTTTTT" + "GGCCCCAA"), (2, "d", "CCCCCCCCCC"), (3, None, None)]
    reads = spark.createDataFrame(rows, "ordinal long, id string, seq string").withColumn("qual_text", F.regexp_replace("seq", ".", "I"))
    v, j = [A.command_aligner(alleles_of(spark), region, stub(region)) for region in "VJ"]
    got = {r.uid: r for r in repertoire.aligned(reads.repartition(3), v, j).collect()}
    assert {u: (r.v.QNAME, r.v.RNAME, r.v.POS, r.v.CIGAR, r.j.RNAME, r.j.POS, r.j.SEQ) for u, r in got.items()} == {
        0: ("a b", "TRBV1*01", 1, "8M11S", "TRBJ1*01", 1, "CATGGGGCCCC"),
        1: ("c", "TRBV2*01", 5, "8M8S", "TRBJ1*01", 3, "GGCCCCAA"),
        2: ("d", "*", 0, "*", "*", 0, ""),
        3: ("", "*", 0, "*", "*", 0, ""),
    }


def test_many_reads_pass_in_bounded_batches(spark, stub):
    reads = spark.range(0, 60_000, 1, 2).select(F.col("id").alias("uid"), F.lit("x").alias("id"), F.lit("AACCGGTTA" * 6).alias("seq"), F.lit("I" * 54).alias("qual_text"))
    got = A.command_aligner(alleles_of(spark), "V", stub("V"))(reads)
    assert got.columns == list(files.SAM_COLUMNS)
    assert got.select("QNAME").distinct().count() == 60_000
    assert A.command_aligner(alleles_of(spark), "V", A.Command("no-such-command"))(reads.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("command", "message"),
    [
        (A.Command("sh -c 'cat > /dev/null; echo broken index >&2; exit 3'"), "ended with 3: broken index"),
        (A.Command("sh -c 'exit 5'"), "ended with 5"),
        (A.Command("cat", "sh -c 'echo no room >&2; exit 1'"), "ended with 1: no room"),
        (A.Command("sleep 60", limit=1.0), "took longer than its limit"),
        (A.Command("no-such-command"), "no-such-command"),
    ],
)
def test_commands_that_fail_raise(spark, command, message):
    reads = spark.range(5).select(F.col("id").alias("uid"), F.lit("x").alias("id"), F.lit("ACGT").alias("seq"), F.lit("IIII").alias("qual_text"))
    with pytest.raises(PySparkException, match=message):
        A.command_aligner(alleles_of(spark), "V", command)(reads).collect()


def test_large_references_raise(spark, monkeypatch):
    monkeypatch.setattr(A, "REFERENCE_BYTES", 10)
    with pytest.raises(ValueError, match="V alleles take"):
        A.reference_fasta(alleles_of(spark), "V")
