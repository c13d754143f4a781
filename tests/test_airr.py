"""AIRR rows and files: values known by hand, calls that the reference lacks, text that looks like quotes."""

from __future__ import annotations

import glob

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from vdjspark.functions import airr
from vdjspark.operators import clones as K
from vdjspark.sources import tables

CLONE = "sequence_id long, seq string, qual array<int>, count long, v_call string, j_call string, v_end int, j_start int"
GERMLINE = [("TRBV1*01", 6, "AAATGCACC"), ("TRBV2*01", 9, "GGTGCGTGCACCACC"), ("TRBJ1*01", 9, "GAAGCTTTCTTTGGA"), ("TRBJ2*01", 3, "TACTTCGGCGCCGGGACCG")]


@pytest.fixture(scope="module")
def germline(spark):
    return spark.createDataFrame(GERMLINE, "name string, refpos int, seq string")


def clone(v: int, j: int, between: str, count: int = 1, number: int = 1) -> tuple:
    (v_name, v_at, v_seq), (j_name, j_at, j_seq) = GERMLINE[v], GERMLINE[j]
    head, tail = v_seq[v_at - 3 :], j_seq[: j_at + 3]
    seq = head + between + tail
    return (number, seq, [40] * len(seq), count, v_name, j_name, len(head), len(head + between))


@pytest.mark.parametrize(
    ("made", "want"),
    [
        (clone(0, 2, "CCC"), {
            "rev_comp": "F", "v_call": "TRBV1*01", "j_call": "TRBJ1*01", "sequence": "AAATGCACCCCCGAAGCTTTCTTTGGA", "junction": "TGCACCCCCGAAGCTTTCTTT", "junction_aa": "CTPEAFF", "duplicate_count": "1", "productive": "T",
            "vj_in_frame": "T", "stop_codon": "F", "cdr3_start": "7", "cdr3_end": "21", "v_sequence_end": "9", "j_sequence_start": "13", "v_junction_end": "6", "j_junction_start": "10",
        }),
        (clone(1, 2, "CC", 123), {
            "sequence": "GGTGCGTGCACCACCCCGAAGCTTTCTTTGGA", "v_call": "TRBV2*01", "junction": "TGCACCACCCCGAAGCTTTCTTT", "junction_aa": "CTTPKLS", "duplicate_count": "123", "productive": "F", "vj_in_frame": "F", "stop_codon": "F",
            "cdr3_start": "10", "cdr3_end": "26", "v_sequence_end": "15", "j_sequence_start": "18", "v_junction_end": "9", "j_junction_start": "12",
        }),
        (clone(0, 3, "TAG"), {
            "sequence": "AAATGCACCTAGTACTTCGGCGCCGGGACCG", "junction": "TGCACCTAGTACTTC", "junction_aa": "CT*YF", "productive": "F", "vj_in_frame": "T", "stop_codon": "T", "cdr3_start": "7", "cdr3_end": "15", "j_sequence_start": "13",
        }),
    ],
)
def test_rows_known_by_hand(spark, germline, made, want):
    got = airr.rearrangements(spark.createDataFrame([made], CLONE), germline).head().asDict()
    assert {k: got[k] for k in want} == want
    assert got["junction_quality_scores"] == "|".join(["40"] * len(made[1]))
    assert got["junction_minimum_quality_score"] == "40"
    assert tuple(got) == airr.COLUMNS
    without = airr.rearrangements(spark.createDataFrame([made], CLONE)).head().asDict()
    assert {c for c in airr.COLUMNS if without[c] == ""} >= {"sequence", "productive", "vj_in_frame", "stop_codon", "cdr3_start", "cdr3_end", "v_sequence_end", "j_sequence_start"}
    assert without["junction_quality_scores"] == got["junction_quality_scores"]


@pytest.mark.parametrize(("v_call", "j_call", "said"), [("TRBV9*01", "TRBJ1*01", "no such allele"), ("TRBV1*01", "TRBJ9*01", "no such allele"), ("TRBJ1*01", "TRBJ1*01", "region V expected"), ("TRBV1*01", "TRBV1*01", "region J expected"), (None, "TRBJ1*01", "no such allele")])
def test_calls_that_the_reference_lacks_raise(spark, germline, v_call, j_call, said):
    made = list(clone(0, 2, "CCC"))
    made[4:6] = v_call, j_call
    rows = spark.createDataFrame([clone(0, 2, "CCC"), tuple(made)], CLONE)
    for chosen in (airr.COLUMNS, ["v_call", "j_call"]):
        with pytest.raises(PySparkException, match=said):
            airr.rearrangements(rows, germline).select(*chosen).collect()


def test_alignments_to_unknown_alleles_raise(spark, germline):
    sam = "struct<QNAME: string, FLAG: int, RNAME: string, POS: int, MAPQ: int, CIGAR: string, SEQ: string, QUAL: string>"
    v = ("r", 0, "TRBV1*01", 1, 40, "9M12S", "AAATGCACCCCCGAAGCTTTC", "I" * 21)
    j = ("r", 0, "TRBJ7*01", 1, 40, "12M", "CCCGAAGCTTTC", "I" * 12)
    unmapped = ("r", 4, "*", 0, 0, "*", "CCC", "III")
    assert K.junctions(spark.createDataFrame([(1, v, unmapped)], f"uid long, v {sam}, j {sam}"), germline).count() == 0
    with pytest.raises(PySparkException, match="TRBJ7"):
        K.junctions(spark.createDataFrame([(1, v, j)], f"uid long, v {sam}, j {sam}"), germline).collect()


def test_files_are_plain_text(spark, tmp_path):
    rows = spark.createDataFrame([('a"b\\c', "", None, " x "), ("I\\", '""', "#", "é")], "a string, b string, c string, d string")
    tables.write_airr(rows.coalesce(1), str(tmp_path / "airr"))
    (part,) = glob.glob(str(tmp_path / "airr" / "part-*"))
    with open(part, encoding="utf-8") as file:
        assert file.read() == 'a\tb\tc\td\na"b\\c\t\t\t x \nI\\\t""\t#\té\n'
    with pytest.raises(PySparkException, match="tab or line end in a"):
        tables.write_airr(rows.withColumn("a", F.lit("x\ty")), str(tmp_path / "bad"))


def test_quotes_are_qualities(spark, tmp_path):
    (tmp_path / "junctions.tsv").write_text('read_name\tnt_jnc\tq_jnc\nr1\tACGT\t""""\nr2\tACGT\t"III\nr3\tAC\tI"\n')
    got = tables.read_junctions(spark, str(tmp_path / "junctions.tsv")).collect()
    assert [(r.seq, list(r.qual)) for r in got] == [("ACGT", [1, 1, 1, 1]), ("ACGT", [1, 40, 40, 40]), ("AC", [40, 1])]
