"""Record files split by byte range give the records of the whole file, wherever the ranges begin."""

from __future__ import annotations

import gzip
import random

import pytest
from pyspark.errors import PySparkException

from vdjspark.sources import ranges
from vdjspark.sources import sequence_files as files


def records_at(kind, path, size):
    out = []
    for part in ranges.planned([(str(path), path.stat().st_size)], size):
        with ranges._opened(part.uri) as stream:
            out.extend(ranges.READ[kind](ranges._lines(stream, part.start), part))
    return out


def fastq_of(rng, n):
    """Qualities that begin with @ and +, ids that look like marks, empty reads, both kinds of line ends."""
    rows = []
    for i in range(n):
        k = rng.choice([0, 1, 2, 5, 9])
        rows.append((f"@{i}" if i % 3 else f"r{i} +x", "".join(rng.choices("ACGTN", k=k)), "".join(rng.choices("@+I!>", k=k))))
    return rows


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_every_size_of_range_gives_the_same_records(tmp_path, end):
    rng = random.Random(1)
    rows = fastq_of(rng, 40)
    path = tmp_path / "a.fq"
    path.write_bytes("".join(f"@{h}{end}{s}{end}+{h if i % 2 else ''}{end}{q}{end}" for i, (h, s, q) in enumerate(rows)).encode())
    want = [tuple(x.encode() for x in r) for r in rows]
    for size in range(1, path.stat().st_size + 2):
        assert records_at("fastq", path, size) == want, size
    fasta = tmp_path / "a.fa"
    fasta.write_bytes(end.join(["; note", ">x y", "ac", "gt", ">z", "", ">w", "A"]).encode())
    plain = tmp_path / "a.txt"
    plain.write_bytes(end.join(["", "a", "", "bb"]).encode())
    for size in range(1, 40):
        assert records_at("fasta", fasta, size) == [(b"x y", b"ACGT"), (b"z", b""), (b"w", b"A")], size
        assert records_at("line", plain, size) == [(b"",), (b"a",), (b"",), (b"bb",)], size


def test_broken_records_raise_in_any_range(tmp_path):
    for text in ("@a\nAC\n+\nII\n@b\nAC\n+\n", "@a\nAC\n+\nII\n@b\nAC\n", "@a\nAC\n+\nI\n@b\nAC\n+\nII\n", "@a\nAC\n+\nII\nb\nAC\n-\nII\n@c\nA\n+\nI\n"):
        path = tmp_path / "b.fq"
        path.write_text(text)
        for size in range(1, len(text) + 1):
            with pytest.raises(ValueError, match="no FASTQ record"):
                records_at("fastq", path, size)


def test_numbers_run_over_ranges_and_files(spark, tmp_path):
    rows = fastq_of(random.Random(2), 50)
    lines = [f"@{h}\n{s}\n+\n{q}\n" for h, s, q in rows]
    folder = tmp_path / "reads"
    folder.mkdir()
    (folder / "a.fq").write_text("".join(lines[:30]))
    (folder / "b.fq.gz").write_bytes(gzip.compress("".join(lines[30:]).encode()))
    (folder / "_SUCCESS").write_text("")
    (folder / "c.fq").write_text("")
    for size in (7, 64, 1 << 20):
        got = files.read_fastq(spark, str(folder), None, size)
        assert [(r.ordinal, r.seq, r.qual_text) for r in got.orderBy("ordinal").collect()] == [(i, s, q) for i, (_, s, q) in enumerate(rows)]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan
    assert [r.line for r in files.lines(spark, [str(folder / "a.fq")], 50).orderBy("line").collect()] == list(range(120))
    with pytest.raises(FileNotFoundError):
        files.read_fastq(spark, str(tmp_path / "none"))
    (tmp_path / "bad.fq").write_text("@r1\nACG\n+\n")
    with pytest.raises(PySparkException, match="no FASTQ record"):
        files.read_fastq(spark, str(tmp_path / "bad.fq")).collect()


def test_no_files_with_bytes_give_an_empty_table(spark, tmp_path):
    (tmp_path / "e.fa").write_text("")
    assert files.read_fasta(spark, str(tmp_path / "e.fa")).count() == 0
