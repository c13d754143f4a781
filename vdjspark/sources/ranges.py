"""Record files split by byte range: a Python data source that plans ranges and finds the record marks within each.

A record belongs to the range that its first byte lies in, and the task of that range reads it to its end, so nothing is
staged or shuffled to bring a record's lines together. Ranges have a fixed size, whatever the cores, so a range's first
number, which comes from the counts of those before it, holds for every run of the plan. Compressed files are one range.
"""

from __future__ import annotations

import bz2
import gzip
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice
from urllib.parse import quote, urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from vdjspark.runtime import BATCH_BYTES, small, stage

RANGE_BYTES = 64 << 20
#: The text columns of a record.
KINDS = {"fastq": ("head", "seq", "qual_text"), "fasta": ("name", "seq"), "line": ("value",)}
PACKED = {".gz": gzip.open, ".bz2": bz2.open}

Lines = Iterator[tuple[int, bytes]]


@dataclass
class Range(InputPartition):
    file: int
    uri: str
    start: int
    end: float


def _opened(uri: str) -> io.BufferedIOBase:
    """The file's bytes, unpacked by suffix; other file systems than the local one by Arrow."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        raw = open(uri.removeprefix("file:").replace("//", "", 1) if uri.startswith("file://") else uri.removeprefix("file:"), "rb")  # noqa: SIM115
    else:
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(quote(uri, safe=":/@?=&%"))
        raw = io.BufferedReader(system.open_input_file(path), 1 << 20)
    unpack = next((u for suffix, u in PACKED.items() if uri.endswith(suffix)), None)
    return unpack(raw, "rb") if unpack else raw


def _lines(stream: io.BufferedIOBase, start: int) -> Lines:
    """Lines without their ends, with the place of their first byte, from the first that begins at ``start`` or later."""
    at = start
    if start:
        stream.seek(start - 1)
        at += len(stream.readline()) - 1
    for line in stream:
        yield at, line.rstrip(b"\r\n")
        at += len(line)


def _fastq(lines: Lines, part: Range) -> Iterator[tuple[bytes, ...]]:
    """Records of four lines. The first head is the line with ``@`` whose second next has ``+``: a quality line can begin with ``@`` too, but a sequence two lines later never begins with ``+``."""
    held = list(islice(lines, 7))
    heads = [i for i in range(min(4, len(held) - 2)) if held[i][1].startswith(b"@") and held[i + 2][1].startswith(b"+")]
    if part.start == 0:
        skip = 0
    elif heads:
        skip = heads[0]
    elif len(held) > 3 or (len(held) > 1 and not held[-2][1].startswith(b"+")):
        raise ValueError(f"{part.uri}, byte {held[0][0]}: no FASTQ record")
    else:
        return  # the last lines of the record before; a file cut behind a head at a range's start looks like this too
    rest = chain(held[skip:], lines)
    while four := list(islice(rest, 4)):
        at, texts = four[0][0], [line for _, line in four]
        if at >= part.end:
            return
        if len(texts) < 4 or not texts[0].startswith(b"@") or not texts[2].startswith(b"+") or len(texts[1]) != len(texts[3]):
            raise ValueError(f"{part.uri}, byte {at}: no FASTQ record")
        yield texts[0][1:], texts[1], texts[3]


def _fasta(lines: Lines, part: Range) -> Iterator[tuple[bytes, ...]]:
    """Headers with the lines up to the next; lines before the first header are comments, or end the record of the range before."""
    name, parts = None, []
    for at, line in lines:
        if line.startswith(b">"):
            if name is not None:
                yield name, b"".join(parts).upper()
            name, parts = None, []
            if at >= part.end:
                return
            name = line[1:]
        elif name is not None:
            parts.append(line.strip())
        elif at >= part.end:
            return
    if name is not None:
        yield name, b"".join(parts).upper()


def _line(lines: Lines, part: Range) -> Iterator[tuple[bytes, ...]]:
    for at, line in lines:
        if at >= part.end:
            return
        yield (line,)


READ = {"fastq": _fastq, "fasta": _fasta, "line": _line}


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.kind, self.files, self.size, self.count = options["kind"], json.loads(options["files"]), int(options["size"]), options["count"] == "true"

    def partitions(self) -> list[Range]:
        return planned(self.files, self.size)

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no ranges were planned
            return
        with _opened(part.uri) as stream:
            records = READ[self.kind](_lines(stream, part.start), part)
            if self.count:
                yield pa.RecordBatch.from_pydict({"file_": pa.array([part.file], pa.int32()), "start_": pa.array([part.start], pa.int64()), "n_": pa.array([sum(1 for _ in records)], pa.int64())})
                return
            first, rows, held = 0, [], 0
            for record in records:
                rows.append(record)
                held += sum(map(len, record))
                if held >= BATCH_BYTES:
                    yield self._batch(part, first, rows)
                    first, rows, held = first + len(rows), [], 0
            if rows:
                yield self._batch(part, first, rows)

    def _batch(self, part: Range, first: int, rows: list[tuple[bytes, ...]]) -> pa.RecordBatch:
        place = {"file_": pa.array([part.file] * len(rows), pa.int32()), "start_": pa.array([part.start] * len(rows), pa.int64()), "place_": pa.array(range(first, first + len(rows)), pa.int64())}
        return pa.RecordBatch.from_pydict(place | {name: pa.array([x.decode("utf-8", "replace") for x in column], pa.string()) for name, column in zip(KINDS[self.kind], zip(*rows, strict=True), strict=True)})


class RecordFiles(DataSource):
    """Options: kind (of KINDS), files (JSON list of URI and bytes), size (bytes of a range), count (``true``: a row for each range with its records)."""

    @classmethod
    def name(cls) -> str:
        return "vdjspark_records"

    def schema(self) -> str:
        values = "n_ bigint" if self.options["count"] == "true" else ", ".join(["place_ bigint", *[f"{c} string" for c in KINDS[self.options["kind"]]]])
        return f"file_ int, start_ bigint, {values}"

    def reader(self, schema) -> _Reader:  # noqa: ANN001
        return _Reader({k: self.options[k] for k in ("kind", "files", "size", "count")})


def planned(files: list[tuple[str, int]], size: int) -> list[Range]:
    """Ranges of ``size`` bytes of each file; a compressed one is a single range without an end."""
    out = []
    for i, (uri, n) in enumerate(files):
        if uri.endswith(tuple(PACKED)):
            out.append(Range(i, uri, 0, float("inf")))
        else:
            out.extend(Range(i, uri, at, min(at + size, n)) for at in range(0, n, size))
    return out


def listed(spark: SparkSession, path: str | list[str]) -> list[tuple[str, int]]:
    """URI and bytes of all files under the paths (globs and folders too), by name; hidden ones are left out. A path without files raises."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    found = {}
    for one in [path] if isinstance(path, str) else path:
        where = hadoop.Path(one)
        system = where.getFileSystem(conf)
        roots = system.globStatus(where)
        if not roots:
            raise FileNotFoundError(one)
        for root in roots:
            top, inside = root.getPath().toString(), system.listFiles(root.getPath(), True)
            while inside.hasNext():
                status = inside.next()
                uri = status.getPath().toString()
                if not any(p.startswith(("_", ".")) for p in uri.removeprefix(top).split("/") if p):
                    found[uri] = status.getLen()
    return sorted(found.items())


def read_records(spark: SparkSession, path: str | list[str], kind: str, number: str | None = "ordinal", size: int = RANGE_BYTES) -> DataFrame:
    """Records of ``kind`` with their text columns and, unless ``number`` is None, numbered from 0 without gaps in the order of files and places.

    Numbers need the counts of all ranges, which a first pass over the files takes; a single range needs none.
    """
    spark.dataSource.register(RecordFiles)
    files = listed(spark, path)
    options = {"kind": kind, "files": json.dumps(files), "size": str(size)}
    rows = spark.read.format(RecordFiles.name()).options(**options, count="false").load()
    if number is None:
        return rows.select(*KINDS[kind])
    if len(planned(files, size)) < 2:
        return rows.select(F.col("place_").alias(number), *KINDS[kind])
    counts = stage(spark.read.format(RecordFiles.name()).options(**options, count="true").load(), "ranges")
    first = F.sum("n_").over(Window.orderBy("file_", "start_")) - F.col("n_")  # a row for each range
    firsts = small(stage(counts.select(F.col("file_").alias("of_"), F.col("start_").alias("from_"), first.alias("first_")), "firsts"))
    numbers = rows.join(firsts, (F.col("file_") == F.col("of_")) & (F.col("start_") == F.col("from_")))
    return numbers.select((F.col("first_") + F.col("place_")).alias(number), *KINDS[kind])
