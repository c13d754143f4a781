"""External aligners as one process per partition: reads go in as FASTQ, SAM comes out.

A command is a template in which ``%(ref_fn)s`` is the FASTA file of one region's alleles, ``%(index_fn)s`` the name of
the index that the build command makes of it, ``%(phred_encoding)s`` 33 or 64 and ``%(n_threads)s`` the process's threads.
"""

from __future__ import annotations

import queue
import shlex
import subprocess
import tempfile
import threading
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjspark.sources import sequence_files as files

#: Reads (uid, id, seq, qual_text) -> SAM rows, whose QNAME begins with ``uid:``.
Aligner = Callable[[DataFrame], DataFrame]

# The default commands and their arguments.
BUILD = "bowtie2-build %(ref_fn)s %(index_fn)s"
ALIGN = "bowtie2 --local -x %(index_fn)s - --phred%(phred_encoding)s --threads %(n_threads)s"
ALIGN_V = f"{ALIGN} -D 20 -R 3 -N 0 -i S,1,0.50 -L 8"
ALIGN_J = f"{ALIGN} -D 20 -R 3 -N 0 -i S,1,0.50 -L 6"

#: Bytes of one region's alleles that go to every task.
REFERENCE_BYTES = 8 << 20


@dataclass(frozen=True)
class Command:
    """``build`` may be empty. ``limit``: seconds that a partition's build or alignment may take, beyond which its task fails."""

    align: str
    build: str = ""
    phred: int = 33
    threads: int = 1
    limit: float = 3600.0


def reference_fasta(alleles: DataFrame, region: str) -> str:
    """FASTA of the region's alleles (name, seq), by name; more than REFERENCE_BYTES raise before anything is collected."""
    rows = alleles.filter(F.substring("name", 4, 1) == region).select("name", "seq")
    held = rows.agg(F.sum(F.octet_length("name") + F.octet_length("seq") + 3)).head()[0] or 0
    if held > REFERENCE_BYTES:
        raise ValueError(f"the {region} alleles take {held} bytes; a reference may take {REFERENCE_BYTES}")
    return "".join(f">{r.name_}\n{r.seq}\n" for r in rows.select(F.col("name").alias("name_"), "seq").sort("name_", "seq").collect())


def _failed(args: list[str], code: int, errors: Path, late: bool) -> RuntimeError:
    why = "took longer than its limit" if late else f"ended with {code}"
    return RuntimeError(f"{shlex.join(args)} {why}: {errors.read_text(errors='replace')[-2000:]}")


def _built(args: list[str], errors: Path, limit: float) -> None:
    with errors.open("wb") as log:
        try:
            code, late = subprocess.run(args, stdout=subprocess.DEVNULL, stderr=log, timeout=limit).returncode, False
        except subprocess.TimeoutExpired:
            code, late = -1, True
    if code:
        raise _failed(args, code, errors, late)


def _sam(process: subprocess.Popen, records: Iterator[bytes]) -> Iterator[list[bytes]]:
    """Writes the records and yields the lines that came out meanwhile, so what is held follows what went in with one batch."""
    came: queue.SimpleQueue = queue.SimpleQueue()

    def collect() -> None:
        for line in process.stdout:
            came.put(line)
        came.put(None)

    threading.Thread(target=collect, daemon=True).start()
    try:
        for record in records:
            process.stdin.write(record)
            yield [came.get() for _ in range(came.qsize() - 1)]  # the last may be the end mark, which is for the loop below
        process.stdin.close()
    except BrokenPipeError:
        pass  # it ended early: its exit is judged when its output is read
    rest = []
    while (line := came.get()) is not None:
        rest.append(line)
        if len(rest) == 10_000:
            yield rest
            rest = []
    yield rest


def _fastq(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
    for batch in batches:
        yield "".join(f"@{n}\n{s}\n+\n{q}\n" for n, s, q in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True)).encode()


def _aligned(batches: Iterator[pa.RecordBatch], command: Command, fasta: str) -> Iterator[pa.RecordBatch]:
    records = _fastq(batches)
    first = next(records, b"")
    if not first:
        return
    # the process needs real files: its task's own, which go with it
    with tempfile.TemporaryDirectory() as folder:
        errors, reference = Path(folder, "errors"), Path(folder, "ref.fa")
        reference.write_text(fasta)
        values = {"ref_fn": str(reference), "index_fn": str(Path(folder, "index")), "phred_encoding": command.phred, "n_threads": command.threads}
        if command.build:
            _built(shlex.split(command.build % values), errors, command.limit)
        args = shlex.split(command.align % values)
        with errors.open("wb") as log:
            process = subprocess.Popen(args, stdin=subprocess.PIPE, stdout=subprocess.PIPE, stderr=log)
        late = threading.Event()
        timer = threading.Timer(command.limit, lambda: (late.set(), process.kill()))
        timer.start()
        try:
            for lines in _sam(process, _chained(first, records)):
                if lines:
                    yield pa.RecordBatch.from_pydict({"value": pa.array([x.decode("utf-8", "replace").rstrip("\r\n") for x in lines], pa.string())})
            code = process.wait()
            if code or late.is_set():
                raise _failed(args, code, errors, late.is_set())
        finally:
            timer.cancel()
            process.kill()
            process.wait()


def _chained(first: bytes, rest: Iterator[bytes]) -> Iterator[bytes]:
    yield first
    yield from rest


def command_aligner(alleles: DataFrame, region: str, command: Command) -> Aligner:
    """An aligner for ``repertoire.aligned`` that pipes each partition's reads through ``command``.

    Each task builds the index of the region's alleles for itself, so a lost executor loses nothing. Partitions without
    reads start no process. A command that isn't there, ends with an error or takes too long fails its task, with the end
    of what it wrote to its error stream. Null sequences and qualities go as empty ones; SAM headers are left out.
    """
    fasta = reference_fasta(alleles, region)

    def align(reads: DataFrame) -> DataFrame:
        empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
        named = reads.select(F.concat(F.col("uid").cast("string"), F.lit(":"), F.coalesce("id", F.lit(""))).alias("name"), empty("seq"), empty("qual_text"))
        return files.sam_records(named.mapInArrow(lambda batches: _aligned(batches, command, fasta), "value string"))

    return align
