"""From paired alignments to ranked, corrected clones: the whole run as one chain of tables.

Aligners are external: a run takes SAM rows, or reads and two aligners, which are commands (``aligners.command_aligner``)
or any functions DataFrame -> DataFrame.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjspark.functions import airr, flat
from vdjspark.functions import sequences as S
from vdjspark.operators import aligners as A
from vdjspark.operators import clones as K
from vdjspark.operators import demultiplex as D
from vdjspark.operators import error_rates as E
from vdjspark.operators import merges as M
from vdjspark.runtime import stage
from vdjspark.sources import sequence_files as files
from vdjspark.sources import tables


@dataclass(frozen=True)
class Options:
    """collapse_vj: clones are junction sequences; else sequence, V and J."""

    min_length: int = 10
    min_quality: int = 5
    confidence: float = 0.99
    collapse_vj: bool = True


def aligned(reads: DataFrame, v_aligner: A.Aligner, j_aligner: A.Aligner) -> DataFrame:
    """Reads (ordinal, id, seq, qual_text) -> uid, v, j: what V leaves of a read goes to the J aligner, and both meet by uid."""
    v = stage(v_aligner(reads.select(F.col("ordinal").alias("uid"), "id", "seq", "qual_text")), "v-aligned")
    head = F.substring_index("QNAME", ":", 1)
    v = v.withColumn("uid", head.cast("long")).withColumn("QNAME", F.substring("QNAME", F.length(head) + 2, F.length("QNAME")))
    v = v.select("uid", *files.SAM_COLUMNS)
    rest = v.select("uid", F.col("QNAME").alias("id"), K.after_v(F.struct(*files.SAM_COLUMNS)).alias("r")).select("uid", "id", F.col("r.seq").alias("seq"), F.col("r.qual").alias("qual_text"))
    return K.paired_by_uid(v, j_aligner(rest).select(*files.SAM_COLUMNS))


def alignment_dump(pairs: DataFrame) -> DataFrame:
    """Each pair as two SAM lines, V before J, in order of uid: ``value``."""
    line = lambda side: F.concat_ws("\t", *[F.col(f"{side}.{c}").cast("string") for c in files.SAM_COLUMNS])
    return pairs.orderBy("uid").select(F.concat_ws("\n", line("v"), line("j")).alias("value"))


def alignment_stats(junctions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Junctions with their alignments -> error sums by region and junction length, and base counts by region and quality.

    The V counts from its anchor on, the J up to its anchor: (region, seqlen, n, mm, ins, dels) and
    (region, q, n, mm). Only reads that gave a junction count.
    """
    errors, seen = _counted(junctions, "errors"), _counted(junctions, "qualities")
    return errors.select("region", "seqlen", "n", "mm", "ins", "dels"), seen.select("region", "q", "n", "mm")


def statistics(junctions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """alignment_stats(), and the histogram (seqlen, q, cnt) of the qualities between V and J, an N's being 0: all by one pass over the junctions, as small written tables."""
    every = stage(_counted(junctions, "errors", "qualities", "between"), "statistics")
    of = lambda kind, *columns: every.filter(F.col("kind") == kind).select(*columns)
    return of("errors", "region", "seqlen", "n", "mm", "ins", "dels"), of("qualities", "region", "q", "n", "mm"), of("between", "seqlen", "q", F.col("n").alias("cnt"))


def _counted(junctions: DataFrame, *kinds: str) -> DataFrame:
    """kind, region, seqlen, q, n, mm, ins, dels: sums of each kind, added up in each Arrow batch first."""
    columns = [F.length("seq").alias("seqlen")]
    for side in "vj":
        at = F.col(f"{side}_ref.refpos")
        columns += [F.col(f"{side}.{c}").alias(f"{side}_{c}") for c in ("CIGAR", "POS", "SEQ", *(["QUAL"] if "qualities" in kinds else []))] + [F.col(f"{side}_ref.seq").alias(f"{side}_germline")]
        columns.append((at - 3 if side == "v" else at + 3).cast("int").alias(f"{side}_bound"))
    if "between" in kinds:
        columns += [F.col(c) for c in ("seq", "qual_text", "v_end", "j_start")]
    made = {"errors": _error_sums, "qualities": _quality_counts, "between": _between}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = {side: _bases(batch, side) for side in "vj"}
            for kind in kinds:
                for found in made[kind](batch, sides):
                    size = len(found["n"])
                    whole = {"kind": [kind] * size, "region": [None] * size, "seqlen": [None] * size, "q": [None] * size} | {c: [0] * size for c in ("mm", "ins", "dels")} | found
                    yield pa.RecordBatch.from_arrays([pa.array(whole[c], t) for c, t in _COUNTED.items()], list(_COUNTED))

    schema = ", ".join(f"{c} {dict(string='string', int32='int', int64='long')[str(t)]}" for c, t in _COUNTED.items())
    return junctions.select(*columns).mapInArrow(work, schema).groupBy("kind", "region", "seqlen", "q").agg(*[F.sum(c).alias(c) for c in ("n", "mm", "ins", "dels")])


_COUNTED = {"kind": pa.string(), "region": pa.string(), "seqlen": pa.int32(), "q": pa.int32(), "n": pa.int64(), "mm": pa.int64(), "ins": pa.int64(), "dels": pa.int64()}


def _bases(batch: pa.RecordBatch, side: str) -> flat.Bases:
    """The bases that count: those of V from its anchor on, of J up to its anchor."""
    of = lambda name: batch.column(f"{side}_{name}")
    low, high = (of("bound"), None) if side == "v" else (None, of("bound"))
    return flat.Bases(of("CIGAR"), of("POS"), of("SEQ"), of("germline"), low, high)


def _scores(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offset, least, most = S.ENCODINGS["Illumina1.8"]
    codes, at = flat.letters(texts)
    scores = codes.astype(np.int64) - offset
    if (bad := scores[(scores < least) | (scores > most)]).size:
        raise ValueError(f"Quality score ({bad[0]}) not in [{least}, {most}]")
    return scores, at


def _error_sums(batch: pa.RecordBatch, sides: dict[str, flat.Bases]) -> Iterator[dict]:
    coded = batch.column("seqlen").dictionary_encode()
    size, code = len(coded.dictionary), flat.numbers(coded.indices)
    for side, bases in sides.items():
        yield {"region": [side.upper()] * size, "seqlen": coded.dictionary} | {c: np.bincount(code, getattr(bases, c), size).astype(np.int64) for c in ("n", "mm", "ins", "dels")}


def _quality_counts(batch: pa.RecordBatch, sides: dict[str, flat.Bases]) -> Iterator[dict]:
    for side, bases in sides.items():
        scores, at = _scores(batch.column(f"{side}_QUAL"))
        none = S.ENCODINGS["Illumina1.8"][2] + 1  # a base without a quality
        i = at[bases.row] + bases.q
        q = np.where(i < at[bases.row + 1], np.append(scores, 0)[np.minimum(i, scores.size)], none)
        j = at[bases.added_row] + bases.added_q
        extra = scores[j[j < at[bases.added_row + 1]]]
        n = np.bincount(q, minlength=none + 1) + np.bincount(extra, minlength=none + 1)
        there = np.flatnonzero(n)
        yield {"region": [side.upper()] * len(there), "q": [None if x == none else x for x in there.tolist()], "n": n[there], "mm": np.bincount(q[bases.wrong], minlength=none + 1)[there]}


def _between(batch: pa.RecordBatch, sides: dict[str, flat.Bases]) -> Iterator[dict]:
    scores, at = _scores(batch.column("qual_text"))
    codes, base_at = flat.letters(batch.column("seq"))
    size = np.diff(at)
    first = np.maximum(flat.numbers(batch.column("v_end")), 0)
    count = np.maximum(np.minimum(flat.numbers(batch.column("j_start")), size) - first, 0)
    row = np.repeat(np.arange(len(size)), count)
    within = flat.ranges(first, count)
    q = np.where(codes[base_at[row] + within] == ord("N"), 0, scores[at[row] + within])
    most = S.ENCODINGS["Illumina1.8"][2] + 1
    n = np.bincount(size[row] * most + q)
    there = np.flatnonzero(n)
    yield {"seqlen": there // most, "q": there % most, "n": n[there]}


def all_qualities(by_quality: DataFrame, most: int = 41) -> DataFrame:
    """region, Q, n, mm for each quality from 0 to ``most``, 0 where there is none."""
    # the table is summed up once: at most a row for each quality is kept of a region
    known = by_quality.groupBy("region").agg(F.map_from_entries(F.collect_list(F.when(F.col("q").isNotNull(), F.struct("q", F.struct("n", "mm"))))).alias("of"))
    every = known.select("region", "of", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("Q")).withColumn("x", F.element_at("of", F.col("Q")))
    return every.select("region", "Q", *[F.coalesce(F.col(f"x.{c}"), F.lit(0)).alias(c) for c in ("n", "mm")])


def corrected(clones: DataFrame, mismatch: M.Rate, overall: float, insertion: float, deletion: float, max_quality: int, options: Options) -> DataFrame:
    """The four merges in turn; each result is a written table. ``mismatch`` is by length or for all, ``overall`` for all. Clones of different V and J stay apart unless they are collapsed."""
    now = M.start(clones, () if options.collapse_vj else ("v_call", "j_call"))
    now = stage(M.merge_by_quality(now, mismatch, options.confidence, max_quality), "by-quality")
    now = stage(M.merge_by_abundance(now, mismatch, options.confidence), "by-abundance")
    now = stage(M.merge_indels(now, insertion, deletion, overall, options.confidence), "indels")
    return stage(M.merge_unknown(now), "unknown")


@dataclass(frozen=True)
class Result:
    kept: DataFrame
    discarded: DataFrame
    by_region: DataFrame  # error sums by region and junction length
    by_quality: DataFrame


def run(pairs: DataFrame, alleles: DataFrame, options: Options | None = None) -> Result:
    """Alignment pairs and alleles -> kept and discarded rows in AIRR columns, numbered by one count, and the error statistics.

    Without any junction it raises, as the reference must be another then.
    """
    options = options or Options()
    found = K.junctions(pairs, alleles, options.min_length, ("v", "j", "v_ref", "j_ref"))
    found = stage(found.withColumn("qual", S.zero_unknown(F.col("seq"), S.decode_quality(F.col("qual_text")))), "junctions")
    if not found.limit(1).count():
        raise ValueError("no junction in the alignments; is it the right reference?")
    sums, by_quality, between = statistics(found)
    key = ["seq"] if options.collapse_vj else ["seq", "v_call", "j_call"]
    notes = found.select("seq", "ordinal", "v_call", "j_call", "v_end", "j_start", (F.col("v_score") + F.col("j_score")).alias("score"))
    named = K.best_of_first_two(notes, key, F.col("score")).drop("ordinal")
    built = K.build(found.select(*key, "qual"), key).join(named, key)
    overall = E.largest_rates(E.rates(sums)).head()
    alpha = E.quality_slope(by_quality).head()["alpha"]
    max_quality = E.lower_median(between).head()["median"]
    rates = stage(E.rates_by_length(sums, between, alpha, overall["mmr"] or 0.0), "rates")
    merged = corrected(built, rates, overall["mmr"] or 0.0, overall["insr"] or 0.0, overall["delsr"] or 0.0, max_quality, options)
    rows = airr.rearrangements(K.ranked(merged.select("seq", "qual", "count", "note.*")), alleles)
    bad = F.coalesce((F.col("junction_minimum_quality_score").cast("int") < options.min_quality) | (F.col("stop_codon") == "T") | (F.col("vj_in_frame") == "F"), F.lit(False))
    return Result(rows.filter(~bad), rows.filter(bad), sums, by_quality)


def _run(spark: SparkSession, given: argparse.Namespace) -> None:
    alleles = tables.read_reference(spark, given.reference)
    wanted = {k: v for k, v in (("species", given.species), ("gene", given.gene)) if v}
    alleles = tables.choose_alleles(tables.require(alleles, **wanted), **wanted)
    if given.sam:
        pairs = files.adjacent_pairs(files.read_sam(spark, given.sam))
    else:
        reads = files.read_fastq(spark, given.reads, encoding=None)
        offset = given.phred or files.phred_offset(reads)
        v, j = [A.command_aligner(alleles, region, A.Command(align, given.build, offset)) for region, align in (("V", given.align_v), ("J", given.align_j))]
        pairs = stage(aligned(reads, v, j), "pairs")
    got = run(pairs, alleles, Options(confidence=given.confidence, collapse_vj=not given.no_vj_collapsing))
    tables.write_airr(got.kept, f"{given.out}/results")
    tables.write_airr(got.discarded, f"{given.out}/discarded")
    got.by_region.select("seqlen", "region", "n", "mm", "ins", "dels").write.csv(f"{given.out}/aln_stats", header=True)
    all_qualities(got.by_quality).write.csv(f"{given.out}/Q_mm_stats", header=True)
    alignment_dump(pairs).write.text(f"{given.out}/alignments", compression="gzip")


def _checkout(spark: SparkSession, given: argparse.Namespace) -> None:
    adapters = D.read_adapters("\n".join(r["value"] for r in spark.read.text(given.barcodes).collect()))
    reads = files.read_fastq(spark, given.paired or given.forward, encoding=None)
    if given.reverse:
        reads = D.mates(reads, files.read_fastq(spark, given.reverse, encoding=None))
    found = stage(D.demultiplex(reads, adapters, given.max_mm, given.reverse_complement, merged=bool(given.paired)), "checked-out")
    files.write_fastq(D.each_mate(found), given.out, ["sample", "qualifier"])
    print(f"{found.count()} of {reads.count()} accepted")


def _umi(spark: SparkSession, given: argparse.Namespace) -> None:
    kept, discarded = D.consensus_reads(files.read_fastq(spark, given.reads), given.k, given.max_shift, given.min_offset_score, given.min_merge_score)
    files.write_fastq(kept, f"{given.out}/consensus")
    files.write_fastq(discarded, f"{given.out}/discarded")


def _convert(spark: SparkSession, given: argparse.Namespace) -> None:
    tables.write_airr(tables.converted(spark.read.parquet(given.clones)), given.out)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Receptor clones from sequencing reads.")
    commands = parser.add_subparsers(required=True)
    for name, work, options in (
        ("run", _run, {"--sam": None, "--reads": None, "--build": A.BUILD, "--align-v": A.ALIGN_V, "--align-j": A.ALIGN_J, "--phred": 0, "--reference": "", "--species": None, "--gene": None, "--confidence": 0.99, "--no-vj-collapsing": False}),
        ("checkout", _checkout, {"--forward": None, "--reverse": None, "--paired": None, "--barcodes": "", "--max-mm": 2, "--reverse-complement": False}),
        ("umi", _umi, {"--reads": "", "--k": 30, "--max-shift": 4, "--min-offset-score": 20, "--min-merge-score": 24}),
        ("convert", _convert, {"--clones": ""}),
    ):
        one = commands.add_parser(name)
        one.set_defaults(work=work)
        one.add_argument("--out", required=True)
        for option, value in options.items():
            if value is False:
                one.add_argument(option, action="store_true")
            else:
                one.add_argument(option, default=value or None, type=str if value in (None, "") else type(value), required=value == "")
    given = parser.parse_args(args)
    if given.work is _run and bool(given.sam) == bool(given.reads):
        parser.error("run takes either --sam or --reads")
    given.work(SparkSession.builder.getOrCreate(), given)


if __name__ == "__main__":
    main()
