"""Clones: reads of one junction sequence, with counts, qualities, annotation and consensus bases."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vdjspark.functions import cigar as C
from vdjspark.functions import flat
from vdjspark.functions import frequencies as frequencies_of
from vdjspark.functions.alleles import with_allele
from vdjspark.functions.sequences import quality_bytes, quality_list, translate_codons
from vdjspark.sources.sequence_files import numbered


def junctions(pairs: DataFrame, alleles: DataFrame, min_length: int = 10, keep: tuple[str, ...] = ()) -> DataFrame:
    """V/J alignment pairs (structs v, j) -> ordinal, seq, qual_text, v_call, j_call, v_end, j_start, scores.

    Dropped: unmapped V or J, reverse-complemented J, anchors that the alignment doesn't reach, and
    junctions shorter than ``min_length``. ``alleles``: name, refpos (anchor) and seq; a mapped alignment
    to an allele that they lack, or of the other region, raises. ``keep`` names
    columns of the pairs, or of v_ref, j_ref (the alleles' refpos and seq) and v_ops, j_ops (the
    alignments' operations), that are returned too.
    """
    ref = F.struct("refpos", "seq")
    mapped = pairs.filter((F.col("v.FLAG").bitwiseAND(4) == 0) & (F.col("j.FLAG").bitwiseAND(4) == 0) & (F.col("j.FLAG").bitwiseAND(16) == 0))
    rows = mapped.withColumn("v_call", F.col("v.RNAME")).withColumn("j_call", F.col("j.RNAME"))
    rows = with_allele(with_allele(rows, alleles, "v_call", "V", v_ref=ref), alleles, "j_call", "J", j_ref=ref)
    v_ras, j_ras = F.col("v.POS") - 1, F.col("j.POS") - 1
    v_cigar, j_cigar = F.col("v.CIGAR"), F.col("j.CIGAR")
    for side, ops in (("v_ops", C.placed(v_cigar, v_ras)), ("j_ops", C.placed(j_cigar, j_ras))):
        rows = rows.withColumn(side, ops) if side in keep else rows
    at = {"v_at_": C.measured(v_cigar, v_ras, F.col("v_ref.refpos") - 3, fixed=True), "j_at_": C.measured(j_cigar, j_ras, F.col("j_ref.refpos") + 3, fixed=True)}
    rows = rows.withColumns(at)
    # the J read is the V read without what V covers
    shift = F.length("v.SEQ") - F.length("j.SEQ")
    rows = rows.withColumn("start", F.col("v_at_.at"))
    rows = rows.withColumn("end", shift + F.col("j_at_.at"))
    rows = rows.filter(F.col("start").isNotNull() & F.col("end").isNotNull() & (F.col("end") <= F.length("v.SEQ")) & (F.col("end") - F.col("start") >= min_length))
    size = F.col("end") - F.col("start")
    return rows.select(
        F.col("uid").alias("ordinal"),
        F.substring("v.SEQ", F.col("start") + 1, size).alias("seq"),
        F.substring("v.QUAL", F.col("start") + 1, size).alias("qual_text"),
        "v_call",
        "j_call",
        (F.col("v_at_.qae") - F.col("start")).alias("v_end"),
        (F.col("j_at_.qas") + shift - F.col("start")).alias("j_start"),
        F.col("v.MAPQ").alias("v_score"),
        F.col("j.MAPQ").alias("j_score"),
        *keep,
    )


def after_v(v: Column) -> Column:
    """struct<seq, qual> of what a V alignment (SAM row) leaves of its read for the J aligner; empty where V is unmapped."""
    unmapped = v["FLAG"].bitwiseAND(4) != 0
    end = C.measured(F.when(~unmapped, v["CIGAR"]), v["POS"] - 1)["qae"]
    rest = lambda c: F.when(unmapped, "").otherwise(F.substring(v[c], end + 1, F.length(v[c])))
    return F.struct(rest("SEQ").alias("seq"), rest("QUAL").alias("qual"))


def paired_by_uid(v: DataFrame, j: DataFrame) -> DataFrame:
    """V rows with ``uid`` and J rows whose QNAME is ``uid:name`` -> uid and structs v, j (its QNAME without the uid)."""
    whole = F.struct(*[c for c in v.columns if c != "uid"]).alias("v")
    head = F.substring_index("QNAME", ":", 1)
    cut = j.withColumn("uid", head.cast("long")).withColumn("QNAME", F.substring("QNAME", F.length(head) + 2, F.length("QNAME")))
    return v.select("uid", whole).join(cut.select("uid", F.struct(*j.columns).alias("j")), "uid")


def template_values() -> dict[str, Column]:
    """What a template may name, and how it is made of a clone (seq, qual, count, v_call, j_call, v_end, j_start)."""
    aa = translate_codons(F.col("seq"))
    return {
        "nt_seq": F.col("seq"), "aa_seq": aa, "count": F.col("count"), "n_stop_codons": F.length(aa) - F.length(F.replace(aa, F.lit("*"))), "min_phred": F.array_min("qual"), "frame": F.length("seq") % 3,
        "qualstr": F.array_join(F.transform("qual", lambda q: q.cast("string")), "|"), "vid": F.col("v_call"), "jid": F.col("j_call"), "ve": F.col("v_end"), "js": F.col("j_start"), "js1": F.col("j_start") + 1,
    }


def formatted(template: str) -> Column:
    """A clone as text: ``%(name)s`` and its like name template_values(); ``%%`` is a percent sign."""
    values = template_values()
    names = re.findall(r"%\((\w+)\)", template)
    if unknown := set(names) - set(values):
        raise ValueError(f"unknown names {sorted(unknown)}")
    return F.format_string(re.sub(r"%\(\w+\)", "%", template), *[values[n] for n in names])


def best_of_first_two(rows: DataFrame, key: list[str], score: Column, order: str = "ordinal") -> DataFrame:
    """Of each key's first two rows the one of larger score; the earlier of equals.

    The two are kept by an aggregate (least by order, then least of the rest), not by ranking all rows.
    """
    packed = F.struct(F.col(order).alias("o"), score.alias("score"), F.struct(*[c for c in rows.columns if c not in key]).alias("row"))
    first = rows.groupBy(*key).agg(F.min(packed).alias("first"))
    rest = rows.withColumn("p_", packed).join(first.select(*key, F.col("first.o").alias("o_")), key).filter(F.col("p_.o") > F.col("o_"))
    second = rest.groupBy(*key).agg(F.min("p_").alias("second"))
    both = first.join(second, key, "left")
    return both.select(*key, F.when(F.col("second.score") > F.col("first.score"), F.col("second.row")).otherwise(F.col("first.row")).alias("row")).select(*key, "row.*")


def build(reads: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Reads (seq, and qual or else qual_text) -> one row per key (default seq): count, orig_count, qual (largest at each position).

    Reads of one key have equal bases, so counts and largest qualities hold all that the reads do. Equal
    keys of an Arrow batch are one row before they are dealt out, a byte for each quality, so a common key
    is not many rows; what meets in a task is then sorted and added up. Nothing else is moved or written.
    """
    key = key or ["seq"]
    text = "qual" not in reads.columns
    rows = reads.select(*key, (F.col("qual_text") if text else F.col("qual")).alias("quality"))
    fields = [rows.schema[k] for k in key]
    moved = T.StructType([*fields, T.StructField("quality", T.BinaryType()), T.StructField("n", T.LongType())])
    whole = T.StructType([*fields, T.StructField("count", T.LongType()), T.StructField("qual", T.ArrayType(T.IntegerType())), T.StructField("orig_count", T.LongType())])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, at = flat.qualities(batch.column(len(key)), text)
            yield _met(batch, len(key), codes, at, np.ones(batch.num_rows, np.int64))

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.concat_batches([held, batch])
            codes, at = flat.letters(batch.column(len(key)), binary=True)
            batch = _met(batch, len(key), codes, at, flat.numbers(batch.column(len(key) + 1)))
            # the last key may go on in the next batch
            held = batch.slice(batch.num_rows - 1)
            yield from _shown(batch.slice(0, batch.num_rows - 1), len(key))
        if held is not None:
            yield from _shown(held, len(key))

    return rows.mapInArrow(first, moved).repartition(*key).sortWithinPartitions(*key).mapInArrow(last, whole)


def _met(batch: pa.RecordBatch, keys: int, codes: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Rows of one key made one, in the order of their first: its columns, the largest quality at each position, and the sum of n."""
    group = None
    for i in range(keys):
        coded = batch.column(i).dictionary_encode(null_encoding="encode")
        here = flat.numbers(coded.indices)
        group = here if group is None else group * len(coded.dictionary) + here
    if keys > 1:
        _, place, group = np.unique(group, return_index=True, return_inverse=True)
        order = np.argsort(place)
        group = np.argsort(order)[group]
    size = int(group.max()) + 1 if len(group) else 0
    where = np.full(size, len(group))
    np.minimum.at(where, group, np.arange(len(group)))
    length = np.diff(at)
    widest = np.zeros(size, np.int64)
    np.maximum.at(widest, group, length)
    begin = flat.starts(widest)
    most = np.zeros(begin[-1], np.uint8)
    np.maximum.at(most, np.repeat(begin[group] - at[:-1], length) + np.arange(len(codes)), codes)
    sums = np.zeros(size, np.int64)
    np.add.at(sums, group, n)
    rows = [batch.column(i).take(pa.array(where)) for i in range(keys)]
    return pa.RecordBatch.from_arrays([*rows, flat.texts(most, begin, pa.binary()), pa.array(sums)], [*batch.schema.names[:keys], "quality", "n"])


def _shown(batch: pa.RecordBatch, keys: int) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, 10_000):
        some = batch.slice(i, 10_000)
        qual = flat.listed(some.column(keys))
        n = some.column(keys + 1)
        yield pa.RecordBatch.from_arrays([*some.columns[:keys], n, qual, n], [*some.schema.names[:keys], "count", "qual", "orig_count"])


def frequencies(reads: DataFrame, group: list[str], offset: Column | None = None, weight: Column | None = None) -> DataFrame:
    """Reads (seq, qual) -> group, pos, base, freq, q: position frequencies and largest qualities; N counts too.

    ``offset`` moves a read within its group; ``weight`` is how often a row counts. Sums and maxima are aggregated before the shuffle.
    """
    bases = reads.select(*group, (F.lit(0) if offset is None else offset).alias("off"), (F.lit(1) if weight is None else weight).alias("weight"), "qual", F.posexplode(F.filter(F.split("seq", ""), lambda c: c != "")).alias("at", "base"))
    rows = bases.select(*group, (F.col("at") + F.col("off")).alias("pos"), "base", "weight", F.get("qual", F.col("at")).alias("q"))
    return rows.groupBy(*group, "pos", "base").agg(F.sum("weight").alias("freq"), F.max("q").alias("q"))


def consensus_bases(freq: DataFrame, group: list[str]) -> DataFrame:
    """The called base at each position: group, pos, base, q, mutations, bases.

    The most frequent of A, C, G, T; among equals the one of larger quality; a tie in both, or none of
    the four, is N of quality 0. mutations: bases of the four other than the called frequency.
    """
    acgt = F.col("base").isin("A", "C", "G", "T")
    best = F.max(F.when(acgt, F.struct("freq", "q")))
    rows = freq.groupBy(*group, "pos").agg(
        best.alias("best"), F.collect_list(F.when(acgt, F.struct("freq", "q", "base"))).alias("all"), F.sum(F.when(acgt, F.col("freq")).otherwise(0)).alias("total"), F.sum("freq").alias("bases")
    )
    winners = F.filter("all", lambda x: (x["freq"] == F.col("best.freq")) & (x["q"] == F.col("best.q")))
    called = F.size(winners) == 1
    return rows.select(
        *group, "pos", F.when(called, F.get(winners, 0)["base"]).otherwise("N").alias("base"), F.when(called, F.col("best.q")).otherwise(0).alias("q"), (F.col("total") - F.coalesce("best.freq", F.lit(0))).alias("mutations"), "bases"
    )


def consensus(reads: DataFrame, group: list[str], offset: Column | None = None, weight: Column | None = None) -> DataFrame:
    """group, seq, qual, base_count, mutation_count of each group's reads."""
    called = consensus_bases(frequencies(reads, group, offset, weight), group)
    ordered = F.sort_array(F.collect_list(F.struct("pos", "base", "q")))
    out = called.groupBy(*group).agg(ordered.alias("at"), F.sum("bases").alias("base_count"), F.sum("mutations").alias("mutation_count"))
    return out.select(*group, F.array_join(F.transform("at", lambda x: x["base"]), "").alias("seq"), F.transform("at", lambda x: x["q"]).alias("qual"), "base_count", "mutation_count")


def with_frequencies(clones: DataFrame) -> DataFrame:
    """Clones (seq, qual, count) with their packed frequencies ``pfm``."""
    return clones.withColumn("pfm", frequencies_of.of_reads(F.col("seq"), F.col("qual"), F.col("count")))


def added(a: Column, b: Column) -> Column:
    """The sum of two clones: structs of pfm (functions.frequencies), count, orig_count and refpos -> such a struct with seq, qual, bases, mutations.

    b is moved by the difference of the two anchors, refpos of a less that of b; counts add, and refpos
    and orig_count are the larger ones. Anchors so far apart that there is a gap raise.
    """
    pfm = frequencies_of.added(a["pfm"], b["pfm"], a["refpos"] - b["refpos"])
    numbers = [(a["count"] + b["count"]).alias("count"), F.greatest(a["orig_count"], b["orig_count"]).alias("orig_count"), F.greatest(a["refpos"], b["refpos"]).alias("refpos")]

    def whole(x: Column) -> Column:
        return frequencies_of.let(frequencies_of.called(x), lambda c: F.struct(x.alias("pfm"), *numbers, *[c[n].alias(n) for n in ("seq", "qual", "bases", "mutations")]))

    return frequencies_of.let(pfm, whole)


def summed(a: Column, b: Column) -> Column:
    """The sum of two clones of equal reads, and how these differ: structs of seq, qual_text, count, orig_count, refpos -> struct of these with mutations, hd, sum_q, max_q.

    What added() and mismatch_quality() give, without the frequencies, by Arrow batches.
    """

    @F.arrow_udf("struct<seq: string, qual_text: string, mutations: long, hd: int, sum_q: int, max_q: int>")
    def sums(sa: pa.Array, sb: pa.Array, qa: pa.Array, qb: pa.Array, na: pa.Array, nb: pa.Array, o: pa.Array) -> pa.Array:
        found = frequencies_of.sums_of([sa, sb], [qa, qb], [na, nb], o)
        return pa.StructArray.from_arrays(list(found.values()), list(found))

    both = sums(a["seq"], b["seq"], a["qual_text"], b["qual_text"], a["count"], b["count"], a["refpos"] - b["refpos"])
    numbers = [(a["count"] + b["count"]).alias("count"), F.greatest(a["orig_count"], b["orig_count"]).alias("orig_count"), F.greatest(a["refpos"], b["refpos"]).alias("refpos")]
    return F.struct(*[both[c].alias(c) for c in ("seq", "qual_text", "mutations", "hd", "sum_q", "max_q")], *numbers)


def with_next(rows: DataFrame, group: str, place: str) -> DataFrame:
    """Each row with each row of its group one place on, as structs a and b: rows are dealt by group once and met in order, instead of joined. Both are integers; a null group is left out."""
    kept = rows.filter(F.col(group).isNotNull() & F.col(place).isNotNull())
    schema = T.StructType([T.StructField(x, kept.schema) for x in "ab"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            edge = edges(held)[0]
            # the last place may go on in the next batch, so the one before waits too
            if len(edge) > 2:
                yield from met(held.slice(0, edge[-1]), len(edge) - 2)
                held = held.slice(edge[-2])
        if held is not None:
            yield from met(held, len(edges(held)[0]))

    def edges(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the places of a batch begin, and their groups and numbers."""
        of, at = [flat.numbers(batch.column(c)) for c in (group, place)]
        edge = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (at[1:] != at[:-1])))
        return edge, of[edge], at[edge]

    def met(batch: pa.RecordBatch, places: int) -> Iterator[pa.RecordBatch]:
        """The first so many places of whole ones with the next each."""
        edge, of, at = edges(batch)
        size = np.diff(np.append(edge, batch.num_rows))
        goes = np.append((of[1:] == of[:-1]) & (at[1:] == at[:-1] + 1), False) & (np.arange(len(edge)) < places)
        # rows of one place meet all of the next
        meets, begins = np.where(goes, np.append(size[1:], 0), 0), np.append(edge[1:], 0)
        mine = np.repeat(np.arange(len(size)), size)
        a, b = np.repeat(np.arange(batch.num_rows), meets[mine]), flat.ranges(begins[mine], meets[mine])
        for i in range(0, len(a), 10_000):
            sides = [batch.take(pa.array(x[i : i + 10_000])).to_struct_array() for x in (a, b)]
            yield pa.RecordBatch.from_arrays(sides, ["a", "b"])

    return kept.repartition(group).sortWithinPartitions(group, place).mapInArrow(work, schema)


def totals(clones: DataFrame) -> DataFrame:
    """Clones, sequences and bases of a set, and its mutations where the clones have any."""
    made = [F.coalesce(F.sum("mutations"), F.lit(0)).alias("mutations")] if "mutations" in clones.columns else []
    return clones.agg(F.count("*").alias("clones"), F.sum("count").alias("sequences"), F.sum(F.col("count") * F.length("seq")).alias("bases"), *made)


def with_clone(clones: DataFrame, more: DataFrame, key: tuple[str, ...] = ("seq",)) -> DataFrame:
    """``clones`` and ``more`` as one set; a clone that both have, or that occurs twice, raises."""
    both = clones.unionByName(more)
    twice = both.groupBy(*key).agg(F.count("*").alias("times_"))
    name = F.concat_ws(" ", *[F.col(k).cast("string") for k in key])
    checked = F.when(F.col("times_") == 1, F.col(key[0])).otherwise(F.raise_error(F.concat(F.lit("clone is there already: "), name)))
    return both.join(twice, list(key)).withColumn(key[0], checked).select(both.columns)


def ranked(clones: DataFrame, column: str = "sequence_id") -> DataFrame:
    """Clones numbered from 1 by descending count, then seq: range partitions, sorted, with offsets from their counts."""
    # sorted and written with a byte for each quality
    lists = dict(clones.dtypes).get("qual") == "array<int>"
    rows = clones.withColumn("qual", quality_bytes(F.col("qual"))) if lists else clones
    out = numbered(rows.orderBy(F.desc("count"), "seq"), column, compression="zstd").withColumn(column, F.col(column) + 1)
    return out.withColumn("qual", quality_list(F.col("qual"))) if lists else out


def routed(clones: DataFrame, min_quality: int = 5) -> tuple[DataFrame, DataFrame]:
    """Kept and discarded clones: least quality below the bound, a stop codon or a frame shift discards."""
    bad = F.coalesce((F.array_min("qual") < min_quality) | (F.col("stop_codon") == "T") | (F.col("vj_in_frame") == "F"), F.lit(False))
    return clones.filter(~bad), clones.filter(bad)


def subgroup_ranks(groups: DataFrame, group: list[str]) -> DataFrame:
    """rank and size of each row in its group, by descending count, descending sum of qualities, then ordinal."""
    quality = F.aggregate("qual", F.lit(0), lambda s, q: s + q)
    w = Window.partitionBy(*group)
    return groups.withColumn("rank", F.row_number().over(w.orderBy(F.desc("count"), quality.desc(), "ordinal"))).withColumn("of", F.count("*").over(w))
