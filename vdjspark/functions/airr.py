"""The AIRR Rearrangement row of a clone, all columns as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vdjspark.functions.alleles import with_allele
from vdjspark.functions.sequences import translate_codons

# The output columns in order.
COLUMNS = (
    "sequence_id", "sequence", "rev_comp", "productive", "v_call", "d_call", "j_call", "sequence_alignment", "germline_alignment",
    "junction", "junction_aa", "v_cigar", "d_cigar", "j_cigar", "duplicate_count", "vj_in_frame", "stop_codon", "cdr3_start", "cdr3_end",
    "v_sequence_end", "j_sequence_start", "junction_quality_scores", "junction_minimum_quality_score", "v_junction_end", "j_junction_start",
)


def _flag(condition: Column) -> Column:
    return F.when(condition, "T").otherwise("F")


def rearrangements(clones: DataFrame, alleles: DataFrame | None = None) -> DataFrame:
    """Clones (sequence_id, seq, qual, count, v_call, j_call, v_end, j_start) -> COLUMNS as strings.

    With alleles (name, refpos, seq) the full sequence, its frame, stop codons and conserved residues
    are filled in: the V reference up to its anchor, the junction, and the J reference after its anchor; a
    call that they lack, or of the wrong region, raises. Quality scores are numbers, joined by bars.
    """
    full = in_frame = stop = productive = cdr3_start = cdr3_end = v_end = j_start = F.lit("")
    rows = clones
    if alleles is not None:
        rows = with_allele(rows, alleles, "v_call", "V", v_at=F.col("refpos"), v_seq=F.col("seq"))
        rows = with_allele(rows, alleles, "j_call", "J", j_at=F.col("refpos"), j_seq=F.col("seq"))
        v_at, j_at, seq = F.col("v_at"), F.col("j_at"), F.col("seq")
        full = F.concat(F.substring("v_seq", F.lit(1), v_at - 3), seq, F.substring("j_seq", j_at + 4, F.length("j_seq")))
        protein = translate_codons(full)
        stops = F.contains(protein, F.lit("*"))
        at_v, at_j = translate_codons(F.substring("v_seq", v_at - 2, F.lit(3))), translate_codons(F.substring("j_seq", j_at + 1, F.lit(3)))
        # the junction's first and last whole codons
        junction = translate_codons(seq)
        kept = (F.substring(junction, 1, 1) == at_v) & (F.substring(junction, -1, 1) == at_j)
        in_frame, stop, productive = _flag(F.length(full) % 3 == (F.length("j_seq") - j_at) % 3), _flag(stops), _flag(kept & ~stops)
        cdr3_start, cdr3_end = v_at + 1, v_at + 1 + F.length(seq) - 7
        v_end, j_start = v_at - 3 + F.col("v_end"), v_at - 3 + F.col("j_start") + 1
    values = {
        "sequence_id": F.col("sequence_id"), "sequence": full, "rev_comp": F.lit("F"), "productive": productive, "v_call": F.col("v_call"), "j_call": F.col("j_call"), "junction": F.col("seq"), "junction_aa": translate_codons(F.col("seq")),
        "duplicate_count": F.col("count"), "vj_in_frame": in_frame, "stop_codon": stop, "cdr3_start": cdr3_start, "cdr3_end": cdr3_end, "v_sequence_end": v_end, "j_sequence_start": j_start, "junction_quality_scores": F.array_join(F.transform("qual", lambda q: q.cast("string")), "|"),
        "junction_minimum_quality_score": F.array_min("qual"), "v_junction_end": F.col("v_end"), "j_junction_start": F.col("j_start") + 1,
    }
    return rows.select(*[F.coalesce(values.get(c, F.lit("")).cast("string"), F.lit("")).alias(c) for c in COLUMNS])
