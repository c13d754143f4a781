"""Column functions on nucleotide strings and their qualities (arrays of Phred scores)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from vdjspark.functions import flat

# Amino acids of the 64 codons, the three bases each in the order T, C, A, G.
BASES, AMINO = "TCAG", "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
# Offset and range of the quality encodings.
ENCODINGS = {"Sanger": (33, 0, 40), "Solexa": (64, -5, 40), "Illumina1.3": (64, 0, 40), "Illumina1.8": (33, 0, 41)}
# Bases that each ambiguity code stands for.
IUPAC = {"A": "A", "C": "C", "G": "G", "T": "T", "U": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


def reverse_complement(seq: Column) -> Column:
    """A, T, C and G are complemented; other letters keep their place in the reversed string."""
    return F.reverse(F.translate(seq, "ATCG", "TAGC"))


def decode_quality(text: Column, encoding: str = "Illumina1.8") -> Column:
    """Characters -> array of Phred scores; a score out of range raises. Solexa scores are converted."""
    offset, low, high = ENCODINGS[encoding]
    scores = F.transform(F.filter(F.split(text, ""), lambda c: c != ""), lambda c: F.ascii(c) - offset)
    bad = F.get(F.filter(scores, lambda q: ~q.between(low, high)), 0)
    # one look at the text instead of one at each score
    good = text.rlike(f"^[\\x{low + offset:02x}-\\x{high + offset:02x}]*$")
    checked = F.when(good, scores).when(text.isNotNull(), F.raise_error(F.format_string(f"Quality score (%d) not in [{low}, {high}]", bad)))
    return F.transform(checked, solexa_to_phred) if encoding == "Solexa" else checked


def solexa_to_phred(q: Column) -> Column:
    return F.round(10 * F.log10(F.pow(F.lit(10.0), q / 10) + 1)).cast("int")


def encode_quality(qual: Column, offset: int = 33) -> Column:
    return F.array_join(F.transform(qual, lambda q: F.char(q + offset)), "")


def quality_bytes(qual: Column) -> Column:
    """Lists of qualities as binary values, a byte each, to be moved or written; quality_list() turns them back."""

    @F.arrow_udf("binary")
    def pack(x: pa.Array) -> pa.Array:
        return flat.texts(*flat.qualities(x, False), pa.binary())

    return F.when(qual.isNotNull(), pack(qual))


def quality_list(values: Column) -> Column:
    @F.arrow_udf("array<int>")
    def unpack(x: pa.Array) -> pa.Array:
        return flat.listed(x)

    return F.when(values.isNotNull(), unpack(values))


def zero_unknown(seq: Column, qual: Column) -> Column:
    """Quality 0 wherever the base is N."""
    return F.transform(qual, lambda q, i: F.when(F.substring(seq, i + 1, F.lit(1)) == "N", 0).otherwise(q))


def translate_codons(seq: Column) -> Column:
    """Amino acids of whole codons; ``?`` for a codon with other letters; a partial codon is dropped."""

    @F.arrow_udf("string")
    def translated(x: pa.Array) -> pa.Array:
        return flat.amino_acids(x, AMINO)

    return translated(seq)


def probability_to_phred(p: Column) -> Column:
    return -10 * F.log10(p)


def phred_to_probability(q: Column) -> Column:
    return F.pow(F.lit(10.0), -q / 10)


def allele_parts(name: Column) -> Column:
    """Gene, region, segment and allele of a name such as TRBV10-2*01."""
    halves = F.split(name, "\\*", 2)
    segment = F.substring(F.get(halves, 0), F.lit(5), F.length(name))
    return F.struct(F.substring(name, 1, 3).alias("gene"), F.substring(name, 4, 1).alias("region"), segment.alias("segment"), F.get(halves, 1).alias("allele"))


def umi_parts(name: Column) -> Column:
    """Qualifier, UMI and its quality from ``UMI:qualifier:umi:quality``; the quality may hold colons."""
    return F.struct(*[F.regexp_extract(name, r"^UMI:([^:]*):([^:]*):(.*)$", k).alias(n) for k, n in ((1, "qualifier"), (2, "umi"), (3, "umi_qual"))])


def hamming(a: Column, b: Column) -> Column:
    """Differing positions of two strings of one length; N is a letter like any other."""
    return F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), lambda i: F.substring(a, i, F.lit(1)) != F.substring(b, i, F.lit(1))))


def mismatch_quality(a: Column, qa: Column, b: Column, qb: Column, offset: Column | int = 0) -> Column:
    """At differing positions: their number, and the sum and largest of the smaller quality.

    b is moved right by ``offset`` bases (left where it is negative); only positions that both have count.
    """
    o = F.lit(offset) if isinstance(offset, int) else offset
    first, end = F.greatest(o, F.lit(0)), F.least(F.length(a), F.length(b) + o)
    start = F.struct(F.lit(0).alias("hd"), F.lit(0).alias("sum_q"), F.lit(0).alias("max_q"))

    def step(s: Column, i: Column) -> Column:
        q = F.least(F.get(qa, i - 1), F.get(qb, i - 1 - o))
        differs = F.substring(a, i, F.lit(1)) != F.substring(b, i - o, F.lit(1))
        after = F.struct((s["hd"] + 1).alias("hd"), (s["sum_q"] + q).alias("sum_q"), F.greatest(s["max_q"], q).alias("max_q"))
        return F.when(differs, after).otherwise(s)

    places = F.when(end > first, F.sequence(first + 1, end)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, step)


def joined_reads(a: Column, b: Column) -> Column:
    """struct<name, seq, qual> of two reads one after the other (structs of these fields); the name is ``(a,b)``."""
    name = F.concat(F.lit("("), a["name"], F.lit(","), b["name"], F.lit(")"))
    return F.struct(name.alias("name"), F.concat(a["seq"], b["seq"]).alias("seq"), F.concat(a["qual"], b["qual"]).alias("qual"))


#: Letters as digits of base 32, of which twelve fit a long.
_LETTERS, _DIGITS, _PACKED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789ABCDEFGHIJKLMNOP", 12


def packed(seq: Column) -> Column:
    """array<long> that holds a string of A to Z at five bits a letter; null for other strings."""
    digits = F.translate(seq, _LETTERS, _DIGITS)
    starts = F.sequence(F.lit(0), F.floor(F.length(seq) / _PACKED).cast("int"))
    return F.when(seq.rlike("^[A-Z]*$"), F.transform(starts, lambda i: F.coalesce(F.conv(F.substring(digits, i * _PACKED + 1, F.lit(_PACKED)), 32, 10).cast("long"), F.lit(0).cast("long"))))


def packed_hamming(a: Column, b: Column) -> Column:
    """Differing positions of two packed() strings of one length: twelve letters at a time."""
    ones = F.lit(sum(1 << 5 * i for i in range(_PACKED)))

    def differ(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftright(z, 1)).bitwiseOR(F.shiftright(z, 2)).bitwiseOR(F.shiftright(z, 3)).bitwiseOR(F.shiftright(z, 4))
        return F.bit_count(z.bitwiseAND(ones))

    return F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda s, x: s + x)
