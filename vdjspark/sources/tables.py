"""Tab-separated tables: germline alleles, junction lists, clone sets, AIRR rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vdjspark.functions import airr
from vdjspark.functions import sequences as S
from vdjspark.operators.clones import ranked
from vdjspark.sources.sequence_files import read_fasta

# The header of the reference table, and the names its columns get.
ALLELE_HEADER = ("Species", "Allele name", "Functionality", "Reference position", "Accession number", "Sequence")
ALLELE_NAMES = ("species", "name", "functionality", "refpos", "acc_nr", "seq")
# How J genes show their anchor: Phe or Trp, then Gly-X-Gly; or, liberally, any codon before a Gly.
J_ANCHOR = ("((TT[TC])|(TGG))GG[TCAG]{4}GG[TCAG]{1}", "[TCAG]{3}GG[TCAG]{4}[TCAG]{1}")
V_ANCHOR_COLUMNS = 312


def _parts(alleles: DataFrame) -> DataFrame:
    return alleles.select("*", S.allele_parts(F.col("name")).alias("p_")).select(*alleles.columns, "p_.*")


def read_alleles(spark: SparkSession, path: str) -> DataFrame:
    """The reference table; a header other than the expected one raises. Names must be unique to be joined on."""
    found = spark.read.csv(path, sep="\t", header=True)
    if tuple(found.columns) != ALLELE_HEADER:
        raise ValueError(f"unexpected header {found.columns}")
    return _parts(found.toDF(*ALLELE_NAMES).withColumn("refpos", F.col("refpos").cast("int")))


def write_alleles(alleles: DataFrame, path: str) -> None:
    alleles.select(*[F.col(n).alias(h) for n, h in zip(ALLELE_NAMES, ALLELE_HEADER, strict=True)]).orderBy(*[F.col(f"`{h}`") for h in ALLELE_HEADER]).write.csv(path, sep="\t", header=True)


def alleles_from_fasta(fasta: DataFrame) -> DataFrame:
    """Gapped germline FASTA (accession|name|species|functionality|...) -> the allele table.

    V: the anchor is the gapped column 312 less the gaps before it. J: where the strict pattern begins,
    else the liberal one; gaps in J, and J without anchor, raise. Dots are gaps and go.
    """
    f = F.split("name", "\\|")
    rows = fasta.select(F.get(f, 2).alias("species"), F.get(f, 1).alias("name"), F.regexp_replace(F.get(f, 3), r"[()\[\]]", "").alias("functionality"), F.get(f, 0).alias("acc_nr"), F.col("seq").alias("gapped"))
    region = F.substring("name", 4, 1)
    head = F.substring("gapped", 1, V_ANCHOR_COLUMNS)
    v_at = V_ANCHOR_COLUMNS - (F.length(head) - F.length(F.regexp_replace(head, r"\.", "")))
    strict, liberal = [F.regexp_instr("gapped", F.lit(p)) for p in J_ANCHOR]
    j_at = F.when(F.contains("gapped", F.lit(".")), F.raise_error(F.concat(F.lit("gaps in "), "name"))).when(strict > 0, strict - 1).when(liberal > 0, liberal - 1)
    at = F.when(region == "V", v_at).when(region == "J", F.coalesce(j_at, F.raise_error(F.concat(F.lit("no anchor in "), "name")).cast("int"))).otherwise(-1)
    return _parts(rows.select("species", "name", "functionality", at.cast("int").alias("refpos"), "acc_nr", F.regexp_replace("gapped", r"\.", "").alias("seq")))


def alleles_from_legacy_fasta(fasta: DataFrame) -> DataFrame:
    """FASTA with names such as ``TRBV1*01|refpos:39``; a V or J without its anchor raises. Species and empty columns are fixed."""
    name, at = F.substring_index("name", "|", 1), F.regexp_extract("name", r"\|refpos:(\d+)", 1)
    wanted = F.substring(name, 4, 1).isin("V", "J")
    refpos = F.when(~wanted, -1).when(at != "", at.cast("int")).otherwise(F.raise_error(F.concat(F.lit("no anchor in "), "name")).cast("int"))
    return _parts(fasta.select(F.lit("HomoSapiens").alias("species"), name.alias("name"), F.lit("").alias("functionality"), refpos.alias("refpos"), F.lit("").alias("acc_nr"), "seq"))


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """A reference file of any of the three kinds, by its first line; others raise."""
    first = spark.read.text(path).head()["value"]
    if first.startswith(">"):
        return (alleles_from_legacy_fasta if "refpos" in first else alleles_from_fasta)(read_fasta(spark, path))
    if "Species" not in first:
        raise ValueError("unknown kind of reference file")
    return read_alleles(spark, path)


def restricted(alleles: DataFrame, **allowed: str | list[str]) -> DataFrame:
    """The same rows; one outside the allowed values of species, gene, region or segment raises."""
    bad = F.lit(False)
    for column, values in allowed.items():
        bad = bad | ~F.col(column).isin([values] if isinstance(values, str) else values)
    return alleles.withColumn("name", F.when(bad, F.raise_error(F.concat(F.lit("allele not allowed: "), "name"))).otherwise(F.col("name")))


def require(alleles: DataFrame, **wanted: str) -> DataFrame:
    """The same rows; a value (of species, gene) that none of them has raises."""
    for column, value in wanted.items():
        if not alleles.filter(F.col(column) == value).limit(1).count():
            raise ValueError(f"no {column} {value} in the reference")
    return alleles


def choose_alleles(alleles: DataFrame, **wanted: str | list[str] | None) -> DataFrame:
    """Rows whose attributes are among the wanted values; None means any."""
    for column, values in wanted.items():
        if values is not None:
            alleles = alleles.filter(F.col(column).isin([values] if isinstance(values, str) else values))
    return alleles


def allele_counts(alleles: DataFrame) -> DataFrame:
    return alleles.groupBy("species", "gene", "region").count()


def read_junctions(spark: SparkSession, path: str, encoding: str = "Illumina1.8") -> DataFrame:
    """Junction list with columns nt_jnc and q_jnc -> reads (seq, qual). Quotes are qualities like any other character."""
    found = spark.read.csv(path, sep="\t", header=True, quote="", escape="")
    return found.select(F.col("nt_jnc").alias("seq"), S.decode_quality(F.col("q_jnc"), encoding).alias("qual"))


# Other names of a clone table's columns.
CLONE_ALIASES = {"nt_jnc": ("nt_jnc", "Junction nucleotide sequence")}


def read_cloneset(spark: SparkSession, path: str) -> DataFrame:
    """Clone table: vid, jid, nt_jnc (or its alias), depth, ve, js, qvec; orig_depth is 0, others null where they are missing."""
    found = spark.read.csv(path, sep="\t", header=True)

    def of(name: str, kind: str) -> Column:
        there = [c for c in CLONE_ALIASES.get(name, (name,)) if c in found.columns]
        return (F.col(f"`{there[0]}`") if there else F.lit(None)).cast(kind)

    qual = F.transform(F.split(of("qvec", "string"), r"\|"), lambda q: q.cast("int"))
    return found.select(
        of("vid", "string").alias("v_call"), of("jid", "string").alias("j_call"), of("nt_jnc", "string").alias("seq"), F.coalesce(of("orig_depth", "long"), F.lit(0)).alias("orig_count"),
        of("depth", "long").alias("count"), of("ve", "int").alias("v_end"), of("js", "int").alias("j_start"), qual.alias("qual"),
    )


def write_cloneset(clones: DataFrame, path: str) -> None:
    """Frequencies of bases aren't part of this format."""
    out = clones.select(F.col("v_call").alias("vid"), F.col("j_call").alias("jid"), F.col("seq").alias("nt_jnc"), F.col("orig_count").alias("orig_depth"), F.col("count").alias("depth"), F.col("v_end").alias("ve"), F.col("j_start").alias("js"), F.array_join(F.transform("qual", lambda q: q.cast("string")), "|").alias("qvec"))
    out.write.csv(path, sep="\t", header=True)


def write_airr(rows: DataFrame, path: str) -> None:
    """Tab-separated text as it is: no quotes, and no escapes for quotes or backslashes. A tab or line end in a value raises."""
    whole = [F.when(F.col(c).rlike(r"[\t\r\n]"), F.raise_error(F.lit(f"tab or line end in {c}"))).otherwise(F.coalesce(F.col(c), F.lit(""))).alias(c) for c in rows.columns]
    lines = rows.select(F.concat_ws("\t", *whole).alias("\t".join(rows.columns)))
    lines.write.csv(path, sep="\x00", header=True, quote="", escape="", emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def converted(clones: DataFrame) -> DataFrame:
    """A stored clone set as AIRR rows in order of descending count, without a reference."""
    missing = {"v_call": "string", "j_call": "string", "v_end": "int", "j_start": "int"}
    rows = clones.select("*", *[F.lit(None).cast(t).alias(c) for c, t in missing.items() if c not in clones.columns])
    return airr.rearrangements(ranked(rows))
