"""FASTA, FASTQ and SAM as DataFrames, and back. Gzip is read by suffix; order is kept in ``ordinal``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vdjspark.functions import sequences as S
from vdjspark.runtime import small, stage
from vdjspark.sources.ranges import RANGE_BYTES, read_records

# The mandatory columns of SAM.
SAM_COLUMNS = ("QNAME", "FLAG", "RNAME", "POS", "MAPQ", "CIGAR", "RNEXT", "PNEXT", "TLEN", "SEQ", "QUAL")
SAM_INTEGERS = {"FLAG", "POS", "MAPQ", "PNEXT", "TLEN"}


def numbered(df: DataFrame, column: str = "ordinal", cells: tuple[str, ...] = (), compression: str = "snappy") -> DataFrame:
    """Rows numbered from 0 in the order of the table, without gaps and without a single task that sees all.

    Each row's partition and place are written with it, since a table is not read back in the order of
    its files; every cell's first number then comes from the counts of the cells before it. Cells are
    partitions, or in the order of the columns ``cells`` whose rows stay together, such as blocks of files.
    """
    row = F.monotonically_increasing_id()
    rows = stage(df.withColumn("row_", row), "numbered", compression)
    rows = rows.withColumn("cell_", F.struct(*cells) if cells else F.struct(F.shiftright("row_", 33).alias("part")))
    counts = stage(rows.groupBy("cell_").agg(F.count("*").alias("n_"), F.min("row_").alias("from_")), "cells")
    firsts = counts.select(F.col("cell_").alias("of_"), "from_", (F.sum("n_").over(Window.orderBy("cell_")) - F.col("n_")).alias("first_"))  # a row for each cell
    out = rows.join(small(firsts), F.col("cell_") == F.col("of_"))
    return out.withColumn(column, F.col("first_") + F.col("row_") - F.col("from_")).drop("row_", "cell_", "of_", "from_", "first_", *cells)


def running_sum(df: DataFrame, cost: str, by: str, order: str, column: str = "spent") -> DataFrame:
    """Adds the sum of ``cost`` over the rows of the same ``by`` up to this one, in the order of ``order``.

    Rows are dealt out by ranges of (by, order) and written with their part; a part's sums start from
    those of the parts before it, so a common value of ``by`` is not one task.
    """
    dealt = df.repartitionByRange(by, order).withColumn("part_", F.spark_partition_id())
    rows = stage(dealt, "ranges")
    sums = rows.groupBy(by, "part_").agg(F.sum(cost).alias("all_"))
    before = F.sum("all_").over(Window.partitionBy(by).orderBy("part_")) - F.col("all_")  # a row for each part
    firsts = stage(sums.select(F.col(by).alias("by_"), F.col("part_").alias("of_"), before.alias("before_")), "firsts")
    inside = rows.withColumn("here_", F.sum(cost).over(Window.partitionBy("part_", by).orderBy(order)))
    out = inside.join(small(firsts), F.col(by).eqNullSafe(F.col("by_")) & (F.col("part_") == F.col("of_")))
    return out.withColumn(column, F.col("before_") + F.col("here_")).drop("part_", "all_", "by_", "of_", "before_", "here_")


def lines(spark: SparkSession, path: str | list[str], size: int = RANGE_BYTES) -> DataFrame:
    """Lines numbered by file name and place in the file; ``size`` is the bytes of a range, which a task reads."""
    return read_records(spark, path, "line", "line", size)


def fastq_records(text: DataFrame, encoding: str | None = "Illumina1.8") -> DataFrame:
    """Lines (line, value) -> ordinal, id, desc, seq, qual_text and, with an encoding, qual.

    Records are strictly four lines; a record that lacks its marks or lines raises.
    """
    four = text.groupBy(F.expr("line div 4").alias("ordinal")).agg(*[F.max(F.when(F.col("line") % 4 == k, F.col("value"))).alias(f"l{k}") for k in range(4)])
    good = F.col("l0").startswith("@") & F.col("l2").startswith("+") & F.col("l3").isNotNull() & (F.length("l1") == F.length("l3"))
    checked = F.when(good, F.substring("l0", 2, 1 << 20)).otherwise(F.raise_error(F.format_string("record %d is no FASTQ record", "ordinal")))
    return _reads(four.select("ordinal", checked.alias("head"), F.col("l1").alias("seq"), F.col("l3").alias("qual_text")), encoding)


def _reads(records: DataFrame, encoding: str | None) -> DataFrame:
    head = F.split("head", " ", 2)
    out = records.select("ordinal", F.get(head, 0).alias("id"), F.coalesce(F.get(head, 1), F.lit("")).alias("desc"), "seq", "qual_text")
    return out if encoding is None else out.withColumn("qual", S.zero_unknown(F.col("seq"), S.decode_quality(F.col("qual_text"), encoding)))


def read_fastq(spark: SparkSession, path: str | list[str], encoding: str | None = "Illumina1.8", size: int = RANGE_BYTES) -> DataFrame:
    """Files -> ordinal, id, desc, seq, qual_text and, with an encoding, qual. A task reads the records that begin in its ``size`` bytes; a broken record raises."""
    return _reads(read_records(spark, path, "fastq", size=size), encoding)


def write_fastq(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """id, seq, qual (or qual_text) and, if there, desc as text files of records; ``by`` names columns (sample, qualifier) that become folders."""
    desc = F.coalesce("desc", F.lit("")) if "desc" in df.columns else F.lit("")
    head = F.concat(F.lit("@"), F.col("id"), F.when(desc != "", F.concat(F.lit(" "), desc)).otherwise(""))
    quality = F.col("qual_text") if "qual_text" in df.columns and "qual" not in df.columns else S.encode_quality(F.col("qual"))
    out = df.select(F.concat_ws("\n", head, F.col("seq"), F.lit("+"), quality).alias("value"), *(by or []))
    (out.write.partitionBy(*by) if by else out.write).text(path)


def read_fasta(spark: SparkSession, path: str | list[str], size: int = RANGE_BYTES) -> DataFrame:
    """Files -> ordinal, name, seq, by ranges of ``size`` bytes; a record is held whole by the task in whose range it begins."""
    return read_records(spark, path, "fasta", size=size)


def write_fasta(df: DataFrame, path: str) -> None:
    df.select(F.concat(F.lit(">"), "name", F.lit("\n"), "seq").alias("value")).write.text(path)


def sam_records(text: DataFrame) -> DataFrame:
    """Lines (value) -> the other columns, ``line`` as ordinal, and the mandatory ones; lines with fewer fields (headers) are left out."""
    fields = F.split("value", "\t")
    rows = text.filter(F.size(fields) >= len(SAM_COLUMNS))
    return rows.select(*[F.col(c).alias("ordinal" if c == "line" else c) for c in text.columns if c != "value"], *[F.get(fields, i).cast("int" if c in SAM_INTEGERS else "string").alias(c) for i, c in enumerate(SAM_COLUMNS)])


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return sam_records(lines(spark, path))


def adjacent_pairs(sam: DataFrame) -> DataFrame:
    """Alternating V and J rows -> one row per pair, with structs v and j."""
    rows = numbered(sam.orderBy("ordinal").drop("ordinal"), "n")
    struct = F.struct(*SAM_COLUMNS)
    return rows.groupBy(F.expr("n div 2").alias("uid")).agg(F.max(F.when(F.col("n") % 2 == 0, struct)).alias("v"), F.max(F.when(F.col("n") % 2 == 1, struct)).alias("j")).filter("j is not null")


def phred_offset(fastq: DataFrame, reads: int = 100) -> int:
    """33 if any quality character of the first reads is below 59, else 64."""
    least = fastq.orderBy("ordinal").limit(reads).select(F.array_min(F.transform(F.split("qual_text", ""), F.ascii)).alias("q")).filter("q > 0").agg(F.min("q")).head()[0]
    return 33 if least is not None and least < 59 else 64
