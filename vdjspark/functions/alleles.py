"""Looking up the germline alleles that alignments and clones name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vdjspark.functions.sequences import allele_parts
from vdjspark.runtime import small


def with_allele(rows: DataFrame, alleles: DataFrame, call: str, region: str, **wanted: Column) -> DataFrame:
    """``rows`` with columns of the allele (name, refpos, seq ...) that ``call`` names.

    A call that the reference lacks, a null one too, and an allele of another region than ``region`` (V,
    J) raise; no row is dropped. The check is part of the columns themselves, so it is made wherever one of
    them is used.
    """
    known = alleles.select(F.col("name").alias("allele_"), allele_parts(F.col("name"))["region"].alias("region_"), *[c.alias(n) for n, c in wanted.items()])
    found = rows.join(small(known), F.col(call) == F.col("allele_"), "left")
    name = F.coalesce(F.col(call), F.lit("null"))

    def checked(value: str) -> Column:
        return (
            F.when(F.col("allele_").isNull(), F.raise_error(F.concat(F.lit("no such allele in the reference: "), name)))
            .when(F.col("region_") != region, F.raise_error(F.concat(F.lit(f"an allele of region {region} expected, not "), name)))
            .otherwise(F.col(value))
        )

    return found.withColumns({c: checked(c) for c in (*wanted, call)}).drop("allele_", "region_")
