"""Session helpers shared by all operators: staged tables, size-checked broadcasts, test sessions."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, MapType, StringType, StructType

#: Bytes of values that may be broadcast; beyond it joins shuffle.
BROADCAST_BYTES = 8 << 20
#: Rows of two fixed-width columns within it.
BROADCAST_ROWS = BROADCAST_BYTES // 16
#: Bytes of an Arrow batch between Spark and Python: texts may be long, so rows alone don't bound a task's memory.
BATCH_BYTES = 4 << 20


def local_session(cores: int | str = 8, partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or in local mode a new one where it is unset."""
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        # the setting is fixed once a session runs, so the context keeps the folder
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        found = context.getCheckpointDir()
    return found.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Limit Arrow batches of the session to BATCH_BYTES, unless the cluster's settings name a limit."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(BATCH_BYTES))


def stage(df: DataFrame, name: str = "stage", compression: str = "snappy") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage with files that survive the loss of an executor, fixes the rows of a
    non-deterministic plan, and gives the optimizer real sizes.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a staged table which nothing lazy reads any more."""
    path = getattr(df, "_staged_at", None)
    if path:
        spark = df.sparkSession
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _width(value: Column, kind: DataType) -> Column | None:
    """Bytes of a value of varying width; None for the others."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.coalesce(F.octet_length(F.to_json(value)), F.lit(0))
    return None


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast of ``df`` only if its values are measured to take at most ``most`` bytes; else the join shuffles.

    Meant for staged or source tables: of fixed-width columns the rows are counted, which reads no
    column; of others the lengths are summed too, unless the rows alone take more.
    """
    rows = most // (8 * max(1, len(df.columns)))
    if df.limit(rows + 1).count() > rows:
        return df
    varying = [w for f in df.schema.fields if (w := _width(df[f.name], f.dataType)) is not None]
    if varying and (df.select(sum(varying[1:], varying[0]).cast("long").alias("w")).agg(F.sum("w")).head()[0] or 0) > most:
        return df
    return F.broadcast(df)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table of fewer partitions than cores (a small file of one row group), dealt to all cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
