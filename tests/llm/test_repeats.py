from __future__ import annotations

from pyspark.sql import functions as F

from vdjspark.llm import repeats


def largest(rows):
    """Rows of the fullest partition."""
    return rows.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).head()[0]


def test_rows_of_a_common_key_go_to_several_tasks(spark):
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(20_000).select(F.when(F.col("id") < 10_000, 0).otherwise(F.col("id")).alias("key"), "id")
        ones = rows.groupBy("key").agg(F.count("*").alias("copies"), F.min("id").alias("least"))
        dealt = repeats._dealt(rows, ones, ones, ["key"], ["id"], 20_000)
        assert largest(rows.join(ones, "key")) > 10_000
        assert largest(dealt) < 5_000
        want = sorted(tuple(r) for r in rows.join(ones, "key").select("key", "id", "copies", "least").collect())
        assert sorted(tuple(r) for r in dealt.select("key", "id", "copies", "least").collect()) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
