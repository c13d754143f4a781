"""Sharding by a hierarchical weighted hash tree (DataFrame functions only).

A document descends region, rack and shard. At each level every child draws -ln(u) / weight from a hash
of the document's key and the child's name, and the least draw wins, so a child gets keys in proportion
to its weight, without any table of keys. Weight that is added later is an entry of its own
(``generation``) at each level of its path: only that entry's draws are new, and a key which it wins
goes down to the weight that was added. So movement stays within the subtrees whose weights grew, and
ends in the shards that grew.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vdjspark.runtime import stage

#: (region, rack, shard, weight, generation)
Leaf = tuple[int, int, int, float, int]


def leaves(shards: int, base: int = 40, shards_per_rack: int = 4, racks_per_region: int = 2) -> list[Leaf]:
    """Equal shards in racks and regions; those from ``base`` on are added one by one, each a generation."""
    per_region = shards_per_rack * racks_per_region
    n_regions = max(1, base // per_region)
    out = []
    for s in range(shards):
        if s < base:
            out.append((s // per_region, s // shards_per_rack, s, 1.0, 0))
        else:
            region = s % n_regions
            out.append((region, region * racks_per_region, s, 1.0, s - base + 1))
    return out


def _draw(key: list[Column], level: str, choices: list[tuple]) -> Column:
    """The child whose draw is least; choices: (name of the child, weight)."""
    scores = []
    for i, (name, weight) in enumerate(choices):
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), F.lit(name), *key), 11)
        scores.append(F.struct((-F.log((bits + F.lit(0.5)) / F.lit(float(2**53))) / F.lit(float(weight))).alias("draw"), F.lit(i).alias("child")))
    return F.array_min(F.array(*scores))["child"] if len(scores) > 1 else F.lit(0)


def shard_of(key: list[Column], tree: list[Leaf]) -> Column:
    """The shard that ``key`` falls to; null keys are keys like any other."""
    regions, racks, shards = defaultdict(float), defaultdict(lambda: defaultdict(float)), defaultdict(lambda: defaultdict(float))
    for region, rack, shard, weight, generation in tree:
        regions[generation, region] += weight
        racks[generation, region][rack] += weight
        shards[generation, region, rack][shard] += weight

    def at_rack(path: tuple) -> Column:
        options = sorted(shards[path].items())
        won = _draw(key, "shard", [(f"{path}/{s}", w) for s, w in options])
        return F.element_at(F.array(*[F.lit(s) for s, _ in options]), won + 1)

    def at_region(path: tuple) -> Column:
        options = sorted(racks[path].items())
        won = _draw(key, "rack", [(f"{path}/{r}", w) for r, w in options])
        return _case(won, [at_rack((*path, r)) for r, _ in options])

    options = sorted(regions.items())
    won = _draw(key, "region", [(f"{generation}/{region}", w) for (generation, region), w in options])
    return _case(won, [at_region(path) for path, _ in options])


def _case(chosen: Column, branches: list[Column]) -> Column:
    out = branches[-1]
    for i, branch in reversed(list(enumerate(branches[:-1]))):
        out = F.when(chosen == i, branch).otherwise(out)
    return out


def assign(docs: DataFrame, tree: list[Leaf], grown: list[Leaf] | None = None) -> DataFrame:
    """Documents -> doc_id, size, text_crc32, shard, slot and, with ``grown``, grown_shard.

    Size: UTF-8 bytes of the text plus 16; null text counts as empty. Slots number a shard's rows
    gapless from 0: rows are counted by shard and by partition of the staged table, the counts give each
    such cell its first slot, and rows are numbered within their cell, so no task holds a whole shard.
    Equal doc_ids share a shard and have slots of their own. The row id is written with the staged rows, so
    counts and slots agree however the table is split when it is read.
    """
    key = [F.col("doc_id")]
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(
        "doc_id",
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        shard_of(key, tree).cast("int").alias("shard"),
        (shard_of(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"),
    )
    rows = stage(found.withColumn("row", F.monotonically_increasing_id()), "shards").withColumn("part", F.shiftright("row", 33))
    cells = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    first = F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    cells = cells.select("shard", "part", first.alias("first"))
    within = F.row_number().over(Window.partitionBy("shard", "part").orderBy("row")) - 1
    placed = rows.withColumn("within", within).join(cells, ["shard", "part"])
    return placed.select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("within")).cast("long").alias("slot"), "grown_shard")
