"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors, over the largest norm, get one more entry that makes all norms 1; queries, over their norm, get
0 there. Then the largest inner product is the least Euclidean distance, which p-stable hashes keep:
hash m of a vector is floor((a_m . x + b_m) / width) with normal a_m, and a bucket is a vector of hashes.

A query visits buckets of all tables in the order of their estimated success. For a neighbour whose
cosine with the query is s, the projection on a_m is normal around s times the query's, with variance
1 - s^2; a bucket's success is the product over its hashes. A first round visits few buckets; the k-th
score found there is the s of the second, which goes on until a neighbour of that score is missed by all
tables with a probability of at most 1 - target. Queries that found too few vectors, or would have to
visit too many buckets, are compared with all vectors, in blocks. So no bucket or list has a cap.

Equal vectors are one class, of which the k + 1 smallest keys are all that any result can hold.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from math import erf, floor, log2, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vdjspark.llm.hashing import mixed
from vdjspark.llm.vectors import matrix, usable
from vdjspark.runtime import small, stage

#: Vectors that a task compares queries with, and queries compared at once: both bound its memory.
BLOCK, QUERIES = 8192, 256
#: Probabilities below it aren't visited for their own sake.
TAIL = 4.0
#: Vectors that a bucket of the finest hashes should hold on average, and bits that a hash tells (about, at a width of 3).
PER_BUCKET, BITS = 256, 1.3
#: The table that holds all vectors, in blocks.
ALL = -1


def _phi(z: float) -> float:
    return 0.5 * (1 + erf(z / sqrt(2)))


def best_first(choices: list[list[tuple[float, int]]]) -> Iterator[tuple[float, tuple[int, ...]]]:
    """Products of one choice (probability, cell) from each list, in falling order; each list falls too."""
    whole = 1.0
    for c in choices:
        if not c:
            return
        whole *= c[0][0]
    heap = [(-whole, (0,) * len(choices), 0)]
    while heap:
        p, ranks, last = heapq.heappop(heap)
        yield -p, tuple(choices[m][r][1] for m, r in enumerate(ranks))
        # only lists from the last one that moved go on, so that no product comes twice
        for m in range(last, len(choices)):
            r = ranks[m]
            if r + 1 < len(choices[m]):
                heapq.heappush(heap, (p * choices[m][r + 1][0] / choices[m][r][0], (*ranks[:m], r + 1, *ranks[m + 1 :]), m))


@dataclass(frozen=True)
class Index:
    """Hash functions, and the number of groups of buckets that points are dealt to. Fitted on counts and the largest norm of all vectors."""

    d: int
    largest: float
    tables: int
    hashes: int
    width: float
    groups: int
    seed: int = 1

    def functions(self) -> tuple[np.ndarray, np.ndarray]:
        rng = np.random.default_rng(self.seed)
        return rng.normal(size=(self.tables, self.hashes, self.d + 1)), rng.random((self.tables, self.hashes)) * self.width

    def keyed(self, table: int, cells: np.ndarray) -> np.ndarray:
        """A number for each row of cells. Two buckets of one number are one bucket: harmless."""
        h = np.full(len(cells), table + 1, np.uint64)
        for m in range(self.hashes):
            h = mixed(h ^ (cells[:, m].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return h.view(np.int64)

    def group(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.view(np.uint64)) % np.uint64(self.groups)).astype(np.int32)

    def placed(self, v: np.ndarray) -> list[np.ndarray]:
        """Each table's buckets of vectors."""
        a, b = self.functions()
        x = v / self.largest
        x = np.column_stack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1)))])
        return [self.keyed(t, np.floor((x @ a[t].T + b[t]) / self.width)) for t in range(self.tables)]

    def choices(self, projection: float, offset: float, s: float) -> list[tuple[float, int]]:
        """(probability, cell) of a neighbour of cosine s, most probable first, for a query's projection."""
        sd = sqrt(max(1 - s * s, 1e-9))
        near = s * projection + offset
        found = []
        for c in range(floor((near - TAIL * sd) / self.width), floor((near + TAIL * sd) / self.width) + 1):
            p = _phi(((c + 1) * self.width - near) / sd) - _phi((c * self.width - near) / sd)
            if p > 0:
                found.append((p, c))
        return sorted(found, reverse=True)

    def visits(self, table: int, projections: np.ndarray, offsets: np.ndarray, s: float) -> Iterator[tuple[float, int, tuple[int, ...]]]:
        """A table's buckets in the order of estimated success: (-probability, table, cells)."""
        for p, cells in best_first([self.choices(f, b, s) for f, b in zip(projections[table].tolist(), offsets[table].tolist(), strict=True)]):
            yield -p, table, cells


def first_visits(index: Index, projections: np.ndarray, offsets: np.ndarray, first: int) -> list[tuple[int, tuple[int, ...]]]:
    """The first round's buckets (table, cells) of a query: the best ``first`` of each table, for a cosine of a half."""
    return [(t, cells) for t in range(index.tables) for _, t, cells in islice(index.visits(t, projections, offsets, 0.5), first)]


def later_visits(index: Index, projections: np.ndarray, offsets: np.ndarray, s: float, target: float, most: int) -> list[tuple[int, tuple[int, ...]]] | None:
    """Buckets for a neighbour of cosine s, best first over all tables, until all miss it with probability 1 - target; None beyond ``most``."""
    miss = [1.0] * index.tables
    out = []
    for p, t, cells in heapq.merge(*[index.visits(t, projections, offsets, s) for t in range(index.tables)]):
        out.append((t, cells))
        miss[t] = max(0.0, miss[t] + p)
        if np.prod(miss) <= 1 - target:
            break
        if len(out) >= most:
            return None
    return out


FOUND = "q long, cid long, score double, none boolean, least long, ids array<long>"


def _best(score: np.ndarray, none: np.ndarray, least: np.ndarray, of: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` best rows of each ``of``: largest score, then null keys last, then smallest key."""
    order = np.lexsort((least, none, -score, of))
    of = of[order]
    first = np.flatnonzero(np.diff(of, prepend=of[0] - 1 if len(of) else 0))
    rank = np.arange(len(of)) - np.repeat(first, np.diff(first, append=len(of)))
    return order[rank < most]


class Block:
    """Vectors of one group in memory, by bucket."""

    def __init__(self, parts: list[pa.RecordBatch], d: int):
        rows = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        bucket = rows.column("bucket").to_numpy()
        order = np.argsort(bucket, kind="stable")
        self.rows = rows
        self.order = order
        self.v = matrix(rows, "v", d)[order]
        self.none = rows.column("none").to_numpy(zero_copy_only=False)[order]
        self.least = rows.column("least").to_numpy()[order]
        keys, first = np.unique(bucket[order], return_index=True)
        self.at = dict(zip(keys.tolist(), zip(first.tolist(), [*first[1:].tolist(), len(order)], strict=True), strict=True))

    def compared(self, q: np.ndarray, asked: list[np.ndarray], floors: np.ndarray, slack: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, exact score) of each query's best rows in the buckets that it asks for, none below its floor."""
        lengths = [len(a) for a in asked]
        keys, who = np.concatenate(asked), np.repeat(np.arange(len(q)), lengths)
        order = np.argsort(keys, kind="stable")
        keys, who = keys[order], who[order]
        first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1 if len(keys) else 0))
        of, at = [], []
        for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)], strict=True):
            begin, end = self.at.get(int(keys[a]), (0, 0))
            if begin == end:
                continue
            mine = who[a:b]
            scores = q[mine] @ self.v[begin:end].T
            bound = floors[mine]
            if end - begin > most:
                bound = np.maximum(bound, np.partition(scores, end - begin - most, axis=1)[:, end - begin - most])
            x, y = np.nonzero(scores >= (bound - slack[mine])[:, None])
            of.append(mine[x])
            at.append(begin + y)
        of, at = (np.concatenate([np.zeros(0, int), *x]) for x in (of, at))
        # by rows, so that a pair's sum is the same wherever it is compared
        exact = np.concatenate([np.zeros(0), *((q[of[i : i + BLOCK]] * self.v[at[i : i + BLOCK]]).sum(axis=1) for i in range(0, len(of), BLOCK))])
        chosen = _best(exact, self.none[at], self.least[at], of, most)
        return of[chosen], at[chosen], exact[chosen]


def _scored(rows: DataFrame, d: int, largest: float, most: int) -> DataFrame:
    """Vectors (kind 0) and queries (kind 1) of each (t, g, part), in this order -> FOUND rows: each query's best in the group."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None
        for batch in batches:
            marks = np.stack([batch.column(c).to_numpy() for c in ("t", "g", "part", "kind")], axis=1)
            edges = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1).tolist(), len(marks)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                key, piece = tuple(marks[a, :3].tolist()), batch.slice(a, b - a)
                if key != now:
                    now, held, block = key, [], None
                if marks[a, 3] == 0:
                    held.append(piece)
                    continue
                if not held:
                    continue
                block = block or Block(held, d)
                for i in range(0, b - a, QUERIES):
                    part = piece.slice(i, QUERIES)
                    q = matrix(part, "v", d)
                    asked = part.column("asked")
                    ends = asked.offsets.to_numpy()
                    keys = asked.values.to_numpy()
                    lists = [keys[x:y] for x, y in zip(ends[:-1], ends[1:], strict=True)]
                    slack = 1e-9 * largest * np.sqrt((q * q).sum(axis=1))
                    of, at, score = block.compared(q, lists, part.column("bound").to_numpy(), slack, most)
                    chosen = block.rows.take(pa.array(block.order[at]))
                    yield pa.RecordBatch.from_pydict({"q": part.column("cid").take(pa.array(of)), "cid": chosen.column("cid"), "score": pa.array(score), "none": chosen.column("none"), "least": chosen.column("least"), "ids": chosen.column("ids")})

    return rows.repartition("t", "g", "part").sortWithinPartitions("t", "g", "part", "kind").mapInArrow(work, FOUND)


def _searched(classes: DataFrame, asked: DataFrame, index: Index, most: int) -> DataFrame:
    """Queries' visits (t, g, cid, v, bound, asked) -> FOUND rows. Only groups that are asked for are shuffled; large ones are split."""
    d, tables, groups = index.d, index.tables, index.groups
    names = {r["t"] for r in asked.select("t").distinct().collect()}  # at most tables + 1

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            buckets = index.placed(matrix(batch, "v", d))
            for t in sorted(names):
                bucket = np.zeros(n, np.int64) if t == ALL else buckets[t]
                g = (mixed(batch.column("cid").to_numpy().view(np.uint64)) % np.uint64(groups)).astype(np.int32) if t == ALL else index.group(bucket)
                yield pa.RecordBatch.from_pydict({"t": pa.array(np.full(n, t, np.int32)), "g": pa.array(g), "bucket": pa.array(bucket)} | {c: batch.column(c) for c in ("cid", "none", "least", "ids", "v")})

    entry = classes.schema["v"].dataType.simpleString()
    points = classes.select("cid", "none", "least", "ids", "v").mapInArrow(place, f"t int, g int, bucket long, cid long, none boolean, least long, ids array<long>, v {entry}")
    # a row for each group of buckets: about a row for BLOCK vectors and table
    sizes = points.groupBy("t", "g").agg(F.count("*").alias("n")).join(asked.select("t", "g").distinct(), ["t", "g"])
    sizes = small(stage(sizes.select("t", "g", F.ceil(F.col("n") / (2 * BLOCK)).cast("int").alias("parts")), "groups"))
    at = points.join(sizes, ["t", "g"]).withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    every = asked.join(sizes, ["t", "g"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    left = at.select("t", "g", "part", F.lit(0).alias("kind"), "bucket", "cid", "none", "least", "ids", "v", F.lit(0.0).alias("bound"), F.array().cast("array<long>").alias("asked"))
    none = F.lit(None)
    right = every.select("t", "g", "part", F.lit(1).alias("kind"), none.cast("long").alias("bucket"), "cid", none.cast("boolean").alias("none"), none.cast("long").alias("least"), F.array().cast("array<long>").alias("ids"), "v", "bound", "asked")
    return _scored(left.unionByName(right), d, index.largest, most)


def _asked(queries: DataFrame, index: Index, first: int, target: float, most: int) -> DataFrame:
    """Query classes (cid, v) -> visits of the first round; with ``bound`` (the score to beat; null: too few found) those of the second."""
    second = "bound" in queries.columns
    groups = index.groups

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = index.functions()
        for batch in batches:
            v = matrix(batch, "v", index.d)
            norm = np.sqrt((v * v).sum(axis=1))
            projected = np.einsum("nd,tmd->ntm", v / norm[:, None], a[:, :, :-1])
            bounds = batch.column("bound").to_pylist() if second else [None] * len(v)
            of, tables, group, lists = [], [], [], []
            for i, bound in enumerate(bounds):
                early = first_visits(index, projected[i], b, first)
                if not second:
                    mine = early
                elif bound is not None:
                    s = min(0.9999, max(-0.9999, bound / (float(norm[i]) * index.largest)))
                    mine = later_visits(index, projected[i], b, s, target, most)
                else:
                    mine = None
                if mine is None:
                    of += [i] * groups
                    tables += [ALL] * groups
                    group += range(groups)
                    lists += [[0]] * groups
                    continue
                done = set(early) if second else ()
                by_group: dict[tuple[int, int], list[int]] = {}
                for t in range(index.tables):
                    cells = [c for u, c in mine if u == t and (u, c) not in done]
                    if cells:
                        keys = index.keyed(t, np.array(cells))
                        for g, k in zip(index.group(keys).tolist(), keys.tolist(), strict=True):
                            by_group.setdefault((t, g), []).append(k)
                for (t, g), keys in by_group.items():
                    of.append(i)
                    tables.append(t)
                    group.append(g)
                    lists.append(keys)
            rows = pa.array(of, pa.int64())
            bound = pa.array([-np.inf if bounds[i] is None else bounds[i] for i in of], pa.float64())
            yield pa.RecordBatch.from_pydict({"t": pa.array(tables, pa.int32()), "g": pa.array(group, pa.int32()), "cid": batch.column("cid").take(rows), "v": batch.column("v").take(rows), "bound": bound, "asked": pa.array(lists, pa.list_(pa.int64()))})

    entry = queries.schema["v"].dataType.simpleString()
    return queries.mapInArrow(work, f"t int, g int, cid long, v {entry}, bound double, asked array<long>")


def _own(queries: DataFrame, d: int) -> DataFrame:
    """Each query's own class as FOUND row: its other members are candidates of score |v|^2."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch, "v", d)
            yield pa.RecordBatch.from_pydict({"q": batch.column("cid"), "score": pa.array((v * v).sum(axis=1))} | {c: batch.column(c) for c in ("cid", "none", "least", "ids")}).select(["q", "cid", "score", "none", "least", "ids"])

    return queries.select("cid", "none", "least", "ids", "v").mapInArrow(work, FOUND)


def _leading(found: DataFrame, most: int) -> DataFrame:
    """Each query's best ``most`` of FOUND rows that may repeat."""
    w = Window.partitionBy("q").orderBy(F.desc("score"), "none", "least", "cid")
    return found.dropDuplicates(["q", "cid"]).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= most)


def search(rows: DataFrame, is_query: Column, k: int = 20, key: str = "vec_id", vector: str = "embedding", tables: int = 2, width: float = 3.0, target: float = 0.95, first: int = 4, most: int = 4096, seed: int = 1) -> DataFrame:
    """Rows (key, vector) -> query_id, rank (from 1), the neighbour's key, score: the ``k`` rows of largest inner product found for each query row.

    Queries are the rows for which ``is_query`` (a condition on ``key``; null: not) holds; candidates are all
    rows but the query's own. Ties go to the smaller key, null keys last. Vectors that are null, empty, zero,
    hold a null or a number that isn't finite, or, where lengths differ, are of another length than the most
    frequent, take no part, neither as query nor as candidate. Repeated rows are candidates each, and of a
    query that occurs twice each gets its ``k`` rows. Other columns are ignored, whatever their names.

    ``target`` is the chance aimed at of visiting a bucket that holds a neighbour as near as the k-th.
    """
    spark = rows.sparkSession
    good, d = usable(rows, key, vector)
    schema = f"query_id long, rank int, {key} long, score double"
    if not d:
        return spark.createDataFrame([], schema)
    good = good.filter(F.exists("v", lambda c: c != 0))
    if good.schema["v"].dataType.elementType.simpleString() not in ("float", "double"):
        good = good.withColumn("v", F.transform("v", lambda c: c.cast("double")))
    asks = good.filter(is_query & F.col(key).isNotNull())
    # a limit on ranks is kept before the shuffle, so a vector that fills the table sends a few rows a task
    ranked = good.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy(F.col(key).asc_nulls_last()))).filter(F.col("r") <= k + 1)
    member = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"))
    grouped = ranked.groupBy("v").agg(F.transform(F.sort_array(F.collect_list(member)), lambda x: x["id"]).alias("ids"))
    named = grouped.join(asks.select("v").distinct().withColumn("asks", F.lit(True)), "v", "left")
    least = F.get("ids", F.lit(0))
    classes = stage(named.select(F.monotonically_increasing_id().alias("cid"), least.isNull().alias("none"), F.coalesce(least, F.lit(0)).alias("least"), "ids", "v", F.coalesce("asks", F.lit(False)).alias("asks")), "classes")
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    n, largest = classes.agg(F.count("*"), F.sqrt(F.max(squares))).head()
    if not n:
        return spark.createDataFrame([], schema)
    hashes = max(1, round(log2(max(n / PER_BUCKET, 1)) / BITS))
    index = Index(d, largest * (1 + 1e-12), tables, hashes, width, max(1, -(-n // BLOCK)), seed)
    queries = classes.filter("asks")
    round_one = stage(_leading(_searched(classes, stage(_asked(queries, index, first, target, most), "asked"), index, k + 1).unionByName(_own(queries, d)), k + 1), "near")
    enough = round_one.groupBy("q").agg(F.count("*").alias("n"), F.min("score").alias("worst")).select(F.col("q").alias("cid"), F.when(F.col("n") > k, F.col("worst")).alias("bound"))
    again = stage(_asked(queries.select("cid", "v").join(enough, "cid").select("cid", "v", "bound"), index, first, target, most), "asked")
    both = round_one.drop("rank").unionByName(_searched(classes, again, index, k + 1))
    best = _leading(both, k + 1)
    entry = F.transform("ids", lambda x: F.struct((-F.col("score")).alias("score"), x.isNull().alias("none"), x.alias("id"), (F.col("cid") == F.col("q")).alias("own")))
    # at most (k + 1)^2 entries of a query
    lists = best.select("q", entry.alias("e")).groupBy("q").agg(F.slice(F.sort_array(F.flatten(F.collect_list("e"))), 1, k + 1).alias("list"))
    lists = stage(lists.join(queries.select(F.col("cid").alias("q"), "v"), "q").select("v", "list"), "lists")
    mine = asks.join(small(lists), "v")
    own = F.array_position(F.transform("list", lambda x: x["own"] & x["id"].eqNullSafe(F.col(key))), True)
    others = F.slice(F.filter("list", lambda x, i: i + 1 != F.col("own_")), 1, k)
    each = mine.withColumn("own_", own).select(F.col(key).alias("query_id"), F.posexplode(others).alias("i", "x"))
    return each.select("query_id", (F.col("i") + 1).alias("rank"), F.col("x.id").alias(key), (-F.col("x.score")).alias("score"))
