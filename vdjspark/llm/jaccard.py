"""N-gram Jaccard join by signature trees.

Every document is its set of distinct word n-grams. Equal sets are one class from the start. Classes
that may link meet by pigeonhole: a set is split by hash into more parts than two linked sets can
differ in, so several parts are equal, and each set leaves out its most common ones, so that passages
which many documents share make few others meet. Classes
that meet, directly or through others, are a family. Within a family's blocks, signature trees find the
pairs to compare: a node holds the OR of its members' token bitmaps and their range of sizes, and a dual
traversal leaves out node pairs whose largest possible overlap is too small. What is left is compared
exactly, unless the two are connected already, so copies of one text need no quadratic number of pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from vdjspark.llm import hashing as H
from vdjspark.llm.components import components
from vdjspark.llm.frames import map_frames
from vdjspark.runtime import small, stage

#: Classes of a family that one task compares with each other.
BLOCK = 256
#: n-grams of such a block, so that long texts make smaller blocks (16 MB of hashes; one longer text is a block's worth).
BLOCK_GRAMS = 1 << 21
WORDS_OF_BITS = 32  # bitmaps of 2048 bits
FANOUT = 8
SEEDS = 4
#: Parts, as a share of those needed, that sets have so that they can leave out the most common ones.
EXTRA_PARTS = 0.15


def shingle_sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's n-grams of words; fewer words are one n-gram, none are none."""
    hashes, first = H.words(texts, lower=True)
    sums = H.prefix(hashes)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        at = np.arange(a, max(b - n + 1, min(a + 1, b)))
        out.append(np.unique(H.stretch(sums, at, np.minimum(at + n, b))))
    return out


class Parts:
    """The keys of a set: hashes of its parts, by level of size.

    Level c is for pairs whose smaller set has low[c] .. low[c + 1] - 1 n-grams. Such sets of Jaccard
    num / den or more differ in at most ``differ`` n-grams, so of differ + 1 + spare parts more than
    ``spare`` are equal. Each set may thus do without ``spare`` of its parts, if all sets leave out
    parts in one order: empty ones first, then those that most sets have. Of the equal parts of two
    sets, the last in that order is left out by neither. A set with more than ``spare`` empty parts
    leaves out only those, and two such sets try another split; in the last split they have keys for
    empty parts too. So no pair is lost. More spare parts let sets leave out more of the passages
    that they share with others, for more keys.
    """

    def __init__(self, num: int, den: int, ratio: float = 1.5, extra: float = EXTRA_PARTS):
        self.num, self.den, self.ratio, self.extra = num, den, ratio, extra
        self.low, self.parts, self.spare = [1], [], []
        self._more(64)

    def _more(self, size: int) -> None:
        while self.low[-1] <= size:
            low, high = self.low[-1], max(self.low[-1] + 1, int(self.low[-1] * self.ratio))
            differ = (high - 1) * (self.den - self.num) // self.num
            spare = math.ceil((differ + 1) * (math.exp(-low / (differ + 1)) + self.extra))
            self.low.append(high)
            self.parts.append(differ + 1 + spare if differ else 0)  # 0: only equal sets link
            self.spare.append(spare)

    def keys(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys, the level modulo 4 in their low bits; and for each the number that its split may leave out of its level."""
        n, found, free = len(tokens), [np.zeros(0, np.uint64)], [np.zeros(0, np.int32)]
        if n == 0:
            return found[0], free[0]
        self._more(n)
        own = int(np.searchsorted(self.low, n, "right")) - 1
        levels = [own]
        # partners may be as small as num / den * n
        while levels[-1] > 0 and -(-n * self.num // self.den) < self.low[levels[-1]]:
            levels.append(levels[-1] - 1)
        for level in levels:
            if p := self.parts[level]:
                for seed in range(SEEDS):
                    salted = H.mixed(tokens + np.uint64((seed * 0x632BE59BD9B4E019 + 1) % (1 << 64)))
                    part = (salted % np.uint64(p)).astype(np.int64)
                    sums, counts = np.zeros(p, np.uint64), np.bincount(part, minlength=p)
                    np.add.at(sums, part, H.mixed(salted))
                    keys = H.mixed(sums + np.arange(p, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25) + np.uint64(level * 64 + seed))
                    keys = (keys & ~np.uint64(3)) | np.uint64(level % 4)
                    empty = int((counts == 0).sum())
                    many = empty > self.spare[level]
                    found.append(keys if many and seed == SEEDS - 1 else keys[counts > 0])
                    free.append(np.full(len(found[-1]), 0 if many else self.spare[level] - empty, np.int32))
                    if not many:
                        break
        return np.concatenate(found), np.concatenate(free)


def bitmap(tokens: np.ndarray) -> np.ndarray:
    bit = (tokens >> np.uint64(53)).astype(np.int64)
    out = np.zeros(WORDS_OF_BITS * 64, np.uint8)
    out[bit] = 1
    return np.packbits(out).view(np.uint64)


class Node:
    """Members first .. last - 1: the OR of their bitmaps, their sizes, the most tokens that share another's bit."""

    def __init__(self, bits: np.ndarray, sizes: np.ndarray, first: int, last: int):
        self.first, self.last = first, last
        own = bits[first:last]
        self.bits = np.bitwise_or.reduce(own)
        self.low, self.high = int(sizes[first:last].min()), int(sizes[first:last].max())
        self.slack = int((sizes[first:last] - np.bitwise_count(own).sum(axis=1)).max())
        step = -(-(last - first) // FANOUT)
        self.children = [] if last - first <= 16 else [Node(bits, sizes, a, min(a + step, last)) for a in range(first, last, step)]


def tree_pairs(bits: np.ndarray, sizes: np.ndarray, num: int, den: int) -> np.ndarray:
    """Which pairs i < j (members in order of size) may reach num / den: dual traversal of one tree."""
    may = np.zeros((len(sizes), len(sizes)), bool)
    root = Node(bits, sizes, 0, len(sizes))
    counts = np.bitwise_count(bits).sum(axis=1).astype(np.int64)
    todo = [(root, root)]
    while todo:
        a, b = todo.pop()
        overlap = min(a.high, b.high, int(np.bitwise_count(a.bits & b.bits).sum()) + min(a.slack, b.slack))
        # overlap >= num / (num + den) of both sizes together; and sizes within num / den
        if overlap * (num + den) < num * (a.low + b.low) or b.high * den < num * a.low or a.high * den < num * b.low:
            continue
        if not a.children and not b.children:
            i, j = np.arange(a.first, a.last), np.arange(b.first, b.last)
            shared = np.bitwise_count(bits[i][:, None] & bits[j][None]).sum(axis=2).astype(np.int64)
            # tokens of i outside j's bits aren't in j, and the other way round
            most = np.minimum(sizes[i][:, None] - (counts[i][:, None] - shared), sizes[j][None] - (counts[j][None] - shared))
            may[a.first : a.last, b.first : b.last] = most * (num + den) >= num * (sizes[i][:, None] + sizes[j][None])
        elif a is b:
            todo += [(x, y) for k, x in enumerate(a.children) for y in a.children[k:]]
        elif not b.children or (a.children and a.last - a.first >= b.last - b.first):
            todo += [(x, b) for x in a.children]
        else:
            todo += [(a, y) for y in b.children]
    return np.triu(may, 1)


def forest(nodes: list[int], sets: list[np.ndarray], marks: list[int], num: int, den: int, first_marks: set[int] | None = None) -> list[tuple[int, int]]:
    """Links between the sets that connect what ``marks`` (component labels so far) hold apart.

    With ``first_marks``, only pairs with one set whose mark is among them are compared.
    """
    sizes = np.array([len(s) for s in sets])
    order = np.argsort(sizes, kind="stable")
    sets, nodes, marks = [sets[i] for i in order], [nodes[i] for i in order], [marks[i] for i in order]
    sizes = sizes[order]
    may = tree_pairs(np.stack([bitmap(s) for s in sets]), sizes, num, den)
    may |= may.T
    vocabulary, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    marked = np.zeros(len(vocabulary), bool)
    group = np.unique(np.array(marks), return_inverse=True)[1]
    chosen = np.ones(len(sets), bool) if first_marks is None else np.array([m in first_marks for m in marks])
    out = []
    # those with most possible partners first: a central text connects the others at once
    for i in np.argsort(-may.sum(axis=1), kind="stable"):
        near = np.flatnonzero(may[i] & (group != group[i]) & (chosen | chosen[i]))
        if not len(near):
            continue
        may[i, near] = may[near, i] = False
        marked[tokens[ends[i] - sizes[i] : ends[i]]] = True
        parts = [tokens[ends[j] - sizes[j] : ends[j]] for j in near]
        shared = np.add.reduceat(marked[np.concatenate(parts)].astype(np.int64), np.cumsum(sizes[near]) - sizes[near])
        marked[tokens[ends[i] - sizes[i] : ends[i]]] = False
        for j in near[shared * (den + num) >= num * (sizes[near] + sizes[i])]:
            if group[j] != group[i]:
                out.append((nodes[i], nodes[j]))
                group[group == group[j]] = group[i]
    return out


def stars(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same components as ``links``, with each node linked to the least: shorter ways for components()."""
    above: dict[int, int] = {}

    def least(node: int) -> int:
        while (up := above.setdefault(node, node)) != node:
            above[node] = node = above[up]
        return node

    for a, b in links:
        low, high = sorted((least(a), least(b)))
        above[high] = low
    return [(node, root) for node in above if (root := least(node)) != node]


def _utf8(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _same(a: str, b: str) -> F.Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))


def _blocks(grams: Column) -> Column:
    """Blocks that a group of classes with so many n-grams in all is dealt to."""
    return F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(grams / BLOCK_GRAMS)).cast("int")


def group_documents(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """Documents -> doc_id, h (xxhash64 of the text), n_shingles, component_id.

    Two documents link when den * |intersection| >= num * |union| of their sets of word n-grams (words
    lower-cased, A to Z only). component_id is the least doc_id that links reach, the row's own
    included. No words or null text: no n-grams, linked with nothing. Rows with null doc_id link like
    others and have a null component_id only if no row they reach has an id. Sets are compared by
    64-bit hashes of their n-grams; every pair that may link is compared, without caps.
    """
    parts = Parts(num, den)

    def summaries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, rows = list(batch["text"]), []
            for a, b in H.chunks(texts):
                for s in shingle_sets(texts[a:b], n):
                    keys, free = parts.keys(s)
                    rows.append((len(s), int(H.mixed(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0, keys.view(np.int64), free))
            out = pd.DataFrame(rows, columns=["n", "node", "keys", "free"])
            out.insert(0, "h", batch["h"].to_numpy())
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    utf8 = _utf8(docs)
    found = stage(map_frames(utf8, summaries, "doc_id long, h long, n long, node long, keys array<long>, free array<int>"), "sets")
    classes = stage(found.filter("n > 0").groupBy("node").agg(F.max("n").alias("n"), F.min("doc_id").alias("least"), F.min(F.struct("doc_id", "h")).alias("at")), "classes")

    # each class leaves out its most common parts; parts that only it has come last, so they needn't be ranked
    rows = found.filter(F.size("keys") > 0).dropDuplicates(["node"])
    rows = rows.select("node", F.explode(F.arrays_zip("keys", "free")).alias("k")).select("node", "k.keys", "k.free").withColumnRenamed("keys", "key")
    common = rows.withColumn("c", F.count("*").over(Window.partitionBy("key"))).filter("c > 1")
    order = Window.partitionBy("node", F.col("key").bitwiseAND(3), "free").orderBy(F.desc("c"), "key")
    kept = common.withColumn("rank", F.row_number().over(order)).filter("rank > free")
    # classes that share a part: all are tied to the least of them; c tells how central a class is
    together = Window.partitionBy("key")
    met = kept.select("node", "key", F.min("node").over(together).alias("low"), F.count("*").over(together).alias("c")).filter("c > 1")
    met = stage(met.groupBy("node", "low").agg(F.sum("c").alias("c")), "met")
    families = stage(components(met.select(F.col("node").alias("a"), F.col("low").alias("b"))), "families")
    central = stage(met.groupBy("node").agg(F.sum("c").alias("c")), "central")
    placed = stage(classes.join(small(families), "node").select("node", "root", "n", "at"), "placed")
    sizes = stage(placed.groupBy("root").agg(_blocks(F.sum("n")).alias("blocks")), "sizes")
    members = placed.join(small(sizes), "root").join(small(central), "node")
    members = stage(members.select("node", "root", "c", "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block"), "at.doc_id", "at.h"), "members")

    def sets_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = list(batch["text"])
            sets = [s.tobytes() for a, b in H.chunks(texts) for s in shingle_sets(texts[a:b], n)]
            yield batch.drop(columns="text").assign(tokens=sets)

    near = small(members).alias("m")
    texts = utf8.alias("t").join(near, _same("t", "m")).select("m.node", "m.root", "m.c", "m.blocks", "m.block", "t.text")
    sets = map_frames(texts, sets_of, "node long, root long, c long, blocks int, block int, tokens binary").dropDuplicates(["node"])
    sets = stage(sets, "family-sets")

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("node")
        tokens = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
        nodes = rows["node"].tolist()
        return pd.DataFrame(stars(forest(nodes, tokens, nodes, num, den)), columns=["a", "b"], dtype="int64")

    # the most central class of a family of several blocks joins each of them
    pivots = sets.filter("blocks > 1").groupBy("root").agg(F.max(F.struct("c", "node")).alias("p"))
    pivots = stage(pivots.select("root", F.col("p.node").alias("node")), "pivots")
    pivots = sets.join(small(pivots), ["root", "node"], "left_semi").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    links = sets.unionByName(pivots.select(sets.columns)).groupBy("root", "block").applyInPandas(compare, "a long, b long")
    linked = stage(components(links), "linked")
    if sets.filter("blocks > 1").limit(1).count():
        across = stage(_across_blocks(sets, linked, num, den), "across")
        if across.limit(1).count():
            # each component so far is a star, so only the links between these are new
            linked = stage(components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(across)), "linked")
    # of linked classes, the least document of the component; of others, their own
    placed = classes.select("node", "least").join(small(linked), "node")
    lowest = stage(placed.groupBy("root").agg(F.min("least").alias("component_id")), "lowest")
    lowest = stage(linked.join(small(lowest), "root").select("node", "component_id"), "lowest")
    labels = classes.join(small(lowest).withColumn("linked", F.lit(True)), "node", "left")
    labels = labels.select("node", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id"))
    out = found.select("doc_id", "h", "n", "node").join(labels, "node", "left")
    return out.select("doc_id", "h", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _across_blocks(sets: DataFrame, linked: DataFrame, num: int, den: int) -> DataFrame:
    """Links between blocks of one family; ``linked`` (node, root) are the components of the blocks' own links.

    Only classes outside their family's largest component so far can add any: they are compared, a
    block at a time, with every block of the family.
    """
    large = sets.filter("blocks > 1").alias("s").join(small(linked).select("node", F.col("root").alias("mark")).alias("l"), F.col("s.node") == F.col("l.node"), "left")
    large = stage(large.select("s.*", F.coalesce("l.mark", "s.node").alias("mark")), "large")
    main = stage(large.groupBy("root", "mark").count().groupBy("root").agg(F.max(F.struct("count", "mark"))["mark"].alias("main")), "main")
    apart = large.join(small(main), "root").filter("mark != main").drop("main")
    n_apart = stage(apart.groupBy("root").agg(_blocks(F.sum(F.octet_length("tokens")) / 8).alias("chunks")), "apart")
    apart = apart.join(small(n_apart), "root").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(1)), "chunks").cast("int"))
    first = apart.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("apart", F.lit(True))
    second = large.join(small(n_apart), "root").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("apart", F.lit(False))
    columns = ["root", "block", "chunk", "node", "mark", "tokens", "apart"]

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("apart", ascending=False).drop_duplicates("node")
        chosen = set(rows.loc[rows["apart"], "mark"])
        tokens = [np.frombuffer(t, np.uint64) for t in rows["tokens"]]
        return pd.DataFrame(forest(rows["node"].tolist(), tokens, rows["mark"].tolist(), num, den, chosen), columns=["a", "b"], dtype="int64")

    return first.select(columns).unionByName(second.select(columns)).groupBy("root", "block", "chunk").applyInPandas(compare, "a long, b long")


def one_of_each(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The documents, all columns, that stand for their group: those with its least doc_id.

    Of rows with equal doc_id and text one stays. Documents without words stay. A row with null doc_id
    stays unless it is linked with a row that has one.
    """
    groups = group_documents(docs, n, num, den)
    stays = stage(groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("doc_id", "h").agg(F.count("*").alias("rows"), F.max("n_shingles").alias("n")), "stays")
    same = F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.xxhash64("t.text") == F.col("m.h"))
    once = docs.alias("t").join(small(stays.filter("rows = 1 or n = 0")).alias("m"), same, "left_semi")
    again = docs.alias("t").join(small(stays.filter("rows > 1 and n > 0")).alias("m"), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return once.unionByName(again)
