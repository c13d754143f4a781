"""Training-order output: token sequences of fixed length in a keyed pseudo-random order, as fixed-stride shards.

Every document becomes token ids and one end mark, cut into sequences of ``length`` ids (the last one is
filled with end marks). Sequences are numbered gapless; a keyed Feistel network on the least even number
of bits that holds all numbers, walked in cycles until the result is in range, permutes the numbers into
slots. Shard s holds the slots s * per_shard and up, each a record of the same size, so slot -> shard and
byte offset is arithmetic, and a reader resumes anywhere without an index.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vdjspark.llm.frames import map_frames
from vdjspark.llm.hashing import mixed
from vdjspark.runtime import small, stage

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's pre-tokenizer splits text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
ROUNDS = 6
PER_SHARD = 1 << 16

_encoders: dict[int, Encoder] = {}


class Encoder:
    """tiktoken with this vocabulary. Texts are encoded whole: where many words are rare, looking pieces up in a cache takes longer."""

    def __init__(self, vocabulary: bytes):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1

    def __call__(self, text: str) -> list[int]:
        return self.encoding.encode_ordinary(text)


def encoder(vocabulary: bytes) -> Encoder:
    """One for each Python worker."""
    key = hash(vocabulary)
    if key not in _encoders:
        _encoders[key] = Encoder(vocabulary)
    return _encoders[key]


def permuted(index: np.ndarray, n: int, key: int, backwards: bool = False) -> np.ndarray:
    """Feistel permutation of 0 .. n - 1 with cycle-walking, or its inverse."""
    half = max(1, -(-max(1, (n - 1).bit_length()) // 2))
    mask, bits = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xD1342543DE82EF95) % (1 << 64)) for r in range(ROUNDS)]
    x = index.astype(np.uint64)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> bits, x[todo] & mask
        for k in reversed(keys) if backwards else keys:
            if backwards:
                left, right = right ^ (mixed(left + k) & mask), left
            else:
                left, right = right, left ^ (mixed(right + k) & mask)
        x[todo] = (left << bits) | right
        todo = todo[x[todo] >= n]
    return x.astype(np.int64)


def slot_of(index: Column, n: int, key: int) -> Column:
    @F.pandas_udf("long")
    def slot(values: pd.Series) -> pd.Series:
        return pd.Series(permuted(values.to_numpy(), n, key))

    return slot(index)


def read_vocabulary(spark: SparkSession, path: str) -> bytes:
    """The file's bytes (about 1 MB), read on the driver and sent with the tasks."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").head()["content"])


def sequences(docs: DataFrame, vocabulary: bytes, length: int) -> DataFrame:
    """Documents -> doc_id, seq (from 0), n_tokens (without end marks), tokens (little-endian uint16 or uint32)."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        kind = "<u2" if encode.end < 1 << 16 else "<u4"
        stride = length * np.dtype(kind).itemsize
        for batch in batches:
            rows = []
            for i, text in enumerate(batch["text"]):
                ids = encode(text)
                n = len(ids) // length + 1
                full = np.full(n * length, encode.end, kind)
                full[: len(ids)] = ids
                data = full.tobytes()
                rows += [(i, s, min(length, len(ids) - s * length), data[s * stride : (s + 1) * stride]) for s in range(n)]
            out = pd.DataFrame(rows, columns=["of", "seq", "n_tokens", "tokens"])
            out.insert(0, "doc_id", batch["doc_id"].array[out.pop("of").to_numpy()])
            yield out

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_frames(chosen, work, "doc_id long, seq int, n_tokens int, tokens binary")


def materialise(docs: DataFrame, key: int = 20_240_229, length: int = 256, per_shard: int = PER_SHARD, vocabulary: str = VOCABULARY) -> DataFrame:
    """Documents -> slot, shard, offset (bytes in the shard), doc_id, seq, n_tokens, tokens.

    Null and empty texts are one sequence of end marks. Equal rows have sequences and slots of their
    own. An empty table gives no rows. Each shard lies whole in a partition, sorted by slot. The row id
    is written with the staged sequences, so slots don't depend on how the table is split when it is
    read. ``offset`` is a record's place in the file that write_shards() makes of its shard.
    """
    spark = docs.sparkSession
    made = sequences(docs, read_vocabulary(spark, vocabulary), length).withColumn("row", F.monotonically_increasing_id())
    rows = stage(made, "sequences", compression="zstd")
    part = F.shiftright("row", 33)
    cells = stage(rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("row").alias("from")), "cells")  # a row for each partition
    total = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    firsts = cells.select("part", "from", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("first"))
    numbered = rows.withColumn("part", part).join(small(firsts), "part")
    placed = numbered.withColumn("slot", slot_of(F.col("first") + F.col("row") - F.col("from"), total, key))
    placed = placed.withColumn("shard", F.floor(F.col("slot") / per_shard).cast("int"))
    placed = placed.withColumn("offset", (F.col("slot") % per_shard) * F.octet_length("tokens"))
    shards = max(1, -(-total // per_shard))
    dealt = placed.repartitionByRange(shards, "shard").sortWithinPartitions("slot")
    return dealt.select("slot", "shard", "offset", "doc_id", "seq", "n_tokens", "tokens")


def write_shards(placed: DataFrame, path: str) -> DataFrame:
    """Write each shard as one file of bare records, shard-N.bin: shard, records, stride (bytes of a record).

    ``placed`` is materialise()'s result, whose shards lie whole and in order in a partition; a gap in the
    slots raises. A task streams a shard to a file of its own and renames it when it is complete, so a
    repeated or lost task leaves no part of a shard; records are the same on every run. ``path`` is a URI
    that the executors share and pyarrow opens (file, hdfs, s3, gs). The list of shards is written last, as
    Parquet under ``path``/shards, and returned.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = FileSystem.from_uri(path)
        store.create_dir(base)
        done, out, now = [], None, None

        def close() -> None:
            out.close()
            store.move(now["own"], f"{base}/shard-{now['shard']}.bin")
            done.append((now["shard"], now["records"], now["stride"]))

        for batch in batches:
            for shard, rows in batch.groupby("shard", sort=False):
                if now is None or now["shard"] != shard:
                    if out:
                        close()
                    now = {"shard": shard, "own": f"{base}/.shard-{shard}-{uuid.uuid4().hex}", "records": 0, "stride": len(rows["tokens"].iloc[0]), "next": rows["slot"].iloc[0]}
                    out = store.open_output_stream(now["own"])
                if not (rows["slot"].to_numpy() == now["next"] + np.arange(len(rows))).all():
                    raise ValueError(f"shard {shard} has a gap")
                out.write(b"".join(rows["tokens"]))
                now["records"] += len(rows)
                now["next"] += len(rows)
        if out:
            close()
            yield pd.DataFrame(done, columns=["shard", "records", "stride"])

    shards = placed.select("slot", "shard", "tokens").mapInPandas(work, "shard int, records long, stride long")
    shards.write.mode("overwrite").parquet(f"{path}/shards")
    return placed.sparkSession.read.parquet(f"{path}/shards")


def read_from(spark: SparkSession, path: str, slot: int, n: int, per_shard: int = PER_SHARD) -> DataFrame:
    """slot, tokens of n records from a slot on, in order: each shard that holds some is opened at its offset."""
    shards = spark.read.parquet(f"{path}/shards").filter(F.col("shard").between(slot // per_shard, (slot + n - 1) // per_shard))
    first = F.greatest(F.lit(slot) - F.col("shard").cast("long") * per_shard, F.lit(0))
    last = F.least(F.lit(slot + n) - F.col("shard").cast("long") * per_shard, F.col("records"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = FileSystem.from_uri(path)
        for batch in batches:
            for shard, stride, first, last in batch.itertuples(index=False):
                with store.open_input_file(f"{base}/shard-{shard}.bin") as file:
                    file.seek(first * stride)
                    for at in range(first, last, 4096):
                        m = min(4096, last - at)
                        data = file.read(m * stride)
                        yield pd.DataFrame({"slot": shard * per_shard + at + np.arange(m), "tokens": [data[i * stride : (i + 1) * stride] for i in range(m)]})

    found = shards.select("shard", "stride", first.alias("first"), last.alias("last")).filter("first < last").repartitionByRange("shard")
    return found.mapInPandas(work, "slot long, tokens binary").orderBy("slot")
