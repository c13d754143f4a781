"""Removal of repeated substrings: byte strings (suffix array) and word windows (Rabin-Karp).

Both judge every window of every text, and both first reduce the windows to runs with a common anchor
(hashing.winnowed_runs), which loses none: equal windows have equal anchors. Runs are counted in Spark
by anchor and content. A run whose content occurs again settles all its windows at once, whatever the
number of copies; one representative of each content goes on to be compared window by window, and only
where its anchor has other contents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjspark.llm import hashing as H
from vdjspark.llm.frames import map_frames
from vdjspark.llm.suffixes import repeated_starts
from vdjspark.runtime import BROADCAST_ROWS, small, stage

RUNS = "doc_id long, h long, start int, n int, anchor long, extent long"
PARTS = "anchor long, extent long, begin int, end int, later boolean"
#: A key with over this fraction's share of all rows of a join is dealt to several tasks.
SHARES = 1000


def _units(kind: str, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if kind == "words":
        return H.words(texts)
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    return np.frombuffer(b"".join(texts), np.uint8).astype(np.uint64) + np.uint64(1), first


def _keyed(docs: DataFrame) -> DataFrame:
    """Rows with equal doc_id and text get equal results, so the two name a row."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def _runs(keyed: DataFrame, kind: str, window: int, gram: int) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, ids, hs = list(batch["text"]), batch["doc_id"].array, batch["h"].to_numpy()
            for a, b in H.chunks(texts):
                of, start, n, anchor, extent = H.winnowed_runs(*_units(kind, texts[a:b]), window, gram)
                yield pd.DataFrame({"doc_id": ids[a + of], "h": hs[a + of], "start": start.astype("int32"), "n": n.astype("int32"), "anchor": anchor.view("int64"), "extent": extent.view("int64")})

    return map_frames(keyed, work, RUNS)


def _same(a: str, b: str) -> F.Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))


def _with_lists(keyed: DataFrame, rows: DataFrame, columns: list[str], every: bool) -> DataFrame:
    """Texts joined with the list of their ``rows`` (at most a list as long as the text): those that have any, or every text.

    While few texts have any, only those are shuffled.
    """
    arrays = [F.col(f"l.list.{c}").alias(c) for c in columns]
    lists = stage(rows.distinct().groupBy("doc_id", "h").agg(F.collect_list(F.struct(*columns)).alias("list")), "lists")
    if lists.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS:
        joined = keyed.alias("t").join(lists.alias("l"), _same("t", "l"), "left" if every else "inner")
        return joined.select("t.doc_id", "t.h", "t.text", *arrays)
    names = F.broadcast(lists.select("doc_id", "h")).alias("n")
    hit = keyed.alias("t").join(names, _same("t", "n"), "left_semi").alias("t").join(lists.hint("merge").alias("l"), _same("t", "l"))
    hit = hit.select("t.doc_id", "t.h", "t.text", *arrays)
    rest = keyed.alias("t").join(names, _same("t", "n"), "left_anti").select("doc_id", "h", "text", *[F.lit(None).cast(hit.schema[c].dataType).alias(c) for c in columns])
    return hit.unionByName(rest) if every else hit


def _dealt(rows: DataFrame, ones: DataFrame, counts: DataFrame, keys: list[str], told: list[str], total: int) -> DataFrame:
    """Rows joined with the row of ``ones`` that has their keys, so that no task gets all rows of a common key.

    ``counts`` has the keys' number of rows (copies), as has ``ones``; ``total`` is the sum. A key with
    over a thousandth of all rows, of which there are under a thousand, is dealt by a hash of the columns
    ``told`` to parts of about that size.
    """
    share = max(1, total // SHARES)
    parts = F.ceil(F.col("copies") / share).cast("int")
    common = counts.filter(F.col("copies") > share).select(*keys, parts.alias("parts_"))
    rows = rows.join(F.broadcast(common), keys, "left").withColumn("part_", F.coalesce(F.pmod(F.xxhash64(*told), "parts_"), F.lit(0)).cast("int")).drop("parts_")
    ones = ones.withColumn("part_", F.explode(F.sequence(F.lit(0), parts - 1)))
    return rows.join(ones, [*keys, "part_"]).drop("part_")


def _removed(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n units the spans cover."""
    return np.cumsum(np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1))[:n] > 0


def _edges(gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(gone.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _finish(keyed: DataFrame, spans: DataFrame, columns: list[str], of_text: Callable, schema: str) -> DataFrame:
    joined = _with_lists(keyed, spans.select("doc_id", "h", *columns), columns, every=True)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [of_text(*row) for row in zip(batch["text"], *[batch[c] for c in columns], strict=True)]
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")[1:]])
            out.insert(0, "doc_id", batch["doc_id"].array)
            yield out

    return map_frames(joined, work, schema)


def _byte_result(keep_text: bool) -> Callable:
    def of_text(text: bytes, starts: np.ndarray | None, ends: np.ndarray | None, later: np.ndarray | None) -> tuple:
        kept, removed, n_spans, n_later = text, 0, 0, 0
        if starts is not None:
            gone = _removed(starts, ends, len(text))
            kept, removed, n_spans = np.frombuffer(text, np.uint8)[~gone].tobytes(), int(gone.sum()), len(_edges(gone)[0])
            late = later.astype(bool)
            n_later = int(_removed(starts[late], ends[late], len(text)).sum())
        row = (len(text), removed, n_spans, hashlib.sha256(kept).hexdigest(), n_later)
        return (*row, kept) if keep_text else row

    return of_text


def _word_result(keep_text: bool) -> Callable:
    def of_text(text: bytes, starts: np.ndarray | None, ends: np.ndarray | None) -> tuple:
        words = text.split()  # of bytes: at ASCII white space only
        n, removed, n_spans = len(words), 0, 0
        if starts is not None:
            gone = _removed(starts, ends, n)
            removed, n_spans = int(gone.sum()), len(_edges(gone)[0])
            words = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
        kept = b" ".join(words)
        row = (n, removed, n_spans, hashlib.sha256(kept).hexdigest())
        return (*row, kept.decode()) if keep_text else row

    return of_text


def dedup_words(docs: DataFrame, window: int = 50, gram: int = 8, keep_text: bool = False) -> DataFrame:
    """Documents -> doc_id, n_words, n_removed, n_spans, kept_sha256 and, with ``keep_text``, kept.

    Removes each word that a window covers whose words also start in a document of a smaller doc_id;
    overlapping windows merge into maximal intervals. Windows are counted by their Rabin-Karp hash (64
    bits, and 64 of the anchor). Null text has no words. A null doc_id is smaller than none and has
    none smaller: such rows stay whole. Rows of one doc_id are no smaller than each other.
    """
    keyed = _keyed(docs)
    runs = stage(_runs(keyed.filter(F.col("doc_id").isNotNull()), "words", window, gram), "runs")
    contents = runs.groupBy("anchor", "extent").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    anchors = contents.groupBy("anchor").agg(F.count("*").alias("contents"), F.min("least").alias("a"), F.max("most").alias("b")).filter("b > a")
    shared = stage(contents.join(anchors.select("anchor", "contents"), "anchor").select("anchor", "extent", "least", "contents"), "shared")
    judged = runs.join(shared, ["anchor", "extent"])
    whole = judged.filter("doc_id > least").select("doc_id", "h", "start", (F.col("start") + F.col("n") + (window - 1)).alias("end"))
    open_runs = judged.filter("doc_id = least and contents > 1").select("doc_id", "h", "start", "n", "anchor")

    def window_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc_id, h, text, start, n, anchor in zip(*[batch[c] for c in ("doc_id", "h", "text", "start", "n", "anchor")], strict=True):
                sums = H.prefix(H.words([text])[0])
                at = np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
                yield pd.DataFrame({"anchor": np.repeat(anchor, n), "hash": H.stretch(sums, at, at + window).view("int64"), "doc_id": doc_id, "h": h, "start": at.astype("int32")})

    opened = _with_lists(keyed, open_runs, ["start", "n", "anchor"], every=False)
    windows = stage(map_frames(opened, window_hashes, "anchor long, hash long, doc_id long, h long, start int"), "windows")
    counted = windows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("most > least")
    single = windows.join(counted.select("anchor", "hash", "least"), ["anchor", "hash"]).filter("doc_id > least")
    spans = whole.unionByName(single.select("doc_id", "h", "start", (F.col("start") + window).alias("end")))
    schema = "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * keep_text
    return _finish(keyed, spans, ["start", "end"], _word_result(keep_text), schema)


def dedup_bytes(docs: DataFrame, length: int = 400, gram: int = 128, hot: int = 1500, keep_text: bool = False) -> DataFrame:
    """Documents -> doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_later and, with ``keep_text``, kept (binary).

    Removes each byte that a string of ``length`` bytes covers which also starts anywhere else, in the
    same document too. Strings never cross documents and are judged on the input. n_later counts the
    removed bytes whose string also starts in a document of a smaller doc_id: what would go if the
    first holder kept its copy. Candidate strings, grouped by anchor, are compared by two-stage suffix
    sorting (suffixes.py). An anchor with more than ``hot`` contents is counted by window hash instead,
    so that no task gets an unbounded group. Null text is empty. Each row is a document, equal rows
    too: their texts repeat each other. A null doc_id is smaller than none and has none smaller.
    """
    keyed = _keyed(docs)
    runs = stage(_runs(keyed, "bytes", length, gram), "runs")
    contents = runs.groupBy("anchor", "extent").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "h", "start", "n")).alias("at"), F.min("doc_id").alias("least"))
    anchors = contents.groupBy("anchor").agg(F.count("*").alias("contents"), F.sum("copies").alias("all")).filter("all > 1")
    shared = stage(contents.join(anchors.select("anchor", "contents"), "anchor"), "shared")
    columns = ["start", "n", "anchor", "extent", "least", "settled", "hot"]
    never = F.coalesce("least", F.lit((1 << 63) - 1))  # a null doc_id is never the smaller one
    open_runs = shared.filter("contents > 1").select("at.*", "anchor", "extent", never.alias("least"), (F.col("copies") > 1).alias("settled"), (F.col("contents") > hot).alias("hot"))
    opened = _with_lists(keyed, open_runs, columns, every=False)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = batch[["text", *columns]].explode(columns, ignore_index=True)
            out["piece"] = [t[a : a + n + length - 1] for t, a, n in zip(out["text"], out["start"], out["n"], strict=True)]
            yield out.drop(columns=["text", "start"]).astype({"n": "int32", "anchor": "int64", "extent": "int64", "least": "int64", "settled": bool, "hot": bool})

    pieces = stage(map_frames(opened, cut, "n int, anchor long, extent long, least long, settled boolean, hot boolean, piece binary"), "pieces")

    def sort_suffixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _whole_groups(batches, "anchor", "piece", 1 << 18):
            anchor, extent, least, settled, n = (group[c].to_numpy() for c in ("anchor", "extent", "least", "settled", "n"))
            found = []
            for of, at, later in repeated_starts(list(group["piece"]), length, least):
                for chosen, flag in ((at[later], True), (at[~later], False)):
                    if len(chosen) and (flag or not settled[of]):
                        begins, ends = _edges(np.bincount(chosen, minlength=int(n[of])) > 0)
                        found.append((np.full(len(begins), of), begins, ends + length - 1, np.full(len(begins), flag)))
            if found:  # one frame a group, not one for each content
                of, begins, ends, flags = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pd.DataFrame({"anchor": anchor[of], "extent": extent[of], "begin": begins, "end": ends, "later": flags})

    def window_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                sums = H.prefix(np.frombuffer(row.piece, np.uint8).astype(np.uint64) + np.uint64(1))
                at = np.arange(row.n)
                yield pd.DataFrame({"anchor": row.anchor, "hash": H.stretch(sums, at, at + length).view("int64"), "extent": row.extent, "begin": at, "least": row.least, "settled": row.settled})

    cold = map_frames(pieces.filter("not hot").repartition("anchor").sortWithinPartitions("anchor"), sort_suffixes, PARTS)
    windows = map_frames(pieces.filter("hot"), window_hashes, "anchor long, hash long, extent long, begin int, least long, settled boolean")
    counted = stage(windows.groupBy("anchor", "hash").agg(F.count("*").alias("copies"), F.min("least").alias("first")).filter("copies > 1"), "counted")
    n_windows = pieces.filter("hot").agg(F.coalesce(F.sum("n"), F.lit(0))).head()[0]
    single = _dealt(windows, counted, counted, ["anchor", "hash"], ["extent", "begin"], n_windows)
    single = single.withColumn("later", F.col("least") > F.col("first")).filter("later or not settled")
    parts = cold.unionByName(single.select("anchor", "extent", "begin", (F.col("begin") + length).alias("end"), "later"))
    # of one content: at most its windows
    parts = parts.groupBy("anchor", "extent").agg(F.collect_list(F.struct("begin", "end", "later")).alias("parts"))
    judged = shared.select("anchor", "extent", "copies", "least", (F.col("copies") > 1).alias("whole")).join(parts, ["anchor", "extent"], "left").filter("whole or parts is not null")
    rows = _dealt(runs, judged, shared, ["anchor", "extent"], ["doc_id", "h", "start"], runs.count()).withColumn("late", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)))
    every = F.array(F.struct(F.lit(0).alias("begin"), (F.col("n") + (length - 1)).alias("end"), F.col("late").alias("later")))
    some = F.coalesce("parts", F.array().cast("array<struct<begin:int,end:int,later:boolean>>"))
    found = F.when(F.col("late"), every).when(F.col("whole"), F.concat(every, some)).otherwise(some)
    spans = rows.select("doc_id", "h", "start", F.explode(found).alias("x"))
    spans = spans.select("doc_id", "h", (F.col("start") + F.col("x.begin")).alias("start"), (F.col("start") + F.col("x.end")).alias("end"), (F.col("x.later") & F.col("doc_id").isNotNull()).alias("later"))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_later long" + ", kept binary" * keep_text
    return _finish(keyed, spans, ["start", "end", "later"], _byte_result(keep_text), schema)


def _whole_groups(batches: Iterator[pd.DataFrame], key: str, text: str, limit: int) -> Iterator[pd.DataFrame]:
    """Rows sorted by key -> frames of whole keys and about ``limit`` bytes of text, or of one key."""
    held, size = [], 0
    for batch in batches:
        at = 0
        marks = np.flatnonzero(np.diff(batch[key].to_numpy(), prepend=batch[key].iloc[0] if len(batch) else 0))
        lengths = np.concatenate([[0], np.cumsum(batch[text].str.len().to_numpy())])
        if held and len(batch) and held[-1][key].iloc[-1] != batch[key].iloc[0]:
            marks = np.concatenate([[0], marks])
        for mark in marks:
            if size + lengths[mark] - lengths[at] >= limit:
                held.append(batch.iloc[at:mark])
                yield pd.concat(held, ignore_index=True)
                held, size, at = [], 0, mark
        held.append(batch.iloc[at:])
        size += lengths[-1] - lengths[at]
    if held and sum(map(len, held)):
        yield pd.concat(held, ignore_index=True)
