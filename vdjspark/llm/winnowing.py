"""Benchmark decontamination by winnowing (DataFrame functions only).

Of every window of ``window`` consecutive words, the least hash of its ``gram``-grams is its
fingerprint; runs of windows share one, so a text has few. Equal windows have equal fingerprints, which
guarantees that every shared span of ``window`` words is met. Documents are joined with the benchmark on
fingerprints first, to find those that share one; in these, each place of a shared fingerprint is
extended to the windows around it that a benchmark item has too, and overlapping hits become spans.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vdjspark.runtime import small, stage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words in lower case (A to Z only); null text has none."""
    text = F.coalesce(text, F.lit(""))
    ascii_only = F.octet_length(text) == F.char_length(text)
    # lower() is as good for plain ASCII, and faster
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.filter(F.split(low, SEPARATORS), lambda w: w != "")


def with_fingerprints(df: DataFrame, window: int, gram: int) -> DataFrame:
    """Adds ``prints``: the fingerprint of the window at each position of ``words``; of fewer words, none.

    Each step is a column of its own, so that the next step's lambda reads it instead of computing it
    again for every element. get() past the end is null, which hashes and minima skip.
    """
    width = window - gram + 1
    df = df.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    df = df.withColumn("grams", F.transform("hashes", lambda _, i: F.xxhash64(*[F.get("hashes", i + j) for j in range(gram)])))
    df = df.withColumn("prints", F.transform("grams", lambda g, i: F.least(g, *[F.get("grams", i + j) for j in range(1, width)])))
    return df.withColumn("prints", F.slice("prints", 1, F.greatest(F.size("words") - (window - 1), F.lit(0)))).drop("hashes", "grams")


def _grams(n: int) -> Column:
    """Hashes of n consecutive words at each place of ``words``."""
    starts = F.sequence(F.lit(0), F.size("words") - n)
    return F.when(F.size("words") >= n, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i + 1, n))))


def _windows(df: DataFrame, keep: list[str], window: int, gram: int, short: list[int]) -> DataFrame:
    """keep, n, at, print, hash: a row for each window of ``words``, of each length; a short window is its own fingerprint."""
    whole = with_fingerprints(df.select(*keep, "words"), window, gram).withColumn("hashes", _grams(window))
    rows = whole.select(*keep, F.lit(window).alias("n"), F.posexplode(F.arrays_zip("prints", "hashes")).alias("at", "x"))
    rows = rows.select(*keep, "n", "at", F.col("x.prints").alias("print"), F.col("x.hashes").alias("hash"))
    for n in short:
        some = df.select(*keep, F.lit(n).alias("n"), F.posexplode(_grams(n)).alias("at", "hash"))
        rows = rows.unionByName(some.withColumn("print", F.col("hash")))
    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """Documents -> doc_id, h, n_words, n_hit, items (sorted as text), contaminated; h = xxhash64(text).

    A window is ``window`` consecutive words of a benchmark item; an item of fewer words, but not none,
    is one window. A document's word is hit inside any occurrence of a window. Windows are told apart by
    128 bits of hash (fingerprint and whole window). Null texts, empty texts and an empty benchmark give
    no hits. Null item ids are left out of ``items`` but their windows count as hits. Rows with equal
    doc_id and text have equal results; each row stays.
    """
    items = stage(benchmark.select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("words")).filter(F.size("words") > 0), "items")
    lengths = items.filter(F.size("words") < window).select(F.size("words").alias("n")).distinct()
    short = sorted(r["n"] for r in lengths.collect())  # numbers below window
    found = _windows(items.filter(F.size("words") >= window), ["item_id"], window, gram, [])
    for n in short:
        found = found.unionByName(_windows(items.filter(F.size("words") == n), ["item_id"], window, gram, [n]).filter(F.col("n") == n))
    windows = stage(found.groupBy("n", "print", "hash").agg(F.sort_array(F.collect_set("item_id")).alias("items")), "windows")
    prints = stage(windows.select("n", "print").distinct(), "prints")

    key = docs.select("doc_id", F.xxhash64("text").alias("h"), F.coalesce("text", F.lit("")).alias("text"))
    split = key.select("doc_id", "h", words_of(F.col("text")).alias("words"))
    # one pass over all words: their number and the distinct fingerprints
    seen = with_fingerprints(split, window, gram).select("doc_id", "h", F.size("words").cast("long").alias("n_words"), F.array_distinct("prints").alias("prints"))
    seen = stage(seen, "fingerprints")
    met = seen.select("doc_id", "h", F.explode("prints").alias("print")).join(small(prints.filter(F.col("n") == window).select("print")), "print").select("doc_id", "h")
    for n in short:
        grams = split.select("doc_id", "h", F.explode(F.array_distinct(_grams(n))).alias("print"))
        met = met.unionByName(grams.join(small(prints.filter(F.col("n") == n).select("print")), "print").select("doc_id", "h"))
    met = stage(met.distinct(), "met")
    same = F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("t.h") == F.col("m.h"))
    hit_docs = key.alias("t").join(small(met).alias("m"), same, "left_semi").select("doc_id", "h", words_of(F.col("text")).alias("words"))
    # first the places of shared fingerprints, then the windows around them
    places = _windows(hit_docs, ["doc_id", "h"], window, gram, short).join(small(prints), ["n", "print"])
    hits = places.join(small(windows), ["n", "print", "hash"])
    # of one document: bounded by its own length
    per_doc = hits.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set(F.struct("at", "n"))).alias("spans"), F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    start = F.struct(F.lit(0).alias("upto"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "spans",
        start,
        lambda acc, s: F.struct(F.greatest(acc["upto"], s["at"] + s["n"]).alias("upto"), (acc["n"] + F.greatest(F.lit(0), s["at"] + s["n"] - F.greatest(acc["upto"], s["at"]))).alias("n")),
        lambda acc: acc["n"],
    )
    per_doc = stage(per_doc.select("doc_id", "h", covered.alias("n_hit"), F.sort_array("items").alias("items")), "hits")
    joined = seen.select("doc_id", "h", "n_words").alias("t").join(small(per_doc).alias("m"), same, "left")
    n_hit = F.coalesce("m.n_hit", F.lit(0)).cast("long")
    return joined.select("t.doc_id", "t.h", "t.n_words", n_hit.alias("n_hit"), F.coalesce("m.items", F.array().cast("array<string>")).alias("items"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, gram: int = 5) -> DataFrame:
    """The documents, all columns, that share no window with the benchmark."""
    hit = decontaminate(docs, benchmark, window, gram).filter("contaminated").select("doc_id", "h").distinct()
    hit = small(stage(hit, "contaminated")).alias("m")
    same = F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.xxhash64("t.text") == F.col("m.h"))
    return docs.alias("t").join(hit, same, "left_anti")
