"""Toxicity: a weighted lexicon, matched by Aho-Corasick on folded text and normalised by length.

The lexicon holds whole words and stems (beginnings of words). Its weights are smoothed log odds,
learned from labelled documents; phrases in which a term is harmless are exceptions that cancel it.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vdjspark.llm.frames import map_frames
from vdjspark.runtime import small, stage

# Characters that pass for Latin letters (Cyrillic, Greek), and digits and signs put for letters.
HOMOGLYPHS = dict(zip("авекмнорстухіјѕԁһӏԛԝαβεηικμνορτυχ", "abekmhopctyxijsdhlqwabehikmvoptux", strict=True))
SUBSTITUTES = dict(zip("013457@$", "oieastas", strict=True))
#: Phrases known to be harmless; more are learned.
EXCEPTIONS = ("trash can", "trash bin", "trash bag", "clown fish", "idiot proof")
STEMS = range(4, 8)

_TABLE = {i: " " for i in range(128) if not chr(i).isalpha()} | {ord(k): v for k, v in (HOMOGLYPHS | SUBSTITUTES).items()}
_TABLE |= {0xFF41 + i: chr(97 + i) for i in range(26)} | {0xFF10 + ord(k) - 48: v for k, v in SUBSTITUTES.items() if k.isdigit()}


def folded(text: str) -> str:
    """Lower case, look-alikes and digit substitutions as letters, other ASCII as spaces."""
    return text.lower().translate(_TABLE)


@dataclass
class Model:
    terms: dict[str, float] = field(default_factory=dict)  # " stem" or " word ": weight
    exceptions: dict[str, float] = field(default_factory=dict)  # " phrase": what it cancels
    bias: float = -20.0
    slopes: tuple[float, ...] = (0.0, 0.0, 0.0)

    def matcher(self) -> ahocorasick.Automaton | None:
        if not self.terms:
            return None
        machine = ahocorasick.Automaton()
        for text, weight in (self.terms | self.exceptions).items():
            machine.add_word(text, weight)
        machine.make_automaton()
        return machine


def features(text: str, machine: ahocorasick.Automaton | None) -> tuple[float, float, float]:
    """Summed weight of all hits, the same per word, and the words, each as log(1 + x)."""
    clean = folded(text)
    total = max(0.0, sum(w for _, w in machine.iter(f" {clean} "))) if machine else 0.0
    words = 1 + clean.count(" ")
    return np.log1p(total), np.log1p(100.0 * total / words), np.log1p(words) if total else 0.0


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, max_terms: int = 2000, least_weight: float = 3.0, word_lengths: tuple[int, int] = (3, 40), max_exceptions: int = 500) -> Model:
    """A model from labelled documents outside the held-out fold.

    At most about ``fit_rows`` labelled rows are used, chosen by a hash of doc_id; the lexicon keeps the
    ``max_terms`` most frequent terms and the ``max_exceptions`` most frequent learned phrases. These
    bound what reaches the driver. Words whose length is outside ``word_lengths`` become no terms of the
    lexicon; scoring reads every word. Null texts, ids and labels are left out. Without both classes the
    model finds nothing.
    """
    marked = labels.select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(~held_out(F.col("labelled"))).dropDuplicates(["labelled"])
    share = min(1.0, fit_rows / max(1, marked.count()))
    marked = marked.filter(F.pmod(F.xxhash64("labelled"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = docs.select("doc_id", "text").join(small(marked), F.col("doc_id") == F.col("labelled")).filter(F.col("text").isNotNull()).select("text", "toxic")
    rows = stage(rows, "labelled")
    n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic or not clean:
        return Model()

    def word_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen = {0: Counter(), 1: Counter()}
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                seen[int(label == 1)].update({w for w in folded(text).split() if word_lengths[0] <= len(w) <= word_lengths[1]})
            yield pd.DataFrame([(w, seen[1][w], seen[0][w]) for w in {*seen[0], *seen[1]}], columns=["word", "t", "c"])

    words = rows.mapInPandas(word_counts, "word string, t long, c long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    words = stage(words, "words")
    stems = words.select(F.explode(F.array([F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in STEMS])).alias("stem"), "t", "c")
    stems = stems.filter("stem is not null").groupBy("stem").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    counted = words.select(F.concat(F.lit(" "), "word", F.lit(" ")).alias("term"), "t", "c").unionByName(stems.select(F.concat(F.lit(" "), "stem").alias("term"), "t", "c"))
    weight = F.log((F.col("t") + 0.5) / (toxic + 1)) - F.log((F.col("c") + 0.5) / (clean + 1))
    # a term must be in toxic documents oftener than chance explains: t of t + c, at the base rate, five deviations out
    rate = toxic / (toxic + clean)
    all_ = F.col("t") + F.col("c")
    beyond = (F.col("t") - all_ * rate) / F.sqrt(all_ * rate * (1 - rate))
    terms = counted.withColumn("weight", weight).filter((F.col("t") >= max(5, round(0.001 * toxic))) & (weight >= least_weight) & (beyond >= 5))
    kept: dict[str, float] = {}
    for row in sorted(terms.orderBy(F.desc("t"), "term").limit(max_terms).collect(), key=lambda r: (len(r["term"]), r["term"])):
        # a longer term adds nothing where a stem of it is as telling
        if not any(row["term"][:k] in kept and kept[row["term"][:k]] >= row["weight"] - 1.0 for k in range(2, len(row["term"]))):
            kept[row["term"]] = row["weight"]
    model = Model(terms=kept)
    model.exceptions = _exceptions(rows, model, max_exceptions)
    return _fitted(rows, model)


def _exceptions(rows: DataFrame, model: Model, most: int, least: int = 3) -> dict[str, float]:
    """Phrases of a term's word and the next word that clean documents hold ``least`` times and toxic ones never."""
    stems = tuple(model.terms)

    def of(phrase: str) -> float:
        padded = f" {phrase.split()[0]} "
        return -sum(w for t, w in model.terms.items() if padded.startswith(t))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = Model(terms=dict.fromkeys(stems, 1.0)).matcher()
        for batch in batches:
            seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, label in zip(batch["text"], batch["toxic"], strict=True):
                padded = f" {folded(text)} "
                if machine and any(True for _ in machine.iter(padded)):
                    words = padded.split()
                    for a, b in zip(words, words[1:], strict=False):
                        if any(f" {a} ".startswith(s) for s in stems):
                            seen[f"{a} {b}"][int(label == 1)] += 1
            yield pd.DataFrame([(p, c, t) for p, (c, t) in seen.items()], columns=["phrase", "c", "t"])

    found = {}
    if stems:
        counted = rows.mapInPandas(work, "phrase string, c long, t long").groupBy("phrase").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))
        learned = [r["phrase"] for r in counted.filter((F.col("c") >= least) & (F.col("t") == 0)).orderBy(F.desc("c"), "phrase").limit(most).collect()]
        found = {f" {p} ": w for p in (*EXCEPTIONS, *learned) if (w := of(p)) < 0}
    return found


def _fitted(rows: DataFrame, model: Model, steps: int = 25) -> Model:
    """Logistic regression on features() of the labelled sample, by Newton steps with a small ridge."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = model.matcher()
        for batch in batches:
            x = pd.DataFrame([features(t, machine) for t in batch["text"]], columns=["a", "b", "c"])
            yield x.assign(y=batch["toxic"].to_numpy().astype(float))

    counted = rows.mapInPandas(work, "a double, b double, c double, y double").groupBy(*[F.round(k, 2).alias(k) for k in "abc"], "y").count().toPandas()
    x = np.column_stack([np.ones(len(counted)), counted[["a", "b", "c"]].to_numpy()])
    y, weight = counted["y"].to_numpy(), counted["count"].to_numpy()
    beta = np.zeros(4)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (p - y)) + 0.01 * beta
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(4)
        beta -= np.clip(np.linalg.solve(curve, grad), -4, 4)
    model.bias, model.slopes = float(beta[0]), tuple(map(float, beta[1:]))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Documents -> doc_id, score: 0 to 1 from the text alone. Null text scores as empty."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = model.matcher()
        slopes = np.array(model.slopes)
        for batch in batches:
            x = np.array([features(t, machine) for t in batch["text"]]).reshape(-1, 3)
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "score": 1 / (1 + np.exp(-np.clip(model.bias + x @ slopes, -30, 30)))})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_frames(rows, work, "doc_id long, score double")


def accepted(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The documents, all columns, whose score is below the threshold. Null text is kept."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = model.matcher()
        slopes = np.array(model.slopes)
        for batch in batches:
            x = np.array([features(t or "", machine) for t in batch.column("text").to_pylist()]).reshape(-1, 3)
            # whole Arrow rows: no other column is converted
            yield batch.filter(pa.array(1 / (1 + np.exp(-np.clip(model.bias + x @ slopes, -30, 30))) < threshold))

    return docs.mapInArrow(work, docs.schema)


def lexicon_words(model: Model) -> list[str]:
    return [re.sub(r"^ ", "", t) for t in model.terms]
