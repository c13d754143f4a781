"""From raw documents to training order: five stages, each written as Parquet and read by the next.

1. toxicity: documents that the lexicon model scores 0.7 or more go.
2. near duplicates: one document of each group of linked word 5-gram sets (Jaccard 0.8 or more) stays.
3. decontamination: documents that share a window of ten words with a benchmark item go.
4. mixing: sources are taken to their target weights, documents repeated three times at most.
5. training order: token sequences in their global slots.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vdjspark.llm import jaccard, mixing, toxicity, training_order, winnowing
from vdjspark.runtime import stage, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the lexicon model, fitted on the labels outside the held-out fold, scores 0.7 or more go. Null and empty texts stay; an empty table gives none."""
    return toxicity.accepted(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each linked group stays, that of the least doc_id; of rows with equal doc_id and text one. Texts without words stay; a null doc_id stays unless linked with an id."""
    return jaccard.one_of_each(docs, n=5, num=80, den=100)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window with a benchmark item go. Null texts, and all texts where the benchmark is empty, stay."""
    return winnowing.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the mix takes them, three times at most. A null source is a source of its own; null texts have no words and go or stay with their source's share."""
    return mixing.repeated(docs)


def order_for_training(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences in their global slots, with doc_id; the only stage whose columns are its own. Null and empty texts are one sequence of end marks."""
    return training_order.materialise(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("training_order", order_for_training),
]

#: A learned lexicon, 64-bit text hashes and a tokenizer aren't expressible in SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
