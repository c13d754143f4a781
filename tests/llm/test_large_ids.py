"""Ids above 2^53 beside a null id in the same batch come out whole, and results don't depend on their size."""

from __future__ import annotations

import pytest

from vdjspark.llm import infill, jaccard, media, mixing, repeats, secrets, sharding, toxicity, training_order, winnowing

SCHEMA = "doc_id long, text string, source string, n_chars long"
BIG = (1 << 53) + 1
PASSAGE = " ".join(f"word{i % 37}x{i}" for i in range(90))


def texts() -> list[str]:
    near = PASSAGE.split()
    return [PASSAGE, PASSAGE, " ".join([*near[:40], "other", *near[41:]]), f"a b {PASSAGE} c", 'db_pwd = "q8Zr5tLw0PxV"', "", "plain words"]


def frame(spark, ids: list[int | None]):
    rows = [(i, t, "s", i) for i, t in zip(ids, [*texts(), PASSAGE], strict=True)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(1)


@pytest.fixture(scope="module")
def pair(spark):
    n = len(texts())
    return frame(spark, [*range(n), None]), frame(spark, [*(BIG + 2 * i for i in range(n)), None])


def grown(i: int | None) -> int | None:
    return None if i is None else BIG + 2 * i


MODEL = toxicity.Model()


@pytest.mark.parametrize(
    ("ids", "run"),
    [
        (("doc_id",), lambda d: repeats.dedup_bytes(d)),
        (("doc_id",), lambda d: repeats.dedup_bytes(d, hot=1)),
        (("doc_id",), lambda d: repeats.dedup_words(d)),
        (("doc_id",), lambda d: secrets.digest(secrets.scan(d))),
        (("doc_id", "component_id"), lambda d: jaccard.group_documents(d, n=3, num=90, den=100)),
        (("doc_id", "n_chars"), lambda d: jaccard.one_of_each(d)),
        (("doc_id",), lambda d: toxicity.score(d, MODEL)),
        (("doc_id", "n_chars"), lambda d: toxicity.accepted(d, MODEL)),
        (("doc_id",), lambda d: media.encode(d)),
        (("doc_id",), lambda d: training_order.materialise(d).select("doc_id", "seq", "n_tokens", "tokens")),
    ],
)
def test_results_differ_in_the_ids_only(pair, ids, run):
    small, large = (run(d) for d in pair)
    want = [tuple(grown(v) if c in ids else v for c, v in zip(small.columns, r, strict=True)) for r in small.collect()]
    got = [tuple(r) for r in large.collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_ids_stay_where_hashes_draw(spark, pair):
    wanted = sorted([BIG + 2 * i for i in range(len(texts()))])
    benchmark = spark.createDataFrame([(BIG, PASSAGE)], "item_id long, text string")
    for found in (mixing.mix(pair[1]), sharding.assign(pair[1], sharding.leaves(4), sharding.leaves(5)), winnowing.decontaminate(pair[1], benchmark), infill.transform(pair[1])):
        ids = [r.doc_id for r in found.select("doc_id").collect()]
        assert sorted(i for i in ids if i is not None) == wanted
        assert ids.count(None) == 1


def test_repeats_and_links_are_found_beside_a_null_id(pair):
    removed = {r.doc_id: r.n_removed for r in repeats.dedup_bytes(pair[1]).collect()}
    assert removed[BIG] == removed[BIG + 2] == len(PASSAGE)
    linked = {r.doc_id: r.component_id for r in jaccard.group_documents(pair[1], n=3, num=90, den=100).collect()}
    assert linked[BIG] == linked[BIG + 2] == linked[None] == BIG
