"""Connected components against union-find, and the tables that they take."""

from __future__ import annotations

import random

import pytest

from vdjspark.llm import components as C
from vdjspark.llm import jaccard


def least_of(edges: list[tuple[int, int]]) -> dict[int, int]:
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    return {x: find(x) for x in root}


def graphs() -> dict[str, list[tuple[int, int]]]:
    deal = random.Random(3)
    path = [(i, i + 1) for i in range(-20, 100)]
    names = [deal.randrange(-(1 << 62), 1 << 62) for _ in range(400)]
    return {
        "path": path,
        "shuffled path": [(names[i], names[i + 1]) for i in range(120)],
        "star around the greatest": [(1000, i) for i in range(300)],
        "random": [(deal.choice(names), deal.choice(names)) for _ in range(350)],
        "alone": [(5, 5), (7, 7), (9, 8), (8, 9)],
    }


def rows_of(spark, edges):
    return {r.node: r.root for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}


@pytest.mark.parametrize("name", graphs())
def test_components_match_union_find(spark, name):
    assert rows_of(spark, graphs()[name]) == least_of(graphs()[name])


def test_no_edges_have_no_components(spark):
    assert rows_of(spark, []) == {}


def test_a_round_writes_two_tables(spark, monkeypatch):
    """A path of 121 nodes: the tables of seven rounds at most, the edges and the minima of the last look."""
    written, stage = [], C.stage
    monkeypatch.setattr(C, "stage", lambda df, name: written.append(name) or stage(df, name))
    rows_of(spark, graphs()["path"])
    assert len(written) <= 2 + 2 * 7


def test_blocks_of_a_family_are_joined_once(spark, monkeypatch):
    """Where comparing across blocks links nothing more, components are found twice: of families and of links."""
    words = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([*words, f"x{k}"])) for k in range(12)]
    calls, components = [], jaccard.components
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "components", lambda edges: calls.append(1) or components(edges))
    found = jaccard.group_documents(spark.createDataFrame(rows, "doc_id long, text string"), n=3, num=90, den=100).collect()
    assert {r.component_id for r in found} == {0} and len(calls) == 2


def test_links_become_stars():
    links = [(5, 9), (9, 2), (7, 8), (3, 3), (8, 6)]
    assert sorted(jaccard.stars(links)) == [(5, 2), (7, 6), (8, 6), (9, 2)]
