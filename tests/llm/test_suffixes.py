from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vdjspark.llm.suffixes import repeated_starts, suffix_array

TEXTS = st.lists(st.binary(max_size=60).map(lambda b: bytes(97 + x % 2 for x in b)), min_size=1, max_size=5)


@given(st.binary(min_size=1, max_size=80).map(lambda b: bytes(97 + x % 3 for x in b)))
@settings(max_examples=200, deadline=None)
def test_suffixes_are_in_order(text):
    assert suffix_array(text, len(text)).tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_repeats_match_counts(pieces):
    where: dict = {}
    least = np.arange(len(pieces))[::-1] // 2
    for k, p in enumerate(pieces):
        for i in range(len(p) - 9):
            where.setdefault(p[i : i + 10], []).append(least[k])
    strings = [(k, i, where[p[i : i + 10]]) for k, p in enumerate(pieces) for i in range(len(p) - 9)]
    want = {(k, i, bool(min(at) < least[k])) for k, i, at in strings if len(at) > 1}
    got = {(k, int(i), bool(x)) for k, at, later in repeated_starts(pieces, 10, least) for i, x in zip(at, later, strict=True)}
    assert got == want


@given(st.binary(min_size=1, max_size=80).map(lambda b: bytes(97 + x % 3 for x in b)), st.data())
@settings(max_examples=200, deadline=None)
def test_wanted_suffixes_are_in_order(text, data):
    wanted = np.array(data.draw(st.lists(st.booleans(), min_size=len(text), max_size=len(text))))
    order = suffix_array(text, len(text), wanted)
    assert order[wanted[order]].tolist() == sorted(np.flatnonzero(wanted).tolist(), key=lambda i: text[i:])
    assert len(order) == len(set(order.tolist()))


def test_only_suffixes_that_begin_a_string_are_sorted():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 10_000).astype(np.uint8))
    wanted = np.arange(10_000) % 500 < 20
    assert len(suffix_array(text, 400, wanted)) < 2 * wanted.sum()
