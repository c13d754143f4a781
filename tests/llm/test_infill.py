"""Fill-in-middle against a plain version, cuts against counted units, and texts rebuilt."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pytest

from vdjspark.llm import infill

UNITS = re.compile("[A-Za-z]+|[^A-Za-z]")


def plain(doc_id: int | None, text: str | None, seed: int = 1) -> tuple:
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNITS.findall(text)
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        form, sizes, out = "plain", (None, None), text
    else:
        a, b = sorted(x % (n + 1) for x in h[:2])
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form, sizes = "spm" if h[3] % 100 < 20 else "psm", (len(prefix), len(middle))
        out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return doc_id, n, form, *sizes, sha(out), sha(text), out


TEXTS = [
    None, "", "a", "é", "abc", "a<P>b", "x<S>", "<M>", "<", "<<<PPP>>>SSS", "P><S", "word " * 3000, "z" * 5000, "é𝄞x" * 2000, "\x00\n\r\t", " ", "日本 語abc", "a" * 1023 + "éb" + "c" * 1030,
]


def test_rows_match_a_plain_version(spark):
    rng = np.random.default_rng(1)
    letters = list("abcXYZ <>PSM\n09é𝄞")
    texts = [*TEXTS, *("".join(rng.choice(letters, n)) for n in rng.integers(0, 300, 200))]
    rows = [((1 << 53) + 2 * i + 1, t, "clash", 1) for i, t in enumerate(texts)] + [(None, "no id here", "x", 1), (None, "no id here", "x", 1), (7, "tie", "x", 1), (7, "tie", "x", 1), (7, "other", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int").repartition(3)
    want = sorted((plain(*r[:2]) for r in rows), key=str)
    for block in (1024, 7):
        got = sorted((tuple(r) for r in infill.transform(docs, keep_text=True, block=block).collect()), key=str)
        assert got == want
    assert {r[2] for r in want} == {"plain", "psm", "spm"}


def test_other_rates_and_empty_tables(spark):
    docs = spark.createDataFrame([(i, "some text of words") for i in range(40)], "doc_id long, text string")
    assert {r.form for r in infill.transform(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in infill.transform(docs, rate=100, spm=100).collect()} == {"spm"}
    assert infill.transform(docs, seed=2).select("output_sha256").collect() != infill.transform(docs).select("output_sha256").collect()
    none = infill.transform(docs.limit(0))
    assert none.count() == 0
    assert none.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


@pytest.mark.parametrize("block", [1, 3, 64, 1024])
@pytest.mark.parametrize("text", [t for t in TEXTS if t])
def test_every_cut_is_where_counting_finds_it(text, block):
    units = UNITS.findall(text)
    blocks = infill.Blocks(text.encode(), block)
    assert blocks.n == len(units)
    for k in {0, 1, len(units) // 3, len(units) // 2, len(units) - 1, len(units)}:
        if 0 <= k <= len(units):
            head = "".join(units[:k])
            assert blocks.cut(k) == (len(head.encode()), len(head))


def test_texts_are_rebuilt_whatever_the_cut():
    for text in ("<<P<S", "P>S>M><", "<P", "abc"):
        raw = text.encode()
        for a in range(len(raw) + 1):
            for b in range(a, len(raw) + 1):
                for form in ("psm", "spm"):
                    assert infill.rebuilt(infill.arranged(raw, form, a, b), form) == raw
