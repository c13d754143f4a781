from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import oracle
import pytest
from test_operators import brute_groups, brute_hits, words_of

from vdjspark.llm import queries, toxicity, training_order
from vdjspark.runtime import table

SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    import corpus_pipeline as P

    docs = source = table(spark, SF, "documents")
    for name, step in P.STAGES[:-1]:
        after = step(spark, docs, SF)
        assert after.columns == source.columns, name
        if name != "mixing":
            assert not after.exceptAll(docs).count()
        docs = after
    assert docs.count() > 0.5 * source.count()
    last = P.STAGES[-1][1](spark, docs, SF)
    slots = [r.slot for r in last.select("slot").collect()]
    assert sorted(slots) == list(range(len(slots)))
    assert set(Counter(r.doc_id for r in docs.collect())) == {r.doc_id for r in last.select("doc_id").distinct().collect()}


def brute_score(text: str | None, model: toxicity.Model) -> float:
    """Every term is looked for at every place, instead of by one automaton."""
    clean = toxicity.folded(text or "")
    padded = f" {clean} "
    total = max(0.0, sum(w for term, w in (model.terms | model.exceptions).items() for i in range(len(padded)) if padded.startswith(term, i)))
    words = 1 + clean.count(" ")
    x = np.log1p(total), np.log1p(100 * total / words), np.log1p(words) if total else 0.0
    return 1 / (1 + np.exp(-(model.bias + sum(a * b for a, b in zip(model.slopes, x, strict=True)))))


def brute_mix(rows: list) -> Counter:
    """doc_id -> times: every source's documents in the order of their hash."""
    size = {r.doc_id: len(words_of(r.text)) for r in rows}
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append((int(hashlib.md5(f"7:{r.doc_id}:{r.text}".encode()).hexdigest()[:8], 16) >> 2, r.doc_id))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    open_ = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, target = sum(size.values()), {}
    sums = {s: sum(size[d] for _, d in by_source[s]) for s in names}
    while True:
        share = {s: left * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in open_ if share[s] > 3 * sums[s]]
        if not over:
            break
        for s in over:
            target[s] = 3 * sums[s]
            left -= target[s]
            del open_[s]
    target |= share
    times: Counter = Counter()
    for s in names:
        whole = min(3, int(target[s] // sums[s])) if sums[s] else 0
        rest = target[s] - whole * sums[s]
        for _, d in sorted(by_source[s]):
            once_more = whole < 3 and (size[d] <= rest or 2 * rest >= size[d] > 0)
            times[d] += whole + once_more
            rest = rest - size[d] if size[d] <= rest else -1.0
    return +times


def test_stages_match_plain_versions(spark):
    import corpus_pipeline as P

    step, docs = dict(P.STAGES), table(spark, SF, "documents")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    rows = docs.collect()
    model = toxicity.train(docs, table(spark, SF, "labels"))
    assert model.terms
    docs = step["toxicity"](spark, docs, SF)
    assert ids(docs) == sorted(r.doc_id for r in rows if brute_score(r.text, model) < 0.7)

    rows = docs.collect()
    docs = step["near_duplicates"](spark, docs, SF)
    assert ids(docs) == sorted(d for d, _, least in brute_groups([(r.doc_id, r.text) for r in rows], 5, 80, 100) if d == least)

    rows = docs.collect()
    docs = step["decontamination"](spark, docs, SF)
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert ids(docs) == sorted(d for d, *_, hit in brute_hits([(r.doc_id, r.text) for r in rows], items) if not hit)

    rows = docs.collect()
    docs = step["mixing"](spark, docs, SF)
    assert Counter(ids(docs)) == brute_mix(rows)

    out = step["training_order"](spark, docs, SF).collect()
    assert sorted(r.slot for r in out) == list(range(len(out)))
    encode = training_order.Encoder(open(training_order.VOCABULARY, "rb").read()).encoding.encode_ordinary
    ids_of = {r.doc_id: encode(r.text or "") for r in rows}
    want = Counter((d, s, tuple(i[256 * s : 256 * s + 256])) for d, k in brute_mix(rows).items() for i in [ids_of[d]] for s in range(len(i) // 256 + 1) for _ in range(k))
    assert Counter((r.doc_id, r.seq, tuple(np.frombuffer(r.tokens, "<u2")[: r.n_tokens].tolist())) for r in out) == want


def test_every_query_returns_a_row_per_document(spark):
    n = table(spark, SF, "documents").count()
    for name, f in queries.QUERIES.items():
        rows = f(spark, SF).count()
        assert rows >= n if name.startswith("op9") else rows == n, name


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_rows_match_sql(spark, name):
    assert oracle.same(queries.QUERIES[name](spark, SF).toPandas(), oracle.by_sql(queries.ORACLE[name], SF))
