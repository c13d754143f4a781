"""Secrets in text: fixed patterns, and an assignment-aware lexer for source and configuration syntax."""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vdjspark.llm.frames import map_frames

# The base patterns and the least length of each match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # maximal runs, so the same as [0-9a-f]+ of 16 or more
LEAST_ASSIGN, LEAST_ACCESS = 12, 18
KINDS = ("assign", "access", "hex", "literal")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

# How far a part of a name marks its value as a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "secrets": 1.0, "token": 1.0, "apikey": 1.0,
    "credential": 1.0, "credentials": 1.0, "private": 0.6, "auth": 0.6, "bearer": 0.8, "key": 0.5, "access": 0.4, "signature": 0.5,
    "salt": 0.5, "cert": 0.4, "session": 0.4, "cookie": 0.4, "dsn": 0.5, "webhook": 0.4, "api": 0.4, "client": 0.2,
}
PLACEHOLDER = re.compile(r"^(?:x+|\*+|\.+|<.*>|\$\{.*\}|\{\{.*\}\}|changeme|example|none|null|true|false|todo|test)$", re.I)

_STRING = r""""(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'"""
_TERM = rf"(?:{_STRING}|[A-Za-z0-9_/.=\-]+)"
_NAME = r"[A-Za-z_][A-Za-z0-9_.\-]*+"
# a type has no digits, as a bare value without digits is no literal either
_TYPE = r"(?:&(?:'static[ \t]+)?)?[A-Za-z_][A-Za-z_.]*+(?:[\[<][A-Za-z_., \t|&\[\]<>]*[\]>])?(?:[ \t]*\|[ \t]*[A-Za-z_.]++)*+"
_THEN = r"""(?:[ \t]+=(?![=>])|=(?=[ \t]*["']))"""
PAIR = re.compile(rf"""(?<![A-Za-z0-9_.\-])({_NAME})["']?(?:[ \t]*\??:[ \t]*{_TYPE}(?={_THEN}))?[ \t]*(?::=|=>|=(?!=)|:(?!//))[ \t]*((?:{_NAME}{_THEN}[ \t]*)*)({_TERM}(?:[ \t]*\+[ \t]*{_TERM})*)""")
CHAINED = re.compile(_NAME)
TERM = re.compile(rf"({_STRING})|([A-Za-z0-9_/.=\-]+)")
IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*\Z")
_PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

FOUND = "array<struct<kind: string, start: int, end: int, target: string, score: double>>"


def name_score(name: str) -> float:
    parts = [p.lower() for p in _PARTS.findall(name)]
    joined = {a + b for a, b in zip(parts, parts[1:], strict=False)}
    return min(1.0, sum(SENSITIVE.get(p, 0.0) for p in {*parts, *joined}))


def _scored(head: str, tail: str, length: float, counts: dict[str, float]) -> float:
    """literal_score() of a text of which its first 16 and last 2 characters, its length and its characters' counts are known."""
    if length < 8:
        return 0.0
    if length <= 16:
        placeholder = PLACEHOLDER.match(head)
    else:
        framed = any(head.startswith(x) and tail.endswith(y) for x, y in (("<", ">"), ("${", "}"), ("{{", "}}")))
        placeholder = framed or set(counts) <= {"x", "X"} or set(counts) == {"*"} or set(counts) == {"."}
    if placeholder:
        return 0.0
    entropy = -sum(c / length * math.log2(c / length) for c in counts.values())
    text = "".join(counts)
    kinds = sum(bool(re.search(p, text)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9\\s]"))
    return min(1.0, entropy / 4.0) * (1.0 if kinds >= 2 else 0.6) * (0.3 if re.search(r"\s", text) else 1.0)


def literal_score(text: str) -> float:
    """0 to 1: long, mixed and evenly spread characters look like a key; words and placeholders don't."""
    return _scored(text[:16], text[-2:], len(text), Counter(text))


class Value:
    """What a name stands for: literals and other values, none copied, and of its text what literal_score() needs.

    Scores are pushed from values to their parts at the end, so a literal that many values hold is not
    visited for each of them.
    """

    #: Counts are halved beyond it, as values that hold each other may grow without end; their ratios stay.
    LARGE = 1e12

    def __init__(self, text: str, spans: list[tuple[int, int]], parts: list[Value]):
        self.spans, self.parts = spans, parts
        texts = [text[a:b] for a, b in spans]
        counts: Counter[str] = Counter()
        for t in texts:
            counts.update(t)
        for p in parts:
            for c, n in p.counts.items():
                counts[c] += n
        self.length = float(sum(map(len, texts)) + sum(p.length for p in parts))
        if self.length > self.LARGE:
            counts = Counter({c: n / 2 for c, n in counts.items()})
            self.length = sum(counts.values())
        self.counts = counts
        # the order of literals and names matters to short texts only, where it rarely does
        pieces = [t[:16] for t in texts] + [p.head for p in parts]
        self.head = "".join(pieces)[:16]
        self.tail = ([t[-2:] for t in texts] + [p.tail for p in parts])[-1] if pieces else ""
        #: Best of named * whole score, and of named alone: (score, -time, name).
        self.whole: tuple[float, int, str] = (0.0, 0, "")
        self.named: tuple[float, int, str] = (0.0, 0, "")

    def score(self) -> float:
        return _scored(self.head, self.tail, self.length, self.counts)

    def mark(self, whole: tuple[float, int, str], named: tuple[float, int, str]) -> None:
        self.whole, self.named = max(self.whole, whole), max(self.named, named)


def lexed(text: str, least: float = 0.5) -> list[tuple[int, int, str, float]]:
    """Literals that flow to sensitively named targets: (start, end, target, score).

    Reads ``name = value`` pairs (also ``:``, ``:=``, ``=>``) in order. A value is literals and names
    joined by ``+``; a name that was assigned before stands for what was assigned to it last, so a
    literal is scored by each name it reaches, alone and with the value it is part of, and keeps the
    best. A type may stand between name and value (``name: str = value``), and a value may have several
    targets (``a = b = value``). A value's text holds a literal as often as the parts that it is made of
    do, but a name that is added to itself counts once. Time and memory follow the text's length.
    """
    env: dict[str, Value] = {}
    values: list[Value] = []
    for time, pair in enumerate(PAIR.finditer(text)):
        spans, parts = [], []
        for term in TERM.finditer(text, *pair.span(3)):
            start, end = term.span()
            if term[1]:
                spans.append((start + 1, end - 1))
            elif (known := env.get(term[2])) is not None:
                parts.append(known)
            elif not IDENTIFIER.match(term[2]) or any(c.isdigit() for c in term[2]):
                spans.append((start, end))
        parts = list(dict.fromkeys(parts))  # a = a + a is a
        if len(parts) == 1 and not spans:
            value = parts[0]
        else:
            value = Value(text, spans, parts)
            values.append(value)
        names = [pair[1], *CHAINED.findall(pair[2])]
        env.update(dict.fromkeys(names, value))
        scored = [(named, name) for name in names if (named := name_score(name)) > 0]
        if scored and value.length:
            named, name = max(scored, key=lambda x: x[0])
            value.mark((named * value.score(), -time, name), (named, -time, name))
    out = []
    for value in reversed(values):  # parts were made before
        for part in value.parts:
            part.mark(value.whole, value.named)
        for a, b in value.spans if value.named[0] else ():
            alone = (value.named[0] * literal_score(text[a:b]), *value.named[1:])
            score, _, name = max(value.whole, alone)
            if score >= least and score > 0:
                out.append((a, b, name, round(score, 4)))
    return out


class Inside:
    """Whether a span lies in one of many others."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [a for a, _ in spans]
        self.ends = list(accumulate((b for _, b in spans), max))

    def __contains__(self, span: tuple[int, int]) -> bool:
        before = bisect_right(self.starts, span[0])
        return bool(before) and self.ends[before - 1] >= span[1]


def found_in(text: str) -> list[tuple[str, int, int, str | None, float]]:
    """All spans of a text, by start, then kind as listed; literals inside a base span are left out."""
    out: list[tuple[str, int, int, str | None, float]] = []
    if any(k in (low := text.lower()) for k in KEYWORDS) or not low.isascii():
        out += [("assign", *m.span(), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [("access", *m.span(), None, 1.0) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", *m.span(), None, 1.0) for m in HEX.finditer(text)]
    if ":" in text or "=" in text:
        base = Inside([(s, e) for _, s, e, _, _ in out])
        out += [("literal", s, e, name, score) for s, e, name, score in lexed(text) if (s, e) not in base]
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def scan(docs: DataFrame) -> DataFrame:
    """Documents -> doc_id, found: spans in code points, end exclusive, with target name and score.

    Null text counts as empty. Rows are independent; equal rows give equal results.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "target", "score"), x, strict=True)) for x in found_in(t)] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"].array, "found": found})

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return map_frames(chosen, work, f"doc_id long, found {FOUND}")


def digest(found: DataFrame) -> DataFrame:
    """scan()'s rows -> counts by base kind, a hash of the base spans, and all spans as text."""

    def of(kind: str) -> F.Column:
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def text(column: F.Column) -> F.Column:
        return F.array_join(F.transform(column, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    base = text(F.filter("found", lambda x: x["kind"] != "literal"))
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(base.cast("binary"), 256).alias("base_sha256"), text(F.col("found")).alias("spans"), of("literal"))
