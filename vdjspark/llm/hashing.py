"""Vectorised hashing inside tasks: words, Rabin-Karp windows and winnowed runs of windows.

All hashes are polynomials modulo 2^64 with odd multipliers, finished by a bit mixer, so a sum over a
stretch follows from two prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

UNIT_MULT, WORD_MULT = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_TIE = np.uint64((1 << 24) - 1)
#: Windows handled at once, which bounds the memory of a task.
STEP = 1 << 18

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(mult: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """mult^0 .. mult^n and their inverses."""
    have = _powers.get(mult)
    if have is None or len(have[0]) <= n:
        size = 1 << max(16, n.bit_length())
        both = []
        for base in (mult, pow(mult, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            both.append(np.multiply.accumulate(row))
        have = _powers[mult] = (both[0], both[1])
    return have


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def chunks(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes together; a longer text is alone."""
    at, total = 0, 0
    for i, t in enumerate(texts):
        if total and total + len(t) > limit:
            yield at, i
            at, total = i, 0
        total += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def words(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of bytes other than ASCII white space), and where each text's words begin and end."""
    buf = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if lower:
        buf = _UPPER[buf]
    ends_at = np.cumsum(np.array([len(t) + 1 for t in texts], np.int64)) if texts else np.zeros(0, np.int64)
    solid = ~SPACE[buf]
    edge = np.diff(solid.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    first = np.concatenate([[0], np.searchsorted(starts, ends_at)]).astype(np.int64)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    lengths = ends - starts
    inside = np.flatnonzero(solid)
    offset = np.arange(len(inside)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = (buf[inside].astype(np.uint64) + np.uint64(1)) * powers(WORD_MULT, int(lengths.max()))[0][offset]
    return mixed(np.add.reduceat(terms, np.cumsum(lengths) - lengths)), first


def prefix(units: np.ndarray) -> np.ndarray:
    """Rabin-Karp prefix sums; stretch() makes hashes of stretches from them."""
    out = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * powers(UNIT_MULT, len(units))[0][: len(units)], out=out[1:])
    return out


def stretch(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of units start..end (exclusive), the same wherever the stretch lies."""
    return mixed((sums[end] - sums[start]) * powers(UNIT_MULT, len(sums))[1][start])


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values: block prefixes and suffixes meet."""
    n = len(a)
    full = np.full(-(-n // w) * w, np.iinfo(a.dtype).max, a.dtype)
    full[:n] = a
    rows = full.reshape(-1, w)
    left = np.minimum.accumulate(rows, axis=1).ravel()
    right = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - w + 1], left[w - 1 : n])


def winnowed_runs(units: np.ndarray, first: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """All windows of ``window`` units within a text, as runs that share the same anchor.

    A window's anchor is its rightmost ``gram``-gram of least hash. Equal windows have equal anchors, so
    a window occurs twice only if its anchor does; and two windows of one run differ, as their anchor
    lies at another place in each. Returns text, start, number of windows, anchor's hash and the hash
    of all units which the run's windows cover.
    """
    found = []
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for at in range(0, max(0, len(units) - window + 1), STEP):
        u = units[at : at + STEP + window - 1]
        of = text_of[at : at + len(u)]
        n = len(u) - window + 1
        sums = prefix(u)
        inverse = powers(UNIT_MULT, len(sums))[1]
        grams = mixed((sums[gram:] - sums[:-gram]) * inverse[: len(u) - gram + 1])
        ranked = (grams & ~_TIE) | (_TIE - np.arange(len(grams), dtype=np.uint64))
        anchor = (_TIE - (sliding_min(ranked, window - gram + 1) & _TIE)).astype(np.int64)
        anchor[of[:n] != of[window - 1 :]] = -1
        begins = np.flatnonzero(np.diff(anchor, prepend=np.int64(-2)))
        counts = np.diff(begins, append=n)
        real = anchor[begins] >= 0
        begins, counts = begins[real], counts[real]
        found.append((of[begins], at + begins - first[of[begins]], counts, grams[anchor[begins]], stretch(sums, begins, begins + counts + window - 1)))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))
