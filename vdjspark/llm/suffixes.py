"""Two-stage suffix sorting of a bounded set of pieces, and repeats from adjacent common prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Never part of UTF-8, so no common prefix of text passes it.
END = 0xFF


def suffix_array(text: bytes, depth: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Starts of all suffixes, in order of their first ``depth`` bytes at least.

    Stage one sorts only the suffixes that are smaller than their successors. Stage two places the
    rest: scanning the array upwards, the predecessor of each suffix, if it is a larger-than-successor
    one, goes to the next free place at the front of its first byte's bucket. With ``wanted``, a mask,
    only those suffixes are sorted, and the few behind them that stage two places them by.
    """
    t = np.frombuffer(text, np.uint8)
    n = len(t)
    # larger[i]: suffix i > suffix i + 1; equal bytes take over from their right neighbour
    larger = np.ones(n, bool)
    differs = np.flatnonzero(t[:-1] != t[1:])
    larger[differs] = t[differs] > t[differs + 1]
    following = np.searchsorted(differs, np.arange(n))
    inside = following < len(differs)
    larger[inside] = larger[differs[following[inside]]]
    needed = np.ones(n, bool)
    if wanted is not None:
        # a larger one is placed by its successor: from each wanted start to the next smaller one
        at = np.arange(n)
        stop = np.concatenate([[-1], np.maximum.accumulate(np.where(larger, -1, at))[:-1]])
        needed = np.maximum.accumulate(np.where(wanted, at, -1)) > stop
    induced = larger & needed
    direct = sorted(np.flatnonzero(needed & ~larger).tolist(), key=lambda i: text[i : i + depth])
    order = np.full(int(needed.sum()), -1, np.int64)
    counts, larger_counts = np.bincount(t[needed], minlength=256), np.bincount(t[induced], minlength=256)
    begin = np.cumsum(counts) - counts
    direct_bytes = t[direct] if direct else np.zeros(0, np.uint8)
    smaller_counts = counts - larger_counts
    # within a bucket, larger-than-successor suffixes come first
    rank = np.arange(len(direct)) - np.repeat(np.cumsum(smaller_counts) - smaller_counts, smaller_counts)
    order[begin[direct_bytes] + larger_counts[direct_bytes] + rank] = direct
    sa, front, is_induced = order.tolist(), begin.tolist(), induced.tolist()
    if needed[n - 1]:
        sa[front[text[-1]]] = n - 1  # the last suffix precedes the empty one only
        front[text[-1]] += 1
    for i in range(len(sa)):
        j = sa[i] - 1
        if j >= 0 and is_induced[j]:
            byte = text[j]
            sa[front[byte]] = j
            front[byte] += 1
    return np.array(sa, np.int64)


def common_prefix_reaches(text: bytes, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Whether the suffixes at a[i] and b[i] share ``depth`` bytes; eight bytes are compared at a time."""
    padded = np.frombuffer(text + bytes(depth + 8), np.uint8)
    eight = np.lib.stride_tricks.sliding_window_view(padded, 8).copy().view(np.uint64).ravel()
    live = np.arange(len(a))
    for at in [*range(0, depth - 8, 8), depth - 8]:
        live = live[eight[a[live] + at] == eight[b[live] + at]]
    out = np.zeros(len(a), bool)
    out[live] = True
    return out


def repeated_starts(pieces: list[bytes], length: int, least: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each piece, the starts of its strings of ``length`` (8 at least) that occur again in any piece.

    With them, whether the string occurs in a piece of a smaller number in ``least``.
    """
    text = bytes([END]).join(pieces) + bytes([END])
    first = np.cumsum([0, *[len(p) + 1 for p in pieces[:-1]]])
    sizes = np.array([len(p) for p in pieces])
    # only strings within their piece
    edge = np.zeros(len(text) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + np.maximum(sizes - length + 1, 0), -1)
    starting = np.cumsum(edge)[:-1] > 0
    order = suffix_array(text, length, starting)
    order = order[starting[order]]
    piece = np.searchsorted(first, order, "right") - 1
    if len(order) < 2:
        return
    same = common_prefix_reaches(text, order[:-1], order[1:], length)
    begins = np.concatenate([[0], np.flatnonzero(~same) + 1])  # of the classes of equal strings
    counts = np.diff(begins, append=len(order))
    lowest = np.repeat(np.minimum.reduceat(least[piece], begins), counts)
    again = np.repeat(counts > 1, counts)
    starts, piece, later = order[again], piece[again], (least[piece] > lowest)[again]
    at = np.argsort(starts)
    starts, piece, later = starts[at], piece[at], later[at]
    for mine in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(piece)) + 1) if len(starts) else ():
        p = int(piece[mine[0]])
        yield p, starts[mine] - first[p], later[mine]
