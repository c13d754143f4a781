"""Arrow batches as flat numpy arrays: all letters of a batch at once, where columns would visit them one by one."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa


#: The byte that stands for a quality of 0 where qualities are bytes.
ZERO = 64


def letters(texts: pa.Array, binary: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts (bytes, if they are ``binary``), one after the other, and where each begins (with the end of the last); a null has none."""
    if texts.null_count:
        texts = texts.fill_null(b"" if binary else "")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = texts.buffers()
    wide = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    at = np.frombuffer(places, wide)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    codes = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    if not binary and codes.size and codes.max() > 127:
        whole = texts.to_pylist()
        return np.frombuffer("".join(whole).encode("utf-32-le"), np.uint32), np.concatenate([[0], np.cumsum([len(x) for x in whole])]).astype(np.int64)
    return codes, at - at[0]


def texts(codes: np.ndarray, at: np.ndarray, kind: pa.DataType | None = None) -> pa.Array:
    """The strings of ASCII letters (or binary values) that begin at ``at``."""
    return pa.Array.from_buffers(kind or pa.string(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(codes, np.uint8))])


def qualities(values: pa.Array, text: bool) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of qualities, ZERO for 0, and where each read's begin: of Phred+33 text in the range of Illumina 1.8, or of lists."""
    if text:
        codes, at = letters(values)
        scores = codes.astype(np.int64) - 33
        low, high = 0, 41
    else:
        values = values.fill_null([]) if values.null_count else values
        at = values.offsets.to_numpy().astype(np.int64)
        scores, at = numbers(values.values)[at[0] : at[-1]], at - at[0]
        low, high = -ZERO, 255 - ZERO
    if (bad := scores[(scores < low) | (scores > high)]).size:
        raise ValueError(f"Quality score ({bad[0]}) not in [{low}, {high}]")
    return (scores + ZERO).astype(np.uint8), at


def listed(values: pa.Array) -> pa.Array:
    """Bytes of qualities as lists of them."""
    codes, at = letters(values, binary=True)
    return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(codes.astype(np.int32) - ZERO, pa.int32()))


#: Places of letters in BASES of sequences.translate_codons(), 64 for others, and what three places stand for.
_PLACES = np.full(256, 64, np.int64)
_PLACES[[ord(x) for x in "TCAG"]] = range(4)


def amino_acids(seq: pa.Array, amino: str) -> pa.Array:
    """Amino acids (of the 64 codons in ``amino``) of whole codons; ``?`` for a codon with other letters; empty for null."""
    codes, at = letters(seq)
    count = np.diff(at) // 3
    first = np.repeat(at[:-1], count) + 3 * ranges(np.zeros(len(count), np.int64), count)
    place = _PLACES[np.minimum(codes, 255)]
    codon = place[first] * 16 + place[first + 1] * 4 + place[first + 2] if len(first) else first
    odd = (place[first] > 3) | (place[first + 1] > 3) | (place[first + 2] > 3) if len(first) else np.zeros(0, bool)
    known = np.frombuffer((amino + "?").encode(), np.uint8)
    return texts(known[np.where(odd, 64, codon)], starts(count))


def ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1 ... of each, ``count`` numbers, one after the other."""
    end = np.cumsum(count)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(first - (end - count), count)


def starts(count: np.ndarray) -> np.ndarray:
    """Where each of lists of so many begins, and the end of the last."""
    return np.concatenate([[0], np.cumsum(count)]).astype(np.int64)


def numbers(values: pa.Array, null: int = 0) -> np.ndarray:
    return values.cast(pa.int64()).fill_null(null).to_numpy(zero_copy_only=False)


class Operations:
    """Operations of a batch of CIGAR strings, each distinct string read once: kind (as a letter's code), n, q, r of each, counted from 0.

    Operations of length 0 are left out; null and ``*`` have none; any other text that is no CIGAR raises.
    """

    def __init__(self, cigar: pa.Array):
        coded = cigar.dictionary_encode()
        distinct = [self._of(x) for x in coded.dictionary.to_pylist()] + [[]]
        self.code = numbers(coded.indices, len(distinct) - 1)
        self.size = np.array([len(x) for x in distinct], np.int64)
        self.first = starts(self.size)[:-1]
        self.kind, self.n, self.q, self.r = np.array([x for ops in distinct for x in ops] or np.zeros((0, 4)), np.int64).reshape(-1, 4).T
        # where each distinct string's alignment begins and ends in the query; -1 where nothing is aligned
        spans = [self._span(x) for x in distinct]
        self.qas, self.qae = np.array(spans, np.int64).T

    @staticmethod
    def _of(cigar: str) -> list[tuple[int, int, int, int]]:
        if not re.fullmatch(r"\*|([0-9]+[MIDNSHP=X])+", cigar):
            raise ValueError(f"invalid CIGAR {cigar}")
        out, q, r = [], 0, 0
        for n, kind in re.findall("([0-9]+)([MIDNSHP=X])", cigar):
            if int(n):
                out.append((ord(kind), int(n), q, r))
                q += int(n) * (kind in "MX=IS")
                r += int(n) * (kind in "MX=DN")
        return out

    @staticmethod
    def _span(ops: list[tuple[int, int, int, int]]) -> tuple[int, int]:
        aligned = [x for x in ops if chr(x[0]) not in "SHP"]
        if not aligned:
            return -1, -1
        kind, n, q, _ = aligned[-1]
        return aligned[0][2], q + n * (chr(kind) in "MX=I")

    def each(self) -> tuple[np.ndarray, np.ndarray]:
        """Row and number of every operation of the batch."""
        size = self.size[self.code]
        return np.repeat(np.arange(len(self.code)), size), ranges(self.first[self.code], size)

    def matched(self, number: np.ndarray) -> np.ndarray:
        return np.isin(self.kind[number], [ord(x) for x in "MX="])


class Bases:
    """Bases of a batch of alignments within low <= reference position < high: ``row``, place ``q`` in the query, whether one is ``wrong``, and inserted ones.

    ``ras`` is where an alignment begins in its reference, counted from 0. Arguments are of one length; as in
    cigar.error_stats(), null bounds mean the whole reference, and a start below 0 or not before the end raises.
    """

    def __init__(self, cigar: pa.Array, pos: pa.Array, seq: pa.Array, reference: pa.Array, low: pa.Array | None, high: pa.Array | None):
        ops, ras = Operations(cigar), numbers(pos) - 1
        query, query_at = letters(seq)
        ref, ref_at = letters(reference)
        size = np.diff(ref_at)
        low = np.zeros(len(size), np.int64) if low is None else numbers(low)
        high = size if high is None else np.where(high.is_null().to_numpy(zero_copy_only=False), size, numbers(high))
        if (bad := np.flatnonzero((low < 0) | (low >= high))).size:
            raise ValueError(f"no region from {low[bad[0]]} to {high[bad[0]]}")
        row, k = ops.each()
        n, q, r = ops.n[k], ops.q[k], ops.r[k] + ras[row]
        # an operation is cut to the region first
        first, last = np.maximum(low[row] - r, 0), np.minimum(high[row] - r, n)
        here = ops.matched(k) & (first < last)
        count = (last - first)[here]
        self.row = np.repeat(row[here], count)
        within = ranges(first[here], count)
        self.q = np.repeat(q[here], count) + within
        self.wrong = self._at(query, query_at, self.row, self.q) != self._at(ref, ref_at, self.row, np.repeat(r[here], count) + within)
        inside = (r >= low[row]) & (r < high[row])
        added = inside & (ops.kind[k] == ord("I"))
        self.ins = np.bincount(row[added], n[added], len(size)).astype(np.int64)
        self.added_row, self.added_q = np.repeat(row[added], n[added]), ranges(q[added], n[added])
        gone = inside & (ops.kind[k] == ord("D"))
        self.dels = np.bincount(row[gone], np.minimum(n, high[row] - r)[gone], len(size)).astype(np.int64)
        self.n = np.bincount(self.row, minlength=len(size)) + self.ins
        self.mm = np.bincount(self.row[self.wrong], minlength=len(size))

    @staticmethod
    def _at(codes: np.ndarray, at: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Letters at places of the rows' texts; 0 beyond their ends."""
        i = at[row] + place
        there = i < at[row + 1]
        return np.where(there, codes[np.where(there, i, 0)], 0) if codes.size else np.zeros(len(row), np.uint8)
