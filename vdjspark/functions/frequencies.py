"""Packed position frequencies: five counts and five largest qualities a position, for A, C, G, T and N."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from vdjspark.functions import flat

BASES = "ACGT"
KINDS = len(BASES) + 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used there."""
    return F.get(F.transform(F.array(value), body), 0)


def _positions(first: Column, end: Column) -> Column:
    """first .. end - 1; sequence() would count down where there is none."""
    return F.when(end > first, F.sequence(first, end - 1)).otherwise(F.array().cast("array<int>"))


def of_reads(seq: Column, qual: Column, count: Column) -> Column:
    """struct<freq, quals> of ``count`` equal reads; what isn't A, C, G or T counts as N."""

    def cells(value: Column | None) -> Column:
        def cell(i: Column) -> Column:
            at = F.instr(F.lit(BASES), F.substring(seq, i + 1, F.lit(1)))
            kind = F.when(at == 0, len(BASES)).otherwise(at - 1)
            return F.array(*[F.when(kind == k, F.get(qual, i) if value is None else value).otherwise(0) for k in range(KINDS)])

        return F.flatten(F.transform(_positions(F.lit(0), F.length(seq)), cell))

    return F.struct(cells(count.cast("long")).cast("array<long>").alias("freq"), cells(None).cast("array<int>").alias("quals"))


def added(a: Column, b: Column, offset: Column | int = 0) -> Column:
    """struct<freq, quals> of both, b moved right by ``offset`` bases (left where it is negative). A gap between the two raises."""
    o = F.lit(offset) if isinstance(offset, int) else offset
    return let(a, lambda x: let(b, lambda y: let(o, lambda n: _added(x, y, n))))


def _added(a: Column, b: Column, o: Column) -> Column:
    la, lb = (F.floor(F.size(x["freq"]) / KINDS).cast("int") for x in (a, b))
    gap = (o > la) | (-o > lb)
    first = F.when(gap, F.raise_error(F.lit("offset so large or small that there is a gap")).cast("int")).otherwise(F.least(o, F.lit(0)))
    at = _positions(first, F.greatest(la, lb + o))

    def there(x: Column, name: str, i: Column, k: int, n: Column) -> Column:
        return F.when((i >= 0) & (i < n), F.get(x[name], i * KINDS + k)).otherwise(0)

    freq = F.transform(at, lambda i: F.array(*[there(a, "freq", i, k, la) + there(b, "freq", i - o, k, lb) for k in range(KINDS)]))
    quals = F.transform(at, lambda i: F.array(*[F.greatest(there(a, "quals", i, k, la), there(b, "quals", i - o, k, lb)) for k in range(KINDS)]))
    return F.struct(F.flatten(freq).cast("array<long>").alias("freq"), F.flatten(quals).cast("array<int>").alias("quals"))


def called(x: Column) -> Column:
    """struct<seq, qual, bases, mutations> of packed frequencies.

    The most frequent of A, C, G, T; of equals the one of larger quality; a tie in both, or none of the
    four, is N of quality 0. mutations: bases of the four other than the called frequency.
    """
    return let(x, _called)


def _called(x: Column) -> Column:
    n = F.floor(F.size(x["freq"]) / KINDS).cast("int")

    def cell(i: Column) -> Column:
        each = [F.struct(F.get(x["freq"], i * KINDS + k).alias("f"), F.get(x["quals"], i * KINDS + k).alias("q")) for k in range(len(BASES))]
        best = F.greatest(*each)
        alone = sum((e == best).cast("int") for e in each) == 1
        letter = F.coalesce(*[F.when(e == best, b) for e, b in zip(each, BASES, strict=True)])
        total = sum(F.get(x["freq"], i * KINDS + k) for k in range(len(BASES)))
        return F.struct(F.when(alone, letter).otherwise("N").alias("base"), F.when(alone, best["q"]).otherwise(0).alias("q"), (total - best["f"]).alias("wrong"))

    whole = lambda cells: F.struct(
        F.array_join(F.transform(cells, lambda c: c["base"]), "").alias("seq"), F.transform(cells, lambda c: c["q"]).alias("qual"),
        F.aggregate(x["freq"], F.lit(0).cast("long"), lambda s, f: s + f).alias("bases"), F.aggregate(cells, F.lit(0).cast("long"), lambda s, c: s + c["wrong"]).alias("mutations"),
    )
    return let(F.transform(_positions(F.lit(0), n), cell), whole)


_KINDS = np.full(256, len(BASES), np.int64)
_KINDS[[ord(x) for x in BASES]] = range(len(BASES))


def sums_of(seqs: list[pa.Array], quals: list[pa.Array], counts: list[pa.Array], offset: pa.Array) -> dict[str, pa.Array]:
    """Pairs of reads (text of Phred+33) that were seen so often, the second moved right by ``offset``: what called(added()) and mismatch_quality() give of them.

    seq, qual_text, mutations, hd, sum_q and max_q, for a whole Arrow batch at once. A gap between the two raises.
    """
    o = flat.numbers(offset)
    codes, at = zip(*map(flat.letters, seqs), strict=True)
    q = [flat.qualities(x, True)[0].astype(np.int64) - flat.ZERO for x in quals]
    size = [np.diff(x) for x in at]
    if ((o > size[0]) | (-o > size[1])).any():
        raise ValueError("offset so large or small that there is a gap")
    first, row = np.minimum(o, 0), [np.repeat(np.arange(len(o)), x) for x in size]
    begin = flat.starts(np.maximum(size[0], size[1] + o) - first)
    freq, best_q = np.zeros((begin[-1], KINDS), np.int64), np.zeros((begin[-1], KINDS), np.int64)
    place = []
    for i, moved in enumerate((np.zeros(len(o), np.int64), o)):
        # a read has one base at a place, so nothing is added twice
        place.append((begin[:-1] + moved - first)[row[i]] + np.arange(len(codes[i])) - at[i][:-1][row[i]])
        kind = _KINDS[np.minimum(codes[i], 255)]
        freq[place[i], kind] += flat.numbers(counts[i])[row[i]]
        best_q[place[i], kind] = np.maximum(best_q[place[i], kind], q[i])
    f, g = freq[:, : len(BASES)], best_q[:, : len(BASES)]
    score = f * 256 + g
    top = score.argmax(1)
    most = np.take_along_axis(score, top[:, None], 1)
    alone = (score == most).sum(1) == 1
    base = np.where(alone, np.frombuffer(BASES.encode(), np.uint8)[top], ord("N"))
    called_q = np.where(alone, most[:, 0] % 256, 0)
    pair = np.repeat(np.arange(len(o)), np.diff(begin))
    wrong = np.bincount(pair, f.sum(1) - most[:, 0] // 256, len(o)).astype(np.int64)
    # where the first read has a base, and the second too
    mine = np.full(begin[-1], -1)
    mine[place[0]] = np.arange(len(place[0]))
    other = mine[place[1]]
    differs = (other >= 0) & (codes[0][np.maximum(other, 0)] != codes[1]) if len(place[0]) else np.zeros(len(other), bool)
    at_b = row[1][differs]
    least = np.minimum(q[0][other[differs]], q[1][differs])
    max_q = np.zeros(len(o), np.int64)
    np.maximum.at(max_q, at_b, least)
    hd, sum_q = np.bincount(at_b, minlength=len(o)), np.bincount(at_b, least, len(o)).astype(np.int64)
    numbers = {"mutations": (wrong, pa.int64()), "hd": (hd, pa.int32()), "sum_q": (sum_q, pa.int32()), "max_q": (max_q, pa.int32())}
    return {"seq": flat.texts(base, begin), "qual_text": flat.texts(called_q + 33, begin)} | {c: pa.array(x, t) for c, (x, t) in numbers.items()}
