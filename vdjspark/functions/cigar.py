"""Column functions on CIGAR strings; coordinates are 0-based and half-open."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from vdjspark.functions import flat

TOKEN = r"([0-9]+)([MIDNSHP=X])"


def tokens(cigar: Column) -> Column:
    """array<struct<n: int, op: string>>"""
    n = F.regexp_extract_all(cigar, F.lit(TOKEN), F.lit(1))
    op = F.regexp_extract_all(cigar, F.lit(TOKEN), F.lit(2))
    return F.zip_with(n, op, lambda a, b: F.struct(a.cast("int").alias("n"), b.alias("op")))


def placed(cigar: Column, ras: Column) -> Column:
    """Each operation with its place: array<struct<op, n, q, r>>, q and r where it begins in query and reference.

    Operations of length 0 are left out; ``*`` has none; any other text that is no CIGAR raises. Make it a
    column once where several functions of this module read the same alignment, and give it as ``ops``.
    """
    start = F.struct(F.array().cast("array<struct<op:string,n:int,q:int,r:int>>").alias("ops"), F.lit(0).alias("q"), ras.cast("int").alias("r"))

    def step(s: Column, t: Column) -> Column:
        here = F.struct(t["op"].alias("op"), t["n"].alias("n"), s["q"].alias("q"), s["r"].alias("r"))
        query = F.when(t["op"].isin("M", "X", "=", "I", "S"), t["n"]).otherwise(0)
        reference = F.when(t["op"].isin("M", "X", "=", "D", "N"), t["n"]).otherwise(0)
        return F.struct(F.concat(s["ops"], F.array(here)).alias("ops"), (s["q"] + query).alias("q"), (s["r"] + reference).alias("r"))

    good = cigar.rlike(r"^(\*|([0-9]+[MIDNSHP=X])+)$")
    checked = F.when(good, cigar).when(cigar.isNotNull(), F.raise_error(F.concat(F.lit("invalid CIGAR "), cigar)))
    return F.aggregate(F.filter(tokens(checked), lambda t: t["n"] > 0), start, step, lambda s: s["ops"])


def _first_last(ops: Column) -> tuple[Column, Column]:
    aligned = F.filter(ops, lambda o: ~o["op"].isin("S", "H", "P"))
    return F.get(aligned, 0), F.get(aligned, F.size(aligned) - 1)


def intervals(cigar: Column, ras: Column, ops: Column | None = None) -> Column:
    """struct<qas, qae, ras, rae>: where query and reference are aligned."""
    first, last = _first_last(placed(cigar, ras) if ops is None else ops)
    return F.struct(
        first["q"].alias("qas"),
        (last["q"] + F.when(last["op"].isin("M", "X", "=", "I"), last["n"]).otherwise(0)).alias("qae"),
        ras.cast("int").alias("ras"),
        (last["r"] + F.when(last["op"].isin("M", "X", "=", "D", "N"), last["n"]).otherwise(0)).alias("rae"),
    )


def query_position(cigar: Column, ras: Column, target: Column, ops: Column | None = None) -> Column:
    """The query position aligned with a reference position; null before, after and in gaps."""
    at = F.filter(placed(cigar, ras) if ops is None else ops, lambda o: o["op"].isin("M", "X", "=") & (o["r"] <= target) & (target < o["r"] + o["n"]))
    return F.get(F.transform(at, lambda o: o["q"] + target - o["r"]), 0)


def measured(cigar: Column, ras: Column, target: Column | None = None, fixed: bool = False) -> Column:
    """struct<qas, qae, at> as intervals() and query_position() give them, by Arrow batches in which each distinct CIGAR is read once.

    With ``fixed`` the optimizer may not copy it into filters, where it would be made once more.
    """

    @F.arrow_udf("struct<qas: int, qae: int, at: int>")
    def measure(cigars: pa.Array, begin: pa.Array, wanted: pa.Array) -> pa.Array:
        ops = flat.Operations(cigars)
        row, k = ops.each()
        # far below any place stands for null
        place = flat.numbers(wanted, -(1 << 40)) - flat.numbers(begin, 0) - np.where(begin.is_null().to_numpy(zero_copy_only=False), 1 << 40, 0)
        ahead = place[row] - ops.r[k]
        hit = ops.matched(k) & (ahead >= 0) & (ahead < ops.n[k])
        at = np.full(len(place), -1)
        at[row[hit]] = (ops.q[k] + ahead)[hit]
        values = [ops.qas[ops.code], ops.qae[ops.code], at]
        return pa.StructArray.from_arrays([pa.array(x, pa.int32(), mask=x < 0) for x in values], ["qas", "qae", "at"])

    measure = measure.asNondeterministic() if fixed else measure
    return measure(cigar, ras.cast("int"), (F.lit(None) if target is None else target).cast("int"))


def _region(reference: Column, roi_start: Column | None, roi_end: Column | None) -> tuple[Column, Column]:
    """Bounds, by default the whole reference; bounds below 0 or in the wrong order raise."""
    low = F.lit(0) if roi_start is None else F.coalesce(roi_start, F.lit(0))
    high = F.length(reference) if roi_end is None else F.coalesce(roi_end, F.length(reference))
    bad = F.raise_error(F.format_string("no region from %d to %d", low, high)).cast("int")
    return F.when((low >= 0) & (low < high), low).otherwise(bad), high


def _aligned(ops: Column, low: Column, high: Column, of: Callable[[Column, Column], Column]) -> Column:
    """of(query position, reference position) of each aligned pair with low <= reference position < high."""

    def pairs(o: Column) -> Column:
        # cut to the region first: an operation lists only its bases there
        first, last = F.greatest(low - o["r"], F.lit(0)), F.least(high - o["r"], o["n"])
        return F.when(first < last, F.transform(F.sequence(first, F.greatest(last - 1, first)), lambda k: of(o["q"] + k, o["r"] + k)))

    listed = F.transform(F.filter(ops, lambda o: o["op"].isin("M", "X", "=")), pairs)
    return F.flatten(F.filter(listed, lambda x: x.isNotNull()))


def _indels(ops: Column, kind: str, low: Column, high: Column) -> Column:
    return F.filter(ops, lambda o: (o["op"] == kind) & (o["r"] >= low) & (o["r"] < high))


def error_stats(cigar: Column, pos: Column, seq: Column, reference: Column, roi_start: Column | None = None, roi_end: Column | None = None, ops: Column | None = None) -> Column:
    """struct<n, mm, ins, dels, roi_as, roi_ae> of an alignment (1-based ``pos``) within a stretch of the reference.

    n counts aligned and inserted bases, mm aligned bases that differ. Null bounds mean the whole
    reference; a start below 0 or not before the end raises.
    """
    ras = pos - 1
    low, high = _region(reference, roi_start, roi_end)
    ops = placed(cigar, ras) if ops is None else ops
    differs = _aligned(ops, low, high, lambda q, r: F.substring(seq, q + 1, F.lit(1)) != F.substring(reference, r + 1, F.lit(1)))
    ins = F.aggregate(_indels(ops, "I", low, high), F.lit(0), lambda s, o: s + o["n"])
    dels = F.aggregate(_indels(ops, "D", low, high), F.lit(0), lambda s, o: s + F.least(o["n"], high - o["r"]))
    span = intervals(cigar, ras, ops)
    return F.struct(
        (F.size(differs) + ins).alias("n"),
        F.size(F.filter(differs, lambda x: x)).alias("mm"),
        ins.alias("ins"),
        dels.alias("dels"),
        F.greatest(span["ras"], low).alias("roi_as"),
        F.least(span["rae"], high).alias("roi_ae"),
    )


def base_qualities(cigar: Column, pos: Column, seq: Column, qual: Column, reference: Column, roi_start: Column | None = None, roi_end: Column | None = None, ops: Column | None = None) -> Column:
    """array<struct<q, wrong>>: quality of each base that error_stats() counts in n, and whether it is an aligned one that differs."""
    low, high = _region(reference, roi_start, roi_end)
    ops = placed(cigar, pos - 1) if ops is None else ops
    wrong = lambda q, r: F.substring(seq, q + 1, F.lit(1)) != F.substring(reference, r + 1, F.lit(1))
    aligned = _aligned(ops, low, high, lambda q, r: F.struct(F.get(qual, q).alias("q"), wrong(q, r).alias("wrong")))
    inserted = F.transform(_indels(ops, "I", low, high), lambda o: F.transform(F.slice(qual, o["q"] + 1, o["n"]), lambda q: F.struct(q.alias("q"), F.lit(False).alias("wrong"))))
    return F.concat(aligned, F.flatten(inserted))
