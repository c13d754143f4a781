"""Mixing sources to target weights by hash-threshold histograms (DataFrame functions only).

Every document has a fixed hash. Per source, words are summed by hash bucket; the bucket in which the
running sum passes the source's budget is the boundary. Only the boundary bucket is split again by the
next bits of the hash, so after a few levels a source has one 30-bit threshold, and a filter on the hash
picks its documents. Only the rows whose hash is the threshold itself (one document, or copies of one row)
are told apart by running sums, over ranges. A larger budget takes a superset of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vdjspark.runtime import small, stage
from vdjspark.sources.sequence_files import running_sum

LEVELS, BITS = 3, 10
WORDS = r"[^\x20\x09-\x0D]+"


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size) -> and its target.

    Sources in order of code points, null last, take ``weights`` in turn and share the sum of all
    sizes by weight. A target stops at ``most`` times its source's size, and what is over is shared
    again by weight: the shares are min(most * size, level * weight), and the level follows from the
    sources that stop first, those with the least size per unit of weight.
    The window runs over one row per source.
    """
    turn = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights) + 1).cast("int")))
    weighed = weighed.withColumn("stop", F.col("source_size") * float(most)).withColumn("at", F.col("stop") / F.col("weight"))
    everyone, before = Window.partitionBy(), Window.orderBy("at", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everyone) - F.coalesce(F.sum("stop").over(before), F.lit(0.0))) / (
        F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    found = weighed.withColumn("level", level)
    # the first source, in order of "at", which its level doesn't stop sets the level of all after it; of equal "at" the first has the highest level
    found = found.withColumn("level", -F.min(F.when(F.col("level") < F.col("at"), F.struct("at", (-F.col("level")).alias("down")))).over(everyone)["down"])
    return found.select("source", "source_size", F.least("stop", F.coalesce(F.col("level") * F.col("weight"), F.col("stop"))).alias("target"))


def _digits(hashed: Column, level: int) -> Column:
    """The first ``level`` * BITS bits."""
    return F.shiftright(hashed, (LEVELS - level) * BITS)


def _draws(seed: int, row: str = "") -> tuple[Column, Column]:
    """LEVELS * BITS bits of the MD5 of seed, doc_id and text, which SQL engines have too, and 32 more; nulls are left out."""
    whole = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(f"{row}doc_id").cast("string"), F.col(f"{row}text")).cast("binary"))
    first, more = [F.conv(F.substring(whole, at, 8), 16, 10).cast("long") for at in (1, 9)]
    return F.shiftright(first, 32 - LEVELS * BITS), more


def _size(row: str = "") -> Column:
    return F.coalesce(F.regexp_count(f"{row}text", F.lit(WORDS)), F.lit(0)).cast("long")


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    hashed, more = _draws(seed)
    return stage(docs.select("doc_id", "source", hashed.alias("hashed"), more.alias("more"), _size().alias("size"), F.monotonically_increasing_id().alias("copy")), "mix")


def thresholds(sized: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """(source, hashed, size) -> one row per source: of (its name), source_size, target, whole, bound, rest.

    All documents of the source count ``whole`` times, those whose hash is below ``bound`` once more, and of those
    whose hash is ``bound`` as many as come nearest to ``rest`` words; rest is null where none is at the bound.
    """
    goals = stage(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most), "mix-goals")
    goals = goals.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    goals = goals.withColumn("whole", F.least("whole", F.lit(most)).cast("int"))
    # left: the words still to fill
    state = goals.withColumn("left", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0))).withColumn("bound", F.lit(0).cast("long"))
    for level in range(1, LEVELS + 1):
        known = small(state.select(F.col("source").alias("of"), "bound", "left"))
        inside = sized.join(known, F.col("source").eqNullSafe(F.col("of")) & (_digits(F.col("hashed"), level - 1) == F.col("bound") if level > 1 else F.lit(True)))
        sums = inside.groupBy("of", "left", _digits(F.col("hashed"), level).alias("next")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("of").orderBy("next"))  # 2^BITS rows for each source
        crossed = sums.withColumn("upto", upto).filter(F.col("upto") > F.col("left"))
        crossed = crossed.groupBy("of").agg(F.min(F.struct("next", (F.col("left") - (F.col("upto") - F.col("words"))).alias("rest"), "words")).alias("cut"))
        joined = state.join(crossed, F.col("source").eqNullSafe(F.col("of")), "left")
        state = joined.select(
            *goals.columns,
            # nothing crossed: all of the bucket, or of the source, is taken
            F.coalesce(F.col("cut.next"), F.shiftleft(F.col("bound") + 1, BITS)).alias("bound"),
            F.coalesce(F.col("cut.rest"), F.lit(0.0)).alias("left"),
            F.coalesce(F.col("cut.words"), F.lit(0)).alias("last"),
        )
        state = stage(state, "mix-level")
    rest = F.when((F.col("last") > 0) & (F.col("whole") < most), F.col("left"))
    return state.select(F.col("source").alias("of"), "source_size", "target", "whole", "bound", rest.alias("rest"))


def _with_reps(rows: DataFrame, most: int) -> DataFrame:
    """Rows with hashed, more, copy, size and their source's thresholds -> the same with reps.

    Rows at the bound are taken in the order of ``more``, then of ``copy``, which tells equal rows apart, while at least
    half of the row fits. Their running sums are made over ranges of that order, so a group of copies is not one task.
    """
    at_bound = F.col("rest").isNotNull() & (F.col("hashed") == F.col("bound"))
    known = rows.filter(~at_bound).withColumn("reps", F.col("whole") + ((F.col("hashed") < F.col("bound")) & (F.col("whole") < most)).cast("int"))
    ordered = rows.filter(at_bound).withColumn("order_", F.struct("more", "copy"))
    spent = running_sum(ordered, "size", "of", "order_").drop("order_")
    fits = F.col("spent") * 2 - F.col("size") <= F.col("rest") * 2
    return known.unionByName(spent.withColumn("reps", F.col("whole") + fits.cast("int")).drop("spent"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 7) -> DataFrame:
    """Documents -> doc_id, source, size, source_size, target, reps.

    ``reps`` is how often the mix takes a document: the whole part of target / source_size for all of a
    source, and one more below the threshold. Null text: size 0. Null source: a source of its own.
    The hash covers doc_id and text, so reruns agree; of equal rows, which may differ in ``reps`` by one, as
    many are taken as fit. The words taken miss the target by half of one document at most.
    A document never counts more than ``most`` times. An empty table gives an empty result.
    """
    sized = _sized(docs, seed)
    goal = small(thresholds(sized, weights, most))
    found = _with_reps(sized.join(goal, F.col("source").eqNullSafe(F.col("of"))), most)
    return found.select("doc_id", "source", "size", "source_size", "target", "reps")


def repeated(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 7) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as mix() takes it, with its own columns; only texts at a source's bound are shuffled."""
    goal = small(thresholds(_sized(docs, seed), weights, most).select("of", "whole", "bound", "rest"))
    joined = docs.alias("t").join(goal.alias("g"), F.col("t.source").eqNullSafe(F.col("g.of")))
    hashed, more = _draws(seed, "t.")
    rows = joined.select(F.struct("t.*").alias("row"), "g.*", hashed.alias("hashed"), more.alias("more"), F.monotonically_increasing_id().alias("copy"), _size("t.").alias("size"))
    # sequence(1, 0) would count down, so documents that aren't taken go first
    taken = _with_reps(rows, most).filter("reps > 0").select("row", "reps")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("reps")))).select("row.*")
