"""Mixing sources to target weights by a time-varying curriculum.

Each source gets a number of words (its target) and a schedule: how its weight runs over training time 0 … 1. The
integral of the schedule is the cumulative demand for the source; documents of a source stand in a fixed pseudo-random
order, and a document is trained when the demand reaches the words before it, so inverting the demand gives its
position. Sorting by position mixes the sources. A target above the size of the source repeats the documents in
further passes; the last pass is cut where the target is reached.

Running sums never put a source into one task: documents fall into hash buckets, the sums of the buckets are
accumulated (one row per source and bucket), and only inside a bucket rows are ordered.

Edge cases: null and empty texts have size 0 and are never taken. Null is a source of its own, last in order. Repeated
rows count as often as they stand. A table without words has targets 0. pass_no and position replace columns of these
names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.llm.text import packed, text_key, unpacked, words_of, written

#: (training time, weight) knots of the schedules dealt to the sources in turn: falling, even, rising
SCHEDULES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.25), (0.5, 1.0), (1.0, 1.75)))


def source_targets(sizes: DataFrame, weights: Sequence[int], max_repeats: int) -> DataFrame:
    """source, source_size -> + _order, target: shares by weight, none above max_repeats times its source.

    `sizes` has one row per source. Sources fill up in the order of size per weight: a source is full if, with all
    sources before it full, its share of the rest would still pass its bound. All figures before the last
    division are whole numbers, so the same targets come out on every engine.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.lit(list(weights)), (F.col("_order") % len(weights) + 1).cast("int")).cast("long")
    rows = sizes.withColumn("_order", F.row_number().over(by_name) - 1).withColumns(
        {"_weight": weight, "_bound": F.col("source_size") * max_repeats}
    )
    fill = Window.orderBy(F.col("_bound") / F.col("_weight"), "_order")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumns(
        {
            "_left": F.sum("source_size").over(every) - F.coalesce(F.sum("_bound").over(before), F.lit(0)),
            "_weights": F.sum("_weight").over(rest),
        }
    ).withColumn("_full", F.col("_left") * F.col("_weight") >= F.col("_bound") * F.col("_weights"))
    # the first source that is not full sets the level for all that are not
    level = Window.orderBy(F.col("_full").asc(), F.col("_bound") / F.col("_weight"), "_order").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    share = F.first("_left").over(level) * F.col("_weight") / F.first("_weights").over(level)
    return rows.withColumn("target", F.when(F.col("_full"), F.col("_bound").cast("double")).otherwise(share)).select(
        "source", "source_size", "_order", "target"
    )


def _at(schedules: Sequence, order: Column) -> Column:
    return F.element_at(
        F.array(*[F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in s]) for s in schedules]),
        (order % len(schedules) + 1).cast("int"),
    )


def _integrals(knots: Column) -> Column:
    """Segments of a schedule: start, length, weight at the start, slope, integral before; trapezes add up."""
    segment = F.transform(
        F.arrays_zip(F.slice(knots, F.lit(1), F.size(knots) - 1).alias("p"), F.slice(knots, F.lit(2), F.size(knots) - 1).alias("q")),
        lambda x: F.struct(
            x["p"]["t"].alias("t"),
            x["p"]["w"].alias("w"),
            ((x["q"]["w"] - x["p"]["w"]) / (x["q"]["t"] - x["p"]["t"])).alias("slope"),
            ((x["p"]["w"] + x["q"]["w"]) / 2 * (x["q"]["t"] - x["p"]["t"])).alias("area"),
        ),
    )
    return segment


def invert_demand(knots: Column, share: Column) -> Column:
    """Training time at which the schedule has used `share` (0 … 1) of its whole integral."""
    segments = _integrals(knots)
    total = F.aggregate(segments, F.lit(0.0), lambda s, x: s + x["area"])
    start = F.struct(
        (share * total).alias("left"), F.lit(None).cast("double").alias("t"), F.lit(0.0).alias("last")
    )

    def step(s: Column, x: Column) -> Column:
        # w d + slope d² / 2 = left; the form below is right for slope 0 and loses no digits
        root = F.sqrt(F.greatest(x["w"] * x["w"] + 2 * x["slope"] * s["left"], F.lit(0.0)))
        inside = s["t"].isNull() & (s["left"] <= x["area"])
        time = x["t"] + F.coalesce(F.try_divide(2 * s["left"], x["w"] + root), F.lit(0.0))
        return F.struct(
            F.when(s["t"].isNull(), s["left"] - x["area"]).otherwise(s["left"]).alias("left"),
            F.when(inside, time).otherwise(s["t"]).alias("t"),
            F.lit(1.0).alias("last"),
        )

    return F.aggregate(segments, start, step, lambda s: F.coalesce(s["t"], s["last"]))


def take_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    max_repeats: int = 3,
    buckets: int = 4096,
) -> DataFrame:
    """One row per document: _id, source, size, source_size, target, _order, _before (words of the source ahead
    of it), _times (passes that take it), _last (end of the target in words of the source).

    A document belongs to the last pass if its middle lies before the end of the target. `buckets` bounds the
    rows that are ordered together: a 4096th of a source, by default.
    """
    # rows without an id are ordered by their texts, so they spread over the buckets too
    order = F.md5(F.coalesce(F.col(id_col).cast("string"), text_key(F.col(text_col)).cast("string")).cast("binary"))
    bucket = F.floor(F.conv(F.substring("_at", 1, 8), 16, 10).cast("long") * buckets / 2**32)
    rows = written(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("source"),
            F.size(words_of(F.col(text_col))).cast("long").alias("size"),
            order.alias("_at"),
        ).withColumn("_bucket", bucket.cast("int")),
        "sizes",
    )
    sums = rows.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_repeats)
    offsets = written(
        sums.alias("s").join(targets.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")))
        .select(F.col("s.source").alias("_source"), F.col("_bucket").alias("_b"), "_ahead", "source_size", "target", "_order"),
        "offsets",
    )
    inside = Window.partitionBy("source", "_bucket").orderBy("_at", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        rows.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_b")))
        .withColumn("_before", F.col("_ahead") + F.col("_inside"))
    )
    whole = F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeats))
    part = F.col("target") - whole * F.col("source_size")
    times = F.when(F.col("size") == 0, 0).otherwise(whole + F.when(F.col("_before") + F.col("size") / 2 < part, 1).otherwise(0))
    return placed.withColumn("_times", times.cast("long")).select(
        "_id", "source", "size", "source_size", "target", "_order", "_before", "_times"
    )


def training_positions(taken: DataFrame, schedules: Sequence = SCHEDULES) -> DataFrame:
    """One row per time a document is trained: + pass_no (from 0) and position in training time, 0 … 1."""
    passes = taken.where(F.col("_times") > 0).withColumn("pass_no", F.explode(F.sequence(F.lit(0), (F.col("_times") - 1).cast("int"))))
    done = F.col("pass_no") * F.col("source_size") + F.col("_before") + F.col("size") / 2
    share = F.least(done / F.col("target"), F.lit(1.0))
    return passes.withColumn("position", invert_demand(_at(schedules, F.col("_order")), share))


def training_order(taken: DataFrame, schedules: Sequence = SCHEDULES) -> DataFrame:
    """The passes of `take_documents` rows, range-sorted by position, ties by source and id."""
    return training_positions(taken, schedules).orderBy("position", "source", "_id", "pass_no")


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """One row per document: _id, source, size, source_size, target, and of its places in the training order _passes, first_position and
    last_position; documents that are never trained have no passes and null positions."""
    taken = written(take_documents(docs, id_col, text_col, source_col, **how), "taken")
    order = written(training_order(taken), "training-order")
    # a document with words is told by its source and the words ahead of it
    spots = order.groupBy(F.col("source").alias("_src"), F.col("_before").alias("_ahead")).agg(
        F.count(F.lit(1)).alias("_passes"), F.min("position").alias("first_position"), F.max("position").alias("last_position")
    )
    here = F.col("source").eqNullSafe(F.col("_src")) & (F.col("_before") == F.col("_ahead")) & (F.col("size") > 0)
    return taken.join(spots, here, "left").select(
        "_id", "source", "size", "source_size", "target", F.coalesce("_passes", F.lit(0)).cast("long").alias("_passes"), "first_position", "last_position"
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mixture: columns of `docs`, pass_no and position; range-sorted by position, ties by source and id.

    Rows that repeat id, source and size share the earliest of their positions.
    """
    names = ("_id", "source", "size", "pass_no")
    spots = training_positions(take_documents(docs, id_col, text_col, source_col, **how))
    spots = spots.groupBy(*names).agg(F.min("position").alias("_position"))
    spots = spots.select("_id", F.col("source").alias("_src"), F.col("size").alias("_size"), F.col("pass_no").alias("_pass"), "_position")
    size = F.size(words_of(F.col(text_col))).cast("long")
    tagged = docs.select(packed(docs), F.col(id_col).alias("_key"), F.col(source_col).alias("_key_src"), size.alias("_key_size"))
    same = F.col("_key").eqNullSafe(F.col("_id")) & F.col("_key_src").eqNullSafe(F.col("_src"))
    joined = tagged.join(spots, same & (F.col("_key_size") == F.col("_size")))
    ordered = joined.orderBy("_position", "_key_src", "_key", "_pass")
    return ordered.select(*unpacked(docs, pass_no=F.col("_pass"), position=F.col("_position")))
