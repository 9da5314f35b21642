"""Rolling aggregates over range frames in seconds (both ends inclusive, ties on the time included)."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.functions import HOUR, bucket_of, safe_div, safe_sqrt, square
from tallywire.operators.skew import HOT_SLIDING, same_keys, split_hot

Frames = dict[str, tuple[int, int]]

#: aggregate name -> the part it takes in a column name
SHORT = {"count": "cn", "sum": "sum", "avg": "avg", "std": "std", "isnew": "isnew"}


def range_windows(keys: Sequence[str], time: str, frames: Frames, prefix: str = "") -> dict[str, WindowSpec]:
    """One window per frame, named `{prefix}_{frame}`."""
    base = Window.partitionBy(*keys).orderBy(time)
    head = f"{prefix}_" if prefix else ""
    return {f"{head}{name}": base.rangeBetween(lo, hi) for name, (lo, hi) in frames.items()}


Columns = dict[str, Column]


def rolling_columns(
    keys: Sequence[str], time: str, target: str, frames: Frames, aggs: Sequence[str], prefix: str = ""
) -> tuple[Columns, Columns]:
    """Window columns each computed once, and the result columns made from them.

    Result order per frame: count, sum, avg, std, first-seen flag.
    """
    raw: Columns = {}
    made: Columns = {}
    until = Window.partitionBy(*keys).orderBy(time)
    for (name, window), (lo, hi) in zip(range_windows(keys, time, frames, prefix).items(), frames.values()):
        count, total, std = (f"_{a}_{target}_{name}" for a in ("count", "sum", "std"))
        last = f"_last_{prefix}_{abs(hi)}"
        if {"count", "avg"} & set(aggs):
            raw[count] = F.count(F.lit(1)).over(window)
        if {"sum", "avg"} & set(aggs):
            raw[total] = F.sum(target).over(window)
        if "std" in aggs:
            raw[std] = F.stddev_samp(target).over(window)
        if "isnew" in aggs:
            # the latest earlier time is a running frame: linear in the rows, and shared by the frames
            raw[last] = F.max(time).over(until.rangeBetween(Window.unboundedPreceding, hi))
        results = {
            "count": F.col(count),
            "sum": F.col(total),
            "avg": safe_div(total, count),
            "std": F.col(std),
            "isnew": F.when(F.col(last) >= F.col(time) + lo, 0).otherwise(1),
        }
        made.update({f"{target}_{SHORT[a]}_{name}": c for a, c in results.items() if a in aggs})
    return raw, made


def with_windows(df: DataFrame, raw: Columns, made: Columns) -> DataFrame:
    wide = df.select("*", *[c.alias(n) for n, c in raw.items()])
    return wide.select(*df.columns, *[c.alias(n) for n, c in made.items()])


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    target: str,
    frames: Frames,
    aggs: Sequence[str] = ("count", "avg"),
    prefix: str = "",
    hot_rows: int | None = HOT_SLIDING,
) -> DataFrame:
    """Add `{target}_{cn,sum,avg,std,isnew}_{prefix}_{frame}` for each frame.

    Average is sum over row count and null on an empty frame, `std` the sample deviation. Keys with more
    than `hot_rows` rows take `rolling_by_second`; the results are the same.
    """
    cold, hot = split_hot(df, list(keys), hot_rows)
    out = with_windows(cold, *rolling_columns(keys, time, target, frames, aggs, prefix))
    if hot is None:
        return out
    extra = rolling_by_second(hot, keys, time, target, frames, aggs, prefix)
    return out.unionByName(same_keys(hot, extra, [*keys, time]).select(*out.columns))


# --- hot keys ---------------------------------------------------------------------------------
#
# A range frame depends on (key, second) only, so rows are folded to seconds first. A frame
# [t+lo, t+hi] then falls into three parts:
#
#     the end of the bucket of t+lo | whole buckets between | the start of the bucket of t+hi
#
# The outer parts come from running frames inside each (key, bucket), read at the probe times t+lo and
# t+hi; the middle from a frame over the small bucket table. No group holds more rows than a bucket has
# seconds times the number of probes, however many rows the key has.
#
# Spread is carried as (n, mean, m2); parts are pooled around their common mean, so no large squares are
# subtracted. Inside a bucket, running sums are taken around a value that lies in every frame that ends there
# (the bucket's last second for ends, its first for starts): m2 then loses at most the digits of the number
# of seconds in a bucket.

_SUMS = ("rows", "vals", "sum")


def _moments(n: Column, mean: Column, m2: Column) -> Column:
    return F.struct(n.cast("double").alias("n"), mean.alias("mean"), m2.alias("m2"))


def _running(window: WindowSpec, head: str, around: str | None) -> tuple[Columns, Column]:
    """Window columns of a running frame of seconds inside a bucket, each computed once, and what the frame holds;
    extremes and spread only where a deviation is asked for, the spread from sums around a value of the frame."""
    raw = {f"{head}_{p}": F.sum(f"_{p}").over(window) for p in _SUMS}
    held = [F.col(f"{head}_{p}").alias(p) for p in _SUMS]
    if around:
        apart = F.col("_mean") - F.col(around)
        raw[f"{head}_min"], raw[f"{head}_max"] = F.min("_min").over(window), F.max("_max").over(window)
        raw[f"{head}_gap"] = F.sum(F.col("_vals") * apart).over(window)
        raw[f"{head}_off"] = F.sum(F.col("_vals") * (F.col("_var") + square(apart))).over(window)
        n, gap = F.col(f"{head}_vals"), F.col(f"{head}_gap")
        spread = _moments(n, F.col(around) + safe_div(gap, n), F.col(f"{head}_off") - safe_div(square(gap), n))
        held += [F.col(f"{head}_min").alias("min"), F.col(f"{head}_max").alias("max"), spread.alias("spread")]
    return raw, F.struct(*held)


def _centre(parts: Sequence[Column]) -> Column:
    """Common mean of moments; parts without values have n 0 or are null."""
    n, total = (sum((F.when(p["n"] > 0, x).otherwise(0.0) for p, x in pairs), F.lit(0.0)) for pairs in (
        [(p, p["n"]) for p in parts], [(p, p["n"] * p["mean"]) for p in parts]))
    return safe_div(total, n)


def _apart(part: Column, centre: Column) -> Column:
    """Squares of a part around the common mean."""
    return part["m2"] + part["n"] * square(part["mean"] - centre)


def _facts(target: str, deviation: bool) -> list[Column]:
    """What the rows of a second or a bucket fold to."""
    values = F.col(target)
    return [
        F.count(F.lit(1)).alias("_rows"),
        F.count(values).alias("_vals"),
        F.sum(values).alias("_sum"),
        *([F.avg(values).alias("_mean"), F.var_pop(values).alias("_var"), F.min(values).alias("_min"), F.max(values).alias("_max")] if deviation else []),
    ]


def rolling_by_second(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    target: str,
    frames: Frames,
    aggs: Sequence[str] | dict[str, Sequence[str]],
    prefix: str = "",
) -> DataFrame:
    """The rolling columns once per (keys, time), by the bucket decomposition above; `aggs` of all frames or by frame."""
    keys = list(keys)
    by_frame = aggs if isinstance(aggs, dict) else {name: aggs for name in frames}
    sliding = {name: [a for a in asked if a != "isnew"] for name, asked in by_frame.items()}
    if not any(sliding.values()):
        out = df.select(*keys, time).distinct()
    else:
        out = _three_part_frames(df, keys, time, target, {n: f for n, f in frames.items() if sliding[n]}, sliding, prefix)
    flagged = {n: f for n, f in frames.items() if "isnew" in by_frame[n]}
    if flagged:
        out = with_windows(out, *rolling_columns(keys, time, target, flagged, ["isnew"], prefix))
    return out


def _three_part_frames(
    df: DataFrame,
    keys: list[str],
    time: str,
    target: str,
    frames: Frames,
    aggs: dict[str, Sequence[str]],
    prefix: str,
) -> DataFrame:
    # both ends of a frame must fall into different buckets, or be the same second
    width = max(1, min(HOUR, min(hi - lo for lo, hi in frames.values())))
    offsets = sorted({o for frame in frames.values() for o in frame} - {0})
    spreads = [name for name in frames if "std" in aggs[name]]
    facts = _facts(target, bool(spreads))
    # a struct equals another with the same nulls: one plain key that folds, windows and joins share
    df = df.select(F.struct(*keys).alias("_key"), time, target)
    place = lambda at: F.struct("_key", bucket_of(at, width).alias("_cell"))
    seconds = df.groupBy("_key", time).agg(*facts)
    cells = df.groupBy(place(time).alias("_place")).agg(*facts)

    # every second stands on the line once with its data, which is also the probe at its own time, and once per other
    # offset as a probe at time + offset; a probe in a bucket without data finds nothing and is left out
    is_data = F.col("_offset") == 0
    line = seconds.select("*", F.explode(F.array(*[F.lit(o) for o in (0, *offsets)])).alias("_offset")).select(
        F.col(time).alias("_origin"),
        "_offset",
        (F.col(time) + F.col("_offset")).alias("_at"),
        place(F.col(time) + F.col("_offset")).alias("_place"),
        *[F.when(is_data, F.col(c)).alias(c) for c in seconds.columns if c not in ("_key", time)],
    )
    line = line.join(cells.select("_place"), "_place", "left_semi")
    inside = Window.partitionBy("_place")
    whole = inside.orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if spreads:
        line = line.withColumns(
            {"_first": F.first("_mean", True).over(whole), "_last": F.last("_mean", True).over(whole)}
        )
    # "since" runs backwards in time, because a frame up to unboundedFollowing is recomputed per row
    upto = inside.orderBy("_at").rangeBetween(Window.unboundedPreceding, 0)
    since = inside.orderBy(F.desc("_at")).rangeBetween(Window.unboundedPreceding, 0)
    raw_end, at_end = _running(upto, "_upto", "_first" if spreads else None)
    raw_start, at_start = _running(since, "_since", "_last" if spreads else None)
    line = line.select("_place", "_origin", "_offset", *(["_first", "_last"] if spreads else []), *[c.alias(n) for n, c in {**raw_end, **raw_start}.items()])
    edges = (
        line.select(F.col("_place._key").alias("_key"), "_origin", "_offset", at_end.alias("upto"), at_start.alias("since"))
        .select(place("_origin").alias("_place"), "_origin", "_offset", "upto", "since")
        .repartition("_place")
        .groupBy("_place", "_origin")
        .agg(F.map_from_entries(F.collect_list(F.struct("_offset", F.struct("upto", "since")))).alias("_edges"))
    )

    # whole buckets between the two edges, relative to the bucket of the current second
    by_cell = Window.partitionBy("_key").orderBy("_cell")
    own = F.when(F.col("_vals") > 0, _moments(F.col("_vals"), F.col("_mean"), F.col("_var") * F.col("_vals")))

    def shifts(offset: int) -> list[int]:
        return sorted({offset // width * width, -(-offset // width) * width})

    middles = {
        (name, a, b): by_cell.rangeBetween(a + width, b - width)
        for name, (lo, hi) in frames.items()
        for a in shifts(lo)
        for b in shifts(hi)
        if b - a >= 2 * width
    }
    labels = {k: f"_mid_{i}" for i, k in enumerate(middles)}
    raw: Columns = {}
    for key, window in middles.items():
        label = labels[key]
        raw.update({f"{label}_{p}": F.sum(f"_{p}").over(window) for p in _SUMS})
        if key[0] in spreads:
            raw[f"{label}_min"], raw[f"{label}_max"] = F.min("_min").over(window), F.max("_max").over(window)
            raw[f"{label}_all"] = F.sum(F.col("_vals") * F.col("_mean")).over(window)
            raw[f"{label}_own"] = F.collect_list("_own").over(window)
    cells = cells.select("_place", "_place.*", *[c for c in cells.columns if c != "_place"], *([own.alias("_own")] if spreads else []))
    cells = cells.select("_place", *[c.alias(n) for n, c in raw.items()])
    means = {f"{labels[k]}_mean": safe_div(f"{labels[k]}_all", f"{labels[k]}_vals") for k in middles if k[0] in spreads}
    cells = cells.select("*", *[c.alias(n) for n, c in means.items()])

    def middle_of(key: tuple[str, int, int]) -> Column:
        label = labels[key]
        held = [F.col(f"{label}_{p}").alias(p) for p in _SUMS]
        if key[0] in spreads:
            mean = F.col(f"{label}_mean")
            m2 = F.aggregate(f"{label}_own", F.lit(0.0), lambda s, x: s + _apart(x, mean))
            held += [F.col(f"{label}_{p}").alias(p) for p in ("min", "max")]
            held.append(_moments(F.col(f"{label}_vals"), mean, m2).alias("spread"))
        return F.struct(*held)

    cells = cells.select("_place", *[middle_of(k).alias(label) for k, label in labels.items()])

    joined = edges.join(cells, "_place", "left").withColumn("_cell", F.col("_place._cell"))
    parts: dict[str, list[Column]] = {}
    for name, (lo, hi) in frames.items():
        left = F.col("_edges")[lo]["since"]
        right = F.col("_edges")[hi]["upto"] if hi > lo else None
        step_lo = bucket_of(F.col("_origin") + lo, width) - F.col("_cell")
        step_hi = bucket_of(F.col("_origin") + hi, width) - F.col("_cell")
        middle = None
        for (frame, a, b), label in labels.items():
            if frame == name:
                here = (step_lo == a) & (step_hi == b)
                middle = F.when(here, F.col(label)) if middle is None else middle.when(here, F.col(label))
        parts[name] = [p for p in (left, middle, right) if p is not None]
    # the parts and their common mean stand in columns of their own, so that results refer to them instead of repeating them
    held = {f"_part_{n}_{i}": p for n, found in parts.items() for i, p in enumerate(found)}
    parted = joined.select("_place", F.col("_origin").alias(time), *[c.alias(n) for n, c in held.items()])
    parts = {n: [F.col(f"_part_{n}_{i}") for i in range(len(found))] for n, found in parts.items()}
    centres = {f"_centre_{n}": _centre([p["spread"] for p in parts[n]]) for n in spreads}
    parted = parted.select("*", *[c.alias(n) for n, c in centres.items()])
    made: dict[str, Column] = {}
    for name, found in parts.items():
        label = f"{prefix}_{name}" if prefix else name
        made.update(_finish(found, f"_centre_{name}", target, label, aggs[name], seconds.schema["_sum"].dataType))
    return parted.select(*[F.col("_place._key")[k].alias(k) for k in keys], time, *[c.alias(n) for n, c in made.items()])


def _finish(
    parts: Sequence[Column], centre: str, target: str, name: str, aggs: Sequence[str], sum_type: T.DataType
) -> dict[str, Column]:
    def total(field: str) -> Column:
        kind = sum_type if field == "sum" else "bigint"
        out = zero = F.lit(0).cast(kind)
        for p in parts:
            out = (out + F.coalesce(p[field], zero)).cast(kind)
        return out

    vals = total("vals")
    sum_ = F.when(vals > 0, total("sum"))
    made = {"count": total("rows"), "sum": sum_, "avg": safe_div(sum_, total("rows"))}
    if "std" in aggs:
        # a constant frame has deviation 0 exactly, not rounding noise
        constant = F.array_min(F.array(*[p["min"] for p in parts])) == F.array_max(F.array(*[p["max"] for p in parts]))
        spreads = [p["spread"] for p in parts]
        m2 = sum((F.when(s["n"] > 0, _apart(s, F.col(centre))).otherwise(0.0) for s in spreads), F.lit(0.0))
        deviation = safe_sqrt(safe_div(m2, vals - 1))
        made["std"] = F.when(vals > 1, F.when(constant, 0.0).otherwise(deviation))
    return {f"{target}_{SHORT[a]}_{name}": c for a, c in made.items() if a in aggs}
