"""Rolling aggregates over time buckets, for keys with many rows.

Rows are folded to one row per (key, bucket) with map-side combine; frames run over that table, whose
rows per key are bounded by the clock; a join on (key, bucket) brings the history back, and a running
frame inside the current bucket adds what the history leaves out.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.functions import HOUR, bucket_of, safe_div, safe_sqrt, square
from tallywire.operators.skew import HOT_RUNNING, hot_tags, same_keys, split_by_tags
from tallywire.operators.windows import Frames

BUCKET = "_bucket"
KEYS = "_keys"

#: which sums an aggregate needs
NEEDS = {
    "count": ("cnt",),
    "sum": ("sum",),
    "avg": ("cnt", "sum"),
    "std": ("cnt", "sum", "sq"),
}


@dataclass(frozen=True)
class BucketSpec:
    """Aggregates of one target over frames measured from the start of the current bucket."""

    target: str
    frames: Frames = field(hash=False)
    aggs: tuple[str, ...]
    prefix: str
    include_current: bool = True
    end_of_current: int = 0

    def needs(self) -> list[str]:
        wanted = {n for a in self.aggs for n in NEEDS[a]}
        return [n for n in ("cnt", "sum", "sq") if n in wanted]

    def column(self, agg: str, frame: str) -> str:
        return f"{self.prefix}_{self.target}_{agg}_{frame}"


def _measure(need: str, target: str) -> tuple[str, Column]:
    """Name and per-row value of a sum; the count is the same for all targets."""
    if need == "cnt":
        return "_b_cnt", F.lit(1)
    if need == "sum":
        return f"_b_sum_{target}", F.col(target)
    return f"_b_sq_{target}", square(target)


def _measures(specs: Sequence[BucketSpec], current_only: bool = False) -> dict[str, Column]:
    return dict(
        _measure(n, s.target) for s in specs if s.include_current or not current_only for n in s.needs()
    )


def bucket_agg(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    target: str,
    width: int = HOUR,
    aggs: Sequence[str] = ("count", "sum", "std"),
) -> DataFrame:
    """Count, sum and sum of squares per (keys, bucket)."""
    spec = BucketSpec(target, {}, tuple(aggs), "")
    return _bucket_table(df.withColumn(BUCKET, bucket_of(time, width)), list(keys), [spec])


def _bucket_table(df: DataFrame, keys: list[str], specs: Sequence[BucketSpec]) -> DataFrame:
    return df.groupBy(*keys, BUCKET).agg(*[F.sum(c).alias(n) for n, c in _measures(specs).items()])


def join_buckets(df: DataFrame, buckets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the aggregate of their bucket, null keys included. The bucket table grows with the data: no hint."""
    return same_keys(df, buckets, [*keys, BUCKET])


def bucket_running(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    measures: dict[str, Column],
    end: int = 0,
    hot_rows: int | None = HOT_RUNNING,
    plain: DataFrame | None = None,
) -> DataFrame:
    """Running sums of `measures` inside (keys, bucket), ties included; columns are named `_run…`.

    Buckets with more than `hot_rows` rows are folded to seconds first, which bounds them by `width`. `plain` are the
    same rows with the measured columns only, where `df` is costly: they are counted and folded in its place.
    """
    plain = df if plain is None else plain
    group = [*keys, BUCKET]
    window = Window.partitionBy(*group).orderBy(time).rangeBetween(Window.unboundedPreceding, end)
    tags = hot_tags(plain, group, hot_rows)
    cold, hot = (df, None) if tags is None else split_by_tags(df, tags, group)
    out = cold.select("*", *[F.sum(c).over(window).alias(f"_run{n}") for n, c in measures.items()])
    if hot is None:
        return out
    seconds = split_by_tags(plain, tags, group)[1].groupBy(*group, time).agg(*[F.sum(c).alias(n) for n, c in measures.items()])
    seconds = seconds.select(*group, time, *[F.sum(n).over(window).alias(f"_run{n}") for n in measures])
    return out.unionByName(same_keys(hot, seconds, [*group, time]).select(*out.columns))


def bucketed_multi(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    specs: Sequence[BucketSpec],
    width: int = HOUR,
    hot_rows: int | None = HOT_RUNNING,
    plain: DataFrame | None = None,
    narrow: DataFrame | None = None,
) -> DataFrame:
    """All specs from one bucket table, one window over it, one join and one running frame.

    Where `df` is costly, the bucket table is made from `narrow`, the same rows with the targets only, and the current
    buckets are counted and folded from `plain`, the same rows with the targets of specs that include the current bucket.

    Columns `{prefix}_{target}_{cn,sum,avg,std}_{frame}`; an empty frame gives 0, `std` is the population
    deviation. Equal to the same frames over the bucket start of every row.
    """
    ends = {s.end_of_current for s in specs if s.include_current}
    if len(ends) > 1:
        raise ValueError("specs that include the current bucket must share end_of_current")
    # a struct equals another with the same nulls: one plain key that windows, folds and joins share
    group = {KEYS: F.struct(*keys), BUCKET: bucket_of(time, width)}
    df, plain, narrow = (rows.withColumns(group) for rows in (df, df if plain is None else plain, df if narrow is None else narrow))
    keys = [KEYS]

    by_bucket = Window.partitionBy(*keys).orderBy(BUCKET)
    past: dict[str, Column] = {}
    for s in specs:
        for frame, (lo, hi) in s.frames.items():
            for need in s.needs():
                name, _ = _measure(need, s.target)
                past[f"_h{name}_{lo}_{hi}"] = F.sum(name).over(by_bucket.rangeBetween(lo, hi))
    buckets = _bucket_table(narrow, keys, specs).select(*keys, BUCKET, *[c.alias(n) for n, c in past.items()])

    running = _measures(specs, current_only=True)
    columns = df.columns
    if running:
        df = bucket_running(df, keys, time, running, ends.pop(), hot_rows, plain)
    df = df.join(buckets, [KEYS, BUCKET], "left")

    # totals first, results from the totals: shared values are computed once, and the generated methods
    # stay small enough for the JVM to compile
    keep = [c for c in columns if c not in (KEYS, BUCKET)]
    totals: dict[str, Column] = {}
    made: dict[str, Column] = {}
    for s in specs:
        for frame, (lo, hi) in s.frames.items():
            total: dict[str, Column] = {}
            for need in s.needs():
                name, _ = _measure(need, s.target)
                value = F.coalesce(F.col(f"_h{name}_{lo}_{hi}"), F.lit(0))
                if s.include_current:
                    value = value + F.coalesce(F.col(f"_run{name}"), F.lit(0))
                label = f"_t{name}_{lo}_{hi}_{s.include_current}"
                totals[label] = value
                total[need] = F.col(label)
            made.update(_finish(s, frame, total))
    df = df.select(*keep, *[c.alias(n) for n, c in totals.items()])
    return df.select(*keep, *[c.alias(n) for n, c in made.items()])


def _finish(s: BucketSpec, frame: str, total: dict[str, Column]) -> dict[str, Column]:
    out: dict[str, Column] = {}
    if "count" in s.aggs:
        out[s.column("cn", frame)] = total["cnt"]
    if "sum" in s.aggs:
        out[s.column("sum", frame)] = total["sum"]
    if "avg" in s.aggs:
        out[s.column("avg", frame)] = safe_div(total["sum"], total["cnt"], 0)
    if "std" in s.aggs:
        mean = safe_div(total["sum"], total["cnt"])
        spread = safe_div(total["sq"], total["cnt"]) - mean * mean
        out[s.column("std", frame)] = F.when(total["cnt"] > 1, safe_sqrt(spread)).otherwise(0.0)
    return out


def bucketed_rolling(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    target: str,
    frames: Frames,
    width: int = HOUR,
    aggs: Sequence[str] = ("count",),
    include_current: bool = True,
    end_of_current: int = 0,
    prefix: str = "",
    hot_rows: int | None = HOT_RUNNING,
) -> DataFrame:
    """One target over its frames; see `bucketed_multi`."""
    spec = BucketSpec(target, frames, tuple(aggs), prefix, include_current, end_of_current)
    return bucketed_multi(df, keys, time, [spec], width, hot_rows)
