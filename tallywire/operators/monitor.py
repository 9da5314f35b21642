"""Counters, latency histogram, fraud share, outlier trim, throughput, best run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.functions import safe_div
from tallywire.operators.skew import same_keys
from tallywire.operators.timeline import running_counts

# Default upper bounds of a latency histogram, in seconds.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]


def prediction_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("label", "version").agg(F.count(F.lit(1)).alias("n"))


def histogram(
    df: DataFrame, col: str, by: str | Sequence[Column] = "version", bounds: Sequence[float] = LATENCY_BOUNDS
) -> DataFrame:
    """Cumulative buckets per group: (by, le, bucket_count, total_sum, total_count), +Inf bucket included."""
    steps = [*bounds, float("inf")]
    groups = [F.col(by)] if isinstance(by, str) else list(by)
    folded = df.groupBy(*groups).agg(
        *[F.count_if(F.col(col) <= F.lit(float(b))).alias(f"_b{i}") for i, b in enumerate(steps)],
        F.sum(col).alias("total_sum"),
        F.count(col).alias("total_count"),
    )
    names = folded.columns[: len(groups)]
    buckets = F.array(
        *[F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("bucket_count")) for i, b in enumerate(steps)]
    )
    out = folded.select(*names, F.explode(buckets).alias("b"), "total_sum", "total_count")
    return out.select(*names, "b.le", "b.bucket_count", "total_sum", "total_count")


def fraud_share(
    df: DataFrame, ts: str, length: str = "5 minutes", slide: str | None = None, label: str = "label"
) -> DataFrame:
    """Percent of predictions labelled fraud per window of event time."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    frauds, n = F.count_if(F.col(label) == "fraud"), F.count(F.lit(1))
    return df.groupBy(window.alias("window")).agg(
        n.alias("n"), frauds.alias("frauds"), (safe_div(frauds, n) * 100).alias("fraud_percent")
    )


def trim_outliers(df: DataFrame, by: str, col: str, k: float = 3) -> DataFrame:
    """Rows at most k times the mean of their group; means are folded map-side and joined back."""
    means = df.groupBy(by).agg(F.avg(col).alias("_mean"))
    return same_keys(df, means, [by]).where(F.col(col) <= F.col("_mean") * k).drop("_mean")


def throughput(df: DataFrame, time: str = "unix_time") -> DataFrame:
    """(time, total, rate) per second seen: rows so far and rows so far / (seconds since the start + 1)."""
    start = df.agg(F.min(time).alias("t0")).scalar()
    counts = running_counts(df, time).withColumn("_start", start)
    return counts.select(
        time,
        F.col("upto").alias("total"),
        safe_div("upto", F.col(time) - F.col("_start") + 1).alias("rate"),
    )


def best_runs(df: DataFrame, metric: str, n: int = 1, tie: str = "run") -> DataFrame:
    """The n best runs by a metric, best first."""
    return df.orderBy(F.desc_nulls_last(metric), F.asc(tie)).limit(n)


def next_run_number(df: DataFrame) -> DataFrame:
    return df.agg((F.count(F.lit(1)) + 1).alias("run_number"))
