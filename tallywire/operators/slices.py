"""Batch bounds and range slices. All ranges are half-open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.functions import DAY, MONTH, WEEK, as_col, week_of, date_of
from tallywire.operators.features import LONGEST_LOOKBACK


def span(df: DataFrame, col: str) -> DataFrame:
    """Smallest and largest value in one pass."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def slice_range(df: DataFrame, col: str, lo, hi, week: str | None = None, date: str | None = None) -> DataFrame:
    """Rows with lo <= col < hi; with `week` or `date` the partition column is cut as well, which prunes files."""
    df = df.where((F.col(col) >= lo) & (F.col(col) < hi))
    if week:
        df = df.where(F.col(week).between(week_of(F.lit(lo)), week_of(F.lit(hi))))
    if date:
        df = df.where(F.col(date).between(date_of(F.lit(lo)), date_of(F.lit(hi))))
    return df


def with_clean_bounds(
    row: DataFrame,
    old: int | Column = 0,
    record_limit: int = 1_000_000,
    overlap: int = 1_000_000,
    batch: int = 0,
    first_batch: int | None = None,
) -> DataFrame:
    """Ids to clean next, from a row (min_value, max_value): columns start_id, end_id, keep_from.

    The first run takes everything (or `first_batch` ids). Later runs need `record_limit` new ids, start
    `overlap` before the old end so that duplicates across the seam meet, and keep ids from the old end on.
    All three are null when there is not enough data.
    """
    lo, hi, old = as_col("min_value"), as_col("max_value"), _lit(old)
    first = old <= 0
    enough = first | (hi - old >= record_limit)
    first_end = lo + first_batch if first_batch else hi
    next_end = F.least(old + batch, hi) if batch > 0 else hi
    return row.withColumns(
        {
            "start_id": F.when(enough, F.when(first, lo).otherwise(old - overlap)).cast("bigint"),
            "end_id": F.when(enough, F.when(first, first_end).otherwise(next_end)).cast("bigint"),
            "keep_from": F.when(enough, F.when(first, lo).otherwise(old)).cast("bigint"),
        }
    )


def with_feature_bounds(
    row: DataFrame,
    old: int | Column = 0,
    overlap: int = LONGEST_LOOKBACK,
    time_limit: int = DAY,
    batch: int = MONTH,
    first_batch: int = MONTH,
) -> DataFrame:
    """Times to compute features for: columns start_time, end_time, good_time (null: not enough data).

    Later runs need `overlap` of history and `time_limit` of new data. The first run needs more than
    overlap + batch and takes the latest batch. Rows before good_time only feed the windows.
    """
    lo, hi, old = as_col("min_value"), as_col("max_value"), _lit(old)
    first = old <= 0
    longest = max(first_batch, batch)
    enough = F.when(first, hi - lo > overlap + longest).otherwise(
        (old - lo >= overlap) & (hi - old >= time_limit)
    )
    next_end = F.least(old + batch, hi) if batch > 0 else hi
    start = F.when(first, hi - longest - overlap).otherwise(old - overlap)
    return row.withColumns(
        {
            "start_time": F.when(enough, start).cast("bigint"),
            "end_time": F.when(enough, F.when(first, hi).otherwise(next_end)).cast("bigint"),
            "good_time": F.when(enough, start + overlap).cast("bigint"),
        }
    )


def gaps(lo: int, hi: int, covered: list[tuple[int, int]], batch: int, least: int = 1) -> list[tuple[int, int]]:
    """Half-open batches of at most `batch` seconds that fill [lo, hi) around the `covered` intervals, oldest first.

    A last batch shorter than `least` is left for later, when more has arrived.
    """
    found, at = [], lo
    for start, end in [*sorted(covered), (hi, hi)]:
        while at < min(start, hi):
            stop = min(at + batch, start, hi)
            if stop < hi or stop - at >= least:
                found.append((at, stop))
            at = stop
        at = max(at, end)
    return found


def with_learning_range(
    row: DataFrame, learn: int = WEEK, min_predict: int = DAY, max_predict: int = 2 * DAY
) -> DataFrame:
    """Training range: the last `learn` seconds plus a predict period; null when the span is too short."""
    lo, hi = as_col("min_value"), as_col("max_value")
    predict = (
        F.when(hi - lo >= learn + max_predict, max_predict)
        .when(hi - lo >= learn + min_predict, min_predict)
        .cast("bigint")
    )
    return row.withColumns(
        {
            "predict_period": predict,
            "start_time": (hi - learn - predict).cast("bigint"),
            "end_time": F.when(predict.isNotNull(), hi).cast("bigint"),
        }
    )


def _lit(value: int | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
