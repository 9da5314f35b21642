"""Cleaning: corrupt rows, sentinels, validity, dedup, quality report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.functions import UNKNOWN, epoch, parse_tx_time, week_of
from tallywire.schemas import CORRUPT

SENTINEL_COLUMNS = ["customer_id", "terminal_id", "tx_fraud_scenario", "tx_time_seconds", "tx_time_days"]


def drop_corrupt(df: DataFrame) -> DataFrame:
    return df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt_report(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("corrupt_rows"),
    )


def with_sentinels(df: DataFrame, cols: Sequence[str] = SENTINEL_COLUMNS, value: int = UNKNOWN) -> DataFrame:
    """Null and negative values become `value`."""
    return df.withColumns({c: F.when(F.col(c) >= 0, F.col(c)).otherwise(value) for c in cols})


def parse_time(df: DataFrame, col: str = "tx_datetime") -> DataFrame:
    return df.withColumn(col, parse_tx_time(col))


def is_valid() -> Column:
    """The row rules apart from uniqueness. Null never passes."""
    return (
        (F.col("transaction_id") >= 0)
        & F.col("tx_datetime").isNotNull()
        & (F.col("tx_amount") >= 0)
        & F.col("tx_fraud").isin(0, 1)
    )


def valid(df: DataFrame) -> DataFrame:
    return df.where(is_valid())


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key, the first in `order` (default: all other columns, so the result is fixed).

    Each map task keeps one row per key before the shuffle (Spark's window group limit), so a key with
    very many copies reaches its reducer as one row per task.
    """
    order = order or [c for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where(F.col("_rn") == 1).drop("_rn")


def quality_report(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows, duplicates and bad values, counted after `with_sentinels` and `parse_time`.

    Folded by key first, so duplicates come from map-side counts and not from a window.
    """

    def bad(condition: Column) -> Column:
        return F.sum(F.when(condition, 1).otherwise(0))

    not_ok = {
        "bad_transaction_id": ~F.coalesce(F.col("transaction_id") >= 0, F.lit(False)),
        "bad_tx_datetime": F.col("tx_datetime").isNull(),
        "bad_customer_id": F.col("customer_id") == UNKNOWN,
        "bad_terminal_id": F.col("terminal_id") == UNKNOWN,
        "bad_tx_amount": ~F.coalesce(F.col("tx_amount") >= 0, F.lit(False)),
        "bad_tx_time_seconds": F.col("tx_time_seconds") == UNKNOWN,
        "bad_tx_time_days": F.col("tx_time_days") == UNKNOWN,
        "bad_scenario_id": F.col("tx_fraud_scenario") == UNKNOWN,
        "bad_tx_fraud": ~F.coalesce(F.col("tx_fraud").isin(0, 1), F.lit(False)),
    }
    per_key = df.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"), *[bad(c).alias(n) for n, c in not_ok.items()]
    )
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_after_clean"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicates"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in not_ok],
    )


def with_clean_time(df: DataFrame) -> DataFrame:
    """Epoch seconds and week of the parsed time."""
    df = df.withColumn("unix_time", epoch("tx_datetime"))
    return df.withColumn("week", week_of("unix_time"))


def clean_rows(df: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Raw rows (with the corrupt column) to the clean table. Copies of an id are compared after validation, so a
    broken copy never displaces a valid one."""
    df = valid(with_sentinels(parse_time(drop_corrupt(df))))
    df = dedup(df, ["transaction_id"], order)
    return with_clean_time(df.withColumn("tx_fraud", F.col("tx_fraud").cast("boolean")))
