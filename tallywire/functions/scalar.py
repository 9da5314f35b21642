"""Column expressions. All give the same result with ANSI mode on or off and do their calendar
arithmetic on epoch seconds, i.e. in UTC, whatever the session time zone is."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MINUTE, HOUR, DAY = 60, 3600, 86400
WEEK, MONTH = 7 * DAY, 30 * DAY
UNKNOWN = -1

# Duration units and their seconds.
DURATION_UNITS = {
    "s": 1, "second": 1, "seconds": 1,
    "m": 60, "minute": 60, "minutes": 60,
    "h": 3600, "hour": 3600, "hours": 3600,
    "d": 86400, "day": 86400, "days": 86400,
}


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- null-safe arithmetic ---------------------------------------------------------------------


def safe_div(a: Column | str, b: Column | str, default=None) -> Column:
    """a / b, null (or `default`) when b is zero or either side is null."""
    out = F.try_divide(as_col(a).cast("double"), as_col(b).cast("double"))
    return out if default is None else F.coalesce(out, F.lit(float(default)))


def zero_if_null(c: Column | str) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def safe_sqrt(c: Column | str) -> Column:
    """Square root with rounding noise below zero cut off."""
    return F.sqrt(F.greatest(F.lit(0.0), as_col(c)))


def square(c: Column | str) -> Column:
    c = as_col(c).cast("double")
    return c * c


# --- time -------------------------------------------------------------------------------------


def parse_tx_time(c: Column | str) -> Column:
    """Text 'yyyy-MM-dd HH:mm:ss' to timestamp; midnight written as 24:00:00 becomes 23:59:59, other text null."""
    text = F.regexp_replace(as_col(c), "24:00:00", "23:59:59")
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))


def epoch(c: Column | str) -> Column:
    return F.unix_timestamp(as_col(c))


def from_epoch(c: Column | str) -> Column:
    return F.timestamp_seconds(as_col(c))


def _epoch_day(c: Column) -> Column:
    return F.floor(c / DAY).cast("int")


def date_of(c: Column | str) -> Column:
    """UTC date of epoch seconds."""
    return F.date_from_unix_date(_epoch_day(as_col(c)))


def week_of(c: Column | str) -> Column:
    """Midnight of the Monday of the week of epoch seconds."""
    return F.date_trunc("week", date_of(c))


def hour_of(c: Column | str) -> Column:
    return F.floor(F.pmod(as_col(c), F.lit(DAY)) / HOUR).cast("int")


def day_of_week(c: Column | str) -> Column:
    """1 = Sunday … 7 = Saturday."""
    return F.dayofweek(date_of(c))


def bucket_of(c: Column | str, width: int) -> Column:
    """Start of the bucket of `width` seconds that holds the value."""
    return (F.floor(as_col(c) / width) * width).cast("bigint")


def duration_seconds(c: Column | str) -> Column:
    """'1 minute', '2 hours', '10s' to seconds; 0 for an unknown unit, null when nothing matches."""
    text = F.lower(F.trim(as_col(c)))
    pattern = r"^(\d+)\s*([a-zA-Z]+)"  # fixed value: number, unit
    units = F.create_map(*[F.lit(x) for kv in DURATION_UNITS.items() for x in kv])
    per_unit = F.coalesce(F.try_element_at(units, F.regexp_extract(text, pattern, 2)), F.lit(0))
    amount = F.regexp_extract(text, pattern, 1).try_cast("bigint")
    return F.when(F.regexp_like(text, F.lit(pattern)), amount * per_unit)


# --- features ---------------------------------------------------------------------------------


def cyclic(c: Column | str, period: int) -> tuple[Column, Column]:
    angle = F.lit(2 * math.pi) * as_col(c) / period
    return F.sin(angle), F.cos(angle)


def is_round(c: Column | str) -> Column:
    """1 for a multiple of 100 (which covers multiples of 1000)."""
    return (as_col(c) % 100 == 0).cast("int")


def is_unknown(c: Column | str, value: int = UNKNOWN) -> Column:
    return (as_col(c) == value).cast("int")


def label_text(c: Column | str) -> Column:
    return F.when(as_col(c) == 1, "fraud").otherwise("normal")


def with_calendar(df: DataFrame, time: str = "unix_time") -> DataFrame:
    """Hour, day of week, night and weekend flags, date."""
    hour, dow = hour_of(time), day_of_week(time)
    return df.withColumns(
        {
            "hour": hour,
            "is_night": F.when(hour.between(0, 5), 1).otherwise(0),
            "day_of_week": dow,
            "is_weekend": F.when(dow.isin(1, 7), 1).otherwise(0),
            "date": date_of(time),
        }
    )


def with_cyclic(df: DataFrame, hour: str = "hour", day: str = "day_of_week") -> DataFrame:
    """Sine and cosine of the hour and the day of the week (`with_calendar`)."""
    hour_sin, hour_cos = cyclic(hour, 24)
    day_sin, day_cos = cyclic(day, 7)
    return df.withColumns({"hour_sin": hour_sin, "hour_cos": hour_cos, "day_sin": day_sin, "day_cos": day_cos})


# --- whole rows -------------------------------------------------------------------------------


def fill_numeric(df: DataFrame, value: float = 0) -> DataFrame:
    return df.fillna(value)


def feature_columns(df: DataFrame, exclude: Iterable[str]) -> list[str]:
    exclude = set(exclude)
    return [c for c in df.columns if c not in exclude]


def label_as(df: DataFrame, kind: str, label: str = "tx_fraud") -> DataFrame:
    """Label as 'boolean' or 'int'."""
    return df.withColumn(label, F.col(label).cast(kind))


def coerce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns cast to the widths of `schema`; values that do not fit become null."""
    targets = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(c).try_cast(targets[c]).alias(c) if c in targets else F.col(c) for c in df.columns])


def to_message(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One (key, value) text pair per row; value is the row as JSON, nulls left out."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
