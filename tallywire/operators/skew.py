"""Hot keys and null-safe joins.

A window sends all rows of a key to one task. The operators therefore measure first which keys hold more
rows than one task should take, run the plain window on the rest, and give the hot keys a plan whose
groups are bounded by the clock (seconds or buckets), not by the number of rows. Both plans are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: rows of one key a sliding frame may see (its cost is rows x frame rows)
HOT_SLIDING = 50_000
#: rows of one key a running frame may see (its cost is linear)
HOT_RUNNING = 2_000_000
#: rows a side may have to be broadcast
BROADCAST_ROWS = 200_000


def same_keys(df: DataFrame, other: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on `keys` with null equal to null; the keys of `other` are dropped."""
    names = {k: f"_right_{k}" for k in keys}
    match: Column = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(r)) for k, r in names.items()])
    return df.join(other.withColumnsRenamed(names), match, how).drop(*names.values())


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the session's shuffle partitions, for work that costs far more per row than
    moving the row."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def hot_keys(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """Keys with more than `limit` rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > limit)


def hot_tags(df: DataFrame, keys: list[str], limit: int | None) -> DataFrame | None:
    """Hot keys with `_hot`, or None when there are none. Runs one narrow counting job; `limit=None` skips it."""
    if limit is None:
        return None
    hot = hot_keys(df, keys, limit)
    n = hot.limit(BROADCAST_ROWS + 1).count()
    if n == 0:
        return None
    tags = hot.select(*keys, F.lit(True).alias("_hot"))
    return F.broadcast(tags) if n <= BROADCAST_ROWS else tags


def split_by_tags(df: DataFrame, tags: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of hot keys."""
    tagged = same_keys(df, tags, keys)
    return (
        tagged.where(F.col("_hot").isNull()).drop("_hot"),
        tagged.where(F.col("_hot")).drop("_hot"),
    )


def split_hot(df: DataFrame, keys: list[str], limit: int | None) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys and rows of hot keys (None when there are none, the usual case).

    Runs one narrow counting job. `limit=None` skips it and treats every key as ordinary.
    """
    tags = hot_tags(df, keys, limit)
    return (df, None) if tags is None else split_by_tags(df, tags, keys)
