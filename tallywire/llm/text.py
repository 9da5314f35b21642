"""Column expressions and small helpers that several operators share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.session import scratch_path

#: white space of the contracts: blank, and tab to carriage return
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """Maximal runs of anything but white space; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A to Z only. Texts without other bytes take the plain, faster function."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def trim_spaces(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def text_key(text: Column) -> Column:
    """Tells rows of one id apart: repeated rows share it, other texts of the same id do not."""
    return F.xxhash64(F.coalesce(text, F.lit("")), text.isNull())


def words_at(words: Column, positions: Column) -> Column:
    """The words at 0-based positions, in the order given."""
    return F.transform(positions, lambda i: F.get(words, i))


def kept_positions(size: Column, dropped: Column) -> Column:
    """0 … size - 1 without `dropped` (null: none), in order."""
    every = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    return F.when(dropped.isNull(), every).otherwise(F.array_except(every, dropped))


def packed(docs: DataFrame, *apart: str) -> Column:
    """_all: the columns of `docs` but those `apart`, in one struct, so that no working name can clash with theirs."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in apart]).alias("_all")


def unpacked(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of `docs` out of _all; `new` ones replace those of the same name or follow."""
    kept = [new[c].alias(c) if c in new else F.col("_all").getField(c).alias(c) for c in docs.columns]
    return kept + [column.alias(c) for c, column in new.items() if c not in docs.columns]


def written(df: DataFrame, name: str) -> DataFrame:
    """Write below the shared folder and read back: cuts the lineage, and lost executors do not matter."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ship_code(module: str) -> None:
    """Send the module's functions to the Python workers with the job, so executors need no copy of the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def once_per_worker(shared: Any, build: Callable[..., Any]) -> Any:
    """build(*args) for a broadcast {"args": …}; kept in the worker's copy, so its later tasks find it there."""
    box = shared.value
    if "built" not in box:
        box["built"] = build(*box["args"])
    return box["built"]
ship_code(__name__)
