"""Manifest of the files of a table with the range of one column in each (a zone map).

A refresh lists the files, reads only those that the manifest does not hold, and appends a row for each: how many values, the
smallest and the largest. Bounds of a batch then come from the manifest without reading the table, and a slice opens only
the files whose range meets it.

A file is told by path, length and modification time, so a replaced file is read again; rows of files that are gone do not count.
A file rewritten at the same length within the resolution of that time would not be seen. The manifest is append-only: a run that
dies before its append leaves the files unseen, and rows that two runs add for one file are equal and fold into one. Lists of files pass
through the driver as they do in any Spark scan; rows do not.

Edge cases: a file without rows or without a value of the column is noted, so it is read once, and meets no slice; one of zero bytes is not listed. Nulls of the
column are in no slice. A slice that no file meets is empty. A path that is not there is a FileNotFoundError.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywire.sources.files import file_sizes, listed_path, path_of_row
from tallywire.sources.state import read_or_empty

MANIFEST = "path string, length bigint, modified bigint, n bigint, lo bigint, hi bigint"
_VERSION = ["path", "length", "modified"]


def parquet_files(base: str) -> Callable[[SparkSession, list[str]], DataFrame]:
    """Reader of some files of a Parquet table; all subsets have the columns of the table, partition columns too."""

    def read(spark: SparkSession, paths: list[str]) -> DataFrame:
        schema = spark.read.parquet(base).schema
        return spark.read.schema(schema).option("basePath", base).parquet(*paths)

    return read


class Manifest:
    """Files below `source` and their range of the whole-number column `col`; `read` gives the rows of a list of paths."""

    def __init__(self, spark: SparkSession, path: str, source: str, col: str, read: Callable[[SparkSession, list[str]], DataFrame]):
        self.spark, self.path, self.source, self.col, self.read = spark, path, source, col, read

    def _listed(self) -> DataFrame:
        files = file_sizes(self.spark, self.source, ["modificationTime"])
        return files.select("path", "length", F.unix_millis("modificationTime").alias("modified"))

    def _known(self) -> DataFrame:
        """One row per version of a file, gone or not."""
        noted = read_or_empty(self.spark, self.path, MANIFEST).groupBy(_VERSION)
        return noted.agg(F.max("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def refresh(self) -> list[str]:
        """Note the files that came or changed since the last refresh; returns their paths."""
        fresh = self._listed().join(self._known().select(_VERSION), _VERSION, "left_anti").collect()
        if not fresh:
            return []
        paths = [r["path"] for r in fresh]
        rows = self.read(self.spark, _literal(paths)).select(path_of_row().alias("_file"), F.col(self.col).cast("bigint").alias("_value"))
        zones = rows.groupBy("_file").agg(F.count("_value").alias("n"), F.min("_value").alias("lo"), F.max("_value").alias("hi"))
        # the versions listed above: a file replaced meanwhile has another one and is read again by the next refresh
        seen = self.spark.createDataFrame(fresh, "path string, length bigint, modified bigint")
        noted = seen.join(zones, listed_path(F.col("path")) == F.col("_file"), "left").select(*_VERSION, F.coalesce("n", F.lit(0)).alias("n"), "lo", "hi")
        noted.coalesce(1).write.mode("append").parquet(self.path)
        return paths

    def table(self) -> DataFrame:
        """path, length, modified, n, lo, hi: one row per file that is there and noted."""
        return self._listed().join(self._known(), _VERSION)

    def span(self) -> DataFrame:
        """Smallest and largest value, as `slices.span` has them from the rows."""
        return self.table().agg(F.min("lo").alias("min_value"), F.max("hi").alias("max_value"))

    def paths(self, lo: int, hi: int) -> list[str]:
        """Files that may hold values in [lo, hi); those that came or changed since the refresh may."""
        files = self._listed().join(self._known(), _VERSION, "left")
        may = F.col("n").isNull() | ((F.col("lo") < hi) & (F.col("hi") >= lo))
        return [r["path"] for r in files.where(may).orderBy("path").collect()]

    def slice(self, lo: int, hi: int) -> DataFrame:
        """Rows with lo <= col < hi; other files are not opened."""
        found = self.paths(lo, hi)
        rows = self.read(self.spark, _literal(found)) if found else self.read(self.spark, [self.source]).where(F.lit(False))
        return rows.where((F.col(self.col) >= lo) & (F.col(self.col) < hi))


def _literal(paths: list[str]) -> list[str]:
    """Paths that a reader does not take for patterns."""
    return [re.sub(r"([\\\[\]{}*?])", r"\\\1", p) for p in paths]
