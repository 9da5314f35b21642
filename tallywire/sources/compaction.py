"""Compaction of a partitioned Parquet table: many small files of a partition become the planned few.

The files of a partition are packed, in name order, into ceil(bytes / target) bins of about equal bytes; one task reads a bin and
writes one file, sorted as before. Partitions that have no more files than planned are not touched, nor read.

A run first writes the packed partitions aside as a numbered batch and notes it as staged; then it replaces the partitions of
the table from there and notes the batch as done. A run that finds a staged batch without its end replaces from it again, so a
crash at any point loses nothing. One writer at a time; readers of a partition should wait while it is replaced.
Staged batches stay until their folder is cleaned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.sources.files import file_sizes, listed_path, path_of_row
from tallywire.sources.state import read_state, write_state

BATCH, STAGED = "compaction", "staged"


def packed(sizes: DataFrame, target_bytes: int) -> DataFrame:
    """(dir, path, n_files, planned, bin from 0) of the files of each directory that has more files than planned."""
    files = sizes.where(F.col("path").endswith(".parquet")).withColumn("dir", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))
    whole = Window.partitionBy("dir")
    total = F.greatest(F.sum("length").over(whole), F.lit(1))
    before = F.sum("length").over(whole.orderBy("path").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("length")
    planned = F.ceil(total / target_bytes)
    files = files.select("dir", "path", F.count("*").over(whole).alias("n_files"), planned.alias("planned"), (before * planned / total).alias("at"))
    return files.where("n_files > planned").select("dir", "path", "n_files", "planned", F.least(F.floor("at"), F.col("planned") - 1).alias("bin"))


def _numbered(bins: DataFrame) -> DataFrame:
    """(path, task): tasks from 0, one per bin. Bins are few: bytes / target."""
    tasks = bins.select("dir", "bin").distinct()
    tasks = tasks.withColumn("task", F.row_number().over(Window.orderBy("dir", "bin")) - 1)
    return bins.join(tasks, ["dir", "bin"]).select(listed_path(F.col("path")).alias("_path"), F.col("task").alias("_task"))


def _write(rows: DataFrame, files: DataFrame, path: str, by: Sequence[str], sort: str) -> int:
    """Write `rows` as one file per task of `files`; returns the number of tasks. A row of an unknown file is an error."""
    n = (files.agg(F.max("_task")).first()[0] or 0) + 1
    placed = rows.withColumn("_path", path_of_row()).join(files, "_path", "left")
    known = F.coalesce("_task", F.raise_error(F.concat(F.lit("file not in the plan: "), F.col("_path"))).cast("int"))
    laid_out = placed.withColumn("_task", known).repartitionById(n, "_task").sortWithinPartitions(*by, sort).drop("_path", "_task")
    laid_out.write.partitionBy(*by).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return n


def _read(spark: SparkSession, base: str, by: Sequence[str], dirs: Sequence[str] = ()) -> DataFrame:
    """The table, or only some of its directories, with partition values as they are written ("01" stays "01")."""
    schema = spark.read.parquet(base).schema
    fields = [T.StructField(f.name, T.StringType() if f.name in by else f.dataType) for f in schema.fields]
    return spark.read.schema(T.StructType(fields)).option("basePath", base).parquet(*(dirs or [base]))


def compact(
    spark: SparkSession, path: str, state_path: str, staging: str, by: str | Sequence[str] = "date", sort: str = "unix_time", target_mb: float = 512
) -> int:
    """Compact the table at `path`; returns the number of files written, 0 if no partition has too many."""
    by = [by] if isinstance(by, str) else list(by)
    state = read_state(spark, state_path)
    number = state.get(BATCH, 0)
    if not state.get(STAGED):
        number += 1
        bins = packed(file_sizes(spark, path), int(target_mb * 1024 * 1024))
        # directories, not rows or files
        dirs = [r["dir"] for r in bins.select("dir").distinct().collect()]
        if not dirs:
            return 0
        _write(_read(spark, path, by, dirs), _numbered(bins), f"{staging}/batch={number}", by, sort)
        write_state(spark, state_path, {BATCH: number, STAGED: True})
    return swap(spark, path, state_path, f"{staging}/batch={number}", by, sort, number)


def swap(spark: SparkSession, path: str, state_path: str, staged: str, by: Sequence[str], sort: str, number: int) -> int:
    """Replace the partitions that a staged batch holds, file by file, and note the batch as done."""
    listed = file_sizes(spark, staged).where(F.col("path").endswith(".parquet"))
    one_each = listed.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), "path", F.col("path").alias("bin"))
    n = _write(_read(spark, staged, by), _numbered(one_each), path, by, sort)
    write_state(spark, state_path, {BATCH: number, STAGED: False})
    return n


def inversions(table: DataFrame, sort: str, by: Sequence[str] = ()) -> DataFrame:
    """(*by, _path, n, first, last, inversions) of every file: rows that stand before an earlier one in file order."""
    row = Window.partitionBy(*by, "_path").orderBy("_row")
    rows = table.withColumns({"_path": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})
    fell = F.col(sort) < F.lag(sort).over(row)
    rows = rows.select(*by, "_path", F.col(sort).alias("_value"), fell.cast("int").alias("_fell"))
    return rows.groupBy(*by, "_path").agg(
        F.count("*").alias("n"), F.min("_value").alias("first"), F.max("_value").alias("last"), F.coalesce(F.sum("_fell"), F.lit(0)).alias("inversions")
    )
