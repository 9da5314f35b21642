"""File sources and sinks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.schemas import CORRUPT, RAW

_CSV = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def read_raw_csv(spark: SparkSession, path: str | list[str], schema: T.StructType = RAW) -> DataFrame:
    """Headerless CSV with `#` comments; a row that does not fit the schema is kept whole in `_corrupt`.

    Spark parses only the fields a query uses, and only a parsed field can make a row corrupt. Tying
    `_corrupt` to all fields makes it mean the same in every query.
    """
    df = spark.read.schema(schema).options(**_CSV).option("header", False).option("comment", "#").csv(path)
    fields = [f.name for f in schema.fields if f.name != CORRUPT]
    all_read = F.size(F.array(*[F.col(f).isNull() for f in fields])) == len(fields)
    return df.withColumn(CORRUPT, F.when(all_read, F.col(CORRUPT)))


def parse_raw_csv(col: Column | str, schema: T.StructType = RAW) -> Column:
    """The same for CSV lines in a column: a struct with the declared fields and `_corrupt`."""
    return F.from_csv(col, schema.simpleString()[len("struct<") : -1].replace(":", " "), _CSV)


def read_table(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Parquet table, reading only `cols`."""
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def read_sample(
    spark: SparkSession, path: str, fraction: float = 0.1, seed: int = 42, cols: Sequence[str] | None = None
) -> DataFrame:
    """Bernoulli sample of a table."""
    return read_table(spark, path, cols).sample(fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, key: str, fraction: float = 0.1, seed: int = 42) -> DataFrame:
    """Bernoulli sample by md5(key:seed): the same rows for every file layout and rerun."""
    limit = f"{math.floor(fraction * 2**32):08x}" if fraction < 1 else "g"
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.where(F.substring(digest, 1, 8) < limit)


def write_partitioned(
    df: DataFrame,
    path: str,
    by: str | Sequence[str] = "week",
    sort: str = "unix_time",
    mode: str = "append",
    max_records: int = 20_000_000,
) -> None:
    """Parquet by partition column, sorted by time inside the files.

    The rebalance hint puts small partitions together and splits large ones over several tasks, so a
    partition with most of the rows does not become one task or one file. With mode
    'overwrite-partitions' only the partitions present in `df` are replaced, which makes a rerun safe.
    """
    by = [by] if isinstance(by, str) else list(by)
    laid_out = df.hint("rebalance", *by).sortWithinPartitions(*by, sort)
    writer = laid_out.write.partitionBy(*by).option("maxRecordsPerFile", max_records)
    if mode == "overwrite-partitions":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    writer.parquet(path)


def listed_path(path: Column) -> Column:
    """A path without the slashes that listings and scans put differently after the scheme."""
    return F.regexp_replace(path, r"^([A-Za-z0-9]+):/+", "$1:/")


def path_of_row() -> Column:
    """The file of a row as listings name it; scans escape it."""
    return listed_path(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))))


def file_sizes(spark: SparkSession, path: str, more: Sequence[str] = ()) -> DataFrame:
    """(path, length) of all files below a path, and `more` of what a listing tells; contents are not read."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise
    return files.select("path", "length", *more)


def file_count_for(sizes: DataFrame, target_mb: int = 512, zip: float = 3) -> DataFrame:
    """One row: input bytes and how many output files of `target_mb` they should become, 1 at least."""
    total = F.coalesce(F.sum("length"), F.lit(0))
    count = F.ceil(total / zip / (1024 * 1024) / target_mb)
    return sizes.agg(total.alias("total_bytes"), F.greatest(F.lit(1), count).cast("int").alias("n_files"))


def plan_file_count(spark: SparkSession, path: str, target_mb: int = 512, zip: float = 3) -> int:
    return file_count_for(file_sizes(spark, path), target_mb, zip).first()["n_files"]
