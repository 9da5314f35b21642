"""Job state, model registry, run log: small append-only tables below a path.

State, ledger and registry number their rows. A commit writes its rows aside and then puts them into the table as the one file
that follows the last number it has seen, if no other writer did so first; the loser reads again and retries, or fails where it
asked for a certain number. That needs a file system on which a rename does not replace a file (HDFS), or hard links (local).
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATE = "seq bigint, state string"
REGISTRY = "seq bigint, name string, version int, alias string, metrics string, folder string"
LEDGER = "seq bigint, start_time bigint, good_time bigint, end_time bigint, status string"
RUNS = "run string, kind string, key string, value string"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet table, or no rows when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _append(spark: SparkSession, path: str, rows: list[tuple], schema: str) -> None:
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


class Conflict(RuntimeError):
    """Another writer committed first."""


def put_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file to a name that is not taken; False, and nothing moved, if it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    old, new = path(source), path(target)
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        return fs.rename(old, new)
    old, new = (fs.makeQualified(x).toUri().getPath() for x in (old, new))
    try:
        os.link(old, new)
    except FileExistsError:
        return False
    os.unlink(old)
    return True


def commit(spark: SparkSession, path: str, schema: str, rows: Callable[[int], list[tuple]], expected: int | None = None) -> list[tuple]:
    """Add `rows(last)`, numbered from last + 1 in their first field, where last is the last number in the table.

    `rows` is called again if another writer was first. With `expected`, any other last number is a Conflict.
    """
    while True:
        last = read_or_empty(spark, path, schema).agg(F.max("seq")).first()[0] or 0
        if expected is not None and last != expected:
            raise Conflict(f"{path} is at {last}, not at {expected}")
        new = rows(last)
        if not new:
            return []
        aside = f"{path}/_aside-{uuid.uuid4().hex}"
        spark.createDataFrame(new, schema).coalesce(1).write.parquet(aside)
        written = spark.read.parquet(aside).select("_metadata.file_path").first()[0]
        if put_if_absent(spark, written, f"{path}/after-{last:012d}.parquet"):
            return new


# --- high-watermark state ---------------------------------------------------------------------


def latest_state(df: DataFrame) -> DataFrame:
    return df.agg(F.max("seq").alias("seq"), F.max_by("state", "seq").alias("state"))


def read_state(spark: SparkSession, path: str) -> dict:
    """Last written state, {} before the first run."""
    row = latest_state(read_or_empty(spark, path, STATE)).first()
    return json.loads(row["state"]) if row["state"] else {}


def write_state(spark: SparkSession, path: str, state: dict, expected: int | None = None) -> int:
    """Add a new state and return its number; the old one stays until the new one is committed.

    With `expected` (a number got from here, 0 before the first), a state that another writer added since is a Conflict.
    """
    return commit(spark, path, STATE, lambda last: [(last + 1, json.dumps(state))], expected)[0][0]


# --- ledger of batches ------------------------------------------------------------------------


class BatchLedger:
    """Which intervals of time a table has batches for: planned, started or committed. Append-only.

    A batch is told by the first time it keeps (good_time); its last row counts. An interval that is planned stays as it is, so a batch
    that was cut short runs again with the same bounds.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        """One row per batch with its status."""
        rows = read_or_empty(self.spark, self.path, LEDGER)
        last = rows.groupBy("good_time").agg(F.max_by(F.struct("start_time", "end_time", "status"), "seq").alias("b"))
        return last.select("b.start_time", "good_time", "b.end_time", "b.status")

    def add(self, batches: Sequence[dict], status: str) -> None:
        def rows(last: int) -> list[tuple]:
            return [(last + i, b["start_time"], b["good_time"], b["end_time"], status) for i, b in enumerate(batches, start=1)]

        commit(self.spark, self.path, LEDGER, rows)

    def open(self) -> list[dict]:
        """Batches without a commit, oldest first; a row per batch, not per row of the table."""
        rows = self.table().where("status <> 'committed'").orderBy("good_time")
        return [r.asDict() for r in rows.select("start_time", "good_time", "end_time").collect()]


# --- model registry ---------------------------------------------------------------------------


def resolve_registry(df: DataFrame) -> DataFrame:
    """(name, latest, best, old_best) from registry rows; the last row of an alias counts."""
    return df.groupBy("name").agg(
        F.max("version").alias("latest"),
        *[
            F.max_by("version", F.when(F.col("alias") == alias, F.col("seq"))).alias(alias)
            for alias in ("best", "old_best")
        ],
    )


class Registry:
    """Models below `path/models`; their versions and aliases in `path/registry`. Writers get versions of their own."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/registry", REGISTRY)

    def _add(self, rows: Callable[[], list[tuple]]) -> list[tuple]:
        def numbered(last: int) -> list[tuple]:
            return [(last + i, *row) for i, row in enumerate(rows(), start=1)]

        return commit(self.spark, f"{self.path}/registry", REGISTRY, numbered)

    def versions(self, name: str) -> dict:
        row = resolve_registry(self.table().where(F.col("name") == name)).first()
        return row.asDict() if row else {"name": name, "latest": None, "best": None, "old_best": None}

    def register(self, model: PipelineModel, name: str, metrics: dict | None = None) -> int:
        """Save a model as the next version; it becomes 'best' when there is none."""
        folder = f"{name}/{uuid.uuid4().hex}"
        model.write().save(f"{self.path}/models/{folder}")

        def rows() -> list[tuple]:
            known = self.versions(name)
            version = (known["latest"] or 0) + 1
            best = [(name, version, "best", None, None)] if known["best"] is None else []
            return [(name, version, None, json.dumps(metrics or {}), folder), *best]

        return self._add(rows)[0][2]

    def resolve(self, name: str, flag: str = "best") -> int | None:
        """Version with the alias 'best', or the latest version."""
        return self.versions(name)["best" if flag == "best" else "latest"]

    def load(self, name: str, version: int) -> PipelineModel:
        known = self.table().where((F.col("name") == name) & (F.col("version") == version) & F.col("folder").isNotNull()).first()
        # models registered before folders were noted lie at their version
        return PipelineModel.load(f"{self.path}/models/{known['folder'] if known else f'{name}/version={version}'}")

    def promote(self, name: str, new: int, old: int) -> None:
        self._add(lambda: [(name, old, "old_best", None, None), (name, new, "best", None, None)])


# --- run log and artifacts --------------------------------------------------------------------


def log_run(spark: SparkSession, path: str, run: str, params: dict, metrics: dict) -> None:
    """Append one run as (run, kind, key, value) rows."""
    rows = [(run, kind, k, str(v)) for kind, d in (("param", params), ("metric", metrics)) for k, v in d.items()]
    _append(spark, path, rows, RUNS)


def runs_wide(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run with a numeric column per key."""
    return df.groupBy("run").pivot("key", list(keys)).agg(F.max(F.col("value").try_cast("double")))


def save_feature_spec(spark: SparkSession, cols: Sequence[str], path: str) -> None:
    spark.createDataFrame([(list(cols),)], "num_cols array<string>").coalesce(1).write.mode("overwrite").json(path)


def read_feature_spec(spark: SparkSession, path: str) -> list[str]:
    return spark.read.schema("num_cols array<string>").json(path).first()["num_cols"]


def limit_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows in `order`."""
    return df.orderBy(*order).limit(n)


def input_example(df: DataFrame, cols: Sequence[str], n: int = 5, order: str = "transaction_id") -> DataFrame:
    """A few rows of model input; `.schema.json()` is the signature."""
    return limit_n(df, n, [order]).select(*cols)
