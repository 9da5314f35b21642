"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from functools import cache, wraps

from pyspark.sql import DataFrame, SparkSession

#: the JVM never compiles methods above 8000 bytes; wide feature rows would run interpreted
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", 8000


def build_session(app: str = "tallywire", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators are written for; the deployer sizes executors."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        # keys of a day of messages do not fit the heap of small executors
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        METHOD_LIMIT: str(COMPILED_BYTES),
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def wide_rows(fn: Callable) -> Callable:
    """For functions of a session or a table that run jobs over wide rows: also in a session that `build_session` did not make,
    generated code too large for the JVM's compiler gives way to split code meanwhile. The session has its own limit back afterwards."""

    @wraps(fn)
    def run(*args, **kwargs):
        given = next(a for a in (*args, *kwargs.values()) if isinstance(a, (SparkSession, DataFrame)))
        spark = given.sparkSession if isinstance(given, DataFrame) else given
        own = spark.conf.get(METHOD_LIMIT)
        if int(own) <= COMPILED_BYTES:  # set by the deployer, or by a caller that is itself such a function
            return fn(*args, **kwargs)
        spark.conf.set(METHOD_LIMIT, str(COMPILED_BYTES))
        try:
            return fn(*args, **kwargs)
        finally:
            spark.conf.set(METHOD_LIMIT, own)

    return run


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a temporary one in local mode only."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tallywire-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Point reliable checkpoints (iterative ML) at the shared folder unless one is already set."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_path(spark, "checkpoints"))
