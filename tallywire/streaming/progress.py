"""What streams report about their batches, kept as a table: the account of rows, and lag from source offsets.

A batch's progress holds the rows that came in, what the state operators dropped, the observed counts of the stream and the
offsets of its sources. Kept as JSON lines, it answers these questions without reading a topic or an output again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "runId string, batchId bigint, timestamp string, observedMetrics map<string, struct<rows: bigint>>, "
    "stateOperators array<struct<numRowsDroppedByWatermark: bigint, customMetrics: map<string, bigint>>>, "
    "sources array<struct<endOffset: string, latestOffset: string>>"
)
#: names under which streams observe their rows
RECEIVED, TIMED, SENT = "received", "timed", "sent"


def counted(df: DataFrame, name: str) -> DataFrame:
    """`df`, whose rows per batch are reported under `name`."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))


def keep_progress(spark: SparkSession, path: str, lines: Iterable[str]) -> None:
    """Append progress reports, one JSON text each. Every call writes a folder of its own: streams report at the same time, and two
    writers into one folder would clear each other's temporary files."""
    rows = [(line,) for line in lines]
    if rows:
        spark.createDataFrame(rows, "value string").coalesce(1).write.text(f"{path.rstrip('/')}/report={uuid.uuid4().hex}")


class ProgressLog(StreamingQueryListener):
    """Appends the progress of the session's streams to a table as it comes: `spark.streams.addListener(ProgressLog(spark, path))`.

    `names` limits it to streams of these names.
    """

    def __init__(self, spark: SparkSession, path: str, names: tuple[str, ...] = ()):
        self.spark, self.path, self.names = spark, path, names

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if not self.names or event.progress.name in self.names:
            keep_progress(self.spark, self.path, [event.progress.json])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def keep_finished(spark: SparkSession, path: str, query: StreamingQuery) -> None:
    """Append what a finished stream still knows of its progress (the session keeps the last hundred batches)."""
    keep_progress(spark, path, [p.json for p in query.recentProgress])


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Typed progress rows; a report that was kept twice counts once."""
    rows = spark.read.text(path).select(F.from_json("value", PROGRESS).alias("p")).select("p.*")
    return rows.dropDuplicates(["runId", "batchId", "timestamp"])


def balance(progress: DataFrame) -> DataFrame:
    """Per batch: received = rejected + late + duplicates + sent, and whether that holds (balanced)."""

    def seen(name: str) -> Column:
        return F.coalesce(F.col("observedMetrics")[name]["rows"], F.lit(0))

    def dropped(of) -> Column:
        return F.aggregate(F.coalesce("stateOperators", F.array()), F.lit(0).cast("bigint"), lambda n, op: n + F.coalesce(of(op), F.lit(0)))

    rows = progress.select(
        "runId",
        "batchId",
        seen(RECEIVED).alias("received"),
        (seen(RECEIVED) - seen(TIMED)).alias("rejected"),
        dropped(lambda op: op["numRowsDroppedByWatermark"]).alias("late"),
        dropped(lambda op: op["customMetrics"]["numDroppedDuplicateRows"]).alias("duplicates"),
        seen(SENT).alias("sent"),
    )
    total = F.col("rejected") + F.col("late") + F.col("duplicates") + F.col("sent")
    return rows.withColumn("balanced", F.col("received") == total)


def lag_from_progress(progress: DataFrame) -> DataFrame:
    """(topic, input_total, output_total, lag) after the last batch of each run: what the topic has, what the stream has read."""
    last = progress.groupBy("runId").agg(F.max_by("sources", "batchId").alias("sources"))
    ends = last.select("runId", F.explode("sources").alias("s"))
    offsets = "map<string, map<string, bigint>>"
    ends = ends.select(
        "runId", F.explode(F.from_json("s.latestOffset", offsets)).alias("topic", "_latest"), F.from_json("s.endOffset", offsets).alias("_end")
    )
    parts = ends.select("topic", F.col("_end")[F.col("topic")].alias("_end"), F.explode("_latest").alias("_part", "latest"))
    parts = parts.select("topic", "latest", F.coalesce(F.col("_end")[F.col("_part")], F.lit(0)).alias("end"))
    sums = parts.groupBy("topic").agg(F.sum("latest").alias("input_total"), F.sum("end").alias("output_total"))
    return sums.withColumn("lag", F.col("input_total") - F.col("output_total"))
