"""The message stream: event time, dedup, clean, encode, quarantine, monitoring, scoring."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallywire.functions import fill_numeric, from_epoch, to_message
from tallywire.operators.monitor import LATENCY_BOUNDS, fraud_share, histogram
from tallywire.operators.models import score
from tallywire.schemas import CONTRACT, FEATURE, MODEL_INPUTS
from tallywire.sources.messages import decode_json, payload_records, split_bad
from tallywire.streaming.progress import RECEIVED, SENT, TIMED, counted

EVENT_TIME = "tx_datetime"


def with_event_time(df: DataFrame, col: str = "unix_time", delay: str = "1 day") -> DataFrame:
    """Event time from epoch seconds, with a watermark. Rows without a time leave here, because they would stay in the
    state for ever; `run_rejects` gives them."""
    df = df.where(F.col(col).isNotNull())
    return df.withColumn(EVENT_TIME, from_epoch(col)).withWatermark(EVENT_TIME, delay)


def stream_dedup(
    df: DataFrame, keys: Sequence[str] = ("transaction_id", EVENT_TIME), within_watermark: bool = False
) -> DataFrame:
    """First row per key inside the watermark; later rows of the key and rows behind the watermark go.

    With `within_watermark` the key may leave out the event time, and copies with another time are caught.
    """
    if within_watermark:
        return df.dropDuplicatesWithinWatermark([k for k in keys if k != EVENT_TIME])
    return df.dropDuplicates(list(keys))


def stream_clean(
    df: DataFrame, drop: Sequence[str] = (EVENT_TIME, "date", "unix_time", "tx_fraud")
) -> DataFrame:
    return fill_numeric(df.drop(*drop), 0)


@dataclass(frozen=True)
class StreamConfig:
    schema: T.StructType = field(default_factory=lambda: FEATURE)
    delay: str = "1 day"
    keys: tuple[str, ...] = ("transaction_id", EVENT_TIME)
    within_watermark: bool = False
    drop: tuple[str, ...] = (EVENT_TIME, "date", "unix_time", "tx_fraud")


def run_stream(messages: DataFrame, cfg: StreamConfig = StreamConfig()) -> DataFrame:
    """Messages with a JSON `value` to deduplicated (key, value) messages without label and time."""
    rows = decode_json(messages, cfg.schema)
    rows = stream_dedup(with_event_time(rows, delay=cfg.delay), cfg.keys, cfg.within_watermark)
    return to_message(stream_clean(rows, cfg.drop))


def run_counted(messages: DataFrame, cfg: StreamConfig = StreamConfig()) -> DataFrame:
    """`run_stream` that reports its rows, so that `progress.balance` accounts for each message of each batch."""
    rows = counted(with_event_time(decode_json(counted(messages, RECEIVED), cfg.schema), delay=cfg.delay), TIMED)
    return counted(to_message(stream_clean(stream_dedup(rows, cfg.keys, cfg.within_watermark), cfg.drop)), SENT)


def run_rejects(messages: DataFrame, cfg: StreamConfig = StreamConfig()) -> DataFrame:
    """What `run_stream` leaves out before dedup, with reasons: text that is no JSON object of the schema, and records
    without a time."""
    wide = T.StructType([*cfg.schema.fields, T.StructField("_bad", T.StringType())])
    data = F.from_json(F.col("value").cast("string"), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = messages.select(F.col("value").cast("string").alias("record"), data.alias("data"))
    undecoded = F.when(F.col("data").isNull() | F.col("data._bad").isNotNull(), F.lit("undecodable"))
    timeless = F.when(F.col("data.unix_time").isNull(), F.lit("unix_time"))
    rows = rows.select("record", F.array_compact(F.array(undecoded, timeless)).alias("reasons"))
    return rows.where(F.array_contains("reasons", "unix_time"))


def run_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet") -> DataStreamWriter:
    """Append to files and stop when the input is used up; a restart goes on from the checkpoint."""
    return (
        df.writeStream.format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
    )


def quarantine_sink(
    messages: DataFrame,
    schema: T.StructType,
    good_path: str,
    bad_path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> DataStreamWriter:
    """Good rows and undecodable messages to two tables, each batch in its own folder so that a replayed
    batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_bad(batch, schema)
            for part, path in ((good, good_path), (bad, bad_path)):
                part.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        finally:
            batch.unpersist()

    return (
        messages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )


def stream_monitor(df: DataFrame, ts: str, delay: str = "1 day", length: str = "5 minutes") -> DataFrame:
    """Predictions and fraud share per window of event time."""
    return fraud_share(df.withWatermark(ts, delay), ts, length)


def stream_counts(df: DataFrame, ts: str, delay: str = "1 day", length: str = "5 minutes") -> DataFrame:
    """Predictions by label and model version per window of event time."""
    window = F.window(ts, length).alias("window")
    return df.withWatermark(ts, delay).groupBy(window, "label", "version").agg(F.count(F.lit(1)).alias("n"))


def stream_histogram(
    df: DataFrame,
    ts: str,
    col: str,
    by: str = "version",
    bounds: Sequence[float] = LATENCY_BOUNDS,
    delay: str = "1 day",
    length: str = "5 minutes",
) -> DataFrame:
    """Cumulative buckets of `col` per window of event time and group. A window comes out once, when the watermark has passed it."""
    return histogram(df.withWatermark(ts, delay), col, [F.window(ts, length).alias("window"), F.col(by)], bounds)


def scored_latency(messages: DataFrame, model: PipelineModel, version: str, schema: T.StructType = CONTRACT) -> DataFrame:
    """Scored records with the record time of their message (`timestamp`) and the seconds from it to their scoring (`latency`)."""
    complete = payload_records(messages, schema).where(F.size("reasons") == 0).select("data.*", "timestamp")
    scored = score(complete, model, version).select("transaction_id", "label", "version", "timestamp")
    took = F.unix_micros(F.current_timestamp()) - F.unix_micros("timestamp")
    return scored.withColumn("latency", took / 1_000_000)


def score_stream(
    messages: DataFrame,
    model: PipelineModel,
    version: str,
    schema: T.StructType = CONTRACT,
    inputs: Sequence[str] = tuple(MODEL_INPUTS),
) -> DataFrame:
    """Payload messages to prediction messages, one per complete record; `rejected_records` gives the others."""
    complete = payload_records(messages, schema).where(F.size("reasons") == 0).select("data.*")
    scored = score(complete, model, version, inputs=inputs)
    return to_message(scored.select("transaction_id", "prediction", "label", "version"))
