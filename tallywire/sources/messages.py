"""Message topics: Kafka adapters, JSON payloads, contract check, archive, lag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tallywire.schemas import CONTRACT

BAD = "_bad"


# --- Kafka ------------------------------------------------------------------------------------


def kafka_security(user: str, password: str, truststore: str | None = None) -> dict[str, str]:
    """SASL_SSL / SCRAM-SHA-512 options for source and sink (fixed names and values of the connector)."""
    options = {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-512",
        "kafka.sasl.jaas.config": (
            "org.apache.kafka.common.security.scram.ScramLoginModule required "
            f"username='{user}' password='{password}';"
        ),
        "kafka.ssl.endpoint.identification.algorithm": "",
    }
    if truststore:
        options |= {"kafka.ssl.truststore.location": truststore, "kafka.ssl.truststore.type": "PEM"}
    return options


def kafka_source_options(
    servers: str, topic: str, security: dict[str, str] | None = None, max_offsets: int | None = None
) -> dict[str, str]:
    """Fixed option names of the connector. `max_offsets` bounds a micro-batch: a long topic takes more batches."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **(security or {}),
    }
    return {**options, "maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else options


def kafka_source(
    spark: SparkSession,
    servers: str,
    topic: str,
    security: dict[str, str] | None = None,
    batch: bool = False,
    max_offsets: int | None = None,
) -> DataFrame:
    """Topic as a stream, or as a table when `batch`."""
    reader = spark.read if batch else spark.readStream
    options = kafka_source_options(servers, topic, security, None if batch else max_offsets)
    return reader.format("kafka").options(**options).load()


def kafka_sink_options(servers: str, topic: str, security: dict[str, str] | None = None) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(security or {})}


def kafka_sink(
    df: DataFrame, servers: str, topic: str, checkpoint: str, security: dict[str, str] | None = None
) -> DataStreamWriter:
    """Append (key, value) rows to a topic; start the returned writer."""
    return (
        df.writeStream.format("kafka")
        .options(**kafka_sink_options(servers, topic, security))
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def write_messages(df: DataFrame, servers: str, topic: str, security: dict[str, str] | None = None) -> None:
    """Batch write of (key, value) rows to a topic."""
    df.write.format("kafka").options(**kafka_sink_options(servers, topic, security)).save()


# --- payloads ---------------------------------------------------------------------------------


def decode_json(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """JSON bytes or text to typed columns; unparsable text becomes a row of nulls."""
    return df.select(F.from_json(F.col(col).cast("string"), schema).alias("data")).select("data.*")


def _with_decoded(df: DataFrame, schema: T.StructType, col: str) -> DataFrame:
    """Decoded struct `_data` and a flag `_is_bad` for text that is no JSON object of this schema."""
    wide = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    data = F.from_json(F.col(col).cast("string"), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    df = df.withColumn("_data", data)
    return df.withColumn("_is_bad", F.col("_data").isNull() | F.col(f"_data.{BAD}").isNotNull())


def split_bad(df: DataFrame, schema: T.StructType, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(typed good rows, undecodable rows as they came)."""
    decoded = _with_decoded(df, schema, col)
    good = decoded.where(~F.col("_is_bad")).select(*[F.col(f"_data.{f.name}") for f in schema.fields])
    return good, decoded.where("_is_bad").select(*df.columns)


def validate(df: DataFrame, schema: T.StructType = CONTRACT, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(records that carry every field with its type, rejected text with the fields that failed)."""
    checked = df.withColumn("_data", F.from_json(F.col(col).cast("string"), schema))
    failed = F.array_compact(
        F.array(*[F.when(F.col(f"_data.{f.name}").isNull(), F.lit(f.name)) for f in schema.fields])
    )
    checked = checked.withColumn("reasons", failed)
    good = checked.where(F.size("reasons") == 0).select("_data.*")
    return good, checked.where(F.size("reasons") > 0).select(*df.columns, "reasons")


def payload_records(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """One row per record of a JSON object or list payload: `record` (its text), `data` and `reasons`.

    A list is taken apart before its records are read, so a bad record does not touch its neighbours. `reasons` names
    the fields that are missing or of another type; a payload or record that is no object has the reason "not an object".
    """
    text = F.trim(F.col(col).cast("string"))
    parts = F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
    records = F.coalesce(F.transform(parts, lambda v: F.to_json(v)), F.array(text))

    def read(record: Column) -> Column:
        is_object = F.coalesce(F.startswith(record, F.lit("{")), F.lit(False)) & F.try_parse_json(record).isNotNull()
        return F.struct(record.alias("record"), F.from_json(record, schema).alias("data"), is_object.alias("is_object"))

    # read below the explode: a filter on fields or reasons would else read the text again for each field it names
    rows = df.withColumn("_read", F.explode(F.transform(records, read)))
    fields = [F.when(F.col(f"_read.data.`{f.name}`").isNull(), F.lit(f.name)) for f in schema.fields]
    reasons = F.when(~F.col("_read.is_object"), F.array(F.lit("not an object"))).otherwise(F.array_compact(F.array(*fields)))
    return rows.withColumns({"record": F.col("_read.record"), "data": F.col("_read.data"), "reasons": reasons}).drop("_read")


def explode_payload(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """One row per record of a JSON object or list payload; what is no object gives none."""
    rows = payload_records(df, schema, col)
    return rows.where(~F.array_contains("reasons", "not an object")).select("data.*")


def rejected_records(df: DataFrame, schema: T.StructType, col: str = "value") -> DataFrame:
    """Records that lack a field or are no objects, as (record, reasons)."""
    return payload_records(df, schema, col).where(F.size("reasons") > 0).select("record", "reasons")


def to_messages(df: DataFrame, start_ts: int, end_ts: int, time: str = "unix_time") -> DataFrame:
    """JSON `value` per row of a closed time range; id, time and label as integers."""
    df = df.where(F.col(time).between(start_ts, end_ts))
    ints = {c: F.col(c).cast("bigint") for c in ("transaction_id", time, "tx_fraud") if c in df.columns}
    return df.withColumns(ints).select(F.to_json(F.struct("*")).alias("value"))


# --- size, lag, archive -----------------------------------------------------------------------


def topic_lag(in_df: DataFrame, out_df: DataFrame) -> DataFrame:
    """One row: input_total, output_total, lag."""
    done = out_df.agg(F.count(F.lit(1)).alias("n")).scalar()
    row = in_df.agg(F.count(F.lit(1)).alias("input_total")).withColumn("output_total", done)
    return row.withColumn("lag", F.col("input_total") - F.col("output_total"))


def topic_offsets(df: DataFrame) -> DataFrame:
    """(topic, high, retained) from a topic read as a table: sum of high offsets, and of high - low."""
    per_partition = df.groupBy("topic", "partition").agg(
        (F.max("offset") + 1).alias("high"), F.min("offset").alias("low")
    )
    return per_partition.groupBy("topic").agg(
        F.sum("high").alias("high"), F.sum(F.col("high") - F.col("low")).alias("retained")
    )


def with_archive_path(df: DataFrame, ts: Column | str, tz: str = "Europe/Moscow") -> DataFrame:
    """year / month / day text of the record time in `tz`."""
    # zone-free times from the epoch on: the same path in every session zone
    since = F.make_dt_interval(secs=(F.unix_micros(ts) / 1_000_000).cast("decimal(18,6)"))
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + since
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    return df.withColumns(
        {name: F.date_format(local, fmt) for name, fmt in [("year", "yyyy"), ("month", "MM"), ("day", "dd")]}
    )


def archive_stream(
    df: DataFrame,
    path: str,
    ts_col: str,
    checkpoint: str,
    tz: str = "Europe/Moscow",
    max_records: int = 10_000,
    interval: str | None = "1 hour",
) -> DataStreamWriter:
    """Stream to gzip Parquet below year=/month=/day=; files rotate by rows and by trigger interval.

    `interval=None` archives what is there and stops.
    """
    writer = (
        with_archive_path(df, ts_col, tz)
        .writeStream.format("parquet")
        .partitionBy("year", "month", "day")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_records)
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .outputMode("append")
    )
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
