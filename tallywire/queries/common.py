"""Query registry, shared inputs over the given tables, and their SQL twins.

`@query(name, sql)` registers a callable (spark, sf_dir) -> DataFrame and, where SQL can say the same, the
DuckDB text it is checked against. Doubles are rounded to six places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.functions import DAY, HOUR, bucket_of
from tallywire.session import scratch_path
from tallywire.streaming.transforms import run_to_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- rounding ---------------------------------------------------------------------------------


#: averages of amounts in cents over 32 rows end in an exact half at the seventh place; moving off that
#: half keeps the last bit of a sum from deciding the rounding (and makes -0.0 a plain 0.0)
NUDGE = 1.7e-8


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(
        *[
            F.round(F.col(f.name) + NUDGE, places).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def r6(expr: str, name: str) -> str:
    """SQL twin of `rounded`."""
    return f"round(({expr})::DOUBLE + {NUDGE}::DOUBLE, 6) AS {name}"


# --- tx: clean transactions over events -------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def to_tx(events: DataFrame) -> DataFrame:
    """Date and clock arithmetic keeps the seconds free of the session time zone."""
    ts = F.col("ts")
    seconds = F.unix_date(F.to_date(ts)) * F.lit(DAY).cast("bigint")
    seconds = seconds + F.hour(ts) * HOUR + F.minute(ts) * 60 + F.second(ts)
    return events.select(
        F.col("event_id").alias("transaction_id"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("tx_datetime"),
        seconds.alias("unix_time"),
        F.col("user_id").cast("int").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("int").alias("terminal_id"),
        F.col("value").alias("tx_amount"),
        (F.col("event_type") == "error").cast("int").alias("tx_fraud"),
    )


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return to_tx(table(spark, sf, "events"))


TX = """tx AS (
  SELECT event_id AS transaction_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS tx_datetime,
         floor(epoch(ts))::BIGINT AS unix_time, user_id::INT AS customer_id,
         json_extract_string(props, '$.k')::INT AS terminal_id, value AS tx_amount,
         (event_type = 'error')::INT AS tx_fraud
  FROM events)"""


def tx_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Times cut to the hour: many rows per key and second."""
    return tx(spark, sf).withColumn("unix_time", bucket_of("unix_time", HOUR))


TX_TIES = TX + """, tx_ties AS (
  SELECT * REPLACE (unix_time // 3600 * 3600 AS unix_time) FROM tx)"""


# --- tx_dirty: raw rows with faults -----------------------------------------------------------

EPOCH_2024 = 1704067200


def tx_dirty(spark: SparkSession, sf: str) -> DataFrame:
    df = tx(spark, sf)
    i = F.col("transaction_id")
    seconds = F.col("unix_time") - EPOCH_2024
    late = F.concat(F.substring("tx_datetime", 1, 10), F.lit(" 24:00:00"))
    return df.select(
        F.when(i % 31 == 0, -i).otherwise(i).alias("transaction_id"),
        F.when(i % 29 == 0, "garbage").when(i % 23 == 0, late).otherwise(F.col("tx_datetime")).alias("tx_datetime"),
        F.when(i % 11 != 0, F.col("customer_id")).alias("customer_id"),
        F.when(i % 13 == 0, -5).otherwise(F.col("terminal_id")).alias("terminal_id"),
        F.when(i % 17 == 0, -1.0).otherwise(F.col("tx_amount")).alias("tx_amount"),
        seconds.cast("int").alias("tx_time_seconds"),
        F.floor(seconds / DAY).cast("int").alias("tx_time_days"),
        F.when(i % 19 == 0, 7).otherwise(F.col("tx_fraud")).alias("tx_fraud"),
        F.col("tx_fraud").alias("tx_fraud_scenario"),
    )


TX_DIRTY = TX + """, tx_dirty AS (
  SELECT CASE WHEN transaction_id % 31 = 0 THEN -transaction_id ELSE transaction_id END AS transaction_id,
         CASE WHEN transaction_id % 29 = 0 THEN 'garbage'
              WHEN transaction_id % 23 = 0 THEN tx_datetime[1:10] || ' 24:00:00' ELSE tx_datetime END AS tx_datetime,
         CASE WHEN transaction_id % 11 <> 0 THEN customer_id END AS customer_id,
         CASE WHEN transaction_id % 13 = 0 THEN -5 ELSE terminal_id END AS terminal_id,
         CASE WHEN transaction_id % 17 = 0 THEN -1.0 ELSE tx_amount END AS tx_amount,
         (unix_time - 1704067200)::INT AS tx_time_seconds,
         ((unix_time - 1704067200) // 86400)::INT AS tx_time_days,
         CASE WHEN transaction_id % 19 = 0 THEN 7 ELSE tx_fraud END AS tx_fraud,
         tx_fraud AS tx_fraud_scenario
  FROM tx)"""


def csv_lines(spark: SparkSession, sf: str) -> DataFrame:
    """tx_dirty as CSV text: some rows are cut after four fields, some have text in the customer field."""
    df = tx_dirty(spark, sf)
    i = F.abs("transaction_id")
    cols = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    cols[2] = F.when(i % 41 == 0, "x").otherwise(cols[2])
    whole, cut = F.concat_ws(",", *cols), F.concat_ws(",", *cols[:4])
    return df.select(F.when(i % 37 == 0, cut).otherwise(whole).alias("value"))


# what the permissive reader makes of csv_lines
TX_CSV = TX_DIRTY + """, csv_raw AS (
  SELECT *, abs(transaction_id) % 37 = 0 AS is_cut, abs(transaction_id) % 41 = 0 AS is_x,
         concat_ws(',', transaction_id, tx_datetime,
                   CASE WHEN abs(transaction_id) % 41 = 0 THEN 'x' ELSE coalesce(customer_id::VARCHAR, '') END,
                   terminal_id) AS head,
         concat_ws(',', tx_amount, tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario) AS tail
  FROM tx_dirty), tx_csv AS (
  SELECT transaction_id, tx_datetime, CASE WHEN NOT is_x THEN customer_id END AS customer_id, terminal_id,
         CASE WHEN NOT is_cut THEN tx_amount END AS tx_amount,
         CASE WHEN NOT is_cut THEN tx_time_seconds END AS tx_time_seconds,
         CASE WHEN NOT is_cut THEN tx_time_days END AS tx_time_days,
         CASE WHEN NOT is_cut THEN tx_fraud END AS tx_fraud,
         CASE WHEN NOT is_cut THEN tx_fraud_scenario END AS tx_fraud_scenario,
         CASE WHEN is_cut THEN head WHEN is_x THEN head || ',' || tail END AS _corrupt
  FROM csv_raw)"""


def write_csv(spark: SparkSession, sf: str) -> str:
    """The lines, and a comment line, as text files below the shared folder."""
    path = scratch_path(spark, "raw-csv")
    csv_lines(spark, sf).write.mode("append").text(path)
    table(spark, sf, "events").limit(1).select(F.lit("# id,time,customer,…").alias("value")).write.mode("append").text(path)
    return path


# --- scored: two score columns without a model ------------------------------------------------


def uniform(key: str, salt: str) -> Column:
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{salt}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def scored(spark: SparkSession, sf: str) -> DataFrame:
    df = tx(spark, sf).withColumns(
        {
            "score_a": uniform("transaction_id", "a"),
            "score_b": uniform("transaction_id", "b") * 0.8 + F.col("tx_fraud") * 0.2,
        }
    )
    return df.withColumns(
        {f"pred_{m}": (F.col(f"score_{m}") >= 0.5).cast("int") for m in "ab"}
    )


SCORED = TX + """, scored0 AS (
  SELECT *, ('0x' || substr(md5(transaction_id || ':a'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS score_a,
         ('0x' || substr(md5(transaction_id || ':b'), 1, 8))::BIGINT / 4294967296.0::DOUBLE * 0.8::DOUBLE
           + tx_fraud * 0.2::DOUBLE AS score_b
  FROM tx), scored AS (
  SELECT *, (score_a >= 0.5)::INT AS pred_a, (score_b >= 0.5)::INT AS pred_b FROM scored0)"""


def one_model(df: DataFrame, model: str = "b") -> DataFrame:
    return df.withColumnsRenamed({f"pred_{model}": "prediction", f"score_{model}": "prob_1"})


# --- payloads: JSON messages over tx ----------------------------------------------------------

PAYLOAD = T.StructType(
    [
        T.StructField("transaction_id", T.LongType()),
        T.StructField("unix_time", T.LongType()),
        T.StructField("tx_amount", T.DoubleType()),
        T.StructField("tx_fraud", T.IntegerType()),
    ]
)
PAYLOAD_COLUMNS = PAYLOAD.fieldNames()


def payloads(df: DataFrame) -> DataFrame:
    """tx rows as messages: undecodable text for every 7th id, a list of two records for every 5th."""
    i = F.col("transaction_id")
    record = F.struct(*PAYLOAD_COLUMNS)
    pair = F.concat(F.lit("["), F.to_json(record), F.lit(","), F.to_json(record), F.lit("]"))
    value = F.when(i % 7 == 0, "xx").when(i % 5 == 0, pair).otherwise(F.to_json(record))
    return df.select(i.alias("offset"), value.alias("value"))


# --- streams ----------------------------------------------------------------------------------


def tx_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    return to_tx(events)


def run_and_read(df: DataFrame, name: str) -> DataFrame:
    """Run a stream over its whole input and read what it wrote."""
    spark = df.sparkSession
    path, checkpoint = scratch_path(spark, name), scratch_path(spark, f"{name}-checkpoint")
    run_to_files(df, path, checkpoint).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(path)
