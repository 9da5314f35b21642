"""Section H: scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywire import functions as fn
from tallywire.operators.clean import parse_time
from tallywire.operators.features import with_flags
from tallywire.queries.common import PAYLOAD_COLUMNS, TX, TX_DIRTY, query, r6, rounded, tx, tx_dirty
from tallywire.queries.projections import PARSED
from tallywire.schemas import struct


@query("parse_time", f"WITH {TX_DIRTY} SELECT transaction_id, epoch({PARSED})::BIGINT AS seconds FROM tx_dirty")
def parse_time_query(spark, sf):
    return parse_time(tx_dirty(spark, sf)).select("transaction_id", fn.epoch("tx_datetime").alias("seconds"))


@query("epoch_roundtrip", f"WITH {TX} SELECT transaction_id, unix_time AS seconds FROM tx")
def epoch_roundtrip(spark, sf):
    return tx(spark, sf).select("transaction_id", fn.epoch(fn.from_epoch("unix_time")).alias("seconds"))


@query(
    "week_start",
    f"WITH {TX} SELECT transaction_id, date_trunc('week', make_timestamp(unix_time * 1000000))::DATE AS week FROM tx",
)
def week_start(spark, sf):
    return tx(spark, sf).select("transaction_id", fn.week_of("unix_time").cast("date").alias("week"))


@query(
    "calendar_features",
    f"""WITH {TX}, c AS (SELECT transaction_id, make_timestamp(unix_time * 1000000) AS moment FROM tx)
    SELECT transaction_id, hour(moment)::INT AS hour, (hour(moment) < 6)::INT AS is_night, (dayofweek(moment) + 1)::INT AS day_of_week,
           (dayofweek(moment) IN (0, 6))::INT AS is_weekend, moment::DATE AS date FROM c""",
)
def calendar_features(spark, sf):
    out = fn.with_calendar(tx(spark, sf))
    return out.select("transaction_id", "hour", "is_night", "day_of_week", "is_weekend", "date")


@query(
    "cyclic_features",
    f"""WITH {TX}, c AS (SELECT transaction_id, make_timestamp(unix_time * 1000000) AS moment FROM tx)
    SELECT transaction_id, {r6('sin(2 * pi() * hour(moment) / 24)', 'hour_sin')}, {r6('cos(2 * pi() * hour(moment) / 24)', 'hour_cos')},
      {r6('sin(2 * pi() * (dayofweek(moment) + 1) / 7)', 'day_sin')}, {r6('cos(2 * pi() * (dayofweek(moment) + 1) / 7)', 'day_cos')} FROM c""",
)
def cyclic_features(spark, sf):
    out = fn.with_cyclic(fn.with_calendar(tx(spark, sf)))
    return rounded(out.select("transaction_id", "hour_sin", "hour_cos", "day_sin", "day_cos"))


@query(
    "amount_flags",
    f"""WITH {TX_DIRTY} SELECT transaction_id, (round(tx_amount) * 50 % 100 = 0)::INT AS is_rovn_sum,
        (terminal_id = -5)::INT AS is_unknonw_terminal, (coalesce(customer_id, -1) = -1)::INT AS is_unknonw_customer
    FROM tx_dirty""",
)
def amount_flags(spark, sf):
    df = tx_dirty(spark, sf).withColumns(
        {
            "tx_amount": F.round("tx_amount") * 50,
            "terminal_id": F.when(F.col("terminal_id") == -5, -1).otherwise(F.col("terminal_id")),
            "customer_id": F.coalesce("customer_id", F.lit(-1)),
        }
    )
    return with_flags(df).select("transaction_id", "is_rovn_sum", "is_unknonw_terminal", "is_unknonw_customer")


@query(
    "safe_math",
    f"""WITH {TX_DIRTY} SELECT transaction_id, {r6('tx_amount / nullif(tx_fraud_scenario, 0)', 'ratio')},
        {r6('coalesce(tx_amount / nullif(tx_fraud_scenario, 0), 0)', 'ratio_or_zero')},
        {r6('sqrt(greatest(0, tx_amount))', 'root')}, {r6('tx_amount * tx_amount', 'squared')},
        coalesce(customer_id, 0) AS customer_or_zero FROM tx_dirty""",
)
def safe_math(spark, sf):
    df = tx_dirty(spark, sf).select(
        "transaction_id",
        fn.safe_div("tx_amount", "tx_fraud_scenario").alias("ratio"),
        fn.safe_div("tx_amount", "tx_fraud_scenario", 0).alias("ratio_or_zero"),
        fn.safe_sqrt("tx_amount").alias("root"),
        fn.square("tx_amount").alias("squared"),
        fn.zero_if_null("customer_id").alias("customer_or_zero"),
    )
    return rounded(df)


@query("label_text", f"WITH {TX} SELECT transaction_id, CASE WHEN tx_fraud = 1 THEN 'fraud' ELSE 'normal' END AS label FROM tx")
def label_text(spark, sf):
    return tx(spark, sf).select("transaction_id", fn.label_text("tx_fraud").alias("label"))


@query(
    "coerce_types",
    f"""WITH {TX} SELECT try_cast(transaction_id * 1000000 AS INT) AS transaction_id, unix_time::INT AS unix_time,
        {r6('tx_amount::FLOAT::DOUBLE', 'tx_amount')} FROM tx""",
)
def coerce_types(spark, sf):
    df = tx(spark, sf).select(
        (F.col("transaction_id") * 1_000_000).alias("transaction_id"),
        "unix_time",
        F.col("tx_amount").cast("float").alias("tx_amount"),
    )
    return rounded(fn.coerce(df, struct("transaction_id int, unix_time int, tx_amount double")))


@query(
    "to_message",
    f"""WITH {TX} SELECT transaction_id::VARCHAR AS key, CASE WHEN tx_fraud = 1
      THEN to_json(struct_pack(transaction_id := transaction_id, unix_time := unix_time, tx_amount := tx_amount))::VARCHAR
      ELSE to_json(struct_pack(transaction_id := transaction_id, unix_time := unix_time, tx_amount := tx_amount, tx_fraud := 0))::VARCHAR
      END AS value FROM tx""",
)
def to_message(spark, sf):
    label = F.when(F.col("tx_fraud") == 0, F.col("tx_fraud"))
    return fn.to_message(tx(spark, sf).select(*PAYLOAD_COLUMNS).withColumn("tx_fraud", label))


_UNITS = ["s", " seconds", " MINUTE", "m", " hours", "h", "day", " days", " weeks", ""]


@query(
    "duration_seconds",
    f"""WITH {TX}, d AS (SELECT transaction_id, customer_id, transaction_id % 10 AS u FROM tx)
    SELECT transaction_id, (CASE u WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 60 WHEN 3 THEN 60 WHEN 4 THEN 3600 WHEN 5 THEN 3600
      WHEN 6 THEN 86400 WHEN 7 THEN 86400 WHEN 8 THEN 0 END * customer_id)::BIGINT AS seconds FROM d""",
)
def duration_seconds(spark, sf):
    units = F.array(*[F.lit(u) for u in _UNITS])
    text = F.concat(F.lit(" "), F.col("customer_id"), units[(F.col("transaction_id") % 10).cast("int")])
    return tx(spark, sf).select("transaction_id", fn.duration_seconds(text).alias("seconds"))
