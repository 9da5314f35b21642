"""Section I: streams. Each runs over the whole input and returns what the sink received."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywire.functions import label_text, to_message
from tallywire.queries.common import (
    PAYLOAD,
    PAYLOAD_COLUMNS,
    TX,
    payloads,
    query,
    r6,
    rounded,
    run_and_read,
    tx,
    tx_stream,
)
from tallywire.session import scratch_path
from tallywire.operators.monitor import LATENCY_BOUNDS
from tallywire.sources.messages import explode_payload, rejected_records
from tallywire.streaming import progress
from tallywire.streaming import transforms as st

_MESSAGE = """to_json(struct_pack(transaction_id := transaction_id, tx_amount := tx_amount))::VARCHAR"""


def _twice(df):
    """Every row arrives twice."""
    return df.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")).drop("copy")


@query("stream_dedup", f"WITH {TX} SELECT transaction_id, unix_time, tx_amount FROM tx")
def stream_dedup(spark, sf):
    rows = _twice(tx_stream(spark, sf).select("transaction_id", "unix_time", "tx_amount"))
    return run_and_read(st.stream_dedup(st.with_event_time(rows)), "dedup").drop(st.EVENT_TIME)


@query(
    "stream_dedup_within_watermark",
    f"WITH {TX} SELECT transaction_id, tx_amount FROM tx",
)
def stream_dedup_within_watermark(spark, sf):
    rows = tx_stream(spark, sf).select("transaction_id", "unix_time", "tx_amount")
    shifted = rows.select("*", F.explode(F.array(F.lit(0), F.lit(60))).alias("late"))
    shifted = shifted.withColumn("unix_time", F.col("unix_time") + F.col("late")).drop("late")
    out = st.stream_dedup(st.with_event_time(shifted), within_watermark=True)
    return run_and_read(out, "dedup-within").select("transaction_id", "tx_amount")


@query(
    "stream_late_drop",
    f"""WITH {TX}, b AS (SELECT *, transaction_id % 3 = 2 AS late FROM tx),
      w AS (SELECT max(unix_time) FILTER (NOT late) - 86400 AS mark FROM b)
    SELECT transaction_id, unix_time FROM b, w WHERE NOT late OR unix_time > mark""",
)
def stream_late_drop(spark, sf):
    """Two arrivals: two thirds of the rows, then the rest; the watermark of the first cuts the second."""
    rows = tx(spark, sf).select("transaction_id", "unix_time")
    late = F.col("transaction_id") % 3 == 2
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("late-in", "late-out", "late-checkpoint"))
    for part in (rows.where(~late), rows.where(late)):
        part.write.mode("append").parquet(inbox)
        arriving = spark.readStream.schema(rows.schema).parquet(inbox)
        seen = st.stream_dedup(st.with_event_time(arriving))
        st.run_to_files(seen.drop(st.EVENT_TIME), out, checkpoint).start().awaitTermination()
    return spark.read.schema(rows.schema).parquet(out)


@query(
    "stream_clean",
    f"""WITH {TX} SELECT transaction_id, CASE WHEN transaction_id % 4 = 0 THEN 0 ELSE tx_amount END AS tx_amount FROM tx""",
)
def stream_clean(spark, sf):
    rows = tx_stream(spark, sf).select("transaction_id", "unix_time", "tx_amount", "tx_fraud")
    holes = rows.withColumn("tx_amount", F.when(F.col("transaction_id") % 4 != 0, F.col("tx_amount")))
    return run_and_read(st.stream_clean(holes), "clean")


@query("stream_to_message", f"WITH {TX} SELECT transaction_id::VARCHAR AS key, {_MESSAGE} AS value FROM tx")
def stream_to_message(spark, sf):
    return run_and_read(to_message(tx_stream(spark, sf).select("transaction_id", "tx_amount")), "message")


@query("stream_job", f"WITH {TX} SELECT transaction_id::VARCHAR AS key, {_MESSAGE} AS value FROM tx")
def stream_job(spark, sf):
    """JSON messages, each twice, through the whole stream job."""
    sent = _twice(tx_stream(spark, sf)).select(F.to_json(F.struct(*PAYLOAD_COLUMNS)).cast("binary").alias("value"))
    return run_and_read(st.run_stream(sent, st.StreamConfig(schema=PAYLOAD)), "job")


@query(
    "stream_fraud_share",
    f"""WITH {TX}, w AS (SELECT unix_time // 300 * 300 AS start_time, count(*) AS n, sum(tx_fraud)::BIGINT AS frauds,
          max(max(unix_time)) OVER () - 86400 AS mark FROM tx GROUP BY 1)
    SELECT start_time, n, frauds, {r6('100.0::DOUBLE * frauds / n', 'fraud_percent')} FROM w WHERE start_time + 300 <= mark""",
)
def stream_fraud_share(spark, sf):
    """Windows close once the watermark has passed them."""
    rows = tx_stream(spark, sf).select(
        F.timestamp_seconds("unix_time").alias("at"), label_text("tx_fraud").alias("label")
    )
    shares = run_and_read(st.stream_monitor(rows, "at"), "share")
    return rounded(
        shares.select(F.unix_timestamp("window.start").alias("start_time"), "n", "frauds", "fraud_percent")
    )


@query(
    "stream_counts",
    f"""WITH {TX}, w AS (SELECT unix_time // 3600 * 3600 AS start_time, CASE WHEN tx_fraud = 1 THEN 'fraud' ELSE 'normal' END AS label,
          'v' || (customer_id % 3) AS version, count(*) AS n FROM tx GROUP BY ALL)
    SELECT * FROM w WHERE start_time + 3600 <= (SELECT max(unix_time) - 86400 FROM tx)""",
)
def stream_counts(spark, sf):
    rows = tx_stream(spark, sf).select(
        F.timestamp_seconds("unix_time").alias("at"),
        label_text("tx_fraud").alias("label"),
        F.concat(F.lit("v"), F.col("customer_id") % 3).alias("version"),
    )
    counts = run_and_read(st.stream_counts(rows, "at", length="1 hour"), "counts")
    return counts.select(F.unix_timestamp("window.start").alias("start_time"), "label", "version", "n")


@query(
    "stream_quarantine",
    f"""WITH {TX} SELECT CASE WHEN transaction_id % 7 = 0 OR transaction_id % 5 = 0 THEN 'bad' ELSE 'good' END AS part,
        count(*) AS n, min(transaction_id) AS first_id, max(transaction_id) AS last_id FROM tx GROUP BY 1""",
)
def stream_quarantine(spark, sf):
    """A list payload is no single record, so it is quarantined with the undecodable text."""
    good, bad, checkpoint = (scratch_path(spark, n) for n in ("good", "bad", "quarantine-checkpoint"))
    sent = payloads(tx_stream(spark, sf))
    st.quarantine_sink(sent, PAYLOAD, good, bad, checkpoint).start().awaitTermination()
    parts = [
        spark.read.parquet(path).select(F.lit(part).alias("part"), F.col(key).alias("id"))
        for part, path, key in (("good", good, "transaction_id"), ("bad", bad, "offset"))
    ]
    return parts[0].unionByName(parts[1]).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )


@query(
    "stream_job_rejects",
    f"""WITH {TX} SELECT CASE transaction_id % 10 WHEN 0 THEN 'undecodable,unix_time' WHEN 1 THEN 'unix_time' ELSE 'sent' END AS what,
        count(*) AS n FROM tx GROUP BY 1""",
)
def stream_job_rejects(spark, sf):
    """Broken text and records without a time beside good ones: what is not sent on is rejected, with its reason."""
    i = F.col("transaction_id")
    rows = tx_stream(spark, sf).withColumn("unix_time", F.when(i % 10 != 1, F.col("unix_time")))
    text = F.when(i % 10 == 0, F.lit("{broken")).otherwise(F.to_json(F.struct(*PAYLOAD_COLUMNS)))
    sent, cfg = rows.select(text.cast("binary").alias("value")), st.StreamConfig(schema=PAYLOAD)
    good = run_and_read(st.run_stream(sent, cfg), "job-good").select(F.lit("sent").alias("what"))
    bad = run_and_read(st.run_rejects(sent, cfg), "job-bad").select(F.array_join("reasons", ",").alias("what"))
    return good.unionByName(bad).groupBy("what").agg(F.count("*").alias("n"))


@query(
    "stream_record_rejects",
    f"""WITH {TX} SELECT what, count(*) AS n FROM (SELECT unnest(CASE transaction_id % 4 WHEN 0 THEN ['good', 'not an object']
        WHEN 1 THEN ['good', 'unix_time'] WHEN 2 THEN ['not an object'] ELSE ['good'] END) AS what FROM tx) GROUP BY 1""",
)
def stream_record_rejects(spark, sf):
    """Lists with a good record beside a number or beside one without a time, plain text, and single records."""
    i = F.col("transaction_id")
    rows = tx_stream(spark, sf).withColumn("good", F.to_json(F.struct(*PAYLOAD_COLUMNS)))
    rows = rows.withColumn("short", F.to_json(F.struct(*[c for c in PAYLOAD_COLUMNS if c != "unix_time"])))
    text = (
        F.when(i % 4 == 0, F.concat(F.lit("["), "good", F.lit(", 7]")))
        .when(i % 4 == 1, F.concat(F.lit("["), "short", F.lit(","), "good", F.lit("]")))
        .when(i % 4 == 2, F.lit("no json"))
        .otherwise(F.col("good"))
    )
    sent = rows.select(text.alias("value"))
    good = run_and_read(explode_payload(sent, PAYLOAD).where(F.col("unix_time").isNotNull()), "records").select(F.lit("good").alias("what"))
    bad = run_and_read(rejected_records(sent, PAYLOAD), "rejected").select(F.array_join("reasons", ",").alias("what"))
    return good.unionByName(bad).groupBy("what").agg(F.count("*").alias("n"))


# three arrivals; broken records, records twice, and later arrivals that lie behind the watermark for the most part
_ARRIVALS = f"""{TX}, a AS (SELECT *, transaction_id % 3 AS arrival, transaction_id % 10 = 0 AS broken FROM tx),
    m AS (SELECT k.range AS arrival, max(unix_time) - 86400 AS mark FROM range(3) k LEFT JOIN a ON a.arrival < k.range AND NOT broken GROUP BY 1)"""


@query(
    "stream_balance",
    f"""WITH {_ARRIVALS}, c AS (SELECT arrival, CASE WHEN arrival = 0 THEN 2 ELSE 1 END AS times, broken, coalesce(unix_time <= mark, false) AS late FROM a JOIN m USING (arrival))
    SELECT arrival::INT AS arrival, sum(times)::BIGINT AS received, coalesce(sum(times) FILTER (broken), 0)::BIGINT AS rejected,
      coalesce(sum(times) FILTER (NOT broken AND late), 0)::BIGINT AS late, coalesce(sum(times - 1) FILTER (NOT broken), 0)::BIGINT AS duplicates,
      count(*) FILTER (NOT broken AND NOT late) AS sent, true AS balanced FROM c GROUP BY 1""",
)
def stream_balance(spark, sf):
    """Every message is sent, late, a duplicate or rejected; the account comes from the progress of the batches."""
    rows, cfg = tx(spark, sf), st.StreamConfig(schema=PAYLOAD)
    arrival = F.col("transaction_id") % 3
    text = F.when(F.col("transaction_id") % 10 == 0, "{broken").otherwise(F.to_json(F.struct(*PAYLOAD_COLUMNS)))
    inbox, out, checkpoint = (scratch_path(spark, n) for n in ("balance-in", "balance-out", "balance-checkpoint"))
    account = None
    for k in range(3):
        log = scratch_path(spark, "progress")
        sent = rows.where(arrival == k).select(text.alias("value"))
        # the first arrival comes twice; most of the others lies behind the watermark that it leaves
        (_twice(sent) if k == 0 else sent).write.mode("append").text(inbox)
        running = st.run_to_files(st.run_counted(spark.readStream.text(inbox), cfg), out, checkpoint).start()
        running.awaitTermination()
        progress.keep_finished(spark, log, running)
        sums = progress.balance(progress.read_progress(spark, log)).agg(
            F.lit(k).alias("arrival"),
            *[F.sum(c).alias(c) for c in ("received", "rejected", "late", "duplicates", "sent")],
            F.bool_and("balanced").alias("balanced"),
        )
        account = sums if account is None else account.unionByName(sums)
    return account


@query(
    "topic_lag_from_progress",
    """SELECT event_type AS topic, count(*) AS input_total, count(*) FILTER (event_id % 3 > 0) AS output_total, count(*) FILTER (event_id % 3 = 0) AS lag
    FROM events GROUP BY 1""",
)
def topic_lag_from_progress(spark, sf):
    """Offsets of a topic per event type with four partitions, as two batches report them; no topic is read for the lag."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    read = F.count_if(F.col("event_id") % 3 > 0)
    parts = events.groupBy(F.col("event_type").alias("topic"), (F.col("user_id") % 4).cast("string").alias("part")).agg(F.count("*").alias("latest"), read.alias("end"))

    def offsets(col):
        return F.map_from_entries(F.collect_list(F.struct("part", col)))

    topics = parts.groupBy("topic").agg(offsets("latest").alias("latest"), offsets("end").alias("end"), offsets(F.floor(F.col("end") / 2)).alias("half"))
    runs = topics.groupBy().agg(*[F.map_from_entries(F.collect_list(F.struct("topic", c))).alias(c) for c in ("latest", "end", "half")])
    batches = runs.select(F.explode(F.array(F.struct(F.lit(0).alias("k"), F.col("half").alias("end")), F.struct(F.lit(1).alias("k"), "end"))).alias("b"), "latest")
    source = F.array(F.struct(F.col("b.end").alias("endOffset"), F.col("latest").alias("latestOffset")))
    report = F.struct(F.lit("run").alias("runId"), F.col("b.k").alias("batchId"), F.col("b.k").cast("string").alias("timestamp"), source.alias("sources"))
    path = scratch_path(spark, "progress")
    batches.select(F.to_json(report).alias("value")).write.text(path)
    return progress.lag_from_progress(progress.read_progress(spark, path))


_LE = ", ".join(f"{b}::DOUBLE" for b in LATENCY_BOUNDS) + ", 'inf'::DOUBLE"


@query(
    "stream_latency_histogram",
    f"""WITH {TX}, p AS (SELECT unix_time // 3600 * 3600 AS start_time, 'v' || (customer_id % 3) AS version, tx_amount / 100 AS latency FROM tx), b AS (SELECT unnest([{_LE}]) AS le)
    SELECT start_time, version, le::VARCHAR AS le, count(*) FILTER (latency <= le) AS bucket_count, {r6("sum(latency)", "total_sum")}, count(*) AS total_count
    FROM p, b WHERE start_time + 3600 <= (SELECT max(unix_time) - 86400 FROM tx) GROUP BY ALL""",
)
def stream_latency_histogram(spark, sf):
    """Cumulative buckets per hour and version, appended as the watermark closes the hours."""
    rows = tx_stream(spark, sf).select(
        F.timestamp_seconds("unix_time").alias("at"), (F.col("tx_amount") / 100).alias("latency"), F.concat(F.lit("v"), F.col("customer_id") % 3).alias("version")
    )
    out = run_and_read(st.stream_histogram(rows, "at", "latency", length="1 hour"), "latency")
    text = F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("string"))
    return rounded(out.select(F.unix_timestamp("window.start").alias("start_time"), "version", text.alias("le"), "bucket_count", "total_sum", "total_count"))
