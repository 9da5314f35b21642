"""Section A: sources, sinks, state."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywire.functions import DAY, date_of, with_calendar
from tallywire.operators.clean import with_clean_time
from tallywire.operators.slices import span
from tallywire.queries.common import (
    PAYLOAD,
    PAYLOAD_COLUMNS,
    TX,
    TX_CSV,
    query,
    rounded,
    r6,
    table,
    tx,
    tx_stream,
    write_csv,
)
from tallywire.session import scratch_path
from tallywire.sources import compaction, files, manifest, messages, state


@query("csv_permissive_scan", f"WITH {TX_CSV} SELECT * FROM tx_csv")
def csv_permissive_scan(spark, sf):
    return files.read_raw_csv(spark, write_csv(spark, sf))


@query(
    "csv_parse_lines",
    f"WITH {TX_CSV} SELECT transaction_id, customer_id, tx_amount, _corrupt FROM tx_csv",
)
def csv_parse_lines(spark, sf):
    from tallywire.queries.common import csv_lines

    parsed = csv_lines(spark, sf).select(files.parse_raw_csv("value").alias("r"))
    return parsed.select("r.transaction_id", "r.customer_id", "r.tx_amount", "r._corrupt")


@query("parquet_scan_project", "SELECT event_id, user_id, value FROM events")
def parquet_scan_project(spark, sf):
    return files.read_table(spark, f"{sf}/events.parquet", ["event_id", "user_id", "value"])


@query(
    "hash_sample",
    "SELECT event_id, user_id, value FROM events "
    "WHERE ('0x' || substr(md5(event_id || ':42'), 1, 8))::BIGINT < floor(0.1 * 4294967296)",
)
def hash_sample(spark, sf):
    events = files.read_table(spark, f"{sf}/events.parquet", ["event_id", "user_id", "value"])
    return files.hash_sample(events, "event_id", 0.1, 42)


@query("bernoulli_sample", "SELECT true AS rows_of_table, true AS no_repeats, true AS share_within_5_sigma")
def bernoulli_sample(spark, sf):
    """A tenth of the events: known rows, each once, as many as chance allows."""
    drawn = files.read_sample(spark, f"{sf}/events.parquet", 0.1, 42, ["event_id", "value"])
    every = table(spark, sf, "events").select(F.col("event_id").alias("id"), F.col("value").alias("known"))
    n = every.agg(F.count("*")).scalar()
    same = (F.col("event_id") == F.col("id")) & F.col("value").eqNullSafe(F.col("known"))
    return drawn.join(every, same, "left").agg(
        (F.count("id") == F.count("*")).alias("rows_of_table"),
        (F.count_distinct("event_id") == F.count("*")).alias("no_repeats"),
        (F.abs(F.count("*") - 0.1 * n) <= 5 * F.sqrt(0.09 * n)).alias("share_within_5_sigma"),
    )


@query("json_decode", f"WITH {TX} SELECT transaction_id, unix_time, tx_amount, tx_fraud FROM tx")
def json_decode(spark, sf):
    sent = tx(spark, sf).select(F.to_json(F.struct(*PAYLOAD_COLUMNS)).cast("binary").alias("value"))
    return messages.decode_json(sent, PAYLOAD)


_BY_WEEK = """SELECT strftime(date_trunc('week', make_timestamp(unix_time * 1000000)), '%Y-%m-%d') AS week,
       count(*) AS n, min(unix_time) AS first_time, max(unix_time) AS last_time, {total}
FROM tx GROUP BY 1"""


@query("write_read_by_week", f"WITH {TX} " + _BY_WEEK.format(total=r6("sum(tx_amount)", "total")))
def write_read_by_week(spark, sf):
    path = scratch_path(spark, "by-week")
    rows = with_clean_time(tx(spark, sf).withColumn("tx_datetime", F.timestamp_seconds("unix_time")))
    files.write_partitioned(rows, path, "week", "unix_time")
    back = spark.read.parquet(path).groupBy(F.date_format("week", "yyyy-MM-dd").alias("week"))
    return rounded(
        back.agg(
            F.count(F.lit(1)).alias("n"),
            F.min("unix_time").alias("first_time"),
            F.max("unix_time").alias("last_time"),
            F.sum("tx_amount").alias("total"),
        )
    )


@query(
    "write_read_by_date",
    f"WITH {TX} SELECT make_timestamp(unix_time * 1000000)::DATE AS date, count(*) AS n, {r6('sum(tx_amount)', 'total')} "
    "FROM tx GROUP BY 1",
)
def write_read_by_date(spark, sf):
    path = scratch_path(spark, "by-date")
    files.write_partitioned(with_calendar(tx(spark, sf)), path, "date", "unix_time")
    back = spark.read.parquet(path).groupBy("date")
    return rounded(back.agg(F.count(F.lit(1)).alias("n"), F.sum("tx_amount").alias("total")))


@query(
    "write_read_sorted",
    f"WITH {TX} SELECT make_timestamp(unix_time * 1000000)::DATE AS date, count(*) AS n, min(unix_time) AS first, max(unix_time) AS last, "
    "0::BIGINT AS inversions FROM tx GROUP BY 1",
)
def write_read_sorted(spark, sf):
    """Rows that stand before an earlier one in the files of `write_partitioned`, by date."""
    path = scratch_path(spark, "sorted")
    files.write_partitioned(with_calendar(tx(spark, sf)), path, "date", "unix_time")
    return _by_date(compaction.inversions(spark.read.parquet(path), "unix_time", ["date"]))


def _by_date(inverted):
    figures = [F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("inversions").alias("inversions")]
    return inverted.groupBy("date").agg(*figures)


@query(
    "compacted_table",
    f"""WITH {TX} SELECT make_timestamp(unix_time * 1000000)::DATE AS date, count(*) AS n, min(unix_time) AS first, max(unix_time) AS last,
           0::BIGINT AS inversions, {r6('sum(tx_amount)', 'total')}, count(DISTINCT transaction_id % 5) AS files_before, 1::BIGINT AS files_after
    FROM tx GROUP BY 1""",
)
def compacted_table(spark, sf):
    """The events by date, written in five small files a day and compacted to one."""
    path, done = scratch_path(spark, "small-files"), scratch_path(spark, "compaction")
    rows = with_calendar(tx(spark, sf)).withColumn("_part", (F.col("transaction_id") % 5).cast("int"))
    rows = rows.repartitionById(5, "_part").sortWithinPartitions("date", "unix_time").drop("_part")
    rows.write.partitionBy("date").parquet(path)
    before = compaction.inversions(spark.read.parquet(path), "unix_time", ["date"]).groupBy("date").agg(F.count("*").alias("files_before"))
    before.write.parquet(f"{done}/before")
    compaction.compact(spark, path, f"{done}/state", f"{done}/staged", "date", "unix_time")
    back = spark.read.parquet(path)
    files_after = compaction.inversions(back, "unix_time", ["date"])
    after = _by_date(files_after).join(files_after.groupBy("date").agg(F.count("*").alias("files_after")), "date")
    totals = rounded(back.groupBy("date").agg(F.sum("tx_amount").alias("total")))
    return after.join(totals, "date").join(spark.read.parquet(f"{done}/before"), "date")


@query(
    "archive_by_day",
    f"""WITH {TX}, m AS (SELECT *, make_timestamp(unix_time * 1000000) AT TIME ZONE 'UTC'
             AT TIME ZONE 'Europe/Moscow' AS local FROM tx)
    SELECT strftime(local, '%Y') AS year, strftime(local, '%m') AS month, strftime(local, '%d') AS day,
           count(*) AS n, {r6('sum(tx_amount)', 'total')} FROM m GROUP BY ALL""",
)
def archive_by_day(spark, sf):
    path, checkpoint = scratch_path(spark, "archive"), scratch_path(spark, "archive-checkpoint")
    records = tx_stream(spark, sf).withColumn("record_time", F.timestamp_seconds("unix_time"))
    messages.archive_stream(records, path, "record_time", checkpoint, interval=None).start().awaitTermination()
    schema = messages.with_archive_path(records, "record_time").schema
    back = spark.read.schema(schema).parquet(path).groupBy("year", "month", "day")
    return rounded(back.agg(F.count(F.lit(1)).alias("n"), F.sum("tx_amount").alias("total")))


@query("watermark_roundtrip", f"WITH {TX} SELECT max(unix_time) AS old_end_datetime FROM tx")
def watermark_roundtrip(spark, sf):
    path = scratch_path(spark, "state")
    for end in span(tx(spark, sf), "unix_time").first():
        state.write_state(spark, path, {"old_end_datetime": end})
    done = state.read_state(spark, path)
    return spark.createDataFrame([(done["old_end_datetime"],)], "old_end_datetime bigint")


@query(
    "file_count_plan",
    """SELECT sum(n_chars)::BIGINT AS total_bytes, greatest(1, ceil(sum(n_chars) / 3.0::DOUBLE / 1048576))::INT AS n_files
    FROM documents""",
)
def file_count_plan(spark, sf):
    """The rule over text sizes as if each document were a file."""
    sizes = table(spark, sf, "documents").select(F.col("n_chars").cast("bigint").alias("length"))
    return files.file_count_for(sizes, target_mb=1)


_RANGE = (1704672000, 1705276800)


@query(
    "messages_encode",
    f"""WITH {TX} SELECT to_json(struct_pack(transaction_id := transaction_id, unix_time := unix_time,
        tx_amount := tx_amount, tx_fraud := tx_fraud::BIGINT))::VARCHAR AS value
    FROM tx WHERE unix_time BETWEEN {_RANGE[0]} AND {_RANGE[1]}""",
)
def messages_encode(spark, sf):
    return messages.to_messages(tx(spark, sf).select(*PAYLOAD_COLUMNS), *_RANGE)


@query(
    "topic_lag",
    """SELECT (SELECT count(*) FROM events) AS input_total,
              (SELECT count(*) FROM events WHERE event_type <> 'error') AS output_total,
              (SELECT count(*) FROM events WHERE event_type = 'error') AS lag""",
)
def topic_lag(spark, sf):
    events = table(spark, sf, "events")
    return messages.topic_lag(events, events.where(F.col("event_type") != "error"))


@query(
    "topic_offsets",
    """WITH p AS (SELECT event_type AS topic, user_id % 4 AS partition, max(event_id) + 1 AS high, min(event_id) AS low
                  FROM events GROUP BY ALL)
    SELECT topic, sum(high)::BIGINT AS high, sum(high - low)::BIGINT AS retained FROM p GROUP BY 1""",
)
def topic_offsets(spark, sf):
    records = table(spark, sf, "events").select(
        F.col("event_type").alias("topic"), (F.col("user_id") % 4).alias("partition"), F.col("event_id").alias("offset")
    )
    return messages.topic_offsets(records)


@query(
    "registry_resolve",
    f"""WITH {TX}, r AS (SELECT transaction_id AS seq, 'model_' || terminal_id AS name, customer_id AS version,
          CASE transaction_id % 3 WHEN 0 THEN 'best' WHEN 1 THEN 'old_best' END AS alias FROM tx)
    SELECT name, max(version) AS latest, arg_max(version, seq) FILTER (alias = 'best') AS best,
           arg_max(version, seq) FILTER (alias = 'old_best') AS old_best FROM r GROUP BY 1""",
)
def registry_resolve(spark, sf):
    i = F.col("transaction_id")
    rows = tx(spark, sf).select(
        i.alias("seq"),
        F.concat(F.lit("model_"), "terminal_id").alias("name"),
        F.col("customer_id").alias("version"),
        F.when(i % 3 == 0, "best").when(i % 3 == 1, "old_best").alias("alias"),
    )
    return state.resolve_registry(rows)


@query(
    "input_example",
    f"WITH {TX} SELECT transaction_id, tx_amount, unix_time FROM tx ORDER BY transaction_id LIMIT 5",
)
def input_example(spark, sf):
    return state.input_example(tx(spark, sf), ["transaction_id", "tx_amount", "unix_time"])


@query(
    "run_log",
    f"""WITH {TX} SELECT 'run_' || customer_id AS run, count(*)::DOUBLE AS n, {r6('avg(tx_fraud)', 'share')},
        max(tx_amount) AS top FROM tx GROUP BY ALL""",
)
def run_log(spark, sf):
    path = scratch_path(spark, "runs")
    wide = tx(spark, sf).groupBy(F.concat(F.lit("run_"), "customer_id").alias("run")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.avg("tx_fraud").alias("share"),
        F.max("tx_amount").alias("top"),
    )
    long = wide.unpivot("run", ["n", "share", "top"], "key", "value")
    long = long.select("run", F.lit("metric").alias("kind"), "key", F.col("value").cast("string").alias("value"))
    long.write.parquet(path)
    return rounded(state.runs_wide(state.read_or_empty(spark, path, state.RUNS), ["n", "share", "top"]))


@query(
    "file_zones",
    f"""WITH {TX}, d AS (SELECT *, make_timestamp(unix_time * 1000000)::DATE AS date FROM tx),
    cut AS (SELECT make_timestamp((min(unix_time) + max(unix_time)) // 2 * 1000000)::DATE AS half FROM tx)
    SELECT date, count(*) AS n, min(unix_time) AS first, max(unix_time) AS last, date >= half AS second_refresh FROM d, cut GROUP BY date, half""",
)
def file_zones(spark, sf):
    """A table by date whose later half arrives after a first refresh: the range of each file, and which refresh read it."""
    path, noted = scratch_path(spark, "zoned"), scratch_path(spark, "manifest")
    rows = with_calendar(tx(spark, sf))
    half = rows.agg(date_of(F.floor((F.min("unix_time") + F.max("unix_time")) / 2))).scalar()
    known = manifest.Manifest(spark, noted, path, "unix_time", manifest.parquet_files(path))
    for part in (F.col("date") < half, F.col("date") >= half):
        files.write_partitioned(rows.where(part), path, "date", "unix_time")
        new = known.refresh()
    dated = known.table().withColumn("date", F.regexp_extract("path", "/date=([0-9-]+)/", 1).cast("date"))
    return dated.groupBy("date").agg(
        F.sum("n").alias("n"), F.min("lo").alias("first"), F.max("hi").alias("last"), F.bool_and(F.col("path").isin(new)).alias("second_refresh")
    )


@query(
    "slice_by_manifest",
    f"""WITH {TX}, cut AS (SELECT min(unix_time) + (max(unix_time) - min(unix_time)) // 2 AS lo FROM tx)
    SELECT transaction_id, unix_time, tx_amount, make_timestamp(unix_time * 1000000)::DATE AS date, true AS few_files_opened
    FROM tx, cut WHERE unix_time >= lo AND unix_time < lo + {2 * DAY}""",
)
def slice_by_manifest(spark, sf):
    """Two days from the middle of a table by date, bounds and files taken from the manifest: three files of thirty are opened."""
    path = scratch_path(spark, "sliced")
    files.write_partitioned(with_calendar(tx(spark, sf)), path, "date", "unix_time")
    known = manifest.Manifest(spark, scratch_path(spark, "manifest"), path, "unix_time", manifest.parquet_files(path))
    known.refresh()
    ends = known.span().first()
    lo = ends["min_value"] + (ends["max_value"] - ends["min_value"]) // 2
    rows = known.slice(lo, lo + 2 * DAY)
    opened = F.lit(len(rows.inputFiles()) <= 3)
    return rows.select("transaction_id", "unix_time", "tx_amount", "date", opened.alias("few_files_opened"))
