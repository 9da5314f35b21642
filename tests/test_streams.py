import json

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tallywire.queries.common import PAYLOAD, PAYLOAD_COLUMNS, payloads, tx, tx_stream
from tallywire.schemas import CONTRACT, FEATURE
from tallywire.sources import messages
from tallywire.streaming import progress
from tallywire.streaming import transforms as st


def test_kafka_options():
    security = messages.kafka_security("me", "secret", "/ca.pem")
    assert security["kafka.security.protocol"] == "SASL_SSL"
    assert security["kafka.sasl.mechanism"] == "SCRAM-SHA-512"
    assert "username='me' password='secret'" in security["kafka.sasl.jaas.config"]
    source = messages.kafka_source_options("h:9092", "in", security)
    assert (source["subscribe"], source["startingOffsets"], source["failOnDataLoss"]) == ("in", "earliest", "false")
    sink = messages.kafka_sink_options("h:9092", "out")
    assert sink == {"kafka.bootstrap.servers": "h:9092", "topic": "out"}


def _run(df, path, checkpoint):
    st.run_to_files(df, path, checkpoint).start().awaitTermination()


def test_restart_goes_on_from_the_checkpoint(spark, tmp_path):
    rows = tx(spark, SF).select("transaction_id", "unix_time", "tx_amount")
    inbox, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    stream = lambda: st.stream_dedup(st.with_event_time(spark.readStream.schema(rows.schema).parquet(inbox)))
    rows.where("transaction_id < 500").write.mode("append").parquet(inbox)
    _run(stream(), out, cp)
    _run(stream(), out, cp)
    assert spark.read.parquet(out).count() == 500
    # old rows again, and new ones: only what is new and not behind the watermark comes out
    rows.where("transaction_id >= 450").write.mode("append").parquet(inbox)
    _run(stream(), out, cp)
    seen = spark.read.parquet(out)
    assert seen.count() == seen.select("transaction_id").distinct().count() == rows.count()


def test_stream_job_equals_batch(spark, tmp_path):
    sent = tx_stream(spark, SF).select(F.to_json(F.struct(*PAYLOAD_COLUMNS)).alias("value"))
    out = st.run_stream(sent, st.StreamConfig(schema=PAYLOAD))
    _run(out, str(tmp_path / "o"), str(tmp_path / "c"))
    got = {r["key"]: json.loads(r["value"]) for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    want = {str(r[0]): {"transaction_id": r[0], "tx_amount": r[1]} for r in tx(spark, SF).select("transaction_id", "tx_amount").collect()}
    assert got == want


def test_unreadable_messages_do_not_enter_the_state(spark, tmp_path):
    sent = payloads(tx_stream(spark, SF)).select("value")
    out = st.run_stream(sent, st.StreamConfig(schema=PAYLOAD))
    _run(out, str(tmp_path / "o"), str(tmp_path / "c"))
    keys = {r[0] for r in spark.read.parquet(str(tmp_path / "o")).select("key").collect()}
    assert None not in keys and "0" not in keys


def test_split_bad(spark):
    rows = [('{"transaction_id": 1, "tx_amount": 2.5}',), ("xx",), (None,), ("[1]",), ('{"transaction_id": "x"}',)]
    good, bad = messages.split_bad(spark.createDataFrame(rows, "value string"), PAYLOAD)
    assert [r["transaction_id"] for r in good.collect()] == [1]
    assert bad.count() == 4 and bad.columns == ["value"]


def test_payload_shapes(spark):
    rows = [('{"transaction_id": 1}',), ('[{"transaction_id": 2}, {"transaction_id": 3}]',), ("5",), ('"text"',), ("xx",)]
    out = messages.explode_payload(spark.createDataFrame(rows, "value string"), PAYLOAD)
    assert {r["transaction_id"] for r in out.collect()} >= {1, 2, 3}
    assert out.where("transaction_id is not null").count() == 3


def test_full_contract(spark):
    kinds = {"int": 1, "bigint": 1, "double": 1.5}
    record = {f.name: kinds[f.dataType.simpleString()] for f in CONTRACT.fields}
    short = {k: v for k, v in record.items() if k != "is_night"}
    wrong = {**record, "hour_sin": "north"}
    df = spark.createDataFrame([(json.dumps(r),) for r in (record, short, wrong)], "value string")
    good, rejected = messages.validate(df)
    assert good.count() == 1 and len(good.columns) == 63
    assert sorted(r["reasons"] for r in rejected.collect()) == [["hour_sin"], ["is_night"]]


def test_messages_keep_a_closed_range(spark):
    df = spark.createDataFrame([(1, 10, 1.5, True), (2, 20, 2.5, False), (3, 21, 1.0, True)], "transaction_id int, unix_time int, tx_amount double, tx_fraud boolean")
    out = [json.loads(r[0]) for r in messages.to_messages(df, 10, 20).collect()]
    assert out == [
        {"transaction_id": 1, "unix_time": 10, "tx_amount": 1.5, "tx_fraud": 1},
        {"transaction_id": 2, "unix_time": 20, "tx_amount": 2.5, "tx_fraud": 0},
    ]


def test_archive_layout(spark, tmp_path):
    records = tx_stream(spark, SF).withColumn("at", F.timestamp_seconds("unix_time"))
    writer = messages.archive_stream(records, str(tmp_path / "a"), "at", str(tmp_path / "c"), max_records=20, interval=None)
    writer.start().awaitTermination()
    files = list((tmp_path / "a").glob("year=2024/month=*/day=*/*.gz.parquet"))
    assert len(files) > 31
    assert max(spark.read.parquet(str(f)).count() for f in files[:5]) <= 20


@pytest.mark.parametrize("within", [False, True])
def test_same_id_with_another_time(spark, tmp_path, within):
    df = spark.createDataFrame([(1, 1_700_000_000), (1, 1_700_000_060)], "transaction_id bigint, unix_time bigint")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    arriving = st.with_event_time(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    _run(st.stream_dedup(arriving, within_watermark=within), str(tmp_path / "o"), str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == (1 if within else 2)


def test_default_stream_uses_the_feature_schema(spark, tmp_path):
    assert st.StreamConfig().schema == FEATURE
    df = spark.createDataFrame([('{"transaction_id": 7, "unix_time": 1700000000, "tx_fraud": 1}',)], "value string")
    df.write.text(str(tmp_path / "in"))
    _run(st.run_stream(spark.readStream.text(str(tmp_path / "in"))), str(tmp_path / "o"), str(tmp_path / "c"))
    row = spark.read.parquet(str(tmp_path / "o")).first()
    sent = json.loads(row["value"])
    assert row["key"] == "7" and len(sent) == 63 and sent["is_night"] == 0 and "tx_fraud" not in sent


def test_listener_keeps_the_account(spark, tmp_path):
    """Batch by batch, also for a restart; a repeated report counts once."""
    log = str(tmp_path / "log")
    listener = progress.ProgressLog(spark, log, ("account",))
    spark.streams.addListener(listener)
    try:
        for k, rows in enumerate([[(1, 1_700_000_000), (1, 1_700_000_000), (2, None)], [(3, 1_700_000_100), (1, 1_700_000_000)]]):
            df = spark.createDataFrame(rows, "transaction_id bigint, unix_time bigint").select(F.to_json(F.struct("*")).alias("value"))
            df.coalesce(1).write.mode("append").text(str(tmp_path / "in"))
            stream = st.run_counted(spark.readStream.text(str(tmp_path / "in")), st.StreamConfig(schema=PAYLOAD))
            running = st.run_to_files(stream, str(tmp_path / "o"), str(tmp_path / "c")).queryName("account").start()
            running.awaitTermination()
            progress.keep_finished(spark, log, running)
    finally:
        # the listener bus delivers before it is left
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        spark.streams.removeListener(listener)
    rows = progress.balance(progress.read_progress(spark, log)).groupBy("runId").agg(
        *[F.sum(c).alias(c) for c in ("received", "rejected", "late", "duplicates", "sent")], F.bool_and("balanced").alias("balanced")
    )
    assert sorted(tuple(r)[1:] for r in rows.collect()) == [(2, 0, 0, 1, 1, True), (3, 1, 0, 1, 1, True)]


def test_lag_of_unread_and_new_partitions(spark, tmp_path):
    report = {"runId": "r", "timestamp": "t"}
    lines = [
        {**report, "batchId": 0, "sources": [{"endOffset": {"a": {"0": 1}}, "latestOffset": {"a": {"0": 9}}}]},
        {**report, "batchId": 1, "sources": [{"endOffset": {"a": {"0": 5}}, "latestOffset": {"a": {"0": 9, "1": 4}, "b": {"0": 2}}}]},
    ]
    progress.keep_progress(spark, str(tmp_path / "p"), map(json.dumps, lines))
    lag = progress.lag_from_progress(progress.read_progress(spark, str(tmp_path / "p")))
    assert sorted(map(tuple, lag.collect())) == [("a", 13, 5, 8), ("b", 2, 0, 2)]


def test_score_job_keeps_counts_and_latency(spark, tmp_path, monkeypatch):
    from tallywire.plans import jobs

    class Known:
        def __init__(self, *_):
            pass

        def resolve(self, *_):
            return 1

        def load(self, *_):
            return None

    messages_in = spark.readStream.schema("value string, timestamp timestamp").parquet(str(tmp_path))
    scored = messages_in.select(F.lit(1).alias("transaction_id"), F.lit("fraud").alias("label"), F.lit("1").alias("version"), "timestamp", F.lit(0.5).alias("latency"))
    monkeypatch.setattr(jobs, "Registry", Known)
    monkeypatch.setattr(jobs, "kafka_source", lambda *a, **b: messages_in)
    monkeypatch.setattr(jobs, "kafka_sink", lambda *a, **b: "sink")
    monkeypatch.setattr(jobs, "score_stream", lambda *a, **b: messages_in)
    monkeypatch.setattr(jobs, "scored_latency", lambda *a, **b: scored)
    writers = jobs.score_job(spark, "h:1", "in", "out", str(tmp_path / "c"), "registry", rejects=str(tmp_path / "r"), metrics=str(tmp_path / "m"))
    assert len(writers) == 4 and writers[0] == "sink"
    assert len(jobs.score_job(spark, "h:1", "in", "out", str(tmp_path / "c"), "registry")) == 1
