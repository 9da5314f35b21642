import pytest
from conftest import values
from pyspark.sql import functions as F

from tallywire.operators.clean import clean_rows, dedup, quality_report
from tallywire.plans.jobs import CleanConfig, clean_job
from tallywire.queries.common import csv_lines
from tallywire.sources.files import file_count_for, plan_file_count, read_raw_csv, write_partitioned
from tallywire.sources.state import read_state

LINES = """# a comment
1,2024-01-01 10:00:00,5,7,12.5,10,0,0,0
2,2024-01-01 24:00:00,-5,,12.5,10,0,1,0
3,garbage,5,7,12.5,10,0,0,0
4,2024-01-01 10:00:00,x,7,12.5,10,0,0,0
5,2024-01-01 10:00:00,5,7
6,2024-01-01 10:00:00,5,7,-1,10,0,0,0
7,2024-01-01 10:00:00,5,7,1,10,0,3,0
-8,2024-01-01 10:00:00,5,7,1,10,0,0,0
9,2024-01-07 23:59:59,5,7,1,-3,,0,0
9,2024-01-07 23:59:59,5,7,1,-3,,0,0
"""


@pytest.fixture
def raw(spark, tmp_path):
    (tmp_path / "a.csv").write_text(LINES)
    return read_raw_csv(spark, str(tmp_path))


def test_permissive_scan_keeps_bad_rows(raw):
    bad = {r["_corrupt"] for r in raw.where("_corrupt is not null").select("_corrupt").collect()}
    assert bad == {"4,2024-01-01 10:00:00,x,7,12.5,10,0,0,0", "5,2024-01-01 10:00:00,5,7"}
    assert raw.count() == 10


def test_corrupt_flag_is_the_same_for_few_columns(raw):
    assert raw.select("_corrupt").where("_corrupt is not null").count() == 2


def test_clean_rows(raw):
    rows = {r["transaction_id"]: r for r in clean_rows(raw).collect()}
    assert set(rows) == {1, 2, 9}
    assert str(rows[2]["tx_datetime"]) == "2024-01-01 23:59:59"
    assert (rows[2]["customer_id"], rows[2]["terminal_id"], rows[2]["tx_fraud"]) == (-1, -1, True)
    assert (rows[9]["tx_time_seconds"], rows[9]["tx_time_days"]) == (-1, -1)
    assert str(rows[9]["week"]) == "2024-01-01 00:00:00"


def test_quality_report_counts(raw):
    from tallywire.operators.clean import drop_corrupt, parse_time, with_sentinels

    report = quality_report(with_sentinels(parse_time(drop_corrupt(raw)))).first().asDict()
    assert report["rows_after_clean"] == 8 and report["duplicates"] == 1
    assert report["bad_tx_datetime"] == 1 and report["bad_transaction_id"] == 1
    assert report["bad_tx_amount"] == 1 and report["bad_tx_fraud"] == 1


def test_dedup_is_idempotent_and_fixed(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (1, None)], "k int, v string")
    once = dedup(df, ["k"])
    assert values(once) == [(1, None), (2, "c")]
    assert values(dedup(once, ["k"])) == values(once)
    assert values(dedup(df.repartition(3), ["k"], [F.desc("v")])) == [(1, "b"), (2, "c")]


def test_dedup_prunes_before_the_shuffle(spark):
    """One key with most of the rows must not travel to one task."""
    plan = dedup(spark.range(100).selectExpr("id % 2 as k", "id as v"), ["k"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2


def _lines(spark, sf="/root/testdata/sf0.001"):
    return csv_lines(spark, sf)


def test_incremental_runs_equal_one_run(spark, tmp_path):
    lines = _lines(spark)
    for part in ("all", "one", "two"):
        (tmp_path / part).mkdir()
    ident = F.split("value", ",")[0].cast("bigint")
    lines.write.mode("append").text(f"{tmp_path}/all")
    lines.where(ident < 600).write.mode("append").text(f"{tmp_path}/inbox")
    small = CleanConfig(record_limit=10, overlap=50)
    whole = clean_job(spark, f"{tmp_path}/all", f"{tmp_path}/out1", f"{tmp_path}/s1", small)
    first = clean_job(spark, f"{tmp_path}/inbox", f"{tmp_path}/out2", f"{tmp_path}/s2", small)
    # the second delivery repeats the last rows of the first
    lines.where(ident >= 550).write.mode("append").text(f"{tmp_path}/inbox")
    second = clean_job(spark, f"{tmp_path}/inbox", f"{tmp_path}/out2", f"{tmp_path}/s2", small)
    assert first["end_id"] == second["keep_from"] and second["end_id"] == whole["end_id"]
    one, two = (spark.read.parquet(f"{tmp_path}/{o}").drop("batch") for o in ("out1", "out2"))
    assert values(one) == values(two)
    assert clean_job(spark, f"{tmp_path}/inbox", f"{tmp_path}/out2", f"{tmp_path}/s2", small) is None
    assert read_state(spark, f"{tmp_path}/s2") == {"old_end_datetime": whole["end_id"]}


def test_rerun_after_a_crash_writes_nothing_twice(spark, tmp_path):
    """The state was not committed: the same batch, now longer, replaces what the first attempt wrote."""
    lines = _lines(spark)
    ident = F.split("value", ",")[0].cast("bigint")
    lines.where(ident < 600).write.text(f"{tmp_path}/in")
    small = CleanConfig(record_limit=10, overlap=50)
    clean_job(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/lost", small)
    lines.where(ident >= 600).write.mode("append").text(f"{tmp_path}/in")
    clean_job(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/kept", small)
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == out.select("transaction_id").distinct().count()


def test_file_counts(spark, tmp_path):
    sizes = spark.createDataFrame([("a", 3 * 1024 * 1024 * 600), ("b", 0)], "path string, length bigint")
    assert file_count_for(sizes).first()["n_files"] == 2
    assert file_count_for(sizes.where("length = 0")).first()["n_files"] == 1
    with pytest.raises(FileNotFoundError):
        plan_file_count(spark, str(tmp_path / "missing"))


def test_large_partitions_are_split_and_sorted(spark, tmp_path):
    df = spark.range(1000).selectExpr("'w' as week", "1000 - id as unix_time")
    write_partitioned(df, str(tmp_path / "t"), "week", "unix_time", max_records=100)
    assert len(list((tmp_path / "t" / "week=w").glob("*.parquet"))) >= 10


def test_broken_copies_do_not_displace_valid_ones(spark):
    from tallywire.operators.clean import clean_rows
    from tallywire.schemas import RAW

    good = ("2024-01-01 10:00:00", 1, 1, 5.0, 1, 1, 0, 0, None)
    rows = [(5, None, 1, 1, 5.0, 1, 1, 0, 0, None), (5, *good), (6, *good), (6, "2024-01-01 10:00:00", 1, 1, -1.0, 1, 1, 0, 0, None)]
    out = clean_rows(spark.createDataFrame(rows, RAW)).collect()
    assert sorted((r["transaction_id"], r["tx_amount"]) for r in out) == [(5, 5.0), (6, 5.0)]


def test_partial_times_are_no_times(spark):
    from tallywire.functions import parse_tx_time

    texts = ["2024", "12:30:00", "2024-01-01", "2024-01-01 24:00:00", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(F.date_format(parse_tx_time("t"), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == [None, None, None, "2024-01-01 23:59:59", None, None]


def test_archive_days_do_not_depend_on_the_session_zone(spark, conf):
    from tallywire.sources.messages import with_archive_path

    df = spark.createDataFrame([(1704142800,)], "t bigint").withColumn("ts", F.timestamp_seconds("t"))  # 21:00 UTC
    days = set()
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        conf("spark.sql.session.timeZone", zone)
        days.add(tuple(with_archive_path(df, "ts").select("year", "month", "day").first()))
    assert days == {("2024", "01", "02")}


def test_rows_without_a_time_are_in_neither_part(spark):
    from tallywire.operators.split import split_by_time, with_split

    df = spark.createDataFrame([(i, i if i % 3 else None) for i in range(30)], "id int, unix_time bigint")
    parts = {r["id"]: r["part"] for r in with_split(df, rel_err=0).collect()}
    train, test = split_by_time(df, rel_err=0)
    assert {i for i, p in parts.items() if p == "train"} == {r["id"] for r in train.collect()}
    assert {i for i, p in parts.items() if p == "test"} == {r["id"] for r in test.collect()}
    assert all(parts[i] is None for i in range(0, 30, 3))


def test_sorted_files(spark, tmp_path):
    """Rows of every file are in time order, also when a partition becomes several files."""
    from tallywire.sources.files import write_partitioned

    rows = [(i, "ab"[i % 2], (i * 7919) % 5000) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, week string, unix_time int").repartition(5)
    write_partitioned(df, str(tmp_path / "out"), "week", "unix_time")
    seen = {}
    for r in spark.read.parquet(str(tmp_path / "out")).select("unix_time", F.col("_metadata.file_path").alias("f")).collect():
        assert seen.get(r["f"], -1) <= r["unix_time"]
        seen[r["f"]] = r["unix_time"]
    assert len(seen) >= 2
