"""File manifest: unseen files only, slices by file range, jobs that run on it."""

import os

import pytest
from conftest import SF, values
from pyspark.sql import functions as F

from tallywire.functions import DAY
from tallywire.operators.slices import slice_range, span
from tallywire.plans import jobs
from tallywire.queries.common import EPOCH_2024, tx
from tallywire.sources.files import read_raw_csv
from tallywire.sources.manifest import Manifest, parquet_files


def line(i, fraud="0"):
    return f"{i},2024-01-01 00:00:{i % 60:02},1,2,3.5,{i},0,{fraud},0"


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(f"{x}\n" for x in lines))


def csv_manifest(spark, tmp_path):
    return Manifest(spark, str(tmp_path / "manifest"), str(tmp_path / "raw"), "transaction_id", read_raw_csv)


def names(paths):
    return sorted(os.path.basename(p) for p in paths)


def test_reads_only_unseen_files(spark, tmp_path):
    raw, known = tmp_path / "raw", csv_manifest(spark, tmp_path)
    put(raw, "a.csv", map(line, range(10)))
    assert names(known.refresh()) == ["a.csv"] and known.refresh() == []
    # same length and time, other ids: a second look would show
    times = os.stat(raw / "a.csv").st_mtime_ns
    put(raw, "a.csv", [line(5)] * 10)
    os.utime(raw / "a.csv", ns=(times, times))
    put(raw, "b.csv", map(line, range(10, 30)))
    assert names(known.refresh()) == ["b.csv"]
    assert tuple(known.span().first()) == (0, 29)
    # a replaced file is read again, one that is gone no longer counts
    put(raw, "a.csv", map(line, range(40, 50)))
    assert names(known.refresh()) == ["a.csv"] and tuple(known.span().first()) == (10, 49)
    os.remove(raw / "b.csv")
    assert known.refresh() == [] and tuple(known.span().first()) == (40, 49)


def test_slices_equal_the_plain_ones_and_open_few_files(spark, tmp_path):
    raw, known = tmp_path / "raw", csv_manifest(spark, tmp_path)
    for k in range(6):
        put(raw, f"{k}.csv", [*map(line, range(10 * k, 10 * k + 12)), "x,broken", "7", "# comment"])
    known.refresh()
    plain = read_raw_csv(spark, str(raw))
    assert known.span().collect() == span(plain, "transaction_id").collect()
    # "7" is a row of every file, so each file reaches down to it
    for lo, hi in [(0, 100), (8, 9), (23, 31), (61, 62), (70, 90), (-5, 0), (30, 30)]:
        rows = known.slice(lo, hi)
        assert values(rows) == values(slice_range(plain, "transaction_id", lo, hi))
    assert names(known.paths(40, 60)) == ["3.csv", "4.csv", "5.csv"] and known.paths(70, 90) == []
    assert len(known.slice(55, 60).inputFiles()) == 1


def test_odd_names_empty_files_and_late_files(spark, tmp_path):
    raw, known = tmp_path / "raw", csv_manifest(spark, tmp_path)
    put(raw, "a b+c%20[1]{x}*.csv", map(line, range(5)))
    put(raw, "a b+c%20x.csv", map(line, range(5, 9)))
    put(raw, "void.csv", [])  # not listed
    put(raw, "broken.csv", ["x,y", "# nothing"])
    assert len(known.refresh()) == 3 and known.refresh() == []
    assert {os.path.basename(r["path"]): (r["n"], r["lo"], r["hi"]) for r in known.table().collect()} == {
        "a b+c%20[1]{x}*.csv": (5, 0, 4), "a b+c%20x.csv": (4, 5, 8), "broken.csv": (0, None, None)
    }
    assert sorted(r["transaction_id"] for r in known.slice(3, 7).collect()) == [3, 4, 5, 6]
    # a file that came after the refresh is opened, whatever it holds
    put(raw, "late.csv", map(line, range(4, 6)))
    assert sorted(r["transaction_id"] for r in known.slice(3, 7).collect()) == [3, 4, 4, 5, 5, 6]
    # two runs that note one file give one row
    twin = csv_manifest(spark, tmp_path)
    twin.refresh()
    rows = spark.read.parquet(known.path)
    rows.where(F.col("path").endswith("late.csv")).write.mode("append").parquet(str(tmp_path / "again"))
    spark.read.parquet(str(tmp_path / "again")).write.mode("append").parquet(known.path)
    assert known.table().where(F.col("path").endswith("late.csv")).count() == 1


def test_missing_path_and_empty_folder(spark, tmp_path):
    known = csv_manifest(spark, tmp_path)
    with pytest.raises(FileNotFoundError):
        known.refresh()
    put(tmp_path / "raw", "void.csv", [])
    for _ in range(2):
        known.refresh()
        assert tuple(known.span().first()) == (None, None) and known.slice(0, 10).collect() == []
        put(tmp_path / "raw", "comment.csv", ["# nothing"])


def test_partition_columns_of_subsets(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(20).select("id", (F.col("id") * 10).alias("unix_time"), F.when(F.col("id") < 10, "1").otherwise("x").alias("part"))
    rows.write.partitionBy("part").parquet(path)
    known = Manifest(spark, str(tmp_path / "m"), path, "unix_time", parquet_files(path))
    known.refresh()
    found = known.slice(20, 50)
    assert found.schema == spark.read.parquet(path).schema and {r["part"] for r in found.collect()} == {"1"}
    assert sorted(r["id"] for r in found.collect()) == [2, 3, 4]


def test_feature_job_and_backfill_on_a_manifest(spark, tmp_path):
    """The same bounds and rows as without one, and the rerun goes on where the first run ended."""
    rows = tx(spark, SF).withColumn("unix_time", EPOCH_2024 + 3 * (F.col("unix_time") - EPOCH_2024))
    clean = str(tmp_path / "clean")
    parted = rows.withColumn("week", F.date_trunc("week", F.timestamp_seconds("unix_time")).cast("date"))
    parted.repartition("week").write.partitionBy("week").parquet(clean)
    got = {}
    for name, noted in (("plain", None), ("manifest", str(tmp_path / "noted"))):
        cfg = jobs.FeatureJobConfig(manifest=noted, batch=20 * DAY)
        out = str(tmp_path / name)
        done = jobs.backfill_job(spark, clean, out, str(tmp_path / f"{name}-ledger"), cfg, most=1)
        got[name] = done, jobs.feature_job(spark, clean, f"{out}-f", f"{out}-state", cfg), values(spark.read.parquet(out)), values(spark.read.parquet(f"{out}-f"))
    assert got["plain"] == got["manifest"] and got["plain"][2] and got["plain"][3]
