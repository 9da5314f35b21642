"""Compaction: same rows, planned files, order kept, reruns after a crash."""

import pytest
from conftest import values
from pyspark.sql import functions as F

from tallywire.sources import compaction
from tallywire.sources.files import file_sizes
from tallywire.sources.state import read_state


@pytest.fixture
def small_files(spark, tmp_path):
    """Twelve files in month 01, one in month 02, two in the partition without a month."""
    path = str(tmp_path / "table")
    rows = spark.range(1200).select("id", (F.hash("id") % 1000).cast("long").alias("unix_time"))
    rows.where("id < 1000").repartition(12).withColumn("month", F.lit("01")).write.partitionBy("month").mode("append").parquet(path)
    rows.where("id >= 1000 and id < 1100").coalesce(1).withColumn("month", F.lit("02")).write.partitionBy("month").mode("append").parquet(path)
    rows.where("id >= 1100").repartition(2).withColumn("month", F.lit(None).cast("string")).write.partitionBy("month").mode("append").parquet(path)
    return path


def listing(spark, path):
    return {r["path"]: r["length"] for r in file_sizes(spark, path).collect() if r["path"].endswith(".parquet")}


def test_packed_bins_are_even(spark):
    sizes = spark.createDataFrame([(f"x:/t/a/{i:02}.parquet", 10) for i in range(20)] + [("x:/t/b/0.parquet", 500), ("x:/t/a/_SUCCESS", 0)], "path string, length long")
    bins = compaction.packed(sizes, 50).collect()
    assert {r["dir"] for r in bins} == {"x:/t/a"} and {(r["n_files"], r["planned"]) for r in bins} == {(20, 4)}
    assert [sum(r["bin"] == b for r in bins) for b in range(4)] == [5, 5, 5, 5]


@pytest.mark.parametrize("target_mb, files", [(512, 1), (None, 3)])
def test_compact_keeps_rows_and_order(spark, tmp_path, small_files, target_mb, files):
    before, want = listing(spark, small_files), values(spark.read.parquet(small_files))
    one = [size for path, size in before.items() if "month=01" in path]
    target_mb = target_mb or sum(one) / 2.9 / 1024 / 1024
    where = str(tmp_path / "state"), str(tmp_path / "staged")
    assert compaction.compact(spark, small_files, *where, "month", "unix_time", target_mb) == files + 1
    after = listing(spark, small_files)
    assert sum("month=01/" in p for p in after) == files and sum("month=__HIVE" in p for p in after) == 1
    assert {p for p in before if "month=02" in p} == {p for p in after if "month=02" in p}
    spark.catalog.refreshByPath(small_files)
    assert values(spark.read.parquet(small_files)) == want
    found = compaction.inversions(spark.read.parquet(small_files), "unix_time").collect()
    assert sum(r["n"] for r in found) == 1200
    assert all(r["inversions"] == 0 for r in found if "month=02" not in r["_path"]) and any(r["inversions"] for r in found)


def test_rerun_after_a_crash_in_the_swap(spark, tmp_path, small_files, monkeypatch):
    want, where = values(spark.read.parquet(small_files)), (str(tmp_path / "state"), str(tmp_path / "staged"))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(compaction, "swap", lost)
        with pytest.raises(RuntimeError, match="lost"):
            compaction.compact(spark, small_files, *where, "month")
    assert read_state(spark, where[0]) == {"compaction": 1, "staged": True}
    # the crash left one partition half written
    spark.read.parquet(small_files).where("month = 1").limit(3).drop("month").write.mode("overwrite").parquet(f"{small_files}/month=01")
    assert compaction.compact(spark, small_files, *where, "month") == 2
    spark.catalog.refreshByPath(small_files)
    assert values(spark.read.parquet(small_files)) == want
    assert read_state(spark, where[0]) == {"compaction": 1, "staged": False}
    assert compaction.compact(spark, small_files, *where, "month") == 0


def test_rows_of_unknown_files_stop_the_run(spark, tmp_path, small_files):
    plan = spark.createDataFrame([("file:/elsewhere", 0)], "_path string, _task int")
    with pytest.raises(Exception, match="not in the plan"):
        compaction._write(compaction._read(spark, small_files, ["month"]), plan, str(tmp_path / "out"), ["month"], "unix_time")
