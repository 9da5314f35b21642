"""What the plans must look like at scale."""

import re

from conftest import SF
from pyspark.sql import functions as F

from tallywire.operators import features, models
from tallywire.operators.compare import bootstrap
from tallywire.operators.slices import slice_range
from tallywire.plans import jobs
from tallywire.queries.common import scored, table, tx
from tallywire.schemas import CONTRACT
from tallywire.session import METHOD_LIMIT, wide_rows
from tallywire.sources.messages import payload_records


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_customer_windows_share_one_shuffle(spark):
    text = plan(features.customer_features(tx(spark, SF), hot_rows=None))
    assert text.count("Exchange") == 1


def test_feature_row_shuffles_the_rows_twice(spark, conf):
    """Rows by customer and by terminal and bucket; the bucket table by customer (flags), bucket, terminal."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    cfg = features.FeatureConfig(hot_customer_rows=None, hot_bucket_rows=None)
    text = plan(features.build_features(tx(spark, SF), cfg))
    assert text.count("Exchange hashpartitioning") <= 6
    assert "BroadcastExchange" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_no_operator_forces_a_broadcast(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(features.terminal_risk(tx(spark, SF)))
    assert "BroadcastExchange" not in text


def test_slice_reaches_the_scan(spark):
    df = slice_range(table(spark, SF, "events"), "event_id", 10, 20).select("event_id")
    text = plan(df)
    assert "GreaterThanOrEqual(event_id,10)" in text and "LessThan(event_id,20)" in text


def test_slice_prunes_week_folders(spark, tmp_path):
    df = tx(spark, SF).withColumn("week", F.date_trunc("week", F.timestamp_seconds("unix_time")))
    df.write.partitionBy("week").parquet(str(tmp_path / "t"))
    cut = slice_range(spark.read.parquet(str(tmp_path / "t")), "unix_time", 1704672000, 1705276800, week="week")
    assert len(cut.inputFiles()) == len(df.select("week").distinct().collect())
    assert "PartitionFilters: [isnotnull(week" in plan(cut)
    assert cut.count() == df.where("unix_time >= 1704672000 and unix_time < 1705276800").count()


def test_warm_up_filter_stays_above_the_windows(spark):
    df = features.trim_warmup(features.customer_current(tx(spark, SF), None), 1705000000)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.index("1705000000") < text.index("Window")


def test_bootstrap_folds_before_the_big_shuffle(spark):
    text = plan(bootstrap(scored(spark, SF), 8, models={"b": ("pred_b", "score_b")}))
    assert "partial_sum" in text and "Cartesian" not in text and "NestedLoop" not in text


def test_hot_plan_carries_spread_only_where_a_deviation_is_asked_for(spark, conf):
    """Three of the six customer frames ask for it; probes without data are left out before the windows."""
    conf("spark.sql.debug.maxToStringFields", "1000")
    text = features.customer_features(tx(spark, SF), hot_rows=0)._jdf.queryExecution().optimizedPlan().toString()
    middles = [line for line in text.splitlines() if "Window" in line and "collect_list(" in line]
    assert sum(line.count("collect_list(") for line in middles) == 3
    assert text.count("Join LeftSemi") == 1


def test_hot_buckets_are_folded_without_the_customer_frames(spark):
    """Rows of ordinary and of hot buckets carry the customer frames; the bucket table and the seconds do without (70 scans before reuse, if not)."""
    cfg = features.FeatureConfig(hot_customer_rows=0, hot_bucket_rows=0)
    text = features.build_features(tx(spark, SF), cfg)._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Relation [") <= 34


def test_records_are_read_once_whatever_is_asked_of_them(spark):
    lines = spark.createDataFrame([('{"transaction_id": 1}',)], "value string")
    rows = payload_records(lines, CONTRACT).where(F.size("reasons") == 0).select("data.*")
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("from_json|JsonToStructs", text)) == 1


def test_wide_rows_are_compiled_in_any_session(spark, conf, monkeypatch, tmp_path):
    """A session with Spark's own limit would compute feature rows and feed the fit in methods that the JVM never compiles."""
    conf(METHOD_LIMIT, "65535")
    seen = {}

    def spy(owner, name, give):
        def noted(*args, **kwargs):
            seen[name] = spark.conf.get(METHOD_LIMIT)
            return give(*args, **kwargs)

        monkeypatch.setattr(owner, name, noted)

    label = (F.col("id") % 3 == 0).cast("int")
    rows = spark.range(40).select(F.col("id").alias("unix_time"), label.alias("tx_fraud"), F.lit(1.0).alias("weight"), (label * 0.5).alias("x"))
    spy(models, "gbt", models.gbt)
    model = models.train(df=rows, params=models.GbtParams(maxDepth=1, maxIter=1), cols=["x"])
    assert model.transform(rows).where("prediction = tx_fraud").count() == 40
    spy(models, "assemble", lambda df: models.assembler(["x"]).transform(df))
    spy(models, "cv_score", lambda df, folds, params: float(df.count()))
    assert [t["mean_f1"] for t in models.search(rows, [], n=2)] == [40.0, 40.0]
    spy(jobs, "write_partitioned", lambda df, *rest: None)
    bounds = {"start_time": 0, "end_time": 2_000_000_000, "good_time": 0}
    jobs._write_features(tx(spark, SF), str(tmp_path), bounds, jobs.FeatureJobConfig())
    spy(jobs, "learning_rows", lambda *args: None)
    assert jobs.train_job(spark, "", "") is None
    assert seen == dict.fromkeys(("gbt", "assemble", "cv_score", "write_partitioned", "learning_rows"), "8000")
    assert spark.conf.get(METHOD_LIMIT) == "65535"


def test_wide_rows_give_the_limit_back(spark, conf):
    @wide_rows
    def seen(df, fail=False):
        return 1 / (not fail), df.sparkSession.conf.get(METHOD_LIMIT)

    df = spark.range(1)
    conf(METHOD_LIMIT, "65535")
    assert seen(df) == (1.0, "8000") and spark.conf.get(METHOD_LIMIT) == "65535"
    try:
        seen(df, fail=True)
    except ZeroDivisionError:
        pass
    assert spark.conf.get(METHOD_LIMIT) == "65535"
    conf(METHOD_LIMIT, "4000")
    assert seen(df=df) == (1.0, "4000") and spark.conf.get(METHOD_LIMIT) == "4000"
