from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pytest
from conftest import SF
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler

from tallywire.operators.models import SearchSpace
from tallywire.plans import jobs
from tallywire.queries import QUERIES
from tallywire.queries.common import tx
from tallywire.session import scratch_path, shared_folder
from tallywire.sources.state import (
    RUNS,
    STATE,
    Conflict,
    Registry,
    log_run,
    put_if_absent,
    read_feature_spec,
    read_or_empty,
    read_state,
    runs_wide,
    save_feature_spec,
    write_state,
)


def test_state_starts_empty_and_keeps_the_last(spark, tmp_path):
    path = str(tmp_path / "state")
    assert read_state(spark, path) == {}
    write_state(spark, path, {"old_end_datetime": 5})
    write_state(spark, path, {"old_end_datetime": 3})
    assert read_state(spark, path) == {"old_end_datetime": 3}


def at_once(n, write):
    """Results of n calls that start together."""
    with ThreadPoolExecutor(n) as pool:
        start = Barrier(n)

        def one(i):
            start.wait()
            return write(i)

        return list(pool.map(one, range(n)))


def test_two_writers_get_two_numbers(spark, tmp_path):
    path = str(tmp_path / "state")
    assert sorted(at_once(4, lambda i: write_state(spark, path, {"writer": i}))) == [1, 2, 3, 4]
    rows = read_or_empty(spark, path, STATE).orderBy("seq").collect()
    assert [r["seq"] for r in rows] == [1, 2, 3, 4] and len({r["state"] for r in rows}) == 4


def test_a_state_that_moved_on_is_a_conflict(spark, tmp_path):
    path = str(tmp_path / "state")
    first = write_state(spark, path, {"a": 1}, expected=0)

    def write(i):
        try:
            return write_state(spark, path, {"writer": i}, expected=first)
        except Conflict:
            return None

    got = at_once(3, write)
    assert sorted(got, key=str) == [2, None, None] and read_state(spark, path) == {"writer": got.index(2)}


def test_a_taken_name_stays(spark, tmp_path):
    (tmp_path / "new").write_text("new")
    (tmp_path / "old").write_text("old")
    assert not put_if_absent(spark, f"file:{tmp_path}/new", f"file:{tmp_path}/old")
    assert (tmp_path / "old").read_text() == "old" and (tmp_path / "new").read_text() == "new"
    assert put_if_absent(spark, f"file:{tmp_path}/new", f"file:{tmp_path}/free")
    assert (tmp_path / "free").read_text() == "new" and not (tmp_path / "new").exists()


def test_two_registrations_get_two_versions(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    df = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    models = [Pipeline(stages=[VectorAssembler(inputCols=[c], outputCol="v")]).fit(df) for c in ("x", "y")]
    versions = at_once(2, lambda i: registry.register(models[i], "m"))
    assert sorted(versions) == [1, 2] and registry.resolve("m") == 1
    for version, col in zip(versions, ("x", "y")):
        assert registry.load("m", version).stages[0].getInputCols() == [col]


def test_registry_life(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    assert registry.resolve("m") is None
    df = spark.createDataFrame([(1.0,)], "x double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="v")]).fit(df)
    assert [registry.register(model, "m"), registry.register(model, "m")] == [1, 2]
    assert (registry.resolve("m", "best"), registry.resolve("m", "last")) == (1, 2)
    registry.promote("m", 2, 1)
    assert registry.versions("m") == {"name": "m", "latest": 2, "best": 2, "old_best": 1}
    assert registry.load("m", 2).transform(df).count() == 1


def test_run_log_and_feature_spec(spark, tmp_path):
    path = str(tmp_path / "runs")
    log_run(spark, path, "r1", {"depth": 3}, {"f1": 0.5})
    log_run(spark, path, "r2", {"depth": 4}, {"f1": 0.25})
    wide = runs_wide(read_or_empty(spark, path, RUNS), ["f1", "depth"])
    assert {r["run"]: (r["f1"], r["depth"]) for r in wide.collect()} == {"r1": (0.5, 3.0), "r2": (0.25, 4.0)}
    save_feature_spec(spark, ["a", "b"], str(tmp_path / "spec"))
    assert read_feature_spec(spark, str(tmp_path / "spec")) == ["a", "b"]


def test_shared_folder_is_read_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared_folder(spark))


def test_train_twice_and_compare(spark, tmp_path):
    path, registry = str(tmp_path / "features"), str(tmp_path / "registry")
    QUERIES["feature_row"](spark, SF).write.parquet(path)
    cfg = jobs.TrainConfig(
        fraction=1.0, n_folds=2, trials=1, replicates=12, space=SearchSpace(maxDepth=(2, 2), maxIter=(2, 2))
    )
    assert jobs.ab_job(spark, path, registry, cfg) is None
    first = jobs.train_job(spark, path, registry, cfg)
    assert jobs.ab_job(spark, path, registry, cfg) is None
    second = jobs.train_job(spark, path, registry, cfg)
    assert (first["version"], second["version"]) == (1, 2)
    assert {"train_f1_score", "test_f1_score"} <= set(second["metrics"])
    result = jobs.ab_job(spark, path, registry, cfg)
    # the same model twice: nothing to ship
    assert result["should_deploy"] is False and result["metrics"]["f1_improvement"] == pytest.approx(0)
    too_long = jobs.TrainConfig(fraction=1.0, learn=400 * 86400)
    assert jobs.train_job(spark, path, registry, too_long) is None


def test_draws_are_seeded():
    space = SearchSpace()
    assert space.draw(5, 42) == space.draw(5, 42) != space.draw(5, 43)
    for p in space.draw(50, 1):
        assert 3 <= p.maxDepth <= 8 and 30 <= p.maxIter <= 80 and 0.05 <= p.stepSize <= 0.2


def test_tx_reads_only_what_it_needs(spark):
    plan = tx(spark, SF).select("transaction_id", "tx_amount")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,value:double>" in plan


def test_clean_batch_is_finished_with_the_bounds_it_began(spark, tmp_path):
    """Crash after the write; then a smaller first id and more rows arrive, and the batch size shrinks."""
    raw, out, state, lost = (str(tmp_path / n) for n in ("raw", "out", "state", "lost"))

    def add(ids):
        lines = [(f"{i},2024-01-{i % 28 + 1:02d} 10:00:00,1,1,5.0,1,1,0,0",) for i in ids]
        spark.createDataFrame(lines, "value string").write.mode("append").text(raw)

    add(range(100, 200))
    bounds = jobs.clean_job(spark, raw, out, lost)
    write_state(spark, state, {jobs.STARTED: bounds})
    add([*range(1, 10), *range(200, 260)])
    assert jobs.clean_job(spark, raw, out, state, jobs.CleanConfig(first_batch=20)) == bounds
    rows = spark.read.parquet(out).collect()
    assert sorted(r["transaction_id"] for r in rows) == list(range(100, 199)) and len({r["batch"] for r in rows}) == 1
    assert read_state(spark, state) == {jobs.DONE: bounds["end_id"]}


def test_learning_rows_read_the_last_dates_only(spark, tmp_path):
    from tallywire.operators.features import build_features

    path = str(tmp_path / "features")
    build_features(tx(spark, SF)).write.partitionBy("date").parquet(path)
    rows = jobs.learning_rows(spark, path, jobs.TrainConfig())
    plan = rows._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "GreaterThanOrEqual(unix_time" in plan
    every = spark.read.parquet(path)
    last = every.agg({"unix_time": "max"}).first()[0]
    assert rows.count() == every.where(f"unix_time >= {last} - 9 * 86400").count()
