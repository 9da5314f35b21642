"""The batch and stream jobs.

A batch job states its bounds before it writes and commits them last. A run that finds bounds without a commit takes
these bounds again, whatever its configuration or newer data would give, and replaces the partitions of the unfinished
batch, which are keyed by its start."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tallywire.functions import DAY, MONTH, WEEK, date_of, fill_numeric
from tallywire.operators.clean import clean_rows, corrupt_report, drop_corrupt, parse_time, quality_report, with_sentinels
from tallywire.operators.compare import compare_scored
from tallywire.operators.features import LONGEST_LOOKBACK, FeatureConfig, build_features
from tallywire.operators.metrics import flatten_metrics
from tallywire.operators.models import (
    GbtParams,
    SearchSpace,
    evaluate_train_test,
    score,
    search,
    train,
)
from tallywire.operators.monitor import next_run_number
from tallywire.operators.slices import gaps, slice_range, span, with_clean_bounds, with_feature_bounds, with_learning_range
from tallywire.operators.split import split_by_time, time_folds, with_class_weight
from tallywire.schemas import CONTRACT, FEATURE_INPUT, MODEL_INPUTS
from tallywire.session import wide_rows
from tallywire.sources.files import hash_sample, read_raw_csv, read_table, write_partitioned
from tallywire.sources.manifest import Manifest, parquet_files
from tallywire.sources.messages import archive_stream, kafka_sink, kafka_source, rejected_records
from tallywire.sources.state import RUNS, BatchLedger, Registry, input_example, log_run, read_or_empty, read_state, save_feature_spec, write_state
from tallywire.streaming.transforms import StreamConfig, run_rejects, run_counted, score_stream, scored_latency, stream_counts, stream_histogram

DONE, STARTED = "old_end_datetime", "started"


def _bounds(spark: SparkSession, state_path: str, fresh: Callable[[int], dict]) -> dict | None:
    """Bounds of the unfinished batch if there is one, else fresh ones, noted as started; None without enough data."""
    state = read_state(spark, state_path)
    if state.get(STARTED):
        return state[STARTED]
    bounds = fresh(state.get(DONE, 0))
    if any(v is None for v in bounds.values()):
        return None
    write_state(spark, state_path, {**state, STARTED: bounds})
    return bounds


@dataclass(frozen=True)
class CleanConfig:
    record_limit: int = 1_000_000
    overlap: int = 1_000_000
    batch: int = 0
    first_batch: int | None = None
    report: bool = False
    #: folder of a file manifest: bounds come from it, and only files that hold ids of the batch are opened
    manifest: str | None = None


def clean_job(
    spark: SparkSession, in_path: str, out_path: str, state_path: str, cfg: CleanConfig = CleanConfig()
) -> dict | None:
    """Raw CSV to the clean table by week. Returns the bounds of the batch, None without enough data."""
    raw = read_raw_csv(spark, in_path)
    files = Manifest(spark, cfg.manifest, in_path, "transaction_id", read_raw_csv) if cfg.manifest else None
    if files:
        files.refresh()

    def fresh(old: int) -> dict:
        row = files.span() if files else span(raw, "transaction_id")
        row = with_clean_bounds(row, old, cfg.record_limit, cfg.overlap, cfg.batch, cfg.first_batch)
        return row.select("start_id", "end_id", "keep_from").first().asDict()

    bounds = _bounds(spark, state_path, fresh)
    if bounds is None:
        return None
    ids = bounds["start_id"], bounds["end_id"]
    part = files.slice(*ids) if files else slice_range(raw, "transaction_id", *ids)
    result = dict(bounds)
    if cfg.report:
        result["corrupt"] = corrupt_report(part).first().asDict()
        result["quality"] = quality_report(with_sentinels(parse_time(drop_corrupt(part)))).first().asDict()
    cleaned = clean_rows(part).where(F.col("transaction_id") >= bounds["keep_from"])
    cleaned = cleaned.withColumn("batch", F.lit(bounds["keep_from"]).cast("bigint"))
    write_partitioned(cleaned, out_path, ["week", "batch"], "unix_time", "overwrite-partitions")
    write_state(spark, state_path, {DONE: bounds["end_id"]})
    return result


@dataclass(frozen=True)
class FeatureJobConfig:
    overlap: int = LONGEST_LOOKBACK
    time_limit: int = DAY
    batch: int = MONTH
    first_batch: int = MONTH
    features: FeatureConfig = field(default_factory=FeatureConfig)
    #: folder of a file manifest: bounds come from it, and only files that hold times of the batch are opened
    manifest: str | None = None


def _times(spark: SparkSession, in_path: str, cfg: FeatureJobConfig) -> tuple[DataFrame, Callable[[dict], DataFrame]]:
    """First and last time of the clean table, and its files that a batch has to open."""
    table = read_table(spark, in_path)
    if not cfg.manifest:
        return span(table, "unix_time"), lambda bounds: table
    files = Manifest(spark, cfg.manifest, in_path, "unix_time", parquet_files(in_path))
    files.refresh()
    return files.span(), lambda bounds: files.slice(bounds["start_time"], bounds["end_time"])


def feature_job(
    spark: SparkSession, in_path: str, out_path: str, state_path: str, cfg: FeatureJobConfig = FeatureJobConfig()
) -> dict | None:
    """Clean table to feature rows by date. Returns the bounds of the batch, None without enough data."""
    ends, rows_of = _times(spark, in_path, cfg)

    def fresh(old: int) -> dict:
        row = with_feature_bounds(ends, old, cfg.overlap, cfg.time_limit, cfg.batch, cfg.first_batch)
        return row.select("start_time", "end_time", "good_time").first().asDict()

    bounds = _bounds(spark, state_path, fresh)
    if bounds is None:
        return None
    _write_features(rows_of(bounds), out_path, bounds, cfg)
    write_state(spark, state_path, {DONE: bounds["end_time"]})
    return bounds


@wide_rows
def _write_features(table: DataFrame, out_path: str, bounds: dict, cfg: FeatureJobConfig) -> None:
    """Feature rows of one batch; a batch that was written before is replaced."""
    week = "week" if "week" in table.columns else None
    rows = slice_range(table, "unix_time", bounds["start_time"], bounds["end_time"], week=week)
    features = build_features(rows.select(*FEATURE_INPUT), cfg.features, bounds["good_time"])
    features = features.withColumn("batch", F.lit(bounds["good_time"]).cast("bigint"))
    write_partitioned(features, out_path, ["date", "batch"], "unix_time", "overwrite-partitions")


def backfill_job(
    spark: SparkSession,
    in_path: str,
    out_path: str,
    ledger_path: str,
    cfg: FeatureJobConfig = FeatureJobConfig(),
    newest_first: bool = True,
    most: int | None = None,
    done: tuple[tuple[int, int], ...] = (),
) -> list[dict]:
    """Feature rows for all history: from the first time with a whole look-back behind it to the newest row, in batches.

    The ledger holds the batches. A run plans the stretches that no batch covers yet (`done` names intervals [from, to) that
    another job has written), then runs the open batches, newest first, `most` of them at a time. Each is noted as started before it is
    written and as committed after it, on its own, so batches run in any order, and a run that was cut short goes on
    with the batches it left open, at the same bounds. Returns the batches of this run.
    """
    times, rows_of = _times(spark, in_path, cfg)
    ends = times.first()
    if ends["min_value"] is None:
        return []
    ledger = BatchLedger(spark, ledger_path)
    known = [(r["good_time"], r["end_time"]) for r in ledger.table().collect()]
    missing = gaps(ends["min_value"] + cfg.overlap, ends["max_value"], [*known, *done], cfg.batch, cfg.time_limit)
    ledger.add([{"start_time": a - cfg.overlap, "good_time": a, "end_time": b} for a, b in missing], "planned")
    batches = ledger.open()
    batches = (batches[::-1] if newest_first else batches)[:most]
    for bounds in batches:
        ledger.add([bounds], "started")
        _write_features(rows_of(bounds), out_path, bounds, cfg)
        ledger.add([bounds], "committed")
    return batches


@dataclass(frozen=True)
class TrainConfig:
    name: str = "fraud_model"
    #: share of the training part that search and fit see; evaluation and comparison take every row
    fraction: float = 0.1
    seed: int = 42
    learn: int = WEEK
    min_predict: int = DAY
    max_predict: int = 2 * DAY
    ratio: float = 0.8
    n_folds: int = 3
    val_ratio: float = 0.2
    gap: int = 0
    trials: int = 5
    space: SearchSpace = field(default_factory=SearchSpace)
    alpha: float = 0.01
    replicates: int = 100
    paired: bool = False


def learning_rows(spark: SparkSession, in_path: str, cfg: TrainConfig) -> DataFrame | None:
    """Feature rows of the training range, nulls as 0; None when the span is too short.

    The range ends with the table, so only its last dates are read: dates come from the partitions, times from the
    first and the last date.
    """
    cols = ["transaction_id", "tx_fraud", "unix_time", *MODEL_INPUTS]
    rows = read_table(spark, in_path)
    if "date" not in rows.columns:
        rows = rows.withColumn("date", date_of("unix_time"))
    days = rows.agg(F.min("date").alias("first"), F.max("date").alias("last")).first()
    if days["last"] is None:
        return None
    ends = rows.where(F.col("date").isin(days["first"], days["last"]))
    bounds = with_learning_range(span(ends, "unix_time"), cfg.learn, cfg.min_predict, cfg.max_predict).first()
    if bounds["start_time"] is None:
        return None
    start, end = int(bounds["start_time"]), int(bounds["end_time"])
    return fill_numeric(slice_range(rows, "unix_time", start, end + 1, date="date").select(*cols), 0)


@wide_rows
def train_job(
    spark: SparkSession, in_path: str, registry_path: str, cfg: TrainConfig = TrainConfig()
) -> dict | None:
    """Search, fit, evaluate and register a model. Returns version, parameters and metrics."""
    rows = learning_rows(spark, in_path, cfg)
    if rows is None:
        return None
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_part, test_part = split_by_time(rows, cfg.ratio)
        # the bound on rows is for the fit; both parts are judged whole
        weighted = with_class_weight(hash_sample(train_part, "transaction_id", cfg.fraction, cfg.seed))
        folds = [
            r[1:] for r in time_folds(weighted, "unix_time", cfg.n_folds, cfg.val_ratio, cfg.gap).collect()
        ]
        trials = search(weighted, folds, cfg.space, cfg.trials, cfg.seed)
        best = GbtParams(*[trials[0][k] for k in ("maxDepth", "maxIter", "stepSize")])
        model = train(weighted, best)
        tables = evaluate_train_test(model, train_part, test_part)
        metrics = {**tables["train"].first().asDict(), **tables["test"].first().asDict()}
        example = input_example(weighted, MODEL_INPUTS + ["transaction_id"])
        registry = Registry(spark, registry_path)
        version = registry.register(model, cfg.name, metrics)
        save_feature_spec(spark, MODEL_INPUTS, f"{registry_path}/features/version={version}")
        example.coalesce(1).write.mode("overwrite").json(f"{registry_path}/examples/version={version}")
        logged = {"fill_value": 0, "best_f1": trials[0]["mean_f1"], "run_number": _next_run(spark, registry_path)}
        for i, trial in enumerate(trials):
            logged |= {f"trial_{i}_{k}": v for k, v in trial.items()}
        params = {k: trials[0][k] for k in ("maxDepth", "maxIter", "stepSize")}
        log_run(spark, f"{registry_path}/runs", f"{cfg.name}_v{version}", params, {**metrics, **logged})
        for name in ("confusion", "confusion_09"):
            tables[name].coalesce(1).write.mode("overwrite").parquet(f"{registry_path}/{name}/version={version}")
    finally:
        rows.unpersist()
    return {"version": version, "trials": trials, "metrics": metrics}


def _next_run(spark: SparkSession, registry_path: str) -> int:
    """Runs so far and one."""
    runs = read_or_empty(spark, f"{registry_path}/runs", RUNS).select("run").distinct()
    return next_run_number(runs).first()["run_number"]


def score_both(df: DataFrame, base: PipelineModel, candidate: PipelineModel) -> DataFrame:
    """Label, id, time and both models' prediction and score side by side."""
    first = score(df, base, "base").withColumnsRenamed({"prediction": "pred_a", "prob_1": "score_a"})
    both = score(first.drop("label", "version"), candidate, "candidate")
    both = both.withColumnsRenamed({"prediction": "pred_b", "prob_1": "score_b"})
    return both.select("transaction_id", "unix_time", "tx_fraud", "pred_a", "score_a", "pred_b", "score_b")


@wide_rows
def ab_job(
    spark: SparkSession, in_path: str, registry_path: str, cfg: TrainConfig = TrainConfig()
) -> dict | None:
    """Latest against best model on the test part; the alias moves when the latest is significantly better.

    None when there is nothing to compare or not enough data.
    """
    registry = Registry(spark, registry_path)
    best, latest = registry.resolve(cfg.name, "best"), registry.resolve(cfg.name, "last")
    if best is None or latest is None or best == latest:
        return None
    rows = learning_rows(spark, in_path, cfg)
    if rows is None:
        return None
    _, test_part = split_by_time(rows, cfg.ratio)
    scored = score_both(test_part, registry.load(cfg.name, best), registry.load(cfg.name, latest))
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        evaluated, comparison, decision = compare_scored(
            scored, ("pred_a", "score_a"), ("pred_b", "score_b"), cfg.replicates, cfg.seed, cfg.alpha, cfg.paired
        )
        metrics = {f"{r['model']}_{k}": r[k] for r in evaluated.collect() for k in evaluated.columns[1:]}
        for row in comparison.collect():
            one = comparison.where(F.col("metric") == row["metric"])
            metrics |= {f"{row['metric']}_{m['name']}": m["value"] for m in flatten_metrics(one).collect()}
        ship = decision.first()["should_deploy"]
    finally:
        scored.unpersist()
    metrics |= {"should_deploy": int(ship), "run_number": _next_run(spark, registry_path)}
    log_run(spark, f"{registry_path}/runs", f"ab_v{best}_v{latest}", {"best": best, "latest": latest}, metrics)
    if ship:
        registry.promote(cfg.name, latest, best)
    return {"should_deploy": ship, "best": best, "latest": latest, "metrics": metrics}


def score_job(
    spark: SparkSession,
    servers: str,
    topic_in: str,
    topic_out: str,
    checkpoint: str,
    registry_path: str,
    name: str = "fraud_model",
    security: dict[str, str] | None = None,
    rejects: str | None = None,
    max_offsets: int | None = None,
    metrics: str | None = None,
) -> list[DataStreamWriter]:
    """Feature messages to prediction messages with the best model; start the returned writers.

    With a folder `rejects` another writer puts the records there that cannot be scored, with their reasons; with a folder `metrics` two
    more keep predictions by label and version and the latency histogram, per five minutes of record time.
    """
    registry = Registry(spark, registry_path)
    version = registry.resolve(name, "best")
    if version is None:
        raise LookupError(f"no model named {name} in {registry_path}")
    messages = kafka_source(spark, servers, topic_in, security, max_offsets=max_offsets)
    model = registry.load(name, version)
    scored = score_stream(messages, model, str(version))
    writers = [kafka_sink(scored, servers, topic_out, checkpoint, security)]
    writers += _side_writers(rejected_records(messages, CONTRACT), rejects, checkpoint, "rejects")
    if metrics:
        timed = scored_latency(messages, model, str(version))
        writers += _side_writers(stream_counts(timed, "timestamp"), f"{metrics.rstrip('/')}/counts", checkpoint, "counts")
        writers += _side_writers(stream_histogram(timed, "timestamp", "latency"), f"{metrics.rstrip('/')}/latency", checkpoint, "latency")
    return writers


def _side_writers(rows: DataFrame, path: str | None, checkpoint: str, name: str) -> list[DataStreamWriter]:
    if not path:
        return []
    writer = rows.writeStream.format("parquet").option("path", path).outputMode("append")
    return [writer.option("checkpointLocation", f"{checkpoint.rstrip('/')}-{name}")]


def archive_job(
    spark: SparkSession,
    servers: str,
    topic: str,
    path: str,
    checkpoint: str,
    security: dict[str, str] | None = None,
) -> DataStreamWriter:
    """Topic to gzip Parquet by day of the record time; start the returned writer."""
    records = kafka_source(spark, servers, topic, security).select(F.col("value").cast("string"), "timestamp")
    return archive_stream(records, path, "timestamp", checkpoint)


def stream_job(
    spark: SparkSession,
    servers: str,
    topic_in: str,
    topic_out: str,
    checkpoint: str,
    security: dict[str, str] | None = None,
    cfg: StreamConfig = StreamConfig(),
    rejects: str | None = None,
    max_offsets: int | None = None,
) -> list[DataStreamWriter]:
    """Topic to topic; start the returned writers. With a folder `rejects` the second one keeps what was left out. The first one reports
    its rows: with a `ProgressLog`, `progress.balance` accounts for them."""
    messages = kafka_source(spark, servers, topic_in, security, max_offsets=max_offsets)
    writers = [kafka_sink(run_counted(messages, cfg), servers, topic_out, checkpoint, security)]
    return writers + _side_writers(run_rejects(messages, cfg), rejects, checkpoint, "rejects")
