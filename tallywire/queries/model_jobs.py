"""Section J: models and jobs."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywire.functions import DAY, MONTH, fill_numeric, to_message
from tallywire.operators import metrics, models, split, trees
from tallywire.operators.features import LONGEST_LOOKBACK, build_features
from tallywire.plans import jobs
from tallywire.queries.common import EPOCH_2024, TX, TX_CSV, query, rounded, run_and_read, tx, write_csv
from tallywire.queries.projections import PARSED
from tallywire.queries.windows import feature_select, feature_sql
from tallywire.schemas import CONTRACT, FEATURE
from tallywire.session import scratch_path, wide_rows
from tallywire.sources.state import LEDGER, RUNS, Registry, read_feature_spec, read_or_empty, write_state
from tallywire.streaming.transforms import score_stream

PARAMS = models.GbtParams()
#: fitted once per application and input: the queries on a model share it
_FITTED: dict[tuple[str, str], tuple] = {}


@wide_rows
def _features(spark, sf) -> DataFrame:
    """Feature rows, written once so that training does not compute the windows again per pass."""
    path = scratch_path(spark, "features")
    build_features(tx(spark, sf)).write.parquet(path)
    return fill_numeric(spark.read.schema(FEATURE).parquet(path), 0)


def _trained(spark, sf):
    """Model with the default parameters, train part, test part."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _FITTED:
        train_part, test_part = split.split_by_time(_features(spark, sf), rel_err=0)
        _FITTED[key] = models.train(split.with_class_weight(train_part), PARAMS), train_part, test_part
    return _FITTED[key]


def _walked(df: DataFrame, model) -> DataFrame:
    """Scored rows beside the walk through the node table of the saved ensemble: same says whether both agree."""
    rows = models.score(df, model, "1")
    nodes = trees.node_table(model)
    own = trees.walked(models.assemble(df).select("transaction_id", "features"), nodes, PARAMS.maxDepth)
    rows = rows.join(own.select("transaction_id", "walk_prob_1", "walk_prediction"), "transaction_id")
    same = (F.col("prediction") == F.col("walk_prediction")) & (F.abs(F.col("prob_1") - F.col("walk_prob_1")) < 1e-9)
    return rows.withColumn("same", same)


@query("assemble", "SELECT event_id AS transaction_id, 62 AS n_features FROM events")
def assemble(spark, sf):
    rows = models.assemble(fill_numeric(build_features(tx(spark, sf)), 0))
    return rows.select("transaction_id", F.size(vector_to_array("features")).alias("n_features"))


_TEST_PART = f"WITH {TX} SELECT transaction_id, {{facts}} FROM tx WHERE unix_time > (SELECT quantile_disc(unix_time, 0.8) FROM tx)"


@query("gbt_predict", _TEST_PART.format(facts="true AS same_as_tree_walk"))
def gbt_predict(spark, sf):
    """Every test row once; its prediction and probability are those of a walk through the node table."""
    model, _, test_part = _trained(spark, sf)
    return _walked(test_part, model).select("transaction_id", F.col("same").alias("same_as_tree_walk"))


@query("ensemble_nodes", "SELECT t::INT AS tree, true AS is_tree, CASE WHEN t = 0 THEN 1.0 ELSE 0.1 END::DOUBLE AS weight FROM range(50) r(t)")
def ensemble_nodes(spark, sf):
    """Node tables are trees: every node but the root is the child of one node, no deeper than the parameter allows."""
    nodes = trees.node_table(_trained(spark, sf)[0])
    inner = F.count("left")
    return nodes.groupBy("tree", "weight").agg(
        ((F.count("*") == 2 * inner + 1) & (F.count("*") <= 2 ** (PARAMS.maxDepth + 1) - 1) & (F.max(F.greatest("left", "right")) == F.count("*") - 1)).alias("is_tree")
    )


@query("cv_scores", "SELECT i::INT AS fold, true AS same_as_recomputed FROM range(3) r(i)")
@wide_rows
def cv_scores(spark, sf):
    """Weighted F1 of each fold against the one from the confusion counts of walked trees."""
    assembled = models.assemble(split.with_class_weight(_features(spark, sf)))
    weighted = models.fit_input(assembled.select("transaction_id", "features", "tx_fraud", "weight", "unix_time"))
    folds = [r[1:] for r in split.time_folds(weighted, n_folds=3, gap=0, err=0).orderBy("fold").collect()]
    params, rows = models.GbtParams(maxIter=30), []
    scores = models.cv_scores(weighted, folds, params)
    for i, fold in enumerate(folds):
        train_part, val_part = split.fold_data(weighted, fold)
        nodes = trees.node_table(models.fit_gbt(train_part, params))
        own = trees.walked(val_part, nodes, params.maxDepth).withColumnRenamed("walk_prediction", "prediction")
        rows.append((i, abs(metrics.weighted_prf(own).first()["weighted_f1"] - scores[i]) < 1e-9))
    return spark.createDataFrame(rows, "fold int, same_as_recomputed boolean")


@query("search_trials", "SELECT place::INT AS place, true AS in_space, true AS in_order FROM range(5) r(place)")
def search_trials(spark, sf):
    """The five default trials over three folds in the published space; the best comes first."""
    weighted = split.with_class_weight(_features(spark, sf))
    folds = [r[1:] for r in split.time_folds(weighted, n_folds=3, gap=0, err=0).orderBy("fold").collect()]
    found = models.search(weighted, folds)
    rows = models.trials_table(spark, found)
    space = models.SearchSpace()
    inside = F.lit(True)
    for name in ("maxDepth", "maxIter", "stepSize"):
        inside = inside & F.col(name).between(*getattr(space, name))
    order = Window.orderBy(F.desc("mean_f1"), "trial")
    placed = rows.withColumn("place", (F.row_number().over(order) - 1).cast("int"))
    expected = F.array(*[F.lit(t["trial"]) for t in found])
    return placed.select("place", inside.alias("in_space"), (F.get(expected, F.col("place")) == F.col("trial")).alias("in_order"))


_PARTS = f"""WITH {TX}, b AS (SELECT quantile_disc(unix_time, 0.8) AS cut FROM tx)
    SELECT {{name}}, count(*) AS n_rows, sum(tx_fraud)::BIGINT AS n_frauds, true AS same_as_recomputed FROM tx, b {{rest}}"""


@query("evaluate_train_test", _PARTS.format(name="CASE WHEN unix_time <= cut THEN 'train' ELSE 'test' END AS part", rest="GROUP BY 1"))
def evaluate_train_test(spark, sf):
    """Metric rows of both parts against those recomputed from walked trees; the cells add up to the rows of the part."""
    model, train_part, test_part = _trained(spark, sf)
    tables = models.evaluate_train_test(model, train_part, test_part)
    out = []
    for part, df in (("train", train_part), ("test", test_part)):
        got = tables[part].first().asDict()
        own = _walked(df, model).select("tx_fraud", "unix_time", F.col("walk_prediction").alias("prediction")).persist()
        want = metrics.binary_metrics(own).first().asDict()
        same = all(abs(got[f"{part}_{k}"] - v) < 1e-9 for k, v in want.items())
        tn = own.where("tx_fraud = 0 AND prediction = 0").count()
        own.unpersist()
        out.append((part, sum(want[k] for k in ("tp", "fp", "fn")) + tn, want["tp"] + want["fn"], same))
    return spark.createDataFrame(out, "part string, n_rows bigint, n_frauds bigint, same_as_recomputed boolean")


@query("confusion_confident", _PARTS.format(name="'test' AS part", rest="WHERE unix_time > cut"))
def confusion_confident(spark, sf):
    """Confusion tables of all and of confident test rows against those recomputed from walked trees."""
    model, train_part, test_part = _trained(spark, sf)
    found = models.evaluate_train_test(model, train_part, test_part)
    own = _walked(test_part, model).select("tx_fraud", F.col("walk_prediction").alias("prediction"), F.col("walk_prob_1").alias("prob_1")).persist()
    read = lambda df: sorted(map(tuple, df.collect()))
    every = read(found["confusion"])
    same = every == read(metrics.confusion(own)) and read(found["confusion_09"]) == read(metrics.confusion(metrics.confident(own, 0.9)))
    own.unpersist()
    frauds = sum(r[1] + r[2] for r in every if r[0] == 1)
    return spark.createDataFrame([("test", sum(r[1] + r[2] for r in every), frauds, same)], "part string, n_rows bigint, n_frauds bigint, same_as_recomputed boolean")


@query("batch_score", _TEST_PART.format(facts="true AS same_as_tree_walk, true AS label_of_prediction, '1' AS version"))
def batch_score(spark, sf):
    model, _, test_part = _trained(spark, sf)
    named = F.col("label") == F.when(F.col("walk_prediction") == 1, "fraud").otherwise("normal")
    return _walked(test_part, model).select("transaction_id", F.col("same").alias("same_as_tree_walk"), named.alias("label_of_prediction"), "version")


@query(
    "stream_score",
    f"""WITH {TX} SELECT transaction_id::VARCHAR AS key, true AS same_as_batch FROM tx
    WHERE unix_time > (SELECT quantile_disc(unix_time, 0.8) FROM tx)""",
)
def stream_score(spark, sf):
    """Feature messages through the scorer stream: every record comes out once, as in batch scoring."""
    model, _, test_part = _trained(spark, sf)
    inbox = scratch_path(spark, "score-in")
    test_part.select(F.to_json(F.struct(*CONTRACT.fieldNames())).alias("value")).write.text(inbox)
    streamed = run_and_read(score_stream(spark.readStream.text(inbox), model, "1"), "score-out")
    batch = models.score(test_part, model, "1").select("transaction_id", "prediction", "label", "version")
    both = streamed.join(to_message(batch).withColumnRenamed("value", "expected"), "key", "full")
    return both.select("key", F.col("value").eqNullSafe(F.col("expected")).alias("same_as_batch"))


# rows that survive the clean job: not corrupt, valid, id below the last one
_CLEAN_SQL = f"""WITH {TX_CSV}, b AS (SELECT min(transaction_id) AS lo, max(transaction_id) AS hi FROM tx_csv)
SELECT transaction_id, epoch({PARSED})::BIGINT AS unix_time,
       CASE WHEN customer_id >= 0 THEN customer_id ELSE -1 END AS customer_id,
       CASE WHEN terminal_id >= 0 THEN terminal_id ELSE -1 END AS terminal_id,
       tx_amount, tx_fraud = 1 AS tx_fraud, date_trunc('week', {PARSED})::DATE AS week
FROM tx_csv, b
WHERE _corrupt IS NULL AND transaction_id >= 0 AND transaction_id >= lo AND transaction_id < hi
  AND {PARSED} IS NOT NULL AND tx_amount >= 0 AND tx_fraud IN (0, 1)"""


@query("job_clean", _CLEAN_SQL)
def job_clean(spark, sf):
    out, state = scratch_path(spark, "clean"), scratch_path(spark, "clean-state")
    jobs.clean_job(spark, write_csv(spark, sf), out, state, jobs.CleanConfig(report=True))
    return _cleaned(spark, out)


def _cleaned(spark, out) -> DataFrame:
    return spark.read.parquet(out).select(
        "transaction_id", "unix_time", "customer_id", "terminal_id", "tx_amount", "tx_fraud",
        F.col("week").cast("date").alias("week"),
    )


@query("job_clean_manifest", _CLEAN_SQL)
def job_clean_manifest(spark, sf):
    """The raw lines arrive in two halves by id, each followed by a run whose bounds and files come from the manifest."""
    raw, out, state, noted = (scratch_path(spark, n) for n in ("raw-csv", "clean", "clean-state", "manifest"))
    lines = spark.read.text(write_csv(spark, sf)).withColumn("_id", F.split("value", ",")[0].try_cast("bigint"))
    half = lines.agg(F.percentile_approx("_id", 0.5)).scalar()
    cfg = jobs.CleanConfig(record_limit=1, manifest=noted)
    for part in (F.col("_id") <= half, ~F.coalesce(F.col("_id") <= half, F.lit(False))):
        lines.where(part).select("value").write.mode("append").text(raw)
        jobs.clean_job(spark, raw, out, state, cfg)
    return _cleaned(spark, out)


# the month of events spread over three, so that the default look-back fits in
def _long_tx(spark, sf) -> DataFrame:
    return tx(spark, sf).withColumn("unix_time", EPOCH_2024 + 3 * (F.col("unix_time") - EPOCH_2024))


_LONG = TX.replace("floor(epoch(ts))::BIGINT AS unix_time", f"{EPOCH_2024} + 3 * (floor(epoch(ts))::BIGINT - {EPOCH_2024}) AS unix_time")
_LATE = 3 * DAY // 2


def _features_sql(lo: str, hi: str) -> str:
    """Feature rows of [lo, hi), computed over the whole history; `ends` has the first time and the last."""
    return f"""WITH {feature_sql().replace(TX, _LONG, 1)}, ends AS (SELECT min(unix_time) AS lo, max(unix_time) AS hi FROM tx),
    early AS (SELECT max(unix_time) AS hi_early FROM tx, ends WHERE unix_time < hi - {_LATE})
    SELECT {feature_select()} FROM full_row, ends, early WHERE unix_time >= {lo} AND unix_time < {hi}"""


@query("job_features", _features_sql(f"hi - {MONTH}", "hi"))
def job_features(spark, sf):
    """First run with the default look-back: the latest month."""
    source, out, state = (scratch_path(spark, n) for n in ("clean", "features", "features-state"))
    _long_tx(spark, sf).write.parquet(source)
    jobs.feature_job(spark, source, out, state)
    return rounded(spark.read.parquet(out).select(*FEATURE.fieldNames()))


@query("job_features_rerun", _features_sql(f"hi_early - {MONTH}", "hi_early"))
def job_features_rerun(spark, sf):
    """A batch is written but not committed, a day and a half of rows arrives, and the job runs again with another batch size: the batch it
    began."""
    source, out, state, lost = (scratch_path(spark, n) for n in ("clean", "features", "features-state", "lost-commit"))
    rows = _long_tx(spark, sf)
    last = rows.agg(F.max("unix_time")).scalar() - _LATE
    rows.where(F.col("unix_time") < last).write.parquet(source)
    bounds = jobs.feature_job(spark, source, out, lost)
    write_state(spark, state, {jobs.STARTED: bounds})  # what the state holds when the commit is lost
    rows.where(F.col("unix_time") >= last).write.mode("append").parquet(source)
    jobs.feature_job(spark, source, out, state, jobs.FeatureJobConfig(batch=DAY, first_batch=DAY))
    return rounded(spark.read.parquet(out).select(*FEATURE.fieldNames()))


@query("feature_backfill", _features_sql(f"lo + {LONGEST_LOOKBACK}", "hi"))
def feature_backfill(spark, sf):
    """All history in batches of a fortnight, newest first; the second run stops before its commit, and the next one goes on."""
    source, out, path, ledger = (scratch_path(spark, n) for n in ("clean", "features", "full-ledger", "ledger"))
    _long_tx(spark, sf).write.parquet(source)
    cfg = jobs.FeatureJobConfig(batch=14 * DAY)
    jobs.backfill_job(spark, source, out, path, cfg, most=2)
    # the ledger as it is when the job ends between the second batch's write and its commit
    whole = read_or_empty(spark, path, LEDGER)
    whole.where(F.col("seq") < whole.agg(F.max("seq")).scalar()).write.parquet(ledger)
    jobs.backfill_job(spark, source, out, ledger, cfg)
    return rounded(spark.read.parquet(out).select(*FEATURE.fieldNames()))


@query(
    "job_train_ab",
    """SELECT * FROM (VALUES ('versions', 2), ('latest', 2), ('best is a version', 1), ('trials of both runs', 10), ('runs logged', 3), ('confusion tables', 2),
        ('input columns', 62), ('decision follows alias', 1), ('replicates', 100)) f(fact, value)""",
)
@wide_rows
def job_train_ab(spark, sf):
    """Train twice, each with the default search over every row of the training part, compare, and read registry, run log and tables."""
    path, registry = scratch_path(spark, "features"), scratch_path(spark, "registry")
    build_features(tx(spark, sf)).write.parquet(path)
    for seed in (42, 43):
        jobs.train_job(spark, path, registry, jobs.TrainConfig(fraction=1.0, seed=seed))
    cfg = jobs.TrainConfig()
    compared = jobs.ab_job(spark, path, registry, cfg)
    known = Registry(spark, registry).versions(cfg.name)
    log = read_or_empty(spark, f"{registry}/runs", RUNS)
    tables = spark.read.parquet(f"{registry}/confusion").select("version").distinct().count()
    facts = {
        "versions": spark.read.json(f"{registry}/features").select("version").distinct().count(),
        "latest": known["latest"],
        "best is a version": int(known["best"] in (1, 2)),
        "trials of both runs": log.where(F.col("key").rlike("^trial_[0-9]+_mean_f1$")).count(),
        "runs logged": log.select("run").distinct().count(),
        "confusion tables": tables,
        "input columns": len(read_feature_spec(spark, f"{registry}/features/version=2")),
        "decision follows alias": int(compared["should_deploy"] == (known["best"] == 2)),
        "replicates": cfg.replicates,
    }
    return spark.createDataFrame(list(facts.items()), "fact string, value int")
