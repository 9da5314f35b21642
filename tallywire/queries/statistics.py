"""Section D: aggregations, evaluation, statistics; section F: top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywire.functions import HOUR, label_text
from tallywire.operators import clean, compare, metrics, monitor, slices, split
from tallywire.operators.buckets import bucket_agg
from tallywire.queries.common import (
    SCORED,
    TX,
    TX_CSV,
    TX_DIRTY,
    one_model,
    query,
    r6,
    rounded,
    scored,
    table,
    tx,
    tx_dirty,
    write_csv,
)
from tallywire.queries.projections import PARSED
from tallywire.sources.files import read_raw_csv


@query("time_span", f"WITH {TX} SELECT min(unix_time) AS min_value, max(unix_time) AS max_value FROM tx")
def time_span(spark, sf):
    return slices.span(tx(spark, sf), "unix_time")


@query("dq_corrupt", f"WITH {TX_CSV} SELECT count(*) AS total_rows, count(_corrupt) AS corrupt_rows FROM tx_csv")
def dq_corrupt(spark, sf):
    return clean.corrupt_report(read_raw_csv(spark, write_csv(spark, sf)))


@query(
    "dq_report",
    f"""WITH {TX_DIRTY}, twice AS (SELECT * FROM tx_dirty UNION ALL SELECT * FROM tx_dirty WHERE tx_fraud = 1)
    SELECT count(*) AS rows_after_clean, count(*) - count(DISTINCT transaction_id) AS duplicates,
      count(*) FILTER (transaction_id < 0) AS bad_transaction_id, count(*) FILTER ({PARSED} IS NULL) AS bad_tx_datetime,
      count(*) FILTER (customer_id IS NULL) AS bad_customer_id, count(*) FILTER (terminal_id < 0) AS bad_terminal_id,
      count(*) FILTER (tx_amount < 0) AS bad_tx_amount, count(*) FILTER (tx_time_seconds < 0) AS bad_tx_time_seconds,
      count(*) FILTER (tx_time_days < 0) AS bad_tx_time_days, count(*) FILTER (tx_fraud_scenario < 0) AS bad_scenario_id,
      count(*) FILTER (tx_fraud NOT IN (0, 1)) AS bad_tx_fraud
    FROM twice""",
)
def dq_report(spark, sf):
    rows = tx_dirty(spark, sf)
    twice = rows.unionByName(rows.where(F.col("tx_fraud") == 1))
    return clean.quality_report(clean.with_sentinels(clean.parse_time(twice)))


@query(
    "bucket_agg",
    f"""WITH {TX} SELECT terminal_id, unix_time // 3600 * 3600 AS bucket, count(*) AS cnt, {r6('sum(tx_amount)', 'total')},
        {r6('sum(tx_amount * tx_amount)', 'squares')} FROM tx GROUP BY ALL""",
)
def bucket_agg_query(spark, sf):
    sums = bucket_agg(tx(spark, sf), ["terminal_id"], "unix_time", "tx_amount", HOUR)
    return rounded(sums.toDF("terminal_id", "bucket", "cnt", "total", "squares"))


@query("class_counts", "SELECT toxic, count(*) AS n FROM labels GROUP BY 1")
def class_counts(spark, sf):
    return split.class_counts(table(spark, sf, "labels"), "toxic")


@query(
    "class_weight",
    """SELECT doc_id, toxic, CASE WHEN toxic = 1 THEN (SELECT round_even(
             (count(*) FILTER (toxic = 0))::DOUBLE / count(*) FILTER (toxic = 1), 0) FROM labels) ELSE 1.0 END AS weight
    FROM labels""",
)
def class_weight(spark, sf):
    return split.with_class_weight(table(spark, sf, "labels").select("doc_id", "toxic"), "toxic")


def cells_sql(model: str = "b", table: str = "scored", by: str = "") -> str:
    return f"""cells AS (SELECT {by} count(*) FILTER (tx_fraud = 1 AND pred_{model} = 1) AS tp,
      count(*) FILTER (tx_fraud = 0 AND pred_{model} = 1) AS fp, count(*) FILTER (tx_fraud = 1 AND pred_{model} = 0) AS fn,
      count(*) FILTER (tx_fraud = 0 AND pred_{model} = 0) AS tn, max(unix_time) - min(unix_time) AS span FROM {table})"""


_P = "CASE WHEN tp + fp > 0 THEN tp::DOUBLE / (tp + fp) ELSE 0 END"
_R = "CASE WHEN tp + fn > 0 THEN tp::DOUBLE / (tp + fn) ELSE 0 END"
_F1 = "CASE WHEN tp > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0 END"


@query(
    "binary_metrics",
    f"""WITH {SCORED}, {cells_sql()} SELECT tp, fp, fn, {r6(_P, 'precision')}, {r6(_R, 'recall')}, {r6(_F1, 'f1_score')},
        {r6('fp / (span / 604800.0::DOUBLE)', 'avg_fp_per_week')} FROM cells""",
)
def binary_metrics(spark, sf):
    return rounded(metrics.binary_metrics(one_model(scored(spark, sf))))


@query(
    "confusion_matrix",
    f"""WITH {SCORED} SELECT tx_fraud, count(*) FILTER (pred_b = 0) AS pred_0, count(*) FILTER (pred_b = 1) AS pred_1
    FROM scored GROUP BY 1""",
)
def confusion_matrix(spark, sf):
    return metrics.confusion(one_model(scored(spark, sf)))


@query(
    "quantiles",
    f"""WITH {TX} SELECT quantile_disc(unix_time, 0.1) AS q0, quantile_disc(unix_time, 0.5) AS q1,
        quantile_disc(unix_time, 0.99) AS q2 FROM tx""",
)
def quantiles(spark, sf):
    return split.quantiles(tx(spark, sf), "unix_time", [0.1, 0.5, 0.99], err=0)


@query("quantiles_approx", "SELECT 'q' || i AS name, true AS within_rank_error FROM range(3) r(i)")
def quantiles_approx(spark, sf):
    """Each value's rank lies within the stated error of the one asked for."""
    df, asked, err = tx(spark, sf).select("tx_amount"), [0.1, 0.5, 0.99], 0.001
    found = split.quantiles(df, "tx_amount", asked, err=err)
    rows = found.select(F.explode(F.array(*[F.struct(F.lit(f"q{i}").alias("name"), F.lit(q).alias("q"), F.col(f"q{i}").alias("v")) for i, q in enumerate(asked)])).alias("x")).select("x.*")
    n = df.agg(F.count("tx_amount")).scalar()
    held = [F.struct(F.count_if(F.col("tx_amount") < found.select(f"q{i}").scalar()).alias("lo"), F.count_if(F.col("tx_amount") <= found.select(f"q{i}").scalar()).alias("hi")) for i in range(3)]
    ranks = df.agg(F.array(*held).alias("held")).scalar()
    own = F.get(ranks, F.substring("name", 2, 1).cast("int"))
    return rows.select("name", ((own["lo"] <= (F.col("q") + err) * n + 1) & (own["hi"] >= (F.col("q") - err) * n - 1)).alias("within_rank_error"))


def auc_sql(model: str, name: str) -> str:
    """Average-rank form of the area under the curve."""
    return f"""{name} AS (WITH r AS (SELECT tx_fraud, rank() OVER (ORDER BY score_{model})
          + (count(*) OVER (PARTITION BY score_{model}) - 1) / 2.0::DOUBLE AS rk FROM scored)
      SELECT (sum(rk) FILTER (tx_fraud = 1) - n1 * (n1 + 1) / 2.0::DOUBLE) / (n1 * n0) AS auc
      FROM r, (SELECT count(*) FILTER (tx_fraud = 1)::DOUBLE AS n1, count(*) FILTER (tx_fraud = 0)::DOUBLE AS n0 FROM scored)
      GROUP BY n1, n0)"""


@query("roc_auc", f"WITH {SCORED}, {auc_sql('b', 'a')} SELECT {r6('auc', 'auc')} FROM a")
def roc_auc(spark, sf):
    auc = metrics.roc_auc(one_model(scored(spark, sf)))
    return rounded(spark.createDataFrame([(auc,)], "auc double"))


# class-weighted measures from tp, fp, fn, tn
_P0 = "CASE WHEN tn + fn > 0 THEN tn::DOUBLE / (tn + fn) ELSE 0 END"
_R0 = "CASE WHEN tn + fp > 0 THEN tn::DOUBLE / (tn + fp) ELSE 0 END"
_F0 = "CASE WHEN tn > 0 THEN 2.0::DOUBLE * tn / (2 * tn + fp + fn) ELSE 0 END"


def weighted_sql(one: str, zero: str) -> str:
    return f"((({one}) * (tp + fn) + ({zero}) * (tn + fp)) / (tp + fn + tn + fp))"


@query(
    "weighted_prf",
    f"""WITH {SCORED}, {cells_sql()} SELECT {r6(weighted_sql(_P, _P0), 'weighted_precision')},
        {r6(weighted_sql(_R, _R0), 'weighted_recall')}, {r6(weighted_sql(_F1, _F0), 'weighted_f1')} FROM cells""",
)
def weighted_prf(spark, sf):
    return rounded(metrics.weighted_prf(one_model(scored(spark, sf))))


def bootstrap_sql(n: int, seed: int = 42, scored: str = SCORED) -> str:
    """CTE boot(model, replicate, auc, f1, p, r) over scored."""
    cuts = compare.poisson_cuts()
    weight = " ".join(f"WHEN draw < '{c}' THEN {k}" for k, c in enumerate(cuts))
    return f"""{scored}, draws AS (
      SELECT transaction_id, rep.replicate,
             substr(md5('{seed}:' || transaction_id || ':' || (rep.replicate // 4)), (8 * (rep.replicate % 4) + 1)::INT, 8) AS draw
      FROM tx, (SELECT range AS replicate FROM range({n})) rep),
    weights AS (SELECT transaction_id, replicate, CASE {weight} ELSE {len(cuts)} END AS w FROM draws),
    pairs AS (
      SELECT 'base' AS model, transaction_id, tx_fraud AS y, pred_a AS pred, score_a AS score FROM scored
      UNION ALL SELECT 'candidate', transaction_id, tx_fraud, pred_b, score_b FROM scored),
    folded AS (
      SELECT model, replicate, score, sum(w) FILTER (y = 1) AS pos1, sum(w) FILTER (y = 0) AS neg1,
        sum(w) FILTER (y = 1 AND pred = 1) AS tp1, sum(w) FILTER (y = 0 AND pred = 1) AS fp1,
        sum(w) FILTER (y = 1 AND pred = 0) AS fn1, sum(w) FILTER (y = 0 AND pred = 0) AS tn1
      FROM pairs JOIN weights USING (transaction_id) WHERE w > 0 GROUP BY ALL),
    curve AS (
      SELECT *, coalesce(pos1, 0) * (coalesce(sum(neg1) OVER (PARTITION BY model, replicate ORDER BY score
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + coalesce(neg1, 0) / 2.0::DOUBLE) AS area FROM folded),
    totals AS (
      SELECT model, replicate, sum(area) AS area, sum(pos1)::DOUBLE AS pos, sum(neg1)::DOUBLE AS neg,
        coalesce(sum(tp1), 0)::DOUBLE AS tp, coalesce(sum(fp1), 0)::DOUBLE AS fp,
        coalesce(sum(fn1), 0)::DOUBLE AS fn, coalesce(sum(tn1), 0)::DOUBLE AS tn FROM curve GROUP BY ALL),
    boot AS (
      SELECT model, replicate::INT AS replicate, area / (pos * neg) AS auc, {weighted_sql(_F1, _F0)} AS f1,
        {weighted_sql(_P, _P0)} AS p, {weighted_sql(_R, _R0)} AS r FROM totals)"""


MODELS = {"base": ("pred_a", "score_a"), "candidate": ("pred_b", "score_b")}


@query(
    "bootstrap_metrics",
    f"""WITH {bootstrap_sql(100)} SELECT model, replicate, {r6('auc', 'auc')}, {r6('f1', 'f1')}, {r6('p', 'p')}, {r6('r', 'r')}
    FROM boot""",
)
def bootstrap_metrics(spark, sf):
    return rounded(compare.bootstrap(scored(spark, sf), 100, models=MODELS))


_NARROW = SCORED.replace(
    "scored AS (\n  SELECT *,", "scored AS (\n  SELECT * REPLACE (CASE WHEN transaction_id % 3 = 0 THEN 0.001::DOUBLE ELSE score_a / 50 END AS score_a, score_b / 50 AS score_b),"
)


@query(
    "bootstrap_auc_narrow",
    f"""WITH {bootstrap_sql(100, scored=_NARROW)} SELECT model, replicate, round(auc, 9) AS auc FROM boot""",
)
def bootstrap_auc_narrow(spark, sf):
    """Scores within 0 to 0.02, as fraud scores are; a third of one model's rows share one score."""
    df = scored(spark, sf)
    tied = F.when(F.col("transaction_id") % 3 == 0, 0.001).otherwise(F.col("score_a") / 50)
    df = df.withColumns({"score_a": tied, "score_b": F.col("score_b") / 50})
    return compare.bootstrap(df, 100, models=MODELS).select("model", "replicate", F.round("auc", 9).alias("auc"))


def comparison_sql() -> str:
    """CTE cmp(metric, …) from boot: equal-variance t statistic, Cohen's d, and the two-sided p value by
    Simpson's rule over the density of Student's t."""
    one = """SELECT '{m}' AS metric, count(*) FILTER (model = 'base') AS n1, count(*) FILTER (model = 'candidate') AS n2,
        avg({m}) FILTER (model = 'base') AS m1, avg({m}) FILTER (model = 'candidate') AS m2,
        var_samp({m}) FILTER (model = 'base') AS v1, var_samp({m}) FILTER (model = 'candidate') AS v2 FROM boot"""
    both = " UNION ALL ".join(one.format(m=m) for m in ("f1", "p"))
    return f"""mom AS ({both}), cmp0 AS (
      SELECT *, (m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1.0::DOUBLE / n1 + 1.0::DOUBLE / n2)) AS t,
             abs(m2 - m1) / sqrt((v1 + v2) / 2) AS d FROM mom),
    grid AS (
      SELECT metric, (n1 + n2 - 2)::DOUBLE AS nu, abs(t) / 4000 AS step, i,
             CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS c FROM cmp0, range(4001) r(i)),
    tail AS (
      SELECT metric, greatest(0, 1 - 2 * sum(step / 3 * c * exp(lgamma((nu + 1) / 2) - lgamma(nu / 2)) / sqrt(nu * pi())
             * pow(1 + pow(step * i, 2) / nu, -(nu + 1) / 2))) AS pv FROM grid GROUP BY 1),
    cmp AS (SELECT * FROM cmp0 JOIN tail USING (metric))"""


@query(
    "ttest_effect",
    f"""WITH {bootstrap_sql(100)}, {comparison_sql()} SELECT metric, {r6('t', 't_statistic')}, {r6('d', 'effect_size')},
        {r6('pv', 'p_value')}, pv < 0.01 AS is_significant,
        {r6('m1', 'base_mean')}, {r6('m2', 'candidate_mean')}, {r6('m2 - m1', 'improvement')} FROM cmp""",
)
def ttest_effect(spark, sf):
    scores = compare.bootstrap(scored(spark, sf), 100, models=MODELS)
    return rounded(compare.compare(scores, "base", "candidate", ["f1", "p"]))


@query(
    "ship_decision",
    f"""WITH {bootstrap_sql(100)}, {comparison_sql()}
    SELECT metric, pv < 0.01 AND m2 > m1 AS should_deploy FROM cmp WHERE metric = 'f1'""",
)
def ship_decision(spark, sf):
    scores = compare.bootstrap(scored(spark, sf), 100, models=MODELS)
    return compare.decide(compare.compare(scores, "base", "candidate"))


def _predictions(spark, sf):
    """Prediction rows with a model version, as the scorer emits them."""
    df = one_model(scored(spark, sf))
    return df.select(
        "transaction_id",
        "unix_time",
        label_text("prediction").alias("label"),
        F.concat(F.lit("v"), F.col("customer_id") % 3).alias("version"),
        (F.col("tx_amount") / 100).alias("latency"),
    )


PREDICTIONS = SCORED + """, predictions AS (
  SELECT transaction_id, unix_time, CASE WHEN pred_b = 1 THEN 'fraud' ELSE 'normal' END AS label,
         'v' || (customer_id % 3) AS version, tx_amount / 100 AS latency FROM scored)"""


@query("prediction_counts", f"WITH {PREDICTIONS} SELECT label, version, count(*) AS n FROM predictions GROUP BY ALL")
def prediction_counts(spark, sf):
    return monitor.prediction_counts(_predictions(spark, sf))


_BOUNDS = ", ".join(f"{b}::DOUBLE" for b in monitor.LATENCY_BOUNDS) + ", 'inf'::DOUBLE"


@query(
    "latency_histogram",
    f"""WITH {PREDICTIONS}, b AS (SELECT unnest([{_BOUNDS}]) AS le)
    SELECT version, le::VARCHAR AS le, count(*) FILTER (latency <= le) AS bucket_count, {r6('sum(latency)', 'total_sum')},
           count(*) AS total_count FROM predictions, b GROUP BY ALL""",
)
def latency_histogram(spark, sf):
    out = monitor.histogram(_predictions(spark, sf), "latency")
    text = F.when(F.col("le") == float("inf"), "inf").otherwise(F.col("le").cast("string"))
    return rounded(out.withColumn("le", text))


@query(
    "fraud_share_5m",
    f"""WITH {PREDICTIONS} SELECT unix_time // 300 * 300 AS start_time, count(*) AS n,
        count(*) FILTER (label = 'fraud') AS frauds,
        {r6("count(*) FILTER (label = 'fraud') * 100.0::DOUBLE / count(*)", 'fraud_percent')}
    FROM predictions GROUP BY 1""",
)
def fraud_share_5m(spark, sf):
    rows = _predictions(spark, sf).withColumn("ts", F.timestamp_seconds("unix_time"))
    out = monitor.fraud_share(rows, "ts")
    return rounded(out.select(F.unix_timestamp("window.start").alias("start_time"), "n", "frauds", "fraud_percent"))


@query(
    "fraud_share_sliding",
    f"""WITH {PREDICTIONS} SELECT (unix_time // 60 - k) * 60 AS start_time, count(*) AS n,
        count(*) FILTER (label = 'fraud') AS frauds,
        {r6("count(*) FILTER (label = 'fraud') * 100.0::DOUBLE / count(*)", 'fraud_percent')}
    FROM predictions, range(5) r(k) GROUP BY 1""",
)
def fraud_share_sliding(spark, sf):
    rows = _predictions(spark, sf).withColumn("ts", F.timestamp_seconds("unix_time"))
    out = monitor.fraud_share(rows, "ts", "5 minutes", "1 minute")
    return rounded(out.select(F.unix_timestamp("window.start").alias("start_time"), "n", "frauds", "fraud_percent"))


@query(
    "outlier_trim",
    f"""WITH {TX}, g AS (SELECT transaction_id, customer_id % 3 AS rps, tx_amount AS lag,
          avg(tx_amount) OVER (PARTITION BY customer_id % 3) AS m FROM tx)
    SELECT transaction_id, rps, lag FROM g WHERE lag <= 3 * m""",
)
def outlier_trim(spark, sf):
    rows = tx(spark, sf).select(
        "transaction_id", (F.col("customer_id") % 3).alias("rps"), F.col("tx_amount").alias("lag")
    )
    return monitor.trim_outliers(rows, "rps", "lag")


@query(
    "throughput",
    f"""WITH {TX}, s AS (SELECT DISTINCT unix_time, count(*) OVER (ORDER BY unix_time) AS total FROM tx)
    SELECT unix_time, total, {r6('total::DOUBLE / (unix_time - (SELECT min(unix_time) FROM tx) + 1)', 'rate')} FROM s""",
)
def throughput(spark, sf):
    return rounded(monitor.throughput(tx(spark, sf)))


@query(
    "flatten_metrics",
    f"""WITH {SCORED}, {cells_sql()}, v AS (SELECT {_P} AS p, {_R} AS r, tp, fp FROM cells), flat AS (
      SELECT 'production_metrics_precision' AS name, p AS value FROM v UNION ALL
      SELECT 'production_metrics_recall', r FROM v UNION ALL
      SELECT 'production_metrics_cells_tp', tp FROM v UNION ALL
      SELECT 'production_metrics_cells_fp', fp FROM v UNION ALL
      SELECT 'should_deploy', (p > 0.5)::INT FROM v)
    SELECT name, {r6('value', 'value')} FROM flat""",
)
def flatten_metrics(spark, sf):
    row = metrics.binary_metrics(one_model(scored(spark, sf)))
    nested = row.select(
        (F.col("precision") > 0.5).alias("should_deploy"),
        F.struct("precision", "recall", F.struct("tp", "fp").alias("cells"), F.lit("text").alias("note")).alias(
            "production_metrics"
        ),
    )
    return rounded(metrics.flatten_metrics(nested))


_RUNS = """runs AS (SELECT customer_id AS version, avg(tx_fraud) AS f1, count(*) AS n FROM tx GROUP BY 1)"""


@query("best_run", f"WITH {TX}, {_RUNS} SELECT version, {r6('f1', 'f1')} FROM runs ORDER BY runs.f1 DESC, version LIMIT 5")
def best_run(spark, sf):
    runs = tx(spark, sf).groupBy(F.col("customer_id").alias("version")).agg(F.avg("tx_fraud").alias("f1"))
    return rounded(monitor.best_runs(runs, "f1", 5, tie="version"))


@query("next_run", f"WITH {TX}, {_RUNS} SELECT count(*) + 1 AS run_number FROM runs")
def next_run(spark, sf):
    return monitor.next_run_number(tx(spark, sf).groupBy("customer_id").agg(F.avg("tx_fraud").alias("f1")))


AB_SQL = bootstrap_sql(100)


@query(
    "ab_metrics",
    f"""WITH {SCORED}, {cells_sql('a').replace('cells AS', 'cells_a AS')}, {cells_sql('b').replace('cells AS', 'cells_b AS')},
      {auc_sql('a', 'auc_a')}, {auc_sql('b', 'auc_b')}
    SELECT 'base' AS model, {r6(_P, 'precision')}, {r6(_R, 'recall')}, {r6(_F1, 'f1_score')}, {r6('auc', 'auc')} FROM cells_a, auc_a
    UNION ALL
    SELECT 'candidate', {r6(_P, 'precision')}, {r6(_R, 'recall')}, {r6(_F1, 'f1_score')}, {r6('auc', 'auc')} FROM cells_b, auc_b""",
)
def ab_metrics(spark, sf):
    df = scored(spark, sf)
    rows = [
        metrics.evaluate_scores(df, pred=p, score=s).select(F.lit(name).alias("model"), "*")
        for name, (p, s) in MODELS.items()
    ]
    return rounded(rows[0].unionByName(rows[1]))


@query(
    "ab_test",
    f"""WITH {AB_SQL}, {comparison_sql()}
    SELECT metric, {r6('t', 't_statistic')}, {r6('d', 'effect_size')}, {r6('m1', 'base_mean')}, {r6('m2', 'candidate_mean')},
           {r6('m2 - m1', 'improvement')}, {r6('pv', 'p_value')}, pv < 0.01 AS is_significant,
           (SELECT pv < 0.01 AND m2 > m1 FROM cmp WHERE metric = 'f1') AS should_deploy FROM cmp""",
)
def ab_test(spark, sf):
    _, comparison, decision = compare.compare_scored(scored(spark, sf), MODELS["base"], MODELS["candidate"], 100)
    ship = decision.select("should_deploy").scalar()
    return rounded(comparison.withColumn("should_deploy", ship))
