import math
import random

import numpy as np
import pytest
from conftest import SF, values
from pyspark.sql import functions as F

from tallywire.operators.compare import bootstrap, compare, decide, poisson_cuts, poisson_weight, two_sided_p
from tallywire.operators.metrics import binary_metrics, confusion, roc_auc, weighted_prf
from tallywire.operators.monitor import throughput
from tallywire.operators.split import fold_data, quantiles, split_by_time, time_folds, with_class_weight, with_fold_roles
from tallywire.queries.common import one_model, scored, tx


@pytest.mark.parametrize(
    "t, dof, p",
    # two-sided tails of Student's t from printed tables and closed forms
    [(12.706205, 1, 0.05), (1.0, 1, 0.5), (4.302653, 2, 0.05), (2.228139, 10, 0.05), (2.262157, 9, 0.05),
     (2.711558, 38, 0.01), (2.600887, 198, 0.01), (-2.600887, 198, 0.01), (0.0, 7, 1.0), (2.364624, 7, 0.05)],
)
def test_t_tail(spark, t, dof, p):
    got = spark.range(1).select(two_sided_p(F.lit(t), F.lit(dof))).first()[0]
    assert got == pytest.approx(p, abs=2e-6)


def test_poisson_weights_have_mean_and_variance_one(spark):
    draws = spark.range(60_000).select(poisson_weight(F.substring(F.md5(F.col("id").cast("string")), 1, 8)).alias("w"))
    mean, var = draws.agg(F.avg("w"), F.var_samp("w")).first()
    assert mean == pytest.approx(1, abs=0.02) and var == pytest.approx(1, abs=0.03)
    assert len(poisson_cuts()) > 8


def test_bootstrap_centres_on_the_sample(spark):
    df = scored(spark, SF)
    runs = bootstrap(df, 40, models={"b": ("pred_b", "score_b")}).toPandas()
    assert len(runs) == 40 and runs.replicate.nunique() == 40
    weighted = weighted_prf(one_model(df)).first()
    assert runs.f1.mean() == pytest.approx(weighted["weighted_f1"], abs=0.02)
    assert runs.auc.mean() == pytest.approx(roc_auc(one_model(df)), abs=0.02)


def test_bootstrap_does_not_depend_on_the_layout(spark):
    df = scored(spark, SF)
    model = {"b": ("pred_b", "score_b")}
    assert values(bootstrap(df, 6, models=model)) == values(bootstrap(df.repartition(7), 6, models=model))


def _scores(spark, shift):
    rng = random.Random(3)
    rows = [("base", i, rng.gauss(0.5, 0.01)) for i in range(30)]
    rows += [("new", i, rows[i][2] + shift + rng.gauss(0, 0.001)) for i in range(30)]
    return spark.createDataFrame(rows, "model string, replicate int, f1 double")


def test_compare_against_numpy(spark):
    scores = _scores(spark, 0.004)
    pdf = scores.toPandas()
    a, b = (pdf[pdf.model == m].f1.to_numpy() for m in ("base", "new"))
    pooled = (a.var(ddof=1) + b.var(ddof=1)) / 2
    row = compare(scores, "base", "new", ["f1"]).first()
    assert row["t_statistic"] == pytest.approx((a.mean() - b.mean()) / math.sqrt(pooled * 2 / 30))
    assert row["effect_size"] == pytest.approx(abs(a.mean() - b.mean()) / math.sqrt(pooled))
    paired = compare(scores, "base", "new", ["f1"], paired=True).first()
    gap = a - b
    assert paired["t_statistic"] == pytest.approx(gap.mean() / (gap.std(ddof=1) / math.sqrt(30)))
    assert paired["p_value"] < row["p_value"]


@pytest.mark.parametrize("shift, ship", [(0.05, True), (-0.05, False), (0.0, False)])
def test_decision(spark, shift, ship):
    assert decide(compare(_scores(spark, shift), "base", "new", ["f1"])).first()["should_deploy"] is ship


def test_auc_averages_ties(spark):
    df = spark.createDataFrame([(1, 0.8), (1, 0.5), (0, 0.5), (0, 0.5), (0, 0.1)], "tx_fraud int, prob_1 double")
    assert roc_auc(df) == pytest.approx((3 + 2 * 0.5 + 1) / 6)


def test_metrics_on_empty_denominators(spark):
    df = spark.createDataFrame([(0, 0, 5), (0, 0, 5)], "tx_fraud int, prediction int, unix_time bigint")
    row = binary_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1_score"], row["avg_fp_per_week"]) == (0, 0, 0, 0)
    assert values(confusion(df)) == [(2, 0, 0)]


def test_exact_quantiles_against_numpy(spark):
    rng = random.Random(5)
    data = [rng.randint(0, 300_000) for _ in range(997)]
    df = spark.createDataFrame([(x,) for x in data], "t bigint")
    qs = [0.0, 0.001, 0.25, 0.5, 0.8, 0.999, 1.0]
    got = list(quantiles(df, "t", qs, err=0).first())
    assert got == [int(np.quantile(data, q, method="inverted_cdf")) for q in qs]
    near = quantiles(df, "t", [0.5], err=0.01).first()[0]
    assert abs(sorted(data).index(near) / len(data) - 0.5) < 0.02


def test_split_keeps_every_row_once(spark):
    df = tx(spark, SF)
    train, test = split_by_time(df, 0.8)
    assert train.count() + test.count() == df.count()
    assert train.agg(F.max("unix_time")).first()[0] < test.agg(F.min("unix_time")).first()[0]


def test_folds_walk_forward(spark):
    df = tx(spark, SF)
    folds = [tuple(r[1:]) for r in time_folds(df, "unix_time", 3, 0.2, 1).orderBy("fold").collect()]
    for t0, t1, v0, v1 in folds:
        assert t0 < t1 < v0 < v1
    assert [f[0] for f in folds] == sorted({f[0] for f in folds})
    train, val = fold_data(df, folds[1])
    tagged = with_fold_roles(df, folds).where("fold = 1").groupBy("role").count()
    assert {r["role"]: r["count"] for r in tagged.collect()} == {"train": train.count(), "val": val.count()}


def test_class_weight_rounds_half_to_even(spark):
    df = spark.createDataFrame([(1,)] * 2 + [(0,)] * 5, "tx_fraud int")
    assert {r["tx_fraud"]: r["weight"] for r in with_class_weight(df).collect()} == {1: 2.0, 0: 1.0}
    flags = df.withColumn("tx_fraud", F.col("tx_fraud") == 1)
    assert {r["tx_fraud"]: r["weight"] for r in with_class_weight(flags).collect()} == {True: 2.0, False: 1.0}


def test_throughput_counts_up(spark):
    df = spark.createDataFrame([(10,), (10,), (86_400,), (200_000,)], "unix_time bigint")
    rows = throughput(df).orderBy("unix_time").collect()
    assert [r["total"] for r in rows] == [2, 3, 4]
    assert rows[0]["rate"] == 2.0 and rows[1]["rate"] == pytest.approx(3 / 86_391)


def test_no_spread_is_never_significant(spark):
    from tallywire.operators.compare import compare, decide

    rows = [(m, i, v, v) for m, v in (("base", 0.5), ("candidate", 0.7)) for i in range(5)]
    for part in (rows, rows[:1] + rows[5:6]):  # constant scores; one replicate of each
        out = compare(spark.createDataFrame(part, "model string, replicate int, f1 double, p double"), "base", "candidate")
        assert [tuple(r) for r in out.select("t_statistic", "p_value", "is_significant").collect()] == [(None, None, False)] * 2
        assert decide(out).first()["should_deploy"] is False


def weighted_auc(rows, n, seed):
    """AUC per replicate by definition: every positive against every negative, ties half."""
    import hashlib

    cuts = poisson_cuts()
    out = []
    for rep in range(n):
        ws = []
        for i, _, _ in rows:
            at = 8 * (rep % 4)
            draw = hashlib.md5(f"{seed}:{i}:{rep // 4}".encode()).hexdigest()[at : at + 8]
            ws.append(sum(draw >= c for c in cuts))
        w, y, s = np.array(ws, float), np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        p, q = y == 1, y == 0
        beats = (s[p][:, None] > s[q]) + (s[p][:, None] == s[q]) / 2
        out.append((w[p][:, None] * w[q] * beats).sum() / (w[p].sum() * w[q].sum()))
    return out


@pytest.mark.parametrize("blocks", [3, 16, 1000])
def test_bootstrap_auc_is_exact_in_a_narrow_band(spark, blocks):
    """Scores within 0 to 0.02: neighbours a millionth apart, small ties, one score that holds a third of the rows."""
    rng = random.Random(8)
    rows = []
    for i in range(600):
        y = int(rng.random() < 0.2)
        s = 0.004 if i % 3 == 0 else 0.01 + (y * 3 + rng.randrange(400)) * 1e-6
        rows.append((i, y, s))
    df = spark.createDataFrame([(i, y, s, 0) for i, y, s in rows], "transaction_id long, tx_fraud int, prob_1 double, prediction int")
    got = {r["replicate"]: r["auc"] for r in bootstrap(df, 6, seed=7, blocks=blocks).collect()}
    assert [got[k] for k in range(6)] == pytest.approx(weighted_auc(rows, 6, 7), abs=1e-9)


@pytest.mark.parametrize("blocks", [1, 5])
def test_bootstrap_folds_across_batches(spark, conf, blocks):
    """Ties, null and NaN scores that go on from one Arrow batch to the next; rows are not copied for the replicates."""
    conf("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rng = random.Random(4)
    rows = [(i, int(rng.random() < 0.4), rng.choice([0.1, 0.2, 0.2, 0.3, 0.7])) for i in range(90)]
    ends = {0: (None, float("-inf")), 1: (float("nan"), float("inf"))}  # the lowest and the highest, as the twin sees them
    odd = [(100 + i, i % 3 % 2, ends[i % 2]) for i in range(24)]
    data = [(i, y, s, 0) for i, y, s in rows] + [(i, y, pair[0], 0) for i, y, pair in odd]
    df = spark.createDataFrame(data, "transaction_id long, tx_fraud int, prob_1 double, prediction int")
    found = bootstrap(df, 9, seed=5, blocks=blocks)
    got = {r["replicate"]: r["auc"] for r in found.collect()}
    want = weighted_auc(rows + [(i, y, pair[1]) for i, y, pair in odd], 9, 5)
    assert [got[k] for k in range(9)] == pytest.approx(want, abs=1e-9)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_draws" not in plan and plan.count("MapInArrow") == 2
