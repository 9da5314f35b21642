"""Two models on the same rows: bootstrap, t-test, effect size, ship decision."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywire.functions import safe_div, safe_sqrt
from tallywire.operators.metrics import evaluate_scores, weighted_prf_columns
from tallywire.operators.skew import spread

METRICS = ("auc", "f1", "p", "r")


def poisson_cuts(tail: int = 13) -> list[str]:
    """Eight-digit hex numbers h_k: a uniform 32-bit draw below h_k has Poisson(1) weight at most k."""
    cuts, mass, term = [], 0.0, math.exp(-1)
    for k in range(tail):
        mass += term
        term /= k + 1
        at = math.ceil(mass * 2**32)
        if at >= 2**32:
            break
        cuts.append(f"{at:08x}")
    return cuts


def poisson_weight(digits: Column) -> Column:
    """Weight of a row from eight hex digits; equal-length hex text sorts like the number."""
    cuts = poisson_cuts()
    weight = F.when(digits < cuts[0], 0)
    for k, cut in enumerate(cuts[1:], start=1):
        weight = weight.when(digits < cut, k)
    return weight.otherwise(len(cuts))


def _position(cuts: Column, value: Column, blocks: int, equal: bool) -> Column:
    """How many of the sorted cuts are below `value` (or at it, with `equal`), by bisection."""
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(blocks.bit_length()))])

    def step(at: Column, width: Column) -> Column:
        cut = F.get(cuts, at + width - 1)
        return F.when((cut <= value) if equal else (cut < value), at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)


#: what a block of scores holds of a resample
_FOLDED = ("tp", "fp", "fn", "tn", "pos", "neg")


def _folded(n: int, draws: int, ordered: bool) -> Callable:
    """Arrow function from rows with their digests to one row per model, block and resample that draws from it: cells, positives, negatives
    and, if the rows stand in the order of model, block and score, the area that positives and negatives of the block make.

    Only running sums go from one batch to the next, whatever a block holds. The function is a closure, so it goes to the tasks by value.
    """
    cuts = [int(c, 16) for c in poisson_cuts()]
    names = _FOLDED

    def fold(batches):
        import numpy as np
        import pyarrow as pa

        edges = np.array(cuts, dtype=np.int64)
        block, tie = None, None  # the block and the score that are being summed

        def emit():
            drawn = np.flatnonzero(seen)
            columns = [pa.array(np.full(len(drawn), block[0], np.int32)), pa.array(np.full(len(drawn), block[1], np.int32)), pa.array(drawn.astype(np.int32))]
            columns += [pa.array(sums[i, drawn]) for i in range(len(names))]
            return pa.RecordBatch.from_arrays([*columns, pa.array(area[drawn])], ["model", "_block", "replicate", *names, "_area"])

        for batch in batches:
            if not len(batch):
                continue
            col = {name: batch.column(name) for name in batch.schema.names}
            model, at, label, prediction = (col[k].to_numpy() for k in ("model", "_block", "label", "prediction"))
            lowest = col["score"].is_null().to_numpy(zero_copy_only=False)
            score = col["score"].fill_null(0.0).to_numpy()
            digests = np.frombuffer(b"".join(col["_digests"].to_pylist()), dtype=">u4").reshape(len(batch), 4 * draws)[:, :n]
            w = np.searchsorted(edges, digests.astype(np.int64).ravel(), side="right").reshape(len(batch), n)
            ends = np.flatnonzero((model[1:] != model[:-1]) | (at[1:] != at[:-1])) + 1
            for lo, hi in zip([0, *ends], [*ends, len(batch)]):
                if (model[lo], at[lo]) != block:
                    if block is not None:
                        yield emit()
                    block, tie = (model[lo], at[lo]), None
                    sums, area, seen = np.zeros((len(names), n), np.int64), np.zeros(n), np.zeros(n, np.int64)
                y, p, part = label[lo:hi], prediction[lo:hi], w[lo:hi]
                seen += part.sum(axis=0)
                for i, held in enumerate([(y == 1) & (p == 1), (y == 0) & (p == 1), (y == 1) & (p == 0), (y == 0) & (p == 0)]):
                    sums[i] += part[held].sum(axis=0)
                if ordered:
                    s, none = score[lo:hi], lowest[lo:hi]
                    differs = (none[1:] != none[:-1]) | ~((s[1:] == s[:-1]) | (np.isnan(s[1:]) & np.isnan(s[:-1])))
                    starts = np.append(0, np.flatnonzero(differs) + 1)
                    pos, neg = (np.add.reduceat(part * (y == k)[:, None], starts, axis=0) for k in (1, 0))
                    before = sums[5] + np.cumsum(neg, axis=0) - neg
                    first = (bool(none[0]), "nan" if np.isnan(s[0]) else float(s[0]))
                    if first == tie:
                        # the score goes on from the batch before: its rows here and there are ties of each other
                        area += (pos[0] * (before[0] - open_neg / 2) + open_pos * neg[0] / 2) + pos[0] * neg[0] / 2
                        area += (pos[1:] * (before[1:] + neg[1:] / 2)).sum(axis=0)
                    else:
                        area += (pos * (before + neg / 2)).sum(axis=0)
                        open_pos, open_neg = np.zeros(n, np.int64), np.zeros(n, np.int64)
                    if len(starts) > 1:
                        open_pos, open_neg = pos[-1], neg[-1]
                    else:
                        open_pos, open_neg = open_pos + pos[0], open_neg + neg[0]
                    tie = (bool(none[-1]), "nan" if np.isnan(s[-1]) else float(s[-1]))
                for i, k in ((4, 1), (5, 0)):
                    sums[i] += part[y == k].sum(axis=0)
        if block is not None:
            yield emit()

    return fold


def _drawn(rows: DataFrame, n: int, seed: int, ordered: bool) -> DataFrame:
    """`rows` (with _key) folded to their blocks and resamples. Every four draws of a row come from one digest."""
    draws = -(-n // 4)
    digests = F.concat(*[F.unhex(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("_key"), F.lit(str(i))))) for i in range(draws)])
    flags = [F.coalesce(F.col(c), F.lit(-1)).alias(c) for c in ("label", "prediction")]
    rows = rows.select("model", "_block", "score", *flags, digests.alias("_digests"))
    types = ", ".join(f"{c} bigint" for c in _FOLDED)
    return rows.mapInArrow(_folded(n, draws, ordered), f"model int, _block int, replicate int, {types}, _area double")


def bootstrap(
    df: DataFrame,
    n: int = 100,
    seed: int = 42,
    models: dict[str, tuple[str, str]] | None = None,
    key: str = "transaction_id",
    label: str = "tx_fraud",
    blocks: int = 1000,
) -> DataFrame:
    """(model, replicate, auc, f1, p, r): n resamples with replacement, for all models in one pass.

    `models` maps a name to its (prediction, score) columns. Each row gets a Poisson(1) weight per
    replicate, drawn from md5(seed:id:block) (four draws per digest), so a rerun gives the same weights.
    Both models see the same resamples.

    AUC is that of the exact weighted curve over distinct scores, ties counting half. Rows are dealt to blocks of neighbouring
    scores before they are drawn, so the shuffle moves and sorts each row once per model, not once per replicate; a task reads its blocks in
    order and keeps running sums of all replicates, and only one row per (model, block, replicate) goes on to accumulate the blocks. The cuts between blocks are
    approximate quantiles: they balance the work and do not change the result. A score that holds several quantiles is a block of its own, which
    folds map-side instead. A null score is the lowest.
    """
    models = models or {"model": ("prediction", "prob_1")}
    scored = [
        F.struct(F.lit(i).alias("model"), F.col(pred).cast("int").alias("prediction"), F.col(score).cast("double").alias("score"))
        for i, (pred, score) in enumerate(models.values())
    ]
    rows = df.select(F.col(label).cast("int").alias("label"), F.col(key).cast("string").alias("_key"), F.explode(F.array(*scored)).alias("_s"))
    rows = rows.select("label", "_key", "_s.*")
    # as many numbers per model as there are blocks
    fractions = F.array(*[F.lit((k + 1) / blocks) for k in range(blocks - 1)])
    cuts = rows.groupBy("model").agg(F.percentile_approx("score", fractions, F.lit(10 * blocks)).alias("_cuts"))
    rows = rows.join(F.broadcast(cuts), "model")
    rows = rows.withColumns({f"_{name}": _position(F.col("_cuts"), F.col("score"), blocks, name == "upto") for name in ("below", "upto")})
    is_hot = F.col("_upto") - F.col("_below") >= 2
    rows = rows.select("model", (2 * F.col("_below") + is_hot.cast("int")).alias("_block"), is_hot.alias("_hot"), "score", "label", "prediction", "_key")

    by = ["model", "_block"]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cold = rows.where(~F.col("_hot")).drop("_hot").repartition(parts, *by).sortWithinPartitions(*by, "score")
    cold = _drawn(cold, n, seed, ordered=True)
    hot = _drawn(spread(rows.where("_hot").drop("_hot")), n, seed, ordered=False)
    hot = hot.groupBy(*by, "replicate").agg(*[F.sum(c).alias(c) for c in _FOLDED])
    hot = hot.withColumn("_area", F.col("pos") * F.col("neg") / 2)
    scores = scores_from_blocks(cold.unionByName(hot), ["model", "replicate"])
    names = F.array(*[F.lit(name) for name in models])
    return scores.withColumn("model", names[F.col("model")])


def scores_from_blocks(folded: DataFrame, by: Sequence[str]) -> DataFrame:
    """auc, f1, p, r per group from blocks of neighbouring scores in the order of _block: their cells, pos, neg and the
    _area that positives and negatives of the same block make."""
    by = list(by)
    below = Window.partitionBy(*by).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    area = F.col("_area") + F.col("pos") * F.coalesce(F.sum("neg").over(below), F.lit(0))
    row = (
        folded.withColumn("_area", area)
        .groupBy(*by)
        .agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn", "pos", "neg", "_area")])
    )
    auc = safe_div("_area", F.col("pos") * F.col("neg"), 0)
    return row.select(*by, auc.alias("auc"), *[c.alias(k) for k, c in weighted_prf_columns().items()])


def two_sided_p(t: Column, dof: Column) -> Column:
    """Two-sided tail of Student's t for a whole number of degrees of freedom.

    Finite cosine series of the distribution (Abramowitz & Stegun 26.7.3-4), with x = cos^2 of
    atan(t / sqrt(dof)).
    """
    dof = dof.cast("int")
    theta = F.atan(F.abs(t) / F.sqrt(dof))
    x = F.cos(theta) * F.cos(theta)
    odd = dof % 2 == 1
    half = F.floor(dof / 2).cast("int")
    # terms 1, 1/2 x, (1*3)/(2*4) x^2, … (even dof) or 1, 2/3 x, (2*4)/(3*5) x^2, … (odd dof)
    shift = F.when(odd, 1).otherwise(0)
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(acc: Column, k: Column) -> Column:
        term = acc["term"] * x * (2 * k - 1 + shift) / (2 * k + shift)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    terms = F.when(half > 1, F.sequence(F.lit(1), half - 1)).otherwise(F.array().cast("array<int>"))
    series = F.aggregate(terms, start, step, lambda acc: acc["total"])
    even_area = F.sin(theta) * series
    odd_area = (theta + F.when(dof > 1, F.sin(theta) * F.cos(theta) * series).otherwise(0.0)) * (2 / math.pi)
    inside = F.when(odd, odd_area).otherwise(even_area)
    # greatest skips nulls: without a statistic there is no p value
    return F.when(t.isNotNull() & (dof > 0), F.greatest(F.lit(0.0), 1 - inside))


def compare(
    scores: DataFrame,
    base: str,
    candidate: str,
    metrics: Sequence[str] = ("f1", "p"),
    alpha: float = 0.01,
    paired: bool = False,
    by: str = "model",
) -> DataFrame:
    """One row per metric: t statistic, p value, Cohen's d, significance, means, improvement.

    `scores` is the bootstrap table of both models. The default is the equal-variance two-sample test;
    `paired` tests the differences per replicate instead, which the shared resamples allow. Without a spread, or
    with fewer than two replicates, there is no statistic, and nothing is significant.
    """
    long = scores.where(F.col(by).isin(base, candidate)).unpivot(
        [by, "replicate"], list(metrics), "metric", "value"
    )
    a = F.when(F.col(by) == base, F.col("value"))
    b = F.when(F.col(by) == candidate, F.col("value"))
    row = long.groupBy("metric").agg(
        F.count(a).alias("n1"),
        F.count(b).alias("n2"),
        F.avg(a).alias("base_mean"),
        F.avg(b).alias("candidate_mean"),
        F.var_samp(a).alias("v1"),
        F.var_samp(b).alias("v2"),
    )
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "v1", "v2"))
    gap = F.col("base_mean") - F.col("candidate_mean")
    if paired:
        gaps = long.groupBy("metric", "replicate").agg((F.max(a) - F.max(b)).alias("gap"))
        gaps = gaps.groupBy("metric").agg(F.count("gap").alias("n"), F.var_samp("gap").alias("v"))
        row = row.join(gaps, "metric")
        t, dof = safe_div(gap, F.sqrt(F.col("v") / F.col("n"))), F.col("n") - 1
    else:
        dof = n1 + n2 - 2
        pooled = safe_div((n1 - 1) * v1 + (n2 - 1) * v2, dof)
        t = safe_div(gap, F.sqrt(pooled * (safe_div(F.lit(1), n1) + safe_div(F.lit(1), n2))))
    row = row.withColumns({"t_statistic": t, "_dof": dof})
    row = row.withColumn("p_value", two_sided_p(F.col("t_statistic"), F.col("_dof")))
    return row.select(
        "metric",
        "t_statistic",
        "p_value",
        safe_div(F.abs(gap), safe_sqrt((v1 + v2) / 2)).alias("effect_size"),
        F.coalesce(F.col("p_value") < alpha, F.lit(False)).alias("is_significant"),
        "base_mean",
        "candidate_mean",
        (-gap).alias("improvement"),
    )


def decide(comparison: DataFrame, metric: str = "f1") -> DataFrame:
    """Ship the candidate when its metric is significantly different and better."""
    ship = F.coalesce(F.col("is_significant") & (F.col("improvement") > 0), F.lit(False))
    return comparison.where(F.col("metric") == metric).select("metric", ship.alias("should_deploy"))


def compare_scored(
    df: DataFrame,
    base: tuple[str, str],
    candidate: tuple[str, str],
    n: int = 100,
    seed: int = 42,
    alpha: float = 0.01,
    paired: bool = False,
    metrics: Sequence[str] = ("f1", "p"),
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Evaluation of both models, comparison and decision from one table with both models' score columns."""
    evaluated = None
    for name, (pred, score) in (("base", base), ("candidate", candidate)):
        row = evaluate_scores(df, pred=pred, score=score).select(F.lit(name).alias("model"), "*")
        evaluated = row if evaluated is None else evaluated.unionByName(row)
    scores = bootstrap(df, n, seed, {"base": base, "candidate": candidate})
    # one row per metric: taken once, so that the decision does not run the bootstrap again
    lazy = compare(scores, "base", "candidate", metrics, alpha, paired)
    comparison = df.sparkSession.createDataFrame(lazy.collect(), lazy.schema)
    return evaluated, comparison, decide(comparison, metrics[0])
