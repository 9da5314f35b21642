"""Model quality from scored rows: label, prediction, positive-class score, time."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.functions import WEEK, safe_div


def prob_of(col: str = "probability", k: int = 1) -> Column:
    """Element k of a probability vector."""
    return vector_to_array(F.col(col))[k]


def confident(df: DataFrame, threshold: float = 0.9, score: Column | str = "prob_1") -> DataFrame:
    """Rows scored at or above the threshold; predictions stay as they are."""
    score = F.col(score) if isinstance(score, str) else score
    return df.where(score >= threshold)


def cells(label: str = "tx_fraud", pred: str = "prediction", weight: Column | None = None) -> dict[str, Column]:
    """Aggregates tp, fp, fn, tn."""
    one = F.lit(1) if weight is None else weight
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    return {
        name: F.coalesce(F.sum(F.when((y == a) & (p == b), one)), F.lit(0)).alias(name)
        for name, a, b in [("tp", 1, 1), ("fp", 0, 1), ("fn", 1, 0), ("tn", 0, 0)]
    }


def prf(tp, fp, fn) -> tuple[Column, Column, Column]:
    """Precision, recall, F1; 0 on an empty denominator."""
    tp, fp, fn = F.col(tp), F.col(fp), F.col(fn)
    precision, recall = safe_div(tp, tp + fp, 0), safe_div(tp, tp + fn, 0)
    return precision, recall, safe_div(2 * precision * recall, precision + recall, 0)


def weighted_prf_columns() -> dict[str, Column]:
    """Class-weighted precision, recall and F1 (weight = share of the true class) from tp, fp, fn, tn."""
    p1, r1, f1 = prf("tp", "fp", "fn")
    p0, r0, f0 = prf("tn", "fn", "fp")
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    ones, zeros = tp + fn, tn + fp
    return {
        name: safe_div(a * ones + b * zeros, ones + zeros, 0)
        for name, a, b in [("p", p1, p0), ("r", r1, r0), ("f1", f1, f0)]
    }


def binary_metrics(
    df: DataFrame, label: str = "tx_fraud", pred: str = "prediction", time: str = "unix_time"
) -> DataFrame:
    """One row: cells, precision, recall, f1_score, avg_fp_per_week."""
    row = df.agg(*cells(label, pred).values(), F.min(time).alias("first_tx"), F.max(time).alias("last_tx"))
    precision, recall, f1 = prf("tp", "fp", "fn")
    weeks = safe_div(F.col("last_tx") - F.col("first_tx"), F.lit(WEEK))
    return row.select(
        "tp",
        "fp",
        "fn",
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1_score"),
        safe_div("fp", weeks, 0).alias("avg_fp_per_week"),
    )


def confusion(df: DataFrame, label: str = "tx_fraud", pred: str = "prediction") -> DataFrame:
    """Counts by label, one column per prediction (pred_0, pred_1), missing cells 0."""
    table = (
        df.groupBy(F.col(label).alias(label))
        .pivot(pred, [0, 1])
        .agg(F.count(F.lit(1)))
        .fillna(0)
    )
    return table.toDF(label, "pred_0", "pred_1")


def weighted_prf(df: DataFrame, label: str = "tx_fraud", pred: str = "prediction") -> DataFrame:
    row = df.agg(*cells(label, pred).values())
    names = {"p": "weighted_precision", "r": "weighted_recall", "f1": "weighted_f1"}
    return row.select(*[c.alias(names[k]) for k, c in weighted_prf_columns().items()])


def roc_auc(df: DataFrame, label: str = "tx_fraud", score: str = "prob_1") -> float:
    """Exact area under the ROC curve (ties averaged): Spark ML folds equal scores and range-sorts the rest."""
    scored = df.select(F.col(label).cast("double").alias("label"), F.col(score).cast("double").alias("score"))
    evaluator = BinaryClassificationEvaluator(
        labelCol="label", rawPredictionCol="score", metricName="areaUnderROC", numBins=0
    )
    return evaluator.evaluate(scored)


def evaluate_scores(
    df: DataFrame, label: str = "tx_fraud", pred: str = "prediction", score: str = "prob_1", time: str = "unix_time"
) -> DataFrame:
    """One row: precision, recall, f1_score, auc."""
    auc = roc_auc(df, label, score)
    row = binary_metrics(df, label, pred, time)
    return row.select("precision", "recall", "f1_score", F.lit(auc).alias("auc"))


def flatten_metrics(df: DataFrame, sep: str = "_") -> DataFrame:
    """Nested result rows to (name, value): struct paths joined with `sep`, booleans 1/0, other types left out."""
    from pyspark.sql import types as T

    found: list[tuple[str, Column]] = []

    def walk(schema: T.StructType, path: list[str]) -> None:
        for f in schema.fields:
            here = [*path, f.name]
            col = F.col(".".join(f"`{p}`" for p in here))
            if isinstance(f.dataType, T.StructType):
                walk(f.dataType, here)
            elif isinstance(f.dataType, (T.NumericType, T.BooleanType)):
                found.append((sep.join(here), col.cast("double")))

    walk(df.schema, [])
    pairs = F.array(*[F.struct(F.lit(n).alias("name"), c.alias("value")) for n, c in found])
    return df.select(F.explode(pairs).alias("m")).select("m.name", "m.value").where(F.col("value").isNotNull())
