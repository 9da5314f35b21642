"""Section B: projections, filters, slices; section C: the join."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywire.functions import HOUR, WEEK, bucket_of, feature_columns, fill_numeric, label_as
from tallywire.operators import clean, slices, split
from tallywire.operators.buckets import bucket_agg, join_buckets
from tallywire.operators.features import customer_current, trim_warmup
from tallywire.operators.metrics import confident
from tallywire.queries.common import (
    PAYLOAD,
    SCORED,
    TX,
    TX_CSV,
    TX_DIRTY,
    one_model,
    payloads,
    query,
    r6,
    rounded,
    scored,
    table,
    tx,
    tx_dirty,
    write_csv,
)
from tallywire.sources.files import read_raw_csv
from tallywire.sources.messages import explode_payload, validate


@query(
    "id_slice",
    f"""WITH {TX}, b AS (SELECT min(transaction_id) AS lo, max(transaction_id) AS hi FROM tx)
    SELECT transaction_id, unix_time, tx_amount FROM tx, b
    WHERE transaction_id >= lo + (hi - lo) // 4 AND transaction_id < hi""",
)
def id_slice(spark, sf):
    df = tx(spark, sf)
    lo, hi = slices.span(df, "transaction_id").first()
    return slices.slice_range(df, "transaction_id", lo + (hi - lo) // 4, hi).select(
        "transaction_id", "unix_time", "tx_amount"
    )


@query(
    "clean_bounds",
    """WITH s AS (SELECT min(event_id) AS lo, max(event_id) AS hi FROM events), c AS (
      SELECT 'first' AS run, lo AS start_id, hi AS end_id, lo AS keep_from FROM s
      UNION ALL SELECT 'first_batch', lo, lo + 500, lo FROM s
      UNION ALL SELECT 'next', 400 - 100, hi, 400 FROM s
      UNION ALL SELECT 'next_batch', 400 - 100, least(400 + 200, hi), 400 FROM s
      UNION ALL SELECT 'too_little', NULL, NULL, NULL FROM s)
    SELECT run, start_id::BIGINT AS start_id, end_id::BIGINT AS end_id, keep_from::BIGINT AS keep_from FROM c""",
)
def clean_bounds(spark, sf):
    row = slices.span(table(spark, sf, "events"), "event_id")
    cases = {
        "first": slices.with_clean_bounds(row, 0, 100, 0),
        "first_batch": slices.with_clean_bounds(row, 0, 100, 0, first_batch=500),
        "next": slices.with_clean_bounds(row, 400, 100, 100),
        "next_batch": slices.with_clean_bounds(row, 400, 100, 100, batch=200),
        "too_little": slices.with_clean_bounds(row, F.col("max_value") - 50, 100, 100),
    }
    return _cases(cases, ["start_id", "end_id", "keep_from"])


def _cases(cases, columns):
    out = None
    for name, df in cases.items():
        one = df.select(F.lit(name).alias("run"), *columns)
        out = one if out is None else out.unionByName(one)
    return out


_FIVE_DAYS = 5 * 86400


@query(
    "feature_bounds",
    f"""WITH {TX}, s AS (SELECT min(unix_time) AS lo, max(unix_time) AS hi FROM tx), c AS (
      SELECT 'first' AS run, hi - 2 * 432000 AS start_time, hi AS end_time, hi - 432000 AS good_time FROM s
      UNION ALL SELECT 'next', lo + 864000 - 432000, least(lo + 864000 + 432000, hi), lo + 864000 FROM s
      UNION ALL SELECT 'no_history', NULL, NULL, NULL FROM s
      UNION ALL SELECT 'no_news', NULL, NULL, NULL FROM s
      UNION ALL SELECT 'too_short', NULL, NULL, NULL FROM s)
    SELECT run, start_time::BIGINT AS start_time, end_time::BIGINT AS end_time, good_time::BIGINT AS good_time FROM c""",
)
def feature_bounds(spark, sf):
    row = slices.span(tx(spark, sf), "unix_time")
    lo, hi = F.col("min_value"), F.col("max_value")
    small = dict(overlap=_FIVE_DAYS, batch=_FIVE_DAYS, first_batch=_FIVE_DAYS)
    cases = {
        "first": slices.with_feature_bounds(row, 0, **small),
        "next": slices.with_feature_bounds(row, lo + 2 * _FIVE_DAYS, **small),
        "no_history": slices.with_feature_bounds(row, lo + HOUR, **small),
        "no_news": slices.with_feature_bounds(row, hi - HOUR, **small),
        "too_short": slices.with_feature_bounds(row, 0),
    }
    return _cases(cases, ["start_time", "end_time", "good_time"])


@query(
    "warmup_trim",
    f"""WITH {TX}, w AS (SELECT transaction_id, unix_time, count(*) OVER (PARTITION BY customer_id ORDER BY unix_time
          RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS n FROM tx)
    SELECT transaction_id, n FROM w WHERE unix_time >= (SELECT min(unix_time) + 604800 FROM tx)""",
)
def warmup_trim(spark, sf):
    df = tx(spark, sf)
    good = slices.span(df, "unix_time").first()[0] + WEEK
    out = trim_warmup(customer_current(df), good)
    return out.select("transaction_id", F.col("tx_amount_cn_cust_7d_full").alias("n"))


@query(
    "learning_range",
    f"""WITH {TX}, s AS (SELECT min(unix_time) AS lo, max(unix_time) AS hi FROM tx), c AS (
      SELECT 'enough' AS run, 172800 AS predict_period, hi - 604800 - 172800 AS start_time, hi AS end_time FROM s
      UNION ALL SELECT 'one_day', 86400, lo + 700000 - 604800 - 86400, lo + 700000 FROM s
      UNION ALL SELECT 'stop', NULL, NULL, NULL FROM s)
    SELECT run, predict_period::BIGINT AS predict_period, start_time::BIGINT AS start_time, end_time::BIGINT AS end_time
    FROM c""",
)
def learning_range(spark, sf):
    row = slices.span(tx(spark, sf), "unix_time")
    cases = {
        "enough": slices.with_learning_range(row),
        "one_day": slices.with_learning_range(row.withColumn("max_value", F.col("min_value") + 700_000)),
        "stop": slices.with_learning_range(row.withColumn("max_value", F.col("min_value") + 600_000)),
    }
    return _cases(cases, ["predict_period", "start_time", "end_time"])


@query("drop_corrupt", f"WITH {TX_CSV} SELECT * EXCLUDE (_corrupt) FROM tx_csv WHERE _corrupt IS NULL")
def drop_corrupt(spark, sf):
    return clean.drop_corrupt(read_raw_csv(spark, write_csv(spark, sf)))


def _sentinel_sql(c: str) -> str:
    return f"CASE WHEN {c} >= 0 THEN {c} ELSE -1 END AS {c}"


@query(
    "sentinel_normalise",
    f"WITH {TX_DIRTY} SELECT transaction_id, {', '.join(_sentinel_sql(c) for c in clean.SENTINEL_COLUMNS)} FROM tx_dirty",
)
def sentinel_normalise(spark, sf):
    return clean.with_sentinels(tx_dirty(spark, sf)).select("transaction_id", *clean.SENTINEL_COLUMNS)


PARSED = "try_strptime(replace(tx_datetime, '24:00:00', '23:59:59'), '%Y-%m-%d %H:%M:%S')"


@query(
    "valid_rows",
    f"""WITH {TX_DIRTY} SELECT transaction_id, tx_amount, tx_fraud FROM tx_dirty
    WHERE transaction_id >= 0 AND {PARSED} IS NOT NULL AND tx_amount >= 0 AND tx_fraud IN (0, 1)""",
)
def valid_rows(spark, sf):
    df = clean.valid(clean.parse_time(tx_dirty(spark, sf)))
    return df.select("transaction_id", "tx_amount", "tx_fraud")


@query(
    "label_cast",
    f"WITH {TX} SELECT transaction_id, tx_fraud::BOOLEAN AS as_boolean, tx_fraud::BOOLEAN::INT AS as_int FROM tx",
)
def label_cast(spark, sf):
    df = label_as(tx(spark, sf), "boolean").select("transaction_id", "tx_fraud")
    both = label_as(df.withColumn("as_boolean", F.col("tx_fraud")), "int")
    return both.select("transaction_id", "as_boolean", F.col("tx_fraud").alias("as_int"))


@query(
    "fill_nulls",
    f"WITH {TX_DIRTY} SELECT transaction_id, coalesce(customer_id, 0) AS customer_id, tx_datetime FROM tx_dirty",
)
def fill_nulls(spark, sf):
    return fill_numeric(tx_dirty(spark, sf)).select("transaction_id", "customer_id", "tx_datetime")


@query("select_features", f"WITH {TX} SELECT tx_amount, unix_time FROM tx")
def select_features(spark, sf):
    df = tx(spark, sf)
    exclude = ["transaction_id", "tx_datetime", "customer_id", "terminal_id", "tx_fraud"]
    return df.select(*sorted(feature_columns(df, exclude)))


@query(
    "time_split",
    f"""WITH {TX}, q AS (SELECT quantile_disc(unix_time, 0.8) AS cut FROM tx)
    SELECT transaction_id, CASE WHEN unix_time <= cut THEN 'train' ELSE 'test' END AS part FROM tx, q""",
)
def time_split(spark, sf):
    return split.with_split(tx(spark, sf), 0.8, rel_err=0).select("transaction_id", "part")


_FOLDS = f"""{TX}, c AS (
      SELECT [min(unix_time)] || quantile_disc(unix_time, [1/7, 2/7, 3/7, 4/7, 5/7, 6/7]) || [max(unix_time)] AS p FROM tx),
    folds AS (
      SELECT i::INT AS fold, p[i + 1] AS train_start, p[i + 5] AS train_end, p[i + 5] AS val_start, p[i + 6] AS val_end
      FROM c, range(3) r(i))"""


@query("time_folds", f"WITH {_FOLDS} SELECT * FROM folds")
def time_folds(spark, sf):
    return split.time_folds(tx(spark, sf), "unix_time", 3, 0.2, 0, err=0)


@query(
    "fold_rows",
    f"""WITH {_FOLDS} SELECT transaction_id, fold,
           CASE WHEN unix_time < train_end THEN 'train' ELSE 'val' END AS role
    FROM tx JOIN folds ON unix_time >= train_start AND unix_time < val_end""",
)
def fold_rows(spark, sf):
    df = tx(spark, sf)
    windows = [r[1:] for r in split.time_folds(df, "unix_time", 3, 0.2, 0, err=0).orderBy("fold").collect()]
    return split.with_fold_roles(df, windows).select("transaction_id", "fold", "role")


@query("confident_rows", f"WITH {SCORED} SELECT transaction_id, tx_fraud, pred_b AS prediction FROM scored WHERE score_b >= 0.9")
def confident_rows(spark, sf):
    return confident(one_model(scored(spark, sf)), 0.9).select("transaction_id", "tx_fraud", "prediction")


_CONTRACT = T.StructType([*PAYLOAD.fields, T.StructField("customer_id", T.IntegerType())])


@query(
    "contract_check",
    f"""WITH {TX_DIRTY} SELECT transaction_id, customer_id IS NOT NULL AND transaction_id % 19 <> 0 AS accepted,
        concat_ws(',', CASE WHEN transaction_id % 19 = 0 THEN 'tx_fraud' END,
                       CASE WHEN customer_id IS NULL THEN 'customer_id' END) AS reasons
    FROM tx_dirty""",
)
def contract_check(spark, sf):
    record = F.struct(
        "transaction_id",
        F.col("tx_time_seconds").cast("bigint").alias("unix_time"),
        "tx_amount",
        F.when(F.col("transaction_id") % 19 == 0, "seven").otherwise(F.col("tx_fraud").cast("string")).alias("tx_fraud"),
        "customer_id",
    )
    # the label goes out as a bare number, or as quoted text where it is wrong
    text = F.regexp_replace(F.to_json(record), r'"tx_fraud":"(\d+)"', '"tx_fraud":$1')
    good, rejected = validate(tx_dirty(spark, sf).select(text.alias("value")), _CONTRACT)
    taken = good.select("transaction_id", F.lit(True).alias("accepted"), F.lit("").alias("reasons"))
    refused = rejected.select(
        F.get_json_object("value", "$.transaction_id").cast("bigint").alias("transaction_id"),
        F.lit(False).alias("accepted"),
        F.array_join("reasons", ",").alias("reasons"),
    )
    return taken.unionByName(refused)


@query(
    "payload_explode",
    f"""WITH {TX} SELECT transaction_id, unix_time, tx_amount, tx_fraud FROM tx,
        range(CASE WHEN transaction_id % 7 = 0 THEN 0 WHEN transaction_id % 5 = 0 THEN 2 ELSE 1 END)""",
)
def payload_explode(spark, sf):
    return explode_payload(payloads(tx(spark, sf)), PAYLOAD)


@query(
    "bucket_join_back",
    f"""WITH {TX}, b AS (SELECT *, unix_time // 3600 * 3600 AS bucket FROM tx)
    SELECT transaction_id, bucket, count(*) OVER (PARTITION BY terminal_id, bucket) AS bucket_rows,
           {r6('sum(tx_amount) OVER (PARTITION BY terminal_id, bucket)', 'bucket_sum')} FROM b""",
)
def bucket_join_back(spark, sf):
    df = tx(spark, sf)
    sums = bucket_agg(df, ["terminal_id"], "unix_time", "tx_amount", HOUR, ["count", "sum"])
    joined = join_buckets(df.withColumn("_bucket", bucket_of("unix_time", HOUR)), sums, ["terminal_id"])
    return rounded(
        joined.select(
            "transaction_id",
            F.col("_bucket").alias("bucket"),
            F.col("_b_cnt").alias("bucket_rows"),
            F.col("_b_sum_tx_amount").alias("bucket_sum"),
        )
    )
