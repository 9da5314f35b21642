"""Section E: window functions and features."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallywire.functions import HOUR, bucket_of
from tallywire.operators import features
from tallywire.operators.buckets import bucket_running, bucketed_rolling
from tallywire.operators.clean import dedup
from tallywire.operators.windows import rolling
from tallywire.queries.common import TX, TX_TIES, query, r6, rounded, table, tx, tx_ties
from tallywire.schemas import FEATURE

# --- SQL pieces -------------------------------------------------------------------------------


def frame(lo: int, hi: int) -> str:
    end = "CURRENT ROW" if hi == 0 else f"{-hi} PRECEDING"
    return f"RANGE BETWEEN {-lo} PRECEDING AND {end}"


def over(keys: str, order: str, lo: int, hi: int) -> str:
    return f"OVER (PARTITION BY {keys} ORDER BY {order} {frame(lo, hi)})"


def direct_sql(keys: str, target: str, frames: dict, aggs: tuple[str, ...], prefix: str) -> dict[str, str]:
    """Column -> SQL of rolling frames over rows."""
    out = {}
    for name, (lo, hi) in frames.items():
        w = over(keys, "unix_time", lo, hi)
        made = {
            "cn": f"count(*) {w}",
            "sum": f"sum({target}) {w}",
            "avg": f"sum({target}) {w} / nullif(count(*) {w}, 0)",
            "std": f"stddev_samp({target}) {w}",
            "isnew": f"(count(*) {w} = 0)::INT",
        }
        out.update({f"{target}_{a}_{prefix}_{name}": made[a] for a in aggs})
    return out


def bucket_sql(
    target: str, frames: dict, aggs: tuple[str, ...], prefix: str, current: bool, keys: str = "terminal_id"
) -> dict[str, str]:
    """Column -> SQL of frames over the bucket start of every row, plus the running bucket."""
    out = {}
    run = f"OVER (PARTITION BY {keys}, bucket ORDER BY unix_time RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    for name, (lo, hi) in frames.items():
        w = over(keys, "bucket", lo, hi)

        def total(expr: str) -> str:
            past = f"coalesce({expr} {w}, 0)"
            return f"({past} + coalesce({expr} {run}, 0))" if current else past

        n, s, q = total("count(*)"), total(f"sum({target})"), total(f"sum({target}::DOUBLE * {target})")
        made = {
            "cn": n,
            "sum": s,
            "avg": f"CASE WHEN {n} > 0 THEN {s} / {n} ELSE 0 END",
            "std": f"CASE WHEN {n} > 1 THEN sqrt(greatest(0, {q} / {n} - pow({s} / {n}, 2))) ELSE 0 END",
        }
        out.update({f"{prefix}_{target}_{a}_{name}": made[a] for a in aggs})
    return out


def pick(columns: dict[str, str]) -> str:
    """Select list: counts and flags as integers, the rest rounded."""
    return ", ".join(
        f"({sql})::BIGINT AS {name}"
        if "_cn_" in name or "isnew" in name
        else r6(sql, name)
        for name, sql in columns.items()
    )


BUCKETED = TX + ", bt AS (SELECT *, unix_time // 3600 * 3600 AS bucket FROM tx)"


def _ints(df, wide: bool = True):
    """Flags widened so that both sides have the same type."""
    return df.select(
        *[F.col(c).cast("bigint").alias(c) if "isnew" in c else F.col(c) for c in df.columns]
    )


def _added(df, before):
    return rounded(_ints(df.select("transaction_id", *[c for c in df.columns if c not in before])))


# --- queries ----------------------------------------------------------------------------------

_LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]


@query(
    "dedup_first",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) = 1""",
)
def dedup_first(spark, sf):
    lines = table(spark, sf, "lineitem")
    order = _LINE_ORDER + ["l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    out = dedup(lines, ["l_orderkey", "l_linenumber"], order)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


_WEEK_DAY = {"7d_full": (-604800, 0), "7d_hist": (-604800, -86400)}


def _rolling_query(agg: str, short: str):
    sql = direct_sql("customer_id", "tx_amount", _WEEK_DAY, (short,), "cust")

    @query(f"rolling_{agg}", f"WITH {TX_TIES} SELECT transaction_id, {pick(sql)} FROM tx_ties")
    def run(spark, sf):
        df = tx_ties(spark, sf)
        out = rolling(df, ["customer_id"], "unix_time", "tx_amount", _WEEK_DAY, [agg], "cust")
        return _added(out, df.columns)


for _agg, _short in (("count", "cn"), ("sum", "sum"), ("avg", "avg"), ("std", "std")):
    _rolling_query(_agg, _short)


# the plan for hot keys, with every key treated as hot
@query(
    "rolling_hot_keys",
    f"""WITH {TX} SELECT transaction_id,
      {pick(direct_sql('customer_id', 'tx_amount', features.CUSTOMER_HISTORY, ('cn', 'avg', 'std'), 'cust'))} FROM tx""",
)
def rolling_hot_keys(spark, sf):
    df = tx(spark, sf)
    return _added(features.customer_history(df, hot_rows=0), df.columns)


_REGIMES = """SELECT * REPLACE (CASE WHEN unix_time < (SELECT (min(unix_time) + max(unix_time)) // 2 FROM tx_plain) THEN 2000000.0::DOUBLE
    WHEN transaction_id % 2 = 0 THEN 1.0::DOUBLE ELSE 1.01::DOUBLE END AS tx_amount) FROM tx_plain"""


@query(
    "rolling_hot_std_regimes",
    f"""WITH {TX.replace("tx AS (", "tx_plain AS (", 1)}, tx AS ({_REGIMES}) SELECT transaction_id,
      {pick(direct_sql('customer_id', 'tx_amount', features.CUSTOMER_HISTORY, ('cn', 'avg', 'std'), 'cust'))} FROM tx""",
)
def rolling_hot_std_regimes(spark, sf):
    """Millions first, cents apart later: the deviation of the second half must not feel the first."""
    df = tx(spark, sf)
    middle = df.agg(F.floor((F.min("unix_time") + F.max("unix_time")) / 2)).scalar()
    small = F.when(F.col("transaction_id") % 2 == 0, 1.0).otherwise(1.01)
    df = df.withColumn("tx_amount", F.when(F.col("unix_time") < middle, 2_000_000.0).otherwise(small))
    return _added(features.customer_history(df, hot_rows=0), df.columns)


PAIR_SQL = direct_sql("customer_id, terminal_id", "tx_amount", features.PAIR, ("isnew",), "ct")
CURRENT_SQL = direct_sql("customer_id", "tx_amount", features.CUSTOMER_CURRENT, ("cn", "avg"), "cust")
HISTORY_SQL = direct_sql("customer_id", "tx_amount", features.CUSTOMER_HISTORY, ("cn", "avg", "std"), "cust")


@query("pair_is_new", f"WITH {TX} SELECT transaction_id, {pick(PAIR_SQL)} FROM tx")
def pair_is_new(spark, sf):
    df = tx(spark, sf)
    return _added(features.pair_is_new(df), df.columns)


@query("customer_current", f"WITH {TX} SELECT transaction_id, {pick(CURRENT_SQL)} FROM tx")
def customer_current(spark, sf):
    df = tx(spark, sf)
    return _added(features.customer_current(df), df.columns)


@query("customer_history", f"WITH {TX} SELECT transaction_id, {pick(HISTORY_SQL)} FROM tx")
def customer_history(spark, sf):
    df = tx(spark, sf)
    return _added(features.customer_history(df), df.columns)


_RATIO_COLUMNS = [c for c in features.RATIO_COLUMNS if "cust" in c]


def ratio_sql(c: str) -> str:
    return f"tx_amount / nullif(CASE WHEN {c} <> 0 THEN {c} ELSE tx_amount END, 0)"


@query(
    "ratio_features",
    f"""WITH {TX}, w AS (SELECT *, {', '.join(f'{s} AS {n}' for n, s in HISTORY_SQL.items())} FROM tx)
    SELECT transaction_id, {', '.join(r6(ratio_sql(c), f'ratio_{c}') for c in _RATIO_COLUMNS)} FROM w""",
)
def ratio_features(spark, sf):
    df = features.ratios(features.customer_history(tx(spark, sf)), "tx_amount", _RATIO_COLUMNS, drop=True)
    return rounded(df.select("transaction_id", *[f"ratio_{c}" for c in _RATIO_COLUMNS]))


_BUCKET_FRAMES = {"2d": (-172800, -3600), "1d_gap": (-86400, -7200)}


@query(
    "bucketed_history",
    f"""WITH {BUCKETED} SELECT transaction_id,
      {pick(bucket_sql('tx_amount', _BUCKET_FRAMES, ('cn', 'sum', 'avg', 'std'), 'term', False))} FROM bt""",
)
def bucketed_history(spark, sf):
    df = tx(spark, sf)
    out = bucketed_rolling(
        df, ["terminal_id"], "unix_time", "tx_amount", _BUCKET_FRAMES, HOUR,
        ["count", "sum", "avg", "std"], include_current=False, prefix="term",
    )
    return _added(out, df.columns)


@query(
    "bucket_running",
    f"""WITH {BUCKETED} SELECT transaction_id,
        count(*) OVER w AS run_cn, {r6('sum(tx_amount) OVER w', 'run_sum')} FROM bt
    WINDOW w AS (PARTITION BY terminal_id, bucket ORDER BY unix_time RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def bucket_running_query(spark, sf):
    df = tx(spark, sf).withColumn("_bucket", bucket_of("unix_time", HOUR))
    out = bucket_running(df, ["terminal_id"], "unix_time", {"_cn": F.lit(1), "_sum": F.col("tx_amount")})
    return rounded(out.select("transaction_id", F.col("_run_cn").alias("run_cn"), F.col("_run_sum").alias("run_sum")))


_CFG = features.FeatureConfig()
TERM_CURRENT_SQL = bucket_sql("tx_amount", _CFG.current, ("cn", "avg"), "term", True)
TERM_HISTORY_SQL = bucket_sql("tx_amount", _CFG.history, ("cn", "avg", "std"), "term", False)
NEW_SQL = {
    k: v
    for w in features.PAIR
    for k, v in bucket_sql(f"tx_amount_isnew_ct_{w}", _CFG.current, ("sum",), "term", False).items()
}
RISK_SQL = bucket_sql("tx_fraud", features.RISK, ("cn", "sum"), "fraud", False)
WITH_PAIR = BUCKETED + f", bp AS (SELECT *, {', '.join(f'{s} AS {n}' for n, s in PAIR_SQL.items())} FROM bt)"


@query("terminal_current", f"WITH {BUCKETED} SELECT transaction_id, {pick(TERM_CURRENT_SQL)} FROM bt")
def terminal_current(spark, sf):
    df = tx(spark, sf)
    return _added(features.terminal_current(df), df.columns)


@query("terminal_history", f"WITH {BUCKETED} SELECT transaction_id, {pick(TERM_HISTORY_SQL)} FROM bt")
def terminal_history(spark, sf):
    df = tx(spark, sf)
    return _added(features.terminal_history(df), df.columns)


@query("terminal_new_customers", f"WITH {WITH_PAIR} SELECT transaction_id, {pick(NEW_SQL)} FROM bp")
def terminal_new_customers(spark, sf):
    df = features.pair_is_new(tx(spark, sf))
    return _added(features.terminal_new_customers(df), df.columns)


def delayed_sql() -> str:
    return ", ".join(
        f"fraud_tx_fraud_cn_{w}::BIGINT AS fraud_tx_fraud_cn_{w}_delay, "
        + r6(
            f"CASE WHEN fraud_tx_fraud_cn_{w} > 0 THEN fraud_tx_fraud_sum_{w}::DOUBLE / fraud_tx_fraud_cn_{w} ELSE 0 END",
            f"fraud_tx_fraud_risk_{w}_delay",
        )
        for w in features.RISK
    )


@query(
    "terminal_risk",
    f"""WITH {BUCKETED}, r AS (SELECT *, {', '.join(f'{s} AS {n}' for n, s in RISK_SQL.items())} FROM bt)
    SELECT transaction_id, {delayed_sql()} FROM r""",
)
def terminal_risk(spark, sf):
    df = tx(spark, sf)
    return _added(features.terminal_risk(df), df.columns)


# --- the whole feature row --------------------------------------------------------------------

def feature_sql() -> str:
    """CTEs ending in `full_row` with all raw columns; `feature_select` picks the published 66."""
    raw = {**CURRENT_SQL, **HISTORY_SQL, **TERM_CURRENT_SQL, **TERM_HISTORY_SQL, **NEW_SQL, **RISK_SQL}
    return f"""{WITH_PAIR}, full_row AS (
      SELECT *, make_timestamp(unix_time * 1000000) AS moment, {', '.join(f'{s} AS {n}' for n, s in raw.items())} FROM bp)"""


def feature_select() -> str:
    special = {
        "is_night": "(hour(moment) < 6)::INT",
        "is_weekend": "(dayofweek(moment) IN (0, 6))::INT",
        "is_rovn_sum": "(tx_amount % 100 = 0)::INT",
        "is_unknonw_terminal": "(terminal_id = -1)::INT",
        "is_unknonw_customer": "(customer_id = -1)::INT",
        "hour_sin": "sin(2 * pi() * hour(moment) / 24)",
        "hour_cos": "cos(2 * pi() * hour(moment) / 24)",
        "day_sin": "sin(2 * pi() * (dayofweek(moment) + 1) / 7)",
        "day_cos": "cos(2 * pi() * (dayofweek(moment) + 1) / 7)",
        "date": "moment::DATE",
        **{f"ratio_{c}": ratio_sql(c) for c in features.RATIO_COLUMNS},
    }
    for w in features.RISK:
        n, s = f"fraud_tx_fraud_cn_{w}", f"fraud_tx_fraud_sum_{w}"
        special[f"{n}_delay"] = n
        special[f"fraud_tx_fraud_risk_{w}_delay"] = f"CASE WHEN {n} > 0 THEN {s}::DOUBLE / {n} ELSE 0 END"
    out = []
    for f in FEATURE.fields:
        sql, kind = special.get(f.name, f.name), f.dataType.simpleString()
        out.append(r6(sql, f.name) if kind == "double" else f"({sql})::{kind.upper()} AS {f.name}")
    return ", ".join(out)


FEATURE_ROW_SQL = f"WITH {feature_sql()} SELECT {feature_select()} FROM full_row"


@query("feature_row", FEATURE_ROW_SQL)
def feature_row(spark, sf):
    return rounded(features.build_features(tx(spark, sf)))


# every customer and every bucket treated as hot
@query("feature_row_hot", FEATURE_ROW_SQL)
def feature_row_hot(spark, sf):
    cfg = features.FeatureConfig(hot_customer_rows=0, hot_bucket_rows=0)
    return rounded(features.build_features(tx(spark, sf), cfg))
