"""Declared schemas: raw feed, clean table, feature row, scoring contract, prediction."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt"

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


def struct(fields: str) -> T.StructType:
    """'name type, …' to a schema; unlike `StructType.fromDDL` it needs no running session."""
    pairs = (f.split() for f in fields.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW = struct(
    "transaction_id bigint, tx_datetime string, customer_id int, terminal_id int, tx_amount double, "
    "tx_time_seconds int, tx_time_days int, tx_fraud int, tx_fraud_scenario int, _corrupt string"
)

CLEAN = struct(
    "transaction_id bigint, tx_datetime timestamp, customer_id int, terminal_id int, tx_amount double, "
    "tx_time_seconds int, tx_time_days int, tx_fraud boolean, tx_fraud_scenario int, unix_time bigint, "
    "week timestamp"
)

#: columns of the clean table that the feature job reads
FEATURE_INPUT = ["transaction_id", "customer_id", "terminal_id", "tx_amount", "tx_fraud", "unix_time"]

PREDICTION = struct("transaction_id bigint, prediction int, label string, version string")


def _each(pattern: str, windows: list[str], aggs: dict[str, str]) -> list[str]:
    return [f"{pattern.format(agg=a, win=w)} {t}" for w in windows for a, t in aggs.items()]


_CN_AVG = {"cn": "bigint", "avg": "double"}
_CN_AVG_STD = {**_CN_AVG, "std": "double"}
_NOW = ["7d_full", "1d_full", "1h_full"]
_PAST = ["30d_hist", "7d_hist", "1d_hist"]

# The average and deviation columns the amount is compared with.
RATIO_COLUMNS = [
    "term_tx_amount_avg_30d_hist",
    "term_tx_amount_avg_7d_hist",
    "term_tx_amount_std_30d_hist",
    "term_tx_amount_std_7d_hist",
    "tx_amount_avg_cust_30d_hist",
    "tx_amount_std_cust_30d_hist",
    "tx_amount_avg_cust_7d_hist",
    "tx_amount_std_cust_7d_hist",
]

#: the 66 published feature columns, in published order (the flag spellings are part of the contract)
FEATURE = struct(
    ", ".join(
        ["transaction_id bigint", "tx_amount double", "tx_fraud int", "unix_time bigint"]
        + _each("tx_amount_{agg}_ct_{win}", ["30d_hist", "7d_hist"], {"isnew": "int"})
        + _each("tx_amount_{agg}_cust_{win}", _NOW, _CN_AVG)
        + _each("tx_amount_{agg}_cust_{win}", _PAST, _CN_AVG_STD)
        + _each("term_tx_amount_{agg}_{win}", _NOW, _CN_AVG)
        + _each("term_tx_amount_{agg}_{win}", _PAST, _CN_AVG_STD)
        + _each("term_tx_amount_isnew_ct_30d_hist_{agg}_{win}", _NOW, {"sum": "bigint"})
        + _each("term_tx_amount_isnew_ct_7d_hist_{agg}_{win}", _NOW, {"sum": "bigint"})
        + _each(
            "fraud_tx_fraud_{agg}_{win}_delay",
            ["1d_full", "7d_full", "21d_full"],
            {"cn": "bigint", "risk": "double"},
        )
        + [
            f"{c} int"
            for c in ["is_night", "is_weekend", "is_rovn_sum", "is_unknonw_terminal", "is_unknonw_customer"]
        ]
        + [f"{c} double" for c in ["hour_sin", "hour_cos", "day_sin", "day_cos"]]
        + [
            f"ratio_{c} double"
            for c in RATIO_COLUMNS
        ]
        + ["date date"]
    )
)

#: the 62 model inputs: the feature row without id, label and times
MODEL_INPUTS = [c for c in FEATURE.fieldNames() if c not in ("transaction_id", "tx_fraud", "unix_time", "date")]

#: the 63 fields a scoring request must carry
CONTRACT = T.StructType([f for f in FEATURE.fields if f.name == "transaction_id" or f.name in MODEL_INPUTS])
