"""The 66-column feature row: pair, customer and terminal history, delayed risk, calendar, ratios."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywire.functions import (
    DAY,
    HOUR,
    MONTH,
    WEEK,
    is_round,
    is_unknown,
    safe_div,
    with_calendar,
    with_cyclic,
    zero_if_null,
)
from tallywire.operators.buckets import BucketSpec, bucketed_multi
from tallywire.operators.skew import HOT_RUNNING, HOT_SLIDING, same_keys, split_hot
from tallywire.operators.windows import Frames, rolling_by_second, rolling_columns, with_windows
from tallywire.schemas import FEATURE, RATIO_COLUMNS

TIME, AMOUNT, LABEL = "unix_time", "tx_amount", "tx_fraud"
CUSTOMER, TERMINAL = "customer_id", "terminal_id"

# Frames in seconds, both ends inclusive.
PAIR: Frames = {"30d_hist": (-MONTH, -1), "7d_hist": (-WEEK, -1)}
CUSTOMER_CURRENT: Frames = {"7d_full": (-WEEK, 0), "1d_full": (-DAY, 0), "1h_full": (-HOUR, 0)}
CUSTOMER_HISTORY: Frames = {"30d_hist": (-MONTH, -WEEK), "7d_hist": (-WEEK, -DAY), "1d_hist": (-DAY, -HOUR)}
RISK: Frames = {"1d_full": (-WEEK - DAY, -WEEK), "7d_full": (-2 * WEEK, -WEEK), "21d_full": (-MONTH, -WEEK)}

def terminal_current_frames(width: int = HOUR) -> Frames:
    """Published bounds: the bucket just before the current one is left out."""
    return {
        "7d_full": (-WEEK, -width - 1),
        "1d_full": (-DAY, -width - 1),
        "1h_full": (-2 * HOUR, -width - 1),
    }


def terminal_history_frames(width: int = HOUR) -> Frames:
    return {
        "30d_hist": (-MONTH, -DAY - width - 1),
        "7d_hist": (-WEEK, -DAY - width - 1),
        "1d_hist": (-DAY, -HOUR - width - 1),
    }


def contiguous_current_frames(width: int = HOUR) -> Frames:
    """Like `terminal_current_frames`, but the history ends right where the current bucket begins."""
    return {"7d_full": (-WEEK, -width), "1d_full": (-DAY, -width), "1h_full": (-HOUR, -width)}


@dataclass(frozen=True)
class FeatureConfig:
    width: int = HOUR
    contiguous: bool = False
    hot_customer_rows: int | None = HOT_SLIDING
    hot_bucket_rows: int | None = HOT_RUNNING

    @property
    def current(self) -> Frames:
        return contiguous_current_frames(self.width) if self.contiguous else terminal_current_frames(self.width)

    @property
    def history(self) -> Frames:
        return terminal_history_frames(self.width)


#: seconds a feature row can look back: new customers are counted over a week of buckets, and whether a
#: customer was new then depends on the month before that
LONGEST_LOOKBACK = MONTH + WEEK + HOUR


def customer_current(df: DataFrame, hot_rows: int | None = HOT_SLIDING) -> DataFrame:
    return _customer_block(df, {"now": (CUSTOMER_CURRENT, ("count", "avg"))}, False, hot_rows)


def customer_history(df: DataFrame, hot_rows: int | None = HOT_SLIDING) -> DataFrame:
    return _customer_block(df, {"past": (CUSTOMER_HISTORY, ("count", "avg", "std"))}, False, hot_rows)


def pair_is_new(
    df: DataFrame, hot_rows: int | None = HOT_SLIDING, split: tuple[DataFrame, DataFrame | None] | None = None
) -> DataFrame:
    """1 when this customer was not at this terminal in the last 30 or 7 days (this second excluded)."""
    return _customer_block(df, {}, True, hot_rows, split)


def customer_features(
    df: DataFrame, hot_rows: int | None = HOT_SLIDING, split: tuple[DataFrame, DataFrame | None] | None = None
) -> DataFrame:
    """`split` are the rows of ordinary and of hot customers, where they are known."""
    blocks = {
        "now": (CUSTOMER_CURRENT, ("count", "avg")),
        "past": (CUSTOMER_HISTORY, ("count", "avg", "std")),
    }
    return _customer_block(df, blocks, True, hot_rows, split)


def _customer_block(
    df: DataFrame,
    blocks: dict[str, tuple[Frames, Sequence[str]]],
    pair: bool,
    hot_rows: int | None,
    split: tuple[DataFrame, DataFrame | None] | None = None,
) -> DataFrame:
    """Pair and customer windows in one select: they share the shuffle by customer."""
    parts = [rolling_columns([CUSTOMER], TIME, AMOUNT, f, aggs, "cust") for f, aggs in blocks.values()]
    if pair:
        parts.insert(0, rolling_columns([CUSTOMER, TERMINAL], TIME, AMOUNT, PAIR, ["isnew"], "ct"))
    raw = {n: c for r, _ in parts for n, c in r.items()}
    made = {n: c for _, m in parts for n, c in m.items()}
    cold, hot = split or split_hot(df, [CUSTOMER], hot_rows)
    out = with_windows(cold, raw, made)
    if hot is None:
        return out
    wide = hot
    if pair:
        flags = rolling_by_second(hot, [CUSTOMER, TERMINAL], TIME, AMOUNT, PAIR, ["isnew"], "ct")
        wide = same_keys(wide, flags, [CUSTOMER, TERMINAL, TIME])
    if blocks:
        # all frames in one pass over the seconds
        frames = {name: bounds for block, _ in blocks.values() for name, bounds in block.items()}
        aggs = {name: block_aggs for block, block_aggs in blocks.values() for name in block}
        stats = rolling_by_second(hot, [CUSTOMER], TIME, AMOUNT, frames, aggs, "cust")
        wide = same_keys(wide, stats, [CUSTOMER, TIME])
    return out.unionByName(wide.select(*out.columns))


def current_spec(cfg: FeatureConfig = FeatureConfig()) -> BucketSpec:
    return BucketSpec(AMOUNT, cfg.current, ("count", "avg"), "term")


def history_spec(cfg: FeatureConfig = FeatureConfig()) -> BucketSpec:
    return BucketSpec(AMOUNT, cfg.history, ("count", "avg", "std"), "term", include_current=False)


def new_customer_specs(cfg: FeatureConfig = FeatureConfig()) -> list[BucketSpec]:
    return [
        BucketSpec(f"{AMOUNT}_isnew_ct_{frame}", cfg.current, ("sum",), "term", include_current=False)
        for frame in PAIR
    ]


def risk_spec() -> BucketSpec:
    return BucketSpec(LABEL, RISK, ("count", "sum"), "fraud", include_current=False)


def terminal_current(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    return bucketed_multi(df, [TERMINAL], TIME, [current_spec(cfg)], cfg.width, cfg.hot_bucket_rows)


def terminal_history(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    return bucketed_multi(df, [TERMINAL], TIME, [history_spec(cfg)], cfg.width, cfg.hot_bucket_rows)


def terminal_new_customers(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Sums of the pair flags (`pair_is_new`) at the terminal."""
    return bucketed_multi(df, [TERMINAL], TIME, new_customer_specs(cfg), cfg.width, cfg.hot_bucket_rows)


def terminal_risk(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Fraud share of the terminal as known a week later, when labels have arrived."""
    df = bucketed_multi(df, [TERMINAL], TIME, [risk_spec()], cfg.width, cfg.hot_bucket_rows)
    return with_risk(df)


def with_risk(df: DataFrame) -> DataFrame:
    """For every frame of RISK: rows of the terminal and the share of frauds among them (0 without rows), in place
    of the frame's count and sum."""
    counts, frauds = ({f: f"fraud_{LABEL}_{a}_{f}" for f in RISK} for a in ("cn", "sum"))
    shares = {f"fraud_{LABEL}_risk_{f}_delay": safe_div(frauds[f], counts[f], 0) for f in RISK}
    rows = {f"{counts[f]}_delay": zero_if_null(counts[f]) for f in RISK}
    return df.withColumns({**rows, **shares}).drop(*counts.values(), *frauds.values())


def ratios(df: DataFrame, target: str, columns: Sequence[str], drop: bool = False) -> DataFrame:
    """target / column; a null or zero column counts as the target itself."""
    against = {c: F.coalesce(F.nullif(F.col(c), F.lit(0)), F.col(target)) for c in columns}
    df = df.withColumns({f"ratio_{c}": safe_div(F.col(target), x) for c, x in against.items()})
    return df.drop(*columns) if drop else df


def with_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_rovn_sum": is_round(AMOUNT),
            "is_unknonw_terminal": is_unknown(TERMINAL),
            "is_unknonw_customer": is_unknown(CUSTOMER),
        }
    )


def trim_warmup(df: DataFrame, good: int | Column, time: str = TIME) -> DataFrame:
    """Rows from the first good time on; call it after the windows are in place."""
    return df.where(F.col(time) >= good)


def build_features(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), good: int | None = None) -> DataFrame:
    """The feature row in the published column order.

    Two shuffles of the rows (by customer; by terminal and hour) plus the folded bucket table, which is
    shared by all terminal features. `good` drops the warm-up rows once the windows are computed.
    """
    df = df.select("transaction_id", CUSTOMER, TERMINAL, AMOUNT, F.col(LABEL).cast("int").alias(LABEL), TIME)
    split = split_hot(df, [CUSTOMER], cfg.hot_customer_rows)
    # buckets are folded from rows that carry the pair flags alone: joins of customer frames are not computed for them
    plain, narrow = df, pair_is_new(df, cfg.hot_customer_rows, split)
    df = customer_features(df, cfg.hot_customer_rows, split)
    specs = [current_spec(cfg), history_spec(cfg), *new_customer_specs(cfg), risk_spec()]
    df = bucketed_multi(df, [TERMINAL], TIME, specs, cfg.width, cfg.hot_bucket_rows, plain, narrow)
    df = with_risk(df)
    if good is not None:
        df = trim_warmup(df, good)
    df = with_flags(with_cyclic(with_calendar(df)))
    df = ratios(df, AMOUNT, RATIO_COLUMNS)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FEATURE.fields])
