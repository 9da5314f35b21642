import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from tallywire.operators import features
from tallywire.operators.buckets import BucketSpec, bucketed_multi, bucketed_rolling
from tallywire.operators.skew import split_hot
from tallywire.operators.windows import rolling, rolling_by_second

ROWS = "id bigint, customer_id int, terminal_id int, unix_time bigint, tx_amount double, tx_fraud int"
ALL = ["count", "sum", "avg", "std", "isnew"]


def make(spark, n=400, seed=1, start=0, span=200_000, hot=0.34):
    """Random rows with many ties; a third belongs to the unknown customer and terminal, -1."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        unknown = rng.random() < hot
        rows.append((
            i,
            -1 if unknown else rng.choice([1, 2, 3, None]),
            -1 if unknown else rng.randint(1, 4),
            start + rng.randint(0, span) // 50 * 50,
            rng.choice([None, 5.0, round(rng.uniform(0, 100), 2), round(rng.uniform(0, 100), 2)]),
            rng.randint(0, 1),
        ))
    return spark.createDataFrame(rows, ROWS)


FRAMES = {
    "aligned": {"a": (-86400, 0), "b": (-172800, -86400), "c": (-3600, 0)},
    "odd": {"a": (-5000, -1), "b": (-100_001, -7000), "c": (-7201, -3601)},
    "short": {"a": (-50, 0), "b": (-100, -50)},
    "future": {"a": (-3600, 3600), "b": (0, 7200)},
}


@pytest.mark.parametrize("frames", FRAMES.values(), ids=FRAMES)
def test_hot_keys_equal_direct_windows(spark, frames):
    df = make(spark)
    direct = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=None)
    by_second = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=0)
    assert values(by_second) == values(direct)


def test_hot_and_ordinary_keys_side_by_side(spark):
    df, frames = make(spark), FRAMES["aligned"]
    direct = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=None)
    mixed = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=120)
    assert values(mixed) == values(direct)


def test_one_second_frames(spark):
    df = make(spark, 120, span=2000)
    frames = {"now": (0, 0), "before": (-50, -50)}
    direct = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=None)
    by_second = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=0)
    assert values(by_second) == values(direct)


def test_negative_times(spark):
    df = make(spark, 150, start=-100_000)
    frames = FRAMES["odd"]
    direct = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=None)
    by_second = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=0)
    assert values(by_second) == values(direct)


def test_constant_frames_have_zero_deviation(spark):
    rows = [(i, 1, 1, 60 * i, 1_000_000.1 if i < 50 else 3.3, 0) for i in range(100)]
    df = spark.createDataFrame(rows, ROWS)
    frames = {"w": (-1200, -600)}
    for hot in (None, 0):
        out = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ["std"], "c", hot)
        early = out.where("unix_time between 700 and 2400").select("tx_amount_std_c_w").collect()
        assert {r[0] for r in early if r[0] is not None} == {0.0}


def test_rolling_is_over_all_ties(spark):
    df = spark.createDataFrame([(i, 1, 1, 100 * (i // 2), 1.0, 0) for i in range(6)], ROWS)
    out = rolling(df, ["customer_id"], "unix_time", "tx_amount", {"w": (-100, 0)}, ["count"], "c")
    assert [r[0] for r in out.orderBy("id").select("tx_amount_cn_c_w").collect()] == [2, 2, 4, 4, 4, 4]


BUCKET_FRAMES = {"x": (-86400, -3601), "y": (-172800, -90001), "z": (-7200, -3600)}
BUCKET_AGGS = ["count", "sum", "avg", "std"]


@pytest.mark.parametrize("hot, end", [(None, 0), (20, 0), (0, -1)])
def test_bucketed_equals_frames_over_bucket_start(spark, hot, end):
    df = make(spark).fillna({"tx_amount": 1.5})
    got = bucketed_rolling(
        df, ["terminal_id"], "unix_time", "tx_amount", BUCKET_FRAMES, 3600, BUCKET_AGGS, True, end, "t", hot
    )
    df.withColumn("bucket", F.expr("floor(unix_time / 3600) * 3600")).createOrReplaceTempView("b")
    last = "current row" if end == 0 else f"{-end} preceding"
    cols = []
    for name, (lo, hi) in BUCKET_FRAMES.items():
        past = f"over (partition by terminal_id order by bucket range between {-lo} preceding and {-hi} preceding)"
        here = f"over (partition by terminal_id, bucket order by unix_time range between unbounded preceding and {last})"
        n, s, q = (
            f"(coalesce({e} {past}, 0) + coalesce({e} {here}, 0))"
            for e in ("count(1)", "sum(tx_amount)", "sum(tx_amount * tx_amount)")
        )
        cols += [
            f"{n} as t_tx_amount_cn_{name}",
            f"{s} as t_tx_amount_sum_{name}",
            f"case when {n} > 0 then {s} / {n} else 0 end as t_tx_amount_avg_{name}",
            f"case when {n} > 1 then sqrt(greatest(0, {q} / {n} - pow({s} / {n}, 2))) else 0 end as t_tx_amount_std_{name}",
        ]
    want = spark.sql(f"select {', '.join(df.columns)}, {', '.join(cols)} from b")
    assert values(got, 5) == values(want, 5)


def test_fused_equals_one_by_one(spark):
    df = make(spark)
    specs = [
        BucketSpec("tx_amount", {"x": (-86400, -3601)}, ("count", "avg"), "t"),
        BucketSpec("tx_fraud", {"y": (-172800, -86400)}, ("sum", "count"), "f", include_current=False),
    ]
    fused = bucketed_multi(df, ["terminal_id"], "unix_time", specs)
    single = df
    for s in specs:
        single = bucketed_rolling(
            single, ["terminal_id"], "unix_time", s.target, s.frames, 3600, s.aggs, s.include_current, 0, s.prefix
        )
    assert values(fused) == values(single)


def test_std_alone_is_enough(spark):
    df = make(spark)
    alone = bucketed_rolling(df, ["terminal_id"], "unix_time", "tx_amount", BUCKET_FRAMES, 3600, ["std"], prefix="t")
    all_ = bucketed_rolling(df, ["terminal_id"], "unix_time", "tx_amount", BUCKET_FRAMES, 3600, BUCKET_AGGS, prefix="t")
    assert values(alone) == values(all_.select(*alone.columns))


def test_feature_row_does_not_depend_on_the_hot_limit(spark):
    df = make(spark, 500, span=3_000_000).fillna({"customer_id": -1, "tx_amount": 2.5})
    df = df.withColumnRenamed("id", "transaction_id")
    plain = features.FeatureConfig(hot_customer_rows=None, hot_bucket_rows=None)
    mixed = features.FeatureConfig(hot_customer_rows=130, hot_bucket_rows=1)
    assert values(features.build_features(df, mixed), 5) == values(features.build_features(df, plain), 5)


def test_contiguous_frames_leave_no_hole(spark):
    """With the contiguous preset the 1 h count covers the previous bucket and the running one."""
    df = spark.createDataFrame([(i, 1, 1, 1800 * i, 1.0, 0) for i in range(8)], ROWS)
    cfg = features.FeatureConfig(contiguous=True)
    out = features.terminal_current(df, cfg).orderBy("id")
    assert [r[0] for r in out.select("term_tx_amount_cn_1h_full").collect()] == [1, 2, 3, 4, 3, 4, 3, 4]


def test_split_hot_partitions_the_rows(spark):
    df = make(spark)
    cold, hot = split_hot(df, ["customer_id"], 100)
    assert {r[0] for r in hot.select("customer_id").distinct().collect()} == {-1}
    assert cold.count() + hot.count() == df.count()
    assert split_hot(df, ["customer_id"], 10_000)[1] is None


def test_hot_deviation_does_not_feel_an_earlier_level(spark):
    """Millions, then cents apart, also inside one bucket: nine digits in both plans."""
    rows = [(i, 1, 1, 7200 + 60 * i if i < 100 else 7200 + 6000 + 7 * i, 2e6 if i < 150 else 1 + 0.01 * (i % 2), 0) for i in range(400)]
    df, frames = spark.createDataFrame(rows, ROWS), {"a": (-600, 0), "b": (-3600, -60), "c": (-9000, 0)}
    got = {}
    for name, hot in (("plain", None), ("hot", 0)):
        out = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ["std", "avg"], "c", hot_rows=hot)
        got[name] = {r["id"]: [r[f"tx_amount_{a}_c_{f}"] for a in ("std", "avg") for f in frames] for r in out.collect()}
    for i, want in got["plain"].items():
        for x, y in zip(got["hot"][i], want):
            assert x == y if y is None else x == pytest.approx(y, rel=1e-9, abs=1e-12), i
    assert got["hot"][399][0] == pytest.approx(0.005, rel=0.02)


def test_whole_number_targets_keep_their_type(spark):
    df, frames = make(spark), {"a": (-3600, 0)}
    direct = rolling(df, ["customer_id"], "unix_time", "tx_fraud", frames, ["sum"], "c", hot_rows=None)
    by_second = rolling(df, ["customer_id"], "unix_time", "tx_fraud", frames, ["sum"], "c", hot_rows=0)
    assert direct.schema == by_second.schema and values(direct) == values(by_second)


def test_null_keys_are_a_key_of_buckets(spark):
    df = spark.createDataFrame([(i, None, None, 3600 * i, 1.0, 0) for i in range(4)], ROWS)
    out = bucketed_rolling(df, ["customer_id"], "unix_time", "tx_amount", {"p": (-7200, -3600)}, prefix="c", include_current=False)
    assert [r[0] for r in out.orderBy("id").select("c_tx_amount_cn_p").collect()] == [0, 1, 2, 2]


def test_aggregates_by_frame(spark):
    """Frames of one pass may ask for different aggregates."""
    df, frames = make(spark, 150), {"a": (-86400, 0), "b": (-172800, -86400)}
    asked = {"a": ["count", "avg"], "b": ["sum", "std", "isnew"]}
    got = rolling_by_second(df, ["customer_id"], "unix_time", "tx_amount", frames, asked, "c")
    assert got.columns[2:] == [f"tx_amount_{n}" for n in ("cn_c_a", "avg_c_a", "sum_c_b", "std_c_b", "isnew_c_b")]
    want = rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=None).select(*got.columns).distinct()
    assert values(got) == values(want)


def test_hot_frames_of_null_keys_and_no_values(spark):
    rows = [(0, None, 1, 100, None, 0), (1, None, 1, 90_000, 2.0, 0), (2, 1, 1, 70, 3.0, 0), (3, 1, 1, 9000, None, 0), (4, 1, 1, 50, None, 0), (5, 1, 1, 60, None, 0)]
    df, frames = spark.createDataFrame(rows, ROWS), {"a": (-86400, 0), "b": (-172800, -86400)}
    direct, by_second = (rolling(df, ["customer_id"], "unix_time", "tx_amount", frames, ALL, "c", hot_rows=n) for n in (None, 0))
    assert values(by_second) == values(direct)


@pytest.mark.parametrize("hot", [None, 20, 0])
def test_buckets_from_narrow_rows(spark, hot):
    """Rows that stand in for costly ones in the counting and folding of buckets change nothing."""
    df = make(spark)
    specs = [BucketSpec("tx_amount", BUCKET_FRAMES, ("count", "avg"), "t"), BucketSpec("tx_fraud", BUCKET_FRAMES, ("sum",), "f", include_current=False)]
    plain, narrow = df.select("terminal_id", "unix_time", "tx_amount"), df.select("terminal_id", "unix_time", "tx_amount", "tx_fraud")
    got = bucketed_multi(df, ["terminal_id"], "unix_time", specs, hot_rows=hot, plain=plain, narrow=narrow)
    assert values(got) == values(bucketed_multi(df, ["terminal_id"], "unix_time", specs, hot_rows=hot))
