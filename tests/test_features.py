import pytest
from conftest import SF, values

from tallywire.functions import DAY, duration_seconds, label_text
from tallywire.operators.features import build_features
from tallywire.plans.jobs import FeatureJobConfig, feature_job
from tallywire.queries import QUERIES
from tallywire.queries.common import tx
from tallywire.schemas import CONTRACT, FEATURE, MODEL_INPUTS


def test_contract_sizes():
    names = FEATURE.fieldNames()
    assert len(names) == len(set(names)) == 66
    assert len(MODEL_INPUTS) == 62 and len(CONTRACT.fields) == 63
    assert not {"transaction_id", "tx_fraud", "unix_time", "date"} & set(MODEL_INPUTS)
    assert names[:4] == ["transaction_id", "tx_amount", "tx_fraud", "unix_time"] and names[-1] == "date"
    assert names[21:24] == ["term_tx_amount_cn_7d_full", "term_tx_amount_avg_7d_full", "term_tx_amount_cn_1d_full"]


def test_feature_row_has_the_published_schema(spark):
    got = build_features(tx(spark, SF)).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in FEATURE]


@pytest.mark.parametrize("name", ["feature_row", "calendar_features", "week_start"])
def test_time_zone_does_not_matter(spark, conf, name):
    want = values(QUERIES[name](spark, SF))
    conf("spark.sql.session.timeZone", "America/New_York")
    assert values(QUERIES[name](spark, SF)) == want


@pytest.mark.parametrize(
    "name",
    ["valid_rows", "parse_time", "duration_seconds", "coerce_types", "class_weight", "binary_metrics",
     "contract_check", "label_cast", "csv_permissive_scan", "ratio_features", "terminal_risk"],
)
def test_ansi_mode_does_not_matter(spark, conf, name):
    conf("spark.sql.ansi.enabled", "true")
    want = values(QUERIES[name](spark, SF))
    conf("spark.sql.ansi.enabled", "false")
    assert values(QUERIES[name](spark, SF)) == want


def test_two_batches_equal_one(spark, tmp_path):
    """The overlap covers the longest look-back, so batch borders leave no trace."""
    month = tx(spark, SF)
    parts = [
        month.selectExpr(
            f"transaction_id * 3 + {k} as transaction_id", "customer_id", "terminal_id", "tx_amount",
            "tx_fraud = 1 as tx_fraud", f"unix_time + {k} * 2592000 as unix_time",
        )
        for k in range(3)
    ]
    base = parts[0].unionByName(parts[1]).unionByName(parts[2])
    base.write.parquet(f"{tmp_path}/clean")
    lo, hi = base.selectExpr("min(unix_time)", "max(unix_time)").first()
    end = hi - 5 * DAY

    whole = feature_job(
        spark, f"{tmp_path}/clean", f"{tmp_path}/whole", f"{tmp_path}/s1",
        FeatureJobConfig(batch=40 * DAY, first_batch=40 * DAY),
    )
    base.where(f"unix_time <= {end}").write.parquet(f"{tmp_path}/early")
    cfg = FeatureJobConfig(batch=30 * DAY, first_batch=30 * DAY)
    first = feature_job(spark, f"{tmp_path}/early", f"{tmp_path}/parts", f"{tmp_path}/s2", cfg)
    second = feature_job(spark, f"{tmp_path}/clean", f"{tmp_path}/parts", f"{tmp_path}/s2", cfg)
    assert second["good_time"] == first["end_time"] and second["end_time"] == whole["end_time"] == hi
    from_ = max(whole["good_time"], first["good_time"])
    one, two = (
        spark.read.parquet(f"{tmp_path}/{o}").where(f"unix_time >= {from_}").drop("batch") for o in ("whole", "parts")
    )
    assert one.count() > 500
    assert values(one, 5) == values(two, 5)


def test_duration_and_label(spark):
    rows = [("1 minute", 60), ("2 hours", 7200), ("10s", 10), ("3 fortnights", 0), ("soon", None), (" 2 DAYS ", 172800)]
    df = spark.createDataFrame(rows, "t string, want int")
    assert df.where(~duration_seconds("t").eqNullSafe(df.want)).count() == 0
    assert [r[0] for r in spark.createDataFrame([(1,), (0,)], "p int").select(label_text("p")).collect()] == ["fraud", "normal"]
