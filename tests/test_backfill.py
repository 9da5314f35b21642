"""Batches over all history: planning, the ledger, and runs that were cut short."""

import pytest
from conftest import SF, values

from tallywire.functions import DAY
from tallywire.operators.slices import gaps
from tallywire.plans import jobs
from tallywire.queries.common import EPOCH_2024, tx
from tallywire.sources.state import BatchLedger


@pytest.mark.parametrize(
    "lo, hi, covered, batch, least, want",
    [
        (0, 10, [], 4, 1, [(0, 4), (4, 8), (8, 10)]),
        (0, 10, [], 4, 3, [(0, 4), (4, 8)]),
        (0, 10, [(4, 8)], 4, 1, [(0, 4), (8, 10)]),
        (0, 10, [(3, 5), (4, 7)], 10, 1, [(0, 3), (7, 10)]),
        (5, 10, [(0, 20)], 4, 1, []),
        (0, 10, [(12, 20)], 6, 1, [(0, 6), (6, 10)]),
        (9, 3, [], 4, 1, []),
    ],
)
def test_gaps(lo, hi, covered, batch, least, want):
    assert gaps(lo, hi, covered, batch, least) == want


def test_ledger(spark, tmp_path):
    ledger = BatchLedger(spark, str(tmp_path / "ledger"))
    a, b = ({"start_time": k - 5, "good_time": k, "end_time": k + 10} for k in (10, 20))
    assert ledger.open() == []
    ledger.add([a, b], "planned")
    ledger.add([b], "started")
    assert ledger.open() == [a, b]
    ledger.add([b], "committed")
    assert ledger.open() == [a]
    assert {r["good_time"]: r["status"] for r in ledger.table().collect()} == {10: "planned", 20: "committed"}


def test_backfill_extends_what_the_daily_job_has(spark, tmp_path, monkeypatch):
    """A crash in the middle leaves a batch open; new rows are planned on top; together they equal one batch over everything."""
    rows = tx(spark, SF).selectExpr("transaction_id", "customer_id", "terminal_id", "tx_amount", "tx_fraud = 1 AS tx_fraud", f"{EPOCH_2024} + 3 * (unix_time - {EPOCH_2024}) AS unix_time")
    lo, hi = rows.selectExpr("min(unix_time)", "max(unix_time)").first()
    early = hi - 6 * DAY
    source = f"{tmp_path}/clean"
    rows.where(f"unix_time <= {early}").write.parquet(source)
    cfg = jobs.FeatureJobConfig(batch=12 * DAY)
    real, written = jobs._write_features, []

    def breaks(table, out, bounds, cfg):
        real(table, out, bounds, cfg)
        written.append(bounds["good_time"])
        if len(written) == 2:
            raise RuntimeError("lost")

    monkeypatch.setattr(jobs, "_write_features", breaks)
    with pytest.raises(RuntimeError):
        jobs.backfill_job(spark, source, f"{tmp_path}/out", f"{tmp_path}/ledger", cfg)
    left = BatchLedger(spark, f"{tmp_path}/ledger").open()
    assert written[1] in {b["good_time"] for b in left} and written[0] not in {b["good_time"] for b in left}
    rows.where(f"unix_time > {early}").write.mode("append").parquet(source)
    done = jobs.backfill_job(spark, source, f"{tmp_path}/out", f"{tmp_path}/ledger", cfg)
    assert {b["good_time"] for b in left} < {b["good_time"] for b in done}
    assert jobs.backfill_job(spark, source, f"{tmp_path}/out", f"{tmp_path}/ledger", cfg) == []

    whole = jobs.FeatureJobConfig(batch=200 * DAY)
    jobs.backfill_job(spark, source, f"{tmp_path}/whole", f"{tmp_path}/ledger2", whole)
    a, b = (spark.read.parquet(f"{tmp_path}/{o}").drop("batch") for o in ("out", "whole"))
    assert a.count() > 300 and values(a, 5) == values(b, 5)
