"""Queries against their SQL twins; `python check.py` runs all of them at any scale."""

import pytest
from check import connect, differences
from conftest import SF

from tallywire.queries import ORACLES, QUERIES

# train models, or repeat a plan that test_windows, test_features or another query covers
SLOW = {
    "job_train_ab", "search_trials", "cv_scores", "gbt_predict", "confusion_confident", "evaluate_train_test",
    "batch_score", "feature_row_hot", "ttest_effect", "ship_decision", "rolling_count", "rolling_sum",
}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in SLOW])
def test_query(spark, con, name):
    assert differences(spark, con, name, SF) == ""


def test_most_queries_have_sql():
    assert len(ORACLES) / len(QUERIES) > 0.85
