import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallywire.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


SF = "/root/testdata/sf0.001"


def values(df, digits=6):
    """Rows as a sorted list, columns in name order, doubles rounded."""

    def clean(v):
        # off the exact halves that averages of cents run into
        return round(v + 1.7e-8, digits) + 0.0 if isinstance(v, float) else v

    cols = sorted(df.columns)
    return sorted((tuple(clean(r[c]) for c in cols) for r in df.collect()), key=repr)
