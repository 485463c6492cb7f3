import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowcast.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session("flowcast-tests", "4", **{
        "spark.driver.memory": "6g", "spark.checkpoint.dir": f"file://{shared}",
        "spark.sql.warehouse.dir": f"file://{shared}/warehouse"})
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Build an events table from (timestamp text, type) pairs."""
    def make(pairs):
        rows = [(datetime.fromisoformat(t) if t else None, k) for t, k in pairs]
        return spark.createDataFrame(rows, "ts timestamp_ntz, kind string")
    return make


@pytest.fixture
def series(spark):
    """Build a gap-free hourly series per key from {key: values}."""
    def make(values, start="2024-01-01T00:00:00", kind="bigint"):
        first = datetime.fromisoformat(start)
        cast = int if kind == "bigint" else float
        rows = [(first + timedelta(hours=i), k, cast(v))
                for k, vs in values.items() for i, v in enumerate(vs)]
        return spark.createDataFrame(rows, f"ts_hour timestamp_ntz, kind string, n {kind}")
    return make
