import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace import get_session  # noqa: E402
from millrace.operators.sequence import SLICE_ROWS_CONF, SLICE_ROWS_DEFAULT  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=["plain", "sliced"])
def layout(request, spark):
    """Run a test with ordinary windows and with every key cut into slices of two rows."""
    spark.conf.set(SLICE_ROWS_CONF, "2" if request.param == "sliced" else str(SLICE_ROWS_DEFAULT))
    yield request.param
    spark.conf.set(SLICE_ROWS_CONF, str(SLICE_ROWS_DEFAULT))


@pytest.fixture(scope="session")
def sensors(spark):
    """Nine readings in arrival order (seq), with text times as zone-less timestamps."""
    rows = [
        ("ws_001", 1, 45), ("ws_002", 15, 43), ("ws_003", 20, 42), ("ws_004", 1, 45), ("ws_005", 15, 43),
        ("ws_006", 20, 42), ("ws_001", 6, 12), ("ws_001", 7, 18), ("ws_001", 7, 17),
    ]
    numbered = [(i, name, 1577844000 + s, vc) for i, (name, s, vc) in enumerate(rows)]
    df = spark.createDataFrame(numbered, "seq long, id string, ts long, vc int")
    return df.selectExpr("seq", "id", "ts", "vc", "cast(timestamp_seconds(ts) as timestamp_ntz) as rt")


def rows_of(df, *columns, order=None):
    """Rows as tuples, in the order of a column or sorted."""
    got = [tuple(r) for r in (df.select(*columns, order) if order else df.select(*columns)).collect()]
    if order:
        return [r[:-1] for r in sorted(got, key=lambda r: r[-1])]
    return sorted(got, key=lambda r: tuple((v is None, v) for v in r))
