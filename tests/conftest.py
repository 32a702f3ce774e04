import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from skyfare.schemas import RAW_QUOTES  # noqa: E402
from skyfare.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    import tempfile
    s = build_session("local[4]", 4, app_name="skyfare-tests",
                      extra={"spark.driver.memory": "4g",
                             "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="skyfare-wh-"),
                             "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024)})
    yield s
    s.stop()


def ts(s):
    return dt.datetime.fromisoformat(s)


def d(s):
    return dt.date.fromisoformat(s)


def quote(origin="MEL", dest="BKK", dep="2024-06-01", qts="2024-01-01 10:00:00", price="100.00",
          stops=0, airline="JQ", source="feed", cabin=None):
    return (origin, dest, d(dep) if dep else None, ts(qts) if qts else None,
            Decimal(price) if price is not None else None, stops, airline, source, cabin)


@pytest.fixture
def raw_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, RAW_QUOTES)
    return make


def collect_sorted(df, cols=None):
    cols = cols or df.columns
    return sorted([tuple(r[c] for c in cols) for r in df.collect()],
                  key=lambda t: tuple((x is None, str(x)) for x in t))
