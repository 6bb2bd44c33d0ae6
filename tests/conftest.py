import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom import schemas  # noqa: E402
from tallyloom.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TALLYLOOM_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        # Scans are printed in full in the plan tests.
        "spark.sql.maxMetadataStringLength": "10000",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    session = local_session(8, "tests", **conf)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def new_path(tmp_path):
    return str(tmp_path / "table")


def money(x):
    return None if x is None else Decimal(str(x))


def timestamp(x):
    return dt.datetime.fromisoformat(x) if isinstance(x, str) else x


@pytest.fixture(scope="session")
def make_orders(spark):
    """Rows (customer, order, amount, moment[, status])."""

    def make(*rows):
        data = [
            (c, o, money(a), timestamp(at), status[0] if status else "completed")
            for c, o, a, at, *status in rows
        ]
        return spark.createDataFrame(data, schemas.ORDERS)

    return make


@pytest.fixture(scope="session")
def make_sales(spark):
    """Rows (order, customer, product, amount, status, moment)."""

    def make(*rows):
        data = [(o, c, p, money(a), s, timestamp(at)) for o, c, p, a, s, at in rows]
        return spark.createDataFrame(data, schemas.SALES)

    return make


def rows(df, *columns, order=None):
    """Chosen columns as sorted tuples; nulls last."""
    found = [tuple(r) for r in df.select(*columns).collect()]
    return sorted(found, key=lambda t: [(v is None, v) if v is not None else (True, 0) for v in t])


def same_rows(a, b):
    columns = sorted(a.columns)
    assert columns == sorted(b.columns)
    a, b = a.select(*columns), b.select(*columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def final_plan(df):
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
