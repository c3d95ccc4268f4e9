import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barwright import schemas  # noqa: E402
from barwright.operators import silver  # noqa: E402
from barwright.session import make_session  # noqa: E402

TESTDATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = make_session(
        "barwright-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "100000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TESTDATA


D2, D3 = date(2024, 1, 2), date(2024, 1, 3)
RAW_ROWS = [
    ("PETR4.SA", D2, 28.5, 29.2, 28.0, 29.0, 29.0, 12_000_000),
    ("PETR4.SA", D3, 29.0, 29.8, 28.5, 29.5, 29.5, 13_500_000),
    ("VALE3.SA", D2, 65.1, 66.5, 64.8, 66.0, 66.0, 8_000_000),
    ("VALE3.SA", D3, 66.0, 67.2, 65.5, 67.0, 67.0, 9_200_000),
    ("ITUB4.SA", D2, 32.1, 33.0, 31.9, 32.5, 32.5, 5_500_000),
]


@pytest.fixture
def make_raw(spark):
    return lambda rows: spark.createDataFrame(rows, schemas.RAW_SCHEMA)


@pytest.fixture
def raw_df(make_raw):
    return make_raw(RAW_ROWS)


@pytest.fixture
def raw_df_with_nulls(make_raw):
    return make_raw([r[:5] + (None,) + r[6:] if r[1] == D3 else r for r in RAW_ROWS])


@pytest.fixture
def raw_df_with_duplicates(make_raw):
    return make_raw(RAW_ROWS + RAW_ROWS[:1])


@pytest.fixture
def silver_df(raw_df):
    return silver.transform_silver(raw_df, datetime(2024, 1, 4, 12))


@pytest.fixture
def make_series(spark):
    """Silver-like rows from {ticker: [(date, close, volume, daily_return), ...]}."""

    def build(series):
        rows = [
            (t, d, c, c, c, c, c, v, r) for t, points in series.items() for d, c, v, r in points
        ]
        return spark.createDataFrame(
            rows,
            "ticker string, trade_date date, open_price double, high_price double, "
            "low_price double, close_price double, adj_close double, volume bigint, "
            "daily_return double",
        )

    return build


def by_key(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
