import math
import statistics
from datetime import date, timedelta

import pytest
from conftest import by_key

from barwright.operators import gold, silver
from barwright.schemas import DAILY_METRICS_SCHEMA, MONTHLY_RETURNS_SCHEMA, PORTFOLIO_SUMMARY_SCHEMA


def test_daily_metrics_columns_and_rows(silver_df):
    daily = gold.daily_metrics(silver_df)
    assert daily.columns == DAILY_METRICS_SCHEMA.fieldNames()
    assert daily.count() == silver_df.count()
    first = [r for r in daily.collect() if r.daily_return is None]
    assert len(first) == 3 and all(r.cum_return == 0 for r in first)


@pytest.fixture
def long_series(make_series):
    """25 rows of one ticker with uneven steps, and what each frame should hold."""
    closes = [100 + 7 * math.sin(i) + i for i in range(25)]
    returns = [None] + [b / a - 1 for a, b in zip(closes, closes[1:])]
    volumes = [1000 + (i * 37) % 11 * 100 for i in range(25)]
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(25)]
    return make_series({"A": list(zip(days, closes, volumes, returns))}), days, closes, volumes, returns


def test_rolling_frames_edges(long_series):
    df, days, closes, volumes, returns = long_series
    rows = by_key(gold.daily_metrics(df), "trade_date")
    for i in (0, 1, 2, 18, 19, 20, 24):
        frame = slice(max(0, i - 19), i + 1)
        row = rows[days[i]]
        assert row.avg_volume_20d == pytest.approx(statistics.mean(volumes[frame]))
        known = [r for r in returns[frame] if r is not None]
        if len(known) < 2:
            assert row.volatility_20d is None
        else:
            assert row.volatility_20d == pytest.approx(statistics.stdev(known) * math.sqrt(252))


def test_cum_return_is_close_over_first_close(long_series):
    df, days, closes, *_ = long_series
    rows = by_key(gold.daily_metrics(df), "trade_date")
    for day, close in zip(days, closes):
        assert rows[day].cum_return == pytest.approx(close / closes[0] - 1, rel=1e-12, abs=1e-12)


def test_missing_return_counts_as_no_change(make_series):
    days = [date(2024, 1, d) for d in (1, 2, 3)]
    df = make_series({"A": [(days[0], 1.0, 1, 0.1), (days[1], 1.0, 1, None), (days[2], 1.0, 1, 0.1)]})
    rows = by_key(gold.add_cum_return(df), "trade_date")
    assert [rows[d].cum_return for d in days] == pytest.approx([0.1, 0.1, 0.21])


def test_portfolio_summary(long_series):
    df, days, closes, volumes, _ = long_series
    daily = gold.daily_metrics(df)
    (row,) = gold.portfolio_summary(daily).collect()
    assert gold.portfolio_summary(daily).columns == PORTFOLIO_SUMMARY_SCHEMA.fieldNames()
    assert (row.first_date, row.last_date) == (days[0], days[-1])
    assert row.total_return == pytest.approx(closes[-1] / closes[0] - 1)
    assert row.avg_daily_volume == pytest.approx(statistics.mean(volumes))
    assert (row.period_high, row.period_low) == (max(closes), min(closes))
    known = [r.volatility_20d for r in daily.collect() if r.volatility_20d is not None]
    assert row.avg_volatility == pytest.approx(statistics.mean(known))


def test_total_return_does_not_depend_on_row_order(spark, long_series):
    df, _, closes, *_ = long_series
    shuffled = gold.daily_metrics(df).repartition(4).orderBy("volume")
    assert gold.portfolio_summary(shuffled).first().total_return == pytest.approx(
        closes[-1] / closes[0] - 1
    )


def test_summary_order_puts_best_first_then_ticker(make_series):
    d = date(2024, 1, 1)
    df = make_series({"B": [(d, 1.0, 1, 0.1)], "A": [(d, 1.0, 1, 0.1)], "C": [(d, 1.0, 1, 0.5)]})
    ordered = gold.by_total_return(gold.portfolio_summary(gold.daily_metrics(df)))
    assert [r.ticker for r in ordered.collect()] == ["C", "A", "B"]


def test_monthly_returns(make_series):
    df = make_series(
        {
            "A": [
                (date(2023, 12, 29), 10.0, 1, None),
                (date(2024, 1, 2), 11.0, 2, 0.1),
                (date(2024, 1, 31), 12.0, 3, None),
            ]
        }
    )
    monthly = gold.monthly_returns(df)
    assert monthly.columns == MONTHLY_RETURNS_SCHEMA.fieldNames()
    rows = by_key(monthly, "year", "month")
    december, january = rows[2023, 12], rows[2024, 1]
    assert (december.month_open, december.month_close, december.month_return) == (10.0, 10.0, 0.0)
    assert december.avg_daily_return is None
    assert (january.month_open, january.month_close) == (11.0, 12.0)
    assert january.month_return == pytest.approx(12 / 11 - 1)
    assert january.month_volume == 5 and january.avg_daily_return == pytest.approx(0.1)


def test_monthly_volumes_add_up_to_daily(spark, sf_dir):
    from pyspark.sql import functions as F

    from barwright.registry.base import silver_brand

    clean = silver_brand(spark, sf_dir)
    daily_total = clean.agg(F.sum("volume")).first()[0]
    monthly_total = gold.monthly_returns(clean).agg(F.sum("month_volume")).first()[0]
    assert daily_total == monthly_total


def test_max_drawdown(make_series):
    days = [date(2024, 1, d) for d in range(1, 6)]
    cums = [0.0, 0.5, 0.2, 0.8, -0.1]
    returns = [None] + [(1 + b) / (1 + a) - 1 for a, b in zip(cums, cums[1:])]
    df = make_series({"A": [(d, 1.0, 1, r) for d, r in zip(days, returns)], "B": [(days[0], 1.0, 1, None)]})
    rows = by_key(gold.max_drawdown(gold.daily_metrics(df)), "ticker")
    assert rows["A"].max_drawdown == pytest.approx(0.9 / 1.8 - 1)
    assert rows["B"].max_drawdown == 0


def test_sector_performance(spark, make_series):
    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    df = make_series({t: [(d1, 1.0, 1, None), (d2, 1.0, 1, r)] for t, r in (("A", 0.1), ("B", 0.3), ("C", 0.0))})
    sectors = spark.createDataFrame([("A", "s1"), ("B", "s1"), ("C", "s2")], "ticker string, sector string")
    rows = by_key(gold.sector_performance(gold.portfolio_summary(gold.daily_metrics(df)), sectors), "sector")
    assert rows["s1"].n_tickers == 2 and rows["s1"].avg_total_return == pytest.approx(0.2)
    assert rows["s1"].best_ticker == "B" and rows["s2"].worst_return == pytest.approx(0.0)


def test_zero_close_gives_null_not_an_error(make_series, spark):
    from barwright.operators.silver import add_daily_return

    df = make_series({"A": [(date(2024, 1, 1), 0.0, 1, None), (date(2024, 1, 2), 1.0, 1, None)]})
    assert all(r.daily_return is None for r in add_daily_return(df).collect())
    assert gold.monthly_returns(df).first().month_return is None
