import math
import statistics
from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest
from conftest import by_key
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barwright.operators import analytics, gold, profile, report
from barwright.operators.correlation import correlation_matrix

START = date(2024, 1, 1)


def days(n):
    return [START + timedelta(days=i) for i in range(n)]


def test_volume_spike_is_flagged(make_series):
    volumes = [100 + i % 2 for i in range(29)] + [5000]
    df = make_series({"A": [(d, 1.0, v, None) for d, v in zip(days(30), volumes)]})
    (row,) = analytics.volume_anomalies(df).collect()
    frame = volumes[10:30]
    expected = (5000 - statistics.mean(frame)) / statistics.stdev(frame)
    assert row.trade_date == days(30)[-1] and row.vol_zscore == pytest.approx(expected)


def test_constant_volume_has_no_score_and_no_flag(make_series):
    df = make_series({"A": [(d, 1.0, 100, None) for d in days(30)]})
    assert {r.vol_zscore for r in analytics.volume_zscores(df).collect()} == {None}
    assert analytics.volume_anomalies(df).count() == 0


def test_zscore_needs_five_values(make_series):
    df = make_series({"A": [(d, 1.0, i * i, None) for i, d in enumerate(days(6))]})
    rows = by_key(analytics.volume_zscores(df), "trade_date")
    assert [rows[d].vol_zscore is None for d in days(6)] == [True] * 4 + [False] * 2


def test_bollinger_bands(make_series):
    closes = [10 + math.sin(i) for i in range(25)]
    df = make_series({t: [(d, c, 1, None) for d, c in zip(days(25), closes)] for t in "AB"})
    bands = analytics.bollinger_bands(df, "A")
    rows = by_key(bands, "trade_date")
    assert {r.ticker for r in bands.collect()} == {"A"} and len(rows) == 25
    assert rows[days(1)[0]].std_20 is None and rows[days(1)[0]].upper_band is None
    frame = closes[5:25]
    last = rows[days(25)[-1]]
    assert last.sma_20 == pytest.approx(statistics.mean(frame))
    assert last.upper_band == pytest.approx(statistics.mean(frame) + 2 * statistics.stdev(frame))
    assert analytics.bollinger_bands(df).count() == 50


def test_backtest_is_exact_across_year_ends(make_series):
    dates = [date(2021, 12, 30) + timedelta(days=45 * i) for i in range(20)]
    a = [None] + [0.01 * (-1) ** i * i for i in range(1, 20)]
    b = [None] + [0.02] * 10 + [None] * 9
    df = make_series({"A": [(d, 1.0, 1, r) for d, r in zip(dates, a)], "B": [(d, 1.0, 1, r) for d, r in zip(dates, b)]})
    rows = by_key(analytics.equal_weight_backtest(df), "trade_date")
    value = 1.0
    for d, x, y in zip(dates, a, b):
        known = [r for r in (x, y) if r is not None]
        value *= 1 + (statistics.mean(known) if known else 0)
        assert rows[d].portfolio_cum_return == pytest.approx(value - 1)


def _pandas_corr(frame):
    wide = frame.pivot(index="day", columns="ticker", values="r").astype(float)
    return wide.corr(min_periods=2), wide.notna().astype(int)


@pytest.mark.parametrize("tile, block", [(256, 2048), (2, 3), (1, 1000)])
def test_correlation_equals_pandas_for_any_tiling(spark, tile, block):
    rng = np.random.default_rng(5)
    rows = [
        (f"T{t}", START + timedelta(days=int(d)), float(rng.normal(1e-3 * t, 0.02)))
        for t in range(7)
        for d in range(40)
        if rng.random() > 0.2
    ]
    df = spark.createDataFrame(rows, "ticker string, trade_date date, daily_return double")
    expected, present = _pandas_corr(pd.DataFrame(rows, columns=["ticker", "day", "r"]))
    common = present.T @ present
    got = by_key(correlation_matrix(df, tile=tile, block_days=block), "ticker_a", "ticker_b")
    assert len(got) == 49
    for (a, b), row in got.items():
        assert row.correlation == pytest.approx(expected.loc[a, b], abs=1e-9)
        assert row.n_days == common.loc[a, b]
        assert row.correlation == got[b, a].correlation


def test_correlation_of_constant_or_single_pair_is_null(make_series):
    d = days(4)
    df = make_series(
        {
            "A": [(x, 1.0, 1, r) for x, r in zip(d, [0.1, 0.2, 0.15, 0.3])],
            "FLAT": [(x, 1.0, 1, 0.1) for x in d],
            "ONCE": [(d[0], 1.0, 1, 0.4)],
            # varies overall, but not on the days it shares with HALF
            "HALF": [(x, 1.0, 1, r) for x, r in zip(d[:2], [0.1, 0.3])],
            "PART": [(x, 1.0, 1, r) for x, r in zip(d, [0.07, 0.07, 0.2, 0.9])],
        }
    )
    got = by_key(correlation_matrix(df), "ticker_a", "ticker_b")
    assert got["A", "A"].correlation == pytest.approx(1.0)
    for a, b in [("A", "FLAT"), ("FLAT", "FLAT"), ("A", "ONCE"), ("ONCE", "ONCE"), ("HALF", "PART")]:
        assert got[a, b].correlation is None, (a, b)
    assert got["A", "HALF"].correlation == pytest.approx(1.0)


def test_correlation_averages_repeated_dates(make_series):
    d = days(3)
    once = make_series({"A": list(zip(d, [1.0] * 3, [1] * 3, [0.1, 0.2, 0.4])), "B": list(zip(d, [1.0] * 3, [1] * 3, [0.3, 0.1, 0.2]))})
    twice = once.unionByName(once)
    assert sorted(map(tuple, correlation_matrix(once).collect())) == sorted(map(tuple, correlation_matrix(twice).collect()))


def test_top_cumulative_keeps_whole_series(make_series):
    df = gold.daily_metrics(
        make_series({f"T{i}": [(d, 1.0, 1, 0.01 * i) for d in days(3)] for i in range(7)})
    )
    top = analytics.top_cumulative(df, 5)
    assert {r.ticker for r in top.collect()} == {"T2", "T3", "T4", "T5", "T6"} and top.count() == 15


def test_ticker_stats(make_series):
    df = gold.daily_metrics(make_series({"A": [(d, c, 1, None) for d, c in zip(days(3), (1.0, 2.0, 4.0))]}))
    row = analytics.ticker_stats(df).first()
    assert (row.trading_days, row.avg_close, row.avg_vol_pct, row.max_cum_return_pct) == (3, 2.33, None, 0.0)


def test_returns_wide_has_sorted_fixed_columns(make_series):
    df = make_series({"B": [(days(1)[0], 1.0, 1, 0.1)], "A": [(days(1)[0], 1.0, 1, 0.2)]})
    wide = analytics.returns_wide(df, ["B", "A", "MISSING"])
    assert wide.columns == ["trade_date", "A", "B", "MISSING"]
    assert tuple(wide.first())[1:] == (0.2, 0.1, None)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-0.5, 0.5, allow_nan=False), min_size=1, max_size=40))
def test_histogram_counts_every_return_once(spark, values):
    df = spark.createDataFrame([("A", v) for v in values], "ticker string, daily_return double")
    rows = analytics.return_histogram(df, bins=6).collect()
    assert sum(r.n for r in rows) == len(values)
    assert all(1 <= r.bin <= 6 for r in rows)


def test_histogram_with_a_given_range(spark):
    df = spark.createDataFrame(
        [("A", v) for v in (-0.9, -0.1, 0.0, 0.05, 0.1, 0.7, None)], "ticker string, daily_return double"
    )
    rows = {r.bin: r.n for r in analytics.return_histogram(df, bins=2, low=-0.1, high=0.1).collect()}
    assert rows == {0: 1, 1: 1, 2: 3, 3: 1}


def test_coverage_counts_days_as_bits(spark):
    """Days before and after 1970, ends of the calendar, copies, and tickers without a date."""
    days = [date(1969, 12, 31), date(1969, 12, 31), date(1970, 1, 1), date(1970, 3, 5), date(1970, 3, 6)]
    rows = [("A", d) for d in days] + [("A", None), ("B", None), ("C", date(1, 1, 1)), ("C", date(9999, 12, 31))]
    df = profile.ticker_coverage(spark.createDataFrame(rows, "ticker string, trade_date date"))
    found = {r["ticker"]: tuple(r)[1:] for r in df.collect()}
    assert found == {
        "A": (date(1969, 12, 31), date(1970, 3, 6), 4), "B": (None, None, 0), "C": (date(1, 1, 1), date(9999, 12, 31), 2)
    }
    # no map task or reduce task holds a ticker's single days
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert all("trade_date" not in line.split("keys=[")[1].split("]")[0] for line in plan.splitlines() if "keys=[" in line)


def test_profile(raw_df, raw_df_with_nulls):
    coverage = by_key(profile.ticker_coverage(raw_df.unionByName(raw_df)), "ticker")
    assert coverage["PETR4.SA"].trading_days == 2 and coverage["ITUB4.SA"].trading_days == 1
    nulls = profile.null_counts(raw_df_with_nulls).first()
    assert nulls.close == 2 and nulls.open == 0
    stats = by_key(profile.describe(raw_df_with_nulls), "column")
    assert list(stats) == ["open", "high", "low", "close", "adj_close", "volume"]
    close = stats["close"]
    assert (close["count"], close["null_count"], close["min"], close["max"]) == (3, 2, 29.0, 66.0)
    assert close["mean"] == pytest.approx((29 + 66 + 32.5) / 3) and close["q50"] == 32.5


def monthly(spark, rows):
    return spark.createDataFrame(rows, "ticker string, year int, month int, month_return double")


def test_heatmap_filters_or_falls_back(spark):
    df = monthly(spark, [("PETR4.SA", 2024, 1, 0.1), ("PETR4.SA", 2024, 1, 0.3), ("XXXX3.SA", 2023, 12, 0.2)])
    shown = by_key(report.monthly_heatmap(df), "ticker", "ym")
    assert list(shown) == [("PETR4", "2024-01")]
    assert shown["PETR4", "2024-01"].return_pct == pytest.approx(20.0)
    others = df.where(F.col("ticker") == "XXXX3.SA")
    assert [tuple(r)[:2] for r in report.monthly_heatmap(others).collect()] == [("XXXX3", "2023-12")]


def test_heatmap_wide_is_in_calendar_order(spark):
    df = monthly(spark, [("A", 2024, 2, 0.1), ("A", 2023, 12, 0.2)])
    months = report.month_labels_between(date(2023, 12, 5), date(2024, 2, 1))
    wide = report.heatmap_wide(report.monthly_heatmap(df), months)
    assert wide.columns == ["ticker", "2023-12", "2024-01", "2024-02"]
    assert tuple(wide.first()) == ("A", pytest.approx(20.0), None, pytest.approx(10.0))


def test_summary_table_labels(spark):
    summary = spark.createDataFrame(
        [
            ("PETR4.SA", date(2024, 1, 2), date(2024, 1, 22), 0.045, 12_000_000.0, 0.28, 31.5),
            ("NULL3.SA", None, None, None, None, None, None),
            ("LOSS3.SA", date(2024, 1, 2), date(2024, 1, 22), -0.1, 1_260_000.0, 0.1, 7.0),
        ],
        "ticker string, first_date date, last_date date, total_return double, "
        "avg_daily_volume double, avg_volatility double, period_high double",
    )
    rows = [tuple(r) for r in report.report_summary_table(summary).collect()]
    assert rows == [
        ("PETR4", "02/01/24", "22/01/24", "4.50%", "12.0M", "28.0%", "R$31.50", True),
        ("LOSS3", "02/01/24", "22/01/24", "-10.00%", "1.3M", "10.0%", "R$7.00", False),
        ("NULL3", "-", "-", "0.00%", "0.0M", "0.0%", "R$0.00", True),
    ]
    assert report.report_summary_table(summary, 1).count() == 1


def test_risk_return_and_volatility_series(spark):
    summary = spark.createDataFrame(
        [("A.SA", 0.1, 0.2), ("B.SA", None, 0.2), ("C.SA", 0.1, None)],
        "ticker string, total_return double, avg_volatility double",
    )
    assert [tuple(r) for r in report.risk_return(summary).collect()] == [("A", 20.0, 10.0)]
    daily = spark.createDataFrame(
        [("A.SA", START, None), ("A.SA", days(2)[1], 0.3), ("B.SA", START, 0.1)],
        "ticker string, trade_date date, volatility_20d double",
    )
    rows = by_key(report.volatility_series(daily, ["A.SA"]), "trade_date")
    assert [rows[d].volatility_pct for d in days(2)] == [0.0, 30.0]
