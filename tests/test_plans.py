"""Whole jobs, and that partial runs equal full ones."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from conftest import D2, D3
from pyspark.sql import functions as F

from barwright.operators import incremental, silver
from barwright.operators.quality import QualityError
from barwright.plans import medallion
from barwright.sources import layers

DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(6)]


@pytest.fixture
def bars(make_raw):
    """Two tickers over six days; B is suspended from the second to the fourth."""
    rows = [("A", d, 1.0, 1.0, 1.0, 10.0 + i * i, 10.0, 100 + i) for i, d in enumerate(DAYS)]
    rows += [("B", d, 1.0, 1.0, 1.0, 20.0 + i, 20.0, 50) for i, d in enumerate(DAYS) if i not in (1, 2, 3)]
    return make_raw(rows)


def load(raw, root, **options):
    return medallion.load_bronze(raw, root, start=date(2023, 1, 1), end=date(2025, 1, 1), **options)


def silver_rows(spark, root):
    return sorted(tuple(r) for r in layers.read_silver(spark, root).drop("processed_at").collect())


def test_day_by_day_equals_one_full_run(spark, bars, tmp_path):
    full, daily = str(tmp_path / "full"), str(tmp_path / "daily")
    load(bars, full)
    medallion.build_silver(spark, full)
    for day in DAYS:
        medallion.load_bronze(bars, daily, start=day, end=day + timedelta(days=1))
        medallion.build_silver(spark, daily, trade_date=day)
    assert silver_rows(spark, daily) == silver_rows(spark, full)


def test_a_correction_is_carried_to_the_next_date(spark, bars, tmp_path):
    full, patched = str(tmp_path / "full"), str(tmp_path / "patched")
    fixed_bars = bars.withColumn("close", F.when(F.col("trade_date") == DAYS[2], 99.0).otherwise(F.col("close")))
    load(fixed_bars, full)
    medallion.build_silver(spark, full)
    load(bars, patched)
    medallion.build_silver(spark, patched)
    medallion.load_bronze(fixed_bars, patched, start=DAYS[2], end=DAYS[3])
    medallion.build_silver(spark, patched, since=DAYS[2])
    assert silver_rows(spark, patched) == silver_rows(spark, full)


def test_prior_close_is_found_however_old(spark, bars, tmp_path):
    clean = silver.clean_bars(bars)
    wanted = clean.select("ticker").distinct()
    for lookback in (1, 3, 45):
        rows = incremental.prior_closes(clean, wanted, DAYS[4], lookback).collect()
        assert {(r.ticker, r.trade_date, r.close_price) for r in rows} == {
            ("A", DAYS[3], 19.0),
            ("B", DAYS[0], 20.0),
        }
    assert incremental.prior_closes(clean, wanted, str(DAYS[0])).isEmpty()


def test_failed_gate_writes_nothing(spark, bars, tmp_path):
    root = str(tmp_path)
    load(bars, root)
    with pytest.raises(QualityError, match="future_dates"):
        medallion.build_silver(spark, root, as_of=DAYS[2])
    assert not (tmp_path / "silver").exists()


def test_empty_layers_return_early(spark, raw_df, tmp_path):
    root = str(tmp_path)
    assert load(raw_df.limit(0), root) == (0, 0)
    assert medallion.build_silver(spark, root) == 0
    assert medallion.build_gold(spark, root) == {}
    assert medallion.build_report(spark, root) is None
    assert list(tmp_path.iterdir()) == []


def test_load_takes_the_chosen_tickers(spark, raw_df, tmp_path):
    assert load(raw_df, str(tmp_path), tickers=["PETR4.SA"]) == (2, 3)


def test_all_layers_and_report(spark, raw_df, tmp_path):
    root = str(tmp_path)
    result = medallion.run_all(
        spark, raw_df, root, start=D2, end=D3 + timedelta(days=1), report_time=datetime(2024, 1, 22, 18, 30)
    )
    assert result == {
        "bronze": 5,
        "left_out": 0,
        "silver": 5,
        "daily_metrics": 5,
        "portfolio_summary": 3,
        "monthly_returns": 3,
        "report": f"{root}/reports/report_240122_1830",
    }
    sections = {p.name for p in Path(result["report"]).iterdir()}
    assert sections == {
        "summary_table",
        "risk_return",
        "monthly_heatmap",
        "cumulative_return",
        "volatility",
        "correlation",
        "portfolio_backtest",
        "bollinger_bands",
    }
    bands = spark.read.parquet(f"{result['report']}/bollinger_bands")
    assert {r.ticker for r in bands.collect()} == {"ITUB4"}


def test_sections_without_rows_are_left_out(spark, silver_df):
    tables = medallion.gold_tables(silver_df)
    none = {name: df.limit(0) for name, df in tables.items()}
    sections = medallion.report_sections(
        none["daily_metrics"], tables["portfolio_summary"], none["monthly_returns"]
    )
    assert set(sections) == {"summary_table", "risk_return"}
    assert medallion.report_sections(*none.values()) == {}


def test_no_focus_ticker_no_bollinger_section(spark, silver_df):
    tables = medallion.gold_tables(silver_df)
    sections = medallion.report_sections(*tables.values(), tickers=["NONE3.SA"])
    assert "bollinger_bands" not in sections and "correlation" in sections
