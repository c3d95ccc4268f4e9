"""The report's sections, as written by the report job and read back; long series; gold built piecemeal."""

from datetime import date, datetime

from pyspark.sql import functions as F

from barwright.operators import analytics, gold
from barwright.plans import medallion
from barwright.registry.base import (
    DAILY_VALUES,
    MONTHLY_VALUES,
    PROCESS_TIME,
    SUMMARY_VALUES,
    oracle,
    query,
    r6,
    silver_brand,
    silver_events,
    silver_part,
)
from barwright.session import new_folder, staged
from barwright.sources import bars, layers

_TIME = datetime(2024, 1, 22, 18, 30)
#: The events' series by name; the first ones stand for the report's chosen tickers.
_EVENTS = "SELECT DISTINCT upper(ticker) AS ticker FROM bars ORDER BY 1"


def _section(name):
    """A section of the report on the events' series, after its three tables were stored."""

    def read(spark, folder):
        root = new_folder(spark, "lake")
        stored = staged(silver_events(spark, folder), "silver")
        for table, rows in medallion.gold_tables(stored).items():
            layers.write_gold(rows, root, table)
        tickers = [r["ticker"] for r in stored.select("ticker").distinct().orderBy("ticker").limit(2).collect()]
        section = spark.read.parquet(f"{medallion.build_report(spark, root, _TIME, tickers)}/{name}")
        if name == "portfolio_backtest":  # these series multiply to numbers of more digits than six places leave
            return section.select("trade_date", F.log(F.col("return_pct") / 100 + 1).alias("log_growth"))
        return section

    return read


_CHOSEN = "upper(ticker) IN (SELECT upper(ticker) FROM bars GROUP BY 1 ORDER BY 1 LIMIT 2)"
_SECTIONS = {
    "cumulative_return": f"""
, tops AS (SELECT ticker FROM summary ORDER BY total_return DESC NULLS LAST, upper(ticker) LIMIT 5)
SELECT upper(ticker) AS ticker, trade_date, {r6("cum_return * 100 AS return_pct")} FROM daily WHERE ticker IN (SELECT ticker FROM tops)""",
    "volatility": f"""
SELECT upper(ticker) AS ticker, trade_date, {r6("coalesce(volatility_20d * 100, 0) AS volatility_pct")} FROM daily WHERE {_CHOSEN}""",
    "risk_return": f"""
SELECT upper(ticker) AS ticker, {r6("avg_volatility * 100 AS volatility_pct", "total_return * 100 AS return_pct")}
FROM summary WHERE total_return IS NOT NULL AND avg_volatility IS NOT NULL""",
    "monthly_heatmap": f"""
SELECT upper(ticker) AS ticker, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS ym, {r6("month_return * 100 AS return_pct")}
FROM monthly WHERE {_CHOSEN}""",
    "correlation": f"""
, pairs AS (
  SELECT upper(a.ticker) AS ticker_a, upper(b.ticker) AS ticker_b, count(*) AS n_days,
         corr(a.daily_return, b.daily_return) AS r
  FROM daily AS a JOIN daily AS b USING (trade_date)
  WHERE a.daily_return IS NOT NULL AND b.daily_return IS NOT NULL GROUP BY 1, 2)
SELECT ticker_a, ticker_b, n_days, {r6("CASE WHEN NOT isnan(r) THEN r END AS correlation")} FROM pairs""",
    "bollinger_bands": f"""
, bands AS (
  SELECT upper(ticker) AS ticker, trade_date, close_price, avg(close_price) OVER w AS sma_20, stddev_samp(close_price) OVER w AS std_20
  FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT ticker, trade_date, close_price,
       {r6("sma_20", "std_20", "sma_20 + 2 * std_20 AS upper_band", "sma_20 - 2 * std_20 AS lower_band")}
FROM bands WHERE ticker = (SELECT min(upper(ticker)) FROM bars)""",
    "portfolio_backtest": f"""
, mean AS (SELECT trade_date, avg(daily_return) AS r FROM daily GROUP BY trade_date)
SELECT trade_date, {r6("ln(product(1 + coalesce(r, 0)) OVER (ORDER BY trade_date)) AS log_growth")} FROM mean""",
}

for _name, _sql in _SECTIONS.items():
    query(f"report_section_{_name}", oracle(_sql, "events"))(_section(_name))


_BANDS = f"""
, bands AS (
  SELECT ticker, trade_date, close_price, avg(close_price) OVER w AS sma_20, stddev_samp(close_price) OVER w AS std_20
  FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT upper(ticker) AS ticker, trade_date, close_price,
       {r6("sma_20", "std_20", "sma_20 + 2 * std_20 AS upper_band", "sma_20 - 2 * std_20 AS lower_band")} FROM bands"""


@query("bollinger_one_ticker", oracle(f"{_BANDS} WHERE ticker = 'Brand#11'"))
def _(spark, folder):
    return analytics.bollinger_bands(silver_brand(spark, folder), "BRAND#11")


@query("bollinger_by_block", oracle(_BANDS))
def _(spark, folder):
    return analytics.bollinger_bands_by_block(staged(silver_brand(spark, folder), "silver"), 100)


@query(
    "volume_zscores_by_block",
    oracle(
        f"""
, z AS (
  SELECT ticker, trade_date, volume,
         CASE WHEN count(volume) OVER w >= 5 THEN avg(volume) OVER w END AS vol_mean,
         CASE WHEN count(volume) OVER w >= 5 THEN stddev_samp(volume) OVER w END AS vol_std
  FROM daily WINDOW w AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT upper(ticker) AS ticker, trade_date, volume,
       {r6("vol_mean", "vol_std", "(volume - vol_mean) / nullif(vol_std, 0) AS vol_zscore")} FROM z"""
    ),
)
def _(spark, folder):
    return analytics.volume_zscores_by_block(staged(silver_brand(spark, folder), "silver"), 100)


_DAILY = f"SELECT upper(ticker) AS ticker, trade_date, {DAILY_VALUES} FROM daily"


@query("daily_metrics_by_block", oracle(_DAILY))
def _(spark, folder):
    return gold.daily_metrics_by_block(staged(silver_brand(spark, folder), "silver"), 100).drop("processed_at")


@query("daily_metrics_by_block_part", oracle(_DAILY, "part"))
def _(spark, folder):
    """Short, sparse series: most blocks have fewer rows than a window."""
    return gold.daily_metrics_by_block(staged(silver_part(spark, folder), "silver"), 60).drop("processed_at")


def _gold_piecemeal(spark, folder):
    """Silver and gold for the first dates, then for the last ones, then for a date in between that was late."""
    root = new_folder(spark, "lake")
    raw = bars.bars_from_events(spark, folder, by="user_id")
    late, middle, end = date(2024, 1, 15), date(2024, 1, 20), date(2100, 1, 1)
    on_time = raw.where(F.col("trade_date") != F.lit(late))
    steps = [(on_time, date(1900, 1, 1), middle), (on_time, middle, end), (raw, late, date(2024, 1, 16))]
    for rows, start, stop in steps:
        medallion.load_bronze(rows, root, "events", start=start, end=stop)
        since = None if start.year == 1900 else start
        medallion.build_silver(spark, root, since=since, processed_at=PROCESS_TIME)
        medallion.extend_gold(spark, root, start)
    return root


_PIECEMEAL = {
    "daily_metrics": _DAILY,
    "monthly_returns": f"SELECT upper(ticker) AS ticker, {MONTHLY_VALUES} FROM monthly",
    "portfolio_summary": f"SELECT upper(ticker) AS ticker, {SUMMARY_VALUES} FROM summary",
}


def _table_piecemeal(name):
    return lambda spark, folder: layers.read_gold(spark, _gold_piecemeal(spark, folder), name).drop("processed_at")


for _name, _sql in _PIECEMEAL.items():
    query(f"extend_gold_{_name}", oracle(_sql, "users"))(_table_piecemeal(_name))


_FOLDED = """
, r AS (SELECT upper(ticker) AS ticker, daily_return AS x FROM daily WHERE daily_return IS NOT NULL),
wide AS (
  SELECT min(pow(2.0, e)) AS w FROM generate_series(-10, 60) AS g(e), (SELECT min(x) AS a, max(x) AS b FROM r) AS m
  WHERE floor(b / pow(2.0, e)) - floor(a / pow(2.0, e)) + 1 <= 60)
SELECT ticker, floor(x / w) * w AS low, w AS width, count(*) AS n FROM r, wide GROUP BY 1, 2, 3"""


@query("return_histogram_folded", oracle(_FOLDED))
def _(spark, folder):
    return analytics.folded_histogram(staged(analytics.histogram_cells(silver_brand(spark, folder)), "cells"))


@query("return_histogram_merged", oracle(_FOLDED, "part"))
def _(spark, folder):
    """Cells counted for two parts of the dates and merged."""
    silver = staged(silver_part(spark, folder), "silver")
    early = F.col("trade_date") < F.lit("1997-01-01").cast("date")
    parts = [staged(analytics.histogram_cells(silver.where(side)), "cells") for side in (early, ~early)]
    return analytics.folded_histogram(staged(analytics.merged_cells(*parts), "cells"))
