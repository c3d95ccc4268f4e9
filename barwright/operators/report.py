"""The datasets behind the report's sections."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright import fixed
from barwright.functions.scalars import (
    all_present,
    as_percent,
    date_label,
    member_of,
    month_label,
    number_label,
    ticker_label,
)
from barwright.operators.analytics import bollinger_bands, equal_weight_backtest, mean_per_key, top_cumulative
from barwright.operators.correlation import correlation_matrix
from barwright.operators.gold import by_total_return


def report_summary_table(summary: DataFrame, n: int = fixed.SUMMARY_ROWS) -> DataFrame:
    """The ``n`` best tickers as printed: labels instead of numbers."""
    top = by_total_return(summary).limit(n)
    return top.select(
        ticker_label("ticker").alias("ticker"),
        date_label("first_date").alias("first_date"),
        date_label("last_date").alias("last_date"),
        number_label("%.2f%%", as_percent("total_return")).alias("total_return"),
        number_label("%.1fM", F.col("avg_daily_volume") / 1e6).alias("avg_volume"),
        number_label("%.1f%%", as_percent("avg_volatility")).alias("avg_volatility"),
        number_label("R$%.2f", "period_high").alias("period_high"),
        (F.coalesce("total_return", F.lit(0.0)) >= 0).alias("is_gain"),
    )


def volatility_series(daily: DataFrame, tickers=None) -> DataFrame:
    """Volatility in percent of the chosen tickers (all by default), a missing one shown as 0."""
    df = daily if tickers is None else daily.where(member_of("ticker", tickers))
    return df.select(
        ticker_label("ticker").alias("ticker"),
        "trade_date",
        F.coalesce(as_percent("volatility_20d"), F.lit(0.0)).alias("volatility_pct"),
    )


def risk_return(summary: DataFrame) -> DataFrame:
    return summary.where(all_present("total_return", "avg_volatility")).select(
        ticker_label("ticker").alias("ticker"),
        as_percent("avg_volatility").alias("volatility_pct"),
        as_percent("total_return").alias("return_pct"),
    )


def chosen_or_all(df: DataFrame, tickers) -> DataFrame:
    """Rows of the chosen tickers; of all if there are none of them, or none are named."""
    if tickers is None:
        return df
    chosen = member_of("ticker", tickers)
    return df.where(chosen | ~df.where(chosen).exists())


def monthly_heatmap(monthly: DataFrame, tickers=fixed.FOCUS_TICKERS) -> DataFrame:
    """Month returns in percent as (ticker, ym, return_pct), for the chosen tickers.

    If the table has none of them, all its tickers are shown; an EXISTS subquery decides, inside
    the same query.
    """
    df = chosen_or_all(monthly, tickers)
    cells = mean_per_key(
        df.select("ticker", month_label("year", "month").alias("ym"), "month_return"),
        ["ticker", "ym"],
        "month_return",
    )
    return cells.select(
        ticker_label("ticker").alias("ticker"), "ym", as_percent("month_return").alias("return_pct")
    )


def cumulative_series(daily: DataFrame, n: int = fixed.TOP_SERIES) -> DataFrame:
    """Cumulative return in percent of the ``n`` tickers that end highest."""
    return top_cumulative(daily, n).select(
        ticker_label("ticker").alias("ticker"), "trade_date", as_percent("cum_return").alias("return_pct")
    )


def correlations(daily: DataFrame, tickers=None) -> DataFrame:
    """Correlation of every pair of the given tickers, or of all."""
    chosen = daily if tickers is None else daily.where(member_of("ticker", tickers))
    pairs = correlation_matrix(chosen)
    return pairs.withColumns({c: ticker_label(c) for c in ("ticker_a", "ticker_b")})


def bollinger_series(daily: DataFrame, ticker: str) -> DataFrame:
    """The bands of one ticker; its filter reaches the scan."""
    return bollinger_bands(daily, ticker).withColumn("ticker", ticker_label("ticker"))


def backtest_series(daily: DataFrame) -> DataFrame:
    """Compound return in percent of all tickers at equal weights."""
    return equal_weight_backtest(daily).select("trade_date", as_percent("portfolio_cum_return").alias("return_pct"))


def month_labels_between(first, last) -> list[str]:
    """Every yyyy-MM label from one date's month to another's."""
    n = (last.year - first.year) * 12 + last.month - first.month + 1
    months = (first.year * 12 + first.month - 1 + i for i in range(n))
    return [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in months]


def heatmap_wide(heatmap: DataFrame, months) -> DataFrame:
    """The heatmap as drawn: one row per ticker, one column per month label, in calendar order."""
    return heatmap.groupBy("ticker").pivot("ym", sorted(months)).agg(F.avg("return_pct"))
