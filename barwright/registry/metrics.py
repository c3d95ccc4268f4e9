"""Gold tables."""

from pyspark.sql import functions as F

from barwright.operators import gold
from barwright.registry.base import (
    DAILY_VALUES,
    MONTHLY_VALUES,
    SUMMARY_VALUES,
    daily_brand,
    daily_events,
    daily_part,
    oracle,
    query,
    r6,
    silver_brand,
    silver_part,
)
from barwright.sources import bars

_DAILY = f"SELECT upper(ticker) AS ticker, trade_date, {DAILY_VALUES} FROM daily"


@query("daily_metrics", oracle(_DAILY))
def _(spark, folder):
    return daily_brand(spark, folder).drop("processed_at")


@query("daily_metrics_part", oracle(_DAILY, "part"))
def _(spark, folder):
    return daily_part(spark, folder).drop("processed_at")


@query("daily_metrics_events", oracle(_DAILY, "events"))
def _(spark, folder):
    return daily_events(spark, folder).drop("processed_at")


@query(
    "cum_return",
    oracle(f"SELECT upper(ticker) AS ticker, trade_date, {r6('cum_return')} FROM daily"),
)
def _(spark, folder):
    return gold.add_cum_return(silver_brand(spark, folder)).select(
        "ticker", "trade_date", "cum_return"
    )


_SUMMARY = f"SELECT upper(ticker) AS ticker, {SUMMARY_VALUES} FROM summary"


@query("portfolio_summary", oracle(_SUMMARY))
def _(spark, folder):
    return gold.by_total_return(gold.portfolio_summary(daily_brand(spark, folder)))


@query("portfolio_summary_part", oracle(_SUMMARY, "part"))
def _(spark, folder):
    return gold.portfolio_summary(daily_part(spark, folder))


_MONTHLY = f"SELECT upper(ticker) AS ticker, {MONTHLY_VALUES} FROM monthly"


@query("monthly_returns", oracle(_MONTHLY))
def _(spark, folder):
    return gold.monthly_returns(silver_brand(spark, folder))


@query("monthly_returns_part", oracle(_MONTHLY, "part"))
def _(spark, folder):
    return gold.monthly_returns(silver_part(spark, folder))


@query(
    "max_drawdown",
    oracle(
        f"""
, falls AS (SELECT ticker, (1 + cum_return) / max(1 + cum_return) OVER (
              PARTITION BY ticker ORDER BY trade_date ROWS UNBOUNDED PRECEDING) - 1 AS fall
            FROM daily)
SELECT upper(ticker) AS ticker, {r6("min(fall) AS max_drawdown")} FROM falls GROUP BY ticker"""
    ),
)
def _(spark, folder):
    return gold.max_drawdown(daily_brand(spark, folder))


@query(
    "sector_performance",
    oracle(
        f"""
SELECT p_type AS sector, count(*) AS n_tickers,
       {r6("avg(total_return) AS avg_total_return", "avg(avg_volatility) AS avg_volatility")},
       arg_max(ticker, {{'r': total_return, 't': ticker}}) AS best_ticker,
       {r6("max(total_return) AS best_return", "min(total_return) AS worst_return")}
FROM summary JOIN part ON ticker = 'P' || p_partkey GROUP BY p_type""",
        "part",
    ),
)
def _(spark, folder):
    sectors = bars.table(spark, folder, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"),
        F.col("p_type").alias("sector"),
    )
    return gold.sector_performance(gold.portfolio_summary(daily_part(spark, folder)), sectors)
