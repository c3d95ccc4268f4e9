"""Follow-up questions and report datasets."""

from datetime import date

from pyspark.sql import functions as F

from barwright.operators import analytics, gold, profile, report
from barwright.operators.correlation import correlation_matrix
from barwright.session import staged
from barwright.sources import bars
from barwright.registry.base import (
    daily_brand,
    daily_events,
    daily_orders,
    oracle,
    query,
    r6,
    raw_brand,
    raw_part,
    silver_brand,
    silver_part,
)

# what the SQL side expects of the data; the queries take both lists from the tables
BRANDS = [f"BRAND#{i}" for i in range(1, 26)]


@query(
    "sql_ticker_stats",
    oracle(
        """
SELECT upper(ticker) AS ticker, count(*) AS trading_days, round(avg(close_price), 2) AS avg_close,
       round(avg(volatility_20d) * 100, 2) AS avg_vol_pct,
       round(max(cum_return) * 100, 2) AS max_cum_return_pct
FROM daily GROUP BY 1"""
    ),
)
def _(spark, folder):
    return analytics.ticker_stats(daily_brand(spark, folder))


_COVERAGE = (
    "SELECT ticker, min(trade_date) AS first_date, max(trade_date) AS last_date, "
    "count(DISTINCT trade_date) AS trading_days FROM raw GROUP BY ticker"
)


@query("ticker_coverage", oracle(_COVERAGE))
def _(spark, folder):
    return profile.ticker_coverage(raw_brand(spark, folder))


@query("ticker_coverage_part", oracle(_COVERAGE, "part"))
def _(spark, folder):
    return profile.ticker_coverage(raw_part(spark, folder))


_RAW_COLUMNS = ["ticker", "trade_date", "open", "high", "low", "close", "adj_close", "volume"]


@query(
    "null_counts",
    oracle(
        "SELECT "
        + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _RAW_COLUMNS)
        + " FROM raw"
    ),
)
def _(spark, folder):
    return profile.null_counts(raw_brand(spark, folder))


def _describe_sql(column):
    return (
        f"SELECT '{column}' AS \"column\", count({column}) AS count, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS null_count, "
        + r6(f"avg({column}) AS mean", f"stddev_samp({column}) AS std")
        + f", CAST(min({column}) AS DOUBLE) AS min"
        + "".join(
            f", (SELECT CAST({column} AS DOUBLE) FROM (SELECT {column}, row_number() OVER (ORDER BY {column}) AS k, "
            f"count(*) OVER () AS n FROM raw WHERE {column} IS NOT NULL) AS o WHERE k = ceil({share} * n)) AS {name}"
            for name, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
        )
        + f", CAST(max({column}) AS DOUBLE) AS max FROM raw"
    )


@query(
    "describe_bars", oracle("\nUNION ALL ".join(_describe_sql(c) for c in _RAW_COLUMNS[2:]))
)
def _(spark, folder):
    return profile.describe(staged(raw_brand(spark, folder), "raw"), exact=True)


@query(
    "correlation_matrix",
    oracle(
        f"""
, pairs AS (
  SELECT a.ticker AS ticker_a, b.ticker AS ticker_b, count(*) AS n_days,
         corr(a.daily_return, b.daily_return) AS c
  FROM silver AS a JOIN silver AS b ON a.trade_date = b.trade_date
  WHERE a.daily_return IS NOT NULL AND b.daily_return IS NOT NULL GROUP BY 1, 2)
SELECT upper(ticker_a) AS ticker_a, upper(ticker_b) AS ticker_b, n_days,
       {r6("CASE WHEN n_days > 1 AND NOT isnan(c) THEN c END AS correlation")}
FROM pairs"""
    ),
)
def _(spark, folder):
    returns = analytics.return_series(silver_brand(spark, folder))
    return correlation_matrix(staged(returns, "returns"))


@query(
    "equal_weight_backtest",
    oracle(
        f"""
, portfolio AS (SELECT trade_date, avg(daily_return) AS portfolio_return FROM silver GROUP BY 1),
compound AS (SELECT *, product(1 + coalesce(portfolio_return, 0)) OVER (
               ORDER BY trade_date ROWS UNBOUNDED PRECEDING) - 1 AS portfolio_cum_return
             FROM portfolio)
SELECT trade_date, {r6("portfolio_return", "portfolio_cum_return")} FROM compound""",
        "orders",
    ),
)
def _(spark, folder):
    return analytics.equal_weight_backtest(daily_orders(spark, folder))


@query(
    "bollinger_bands",
    oracle(
        f"""
, bands AS (
  SELECT ticker, trade_date, close_price, avg(close_price) OVER w AS sma_20,
         stddev_samp(close_price) OVER w AS std_20
  FROM daily
  WINDOW w AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT upper(ticker) AS ticker, trade_date, close_price, {r6("sma_20", "std_20",
       "sma_20 + 2 * std_20 AS upper_band", "sma_20 - 2 * std_20 AS lower_band")} FROM bands"""
    ),
)
def _(spark, folder):
    return analytics.bollinger_bands(silver_brand(spark, folder))


_ZSCORES = """
, z AS (
  SELECT ticker, trade_date, volume,
         CASE WHEN count(volume) OVER w >= 5 THEN avg(volume) OVER w END AS vol_mean,
         CASE WHEN count(volume) OVER w >= 5 THEN nullif(stddev_samp(volume) OVER w, 0) END AS vol_std
  FROM daily
  WINDOW w AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""


@query(
    "volume_anomalies",
    oracle(
        f"""{_ZSCORES}
SELECT upper(ticker) AS ticker, trade_date, volume, {r6("vol_mean",
       "(volume - vol_mean) / vol_std AS vol_zscore")}
FROM z WHERE abs((volume - vol_mean) / vol_std) > 3"""
    ),
)
def _(spark, folder):
    return analytics.by_zscore(analytics.volume_anomalies(silver_brand(spark, folder)))


@query(
    "volume_zscores",
    oracle(
        f"""{_ZSCORES}
SELECT upper(ticker) AS ticker, trade_date, volume, {r6("vol_mean",
       "CASE WHEN vol_mean IS NULL THEN NULL ELSE coalesce(vol_std, 0) END AS vol_std",
       "(volume - vol_mean) / vol_std AS vol_zscore")} FROM z"""
    ),
)
def _(spark, folder):
    return analytics.volume_zscores(silver_brand(spark, folder))


@query(
    "top_cumulative",
    oracle(
        f"""
, top AS (SELECT ticker FROM summary ORDER BY total_return DESC NULLS LAST, upper(ticker) LIMIT 5)
SELECT upper(ticker) AS ticker, trade_date, {r6("cum_return")}
FROM daily WHERE ticker IN (SELECT ticker FROM top)"""
    ),
)
def _(spark, folder):
    return analytics.top_cumulative(daily_brand(spark, folder))


@query(
    "return_histogram",
    oracle(
        """
, span AS (SELECT min(daily_return) AS lo, max(daily_return) AS hi FROM silver)
SELECT upper(ticker) AS ticker,
       CAST(least(60, floor(60 * (daily_return - lo) / (hi - lo)) + 1) AS INTEGER) AS bin,
       count(*) AS n
FROM silver, span WHERE daily_return IS NOT NULL GROUP BY 1, 2"""
    ),
)
def _(spark, folder):
    return analytics.return_histogram(silver_brand(spark, folder))


_WIDE = ", ".join(
    r6(f"avg(daily_return) FILTER (WHERE upper(ticker) = '{b}') AS \"{b}\"") for b in sorted(BRANDS)
)


@query("returns_wide", oracle(f"SELECT trade_date, {_WIDE} FROM silver GROUP BY trade_date"))
def _(spark, folder):
    brands = bars.table(spark, folder, "part").select(F.upper("p_brand")).distinct().collect()
    return analytics.returns_wide(silver_brand(spark, folder), sorted(r[0] for r in brands))


@query(
    "return_series",
    oracle("SELECT ticker, trade_date, daily_return FROM silver", "part"),
)
def _(spark, folder):
    return analytics.return_series(silver_part(spark, folder))


@query(
    "close_series",
    oracle("SELECT ticker, trade_date, close FROM raw"),
)
def _(spark, folder):
    return analytics.return_series(raw_brand(spark, folder), value="close")


_HEATMAP = f"""
SELECT upper(ticker) AS ticker, year || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS ym,
       {r6("avg(month_return) * 100 AS return_pct")} FROM monthly GROUP BY ticker, year, month"""


@query("monthly_heatmap", oracle(_HEATMAP))
def _(spark, folder):
    # none of the focus tickers is in the data, so all tickers are shown
    return report.monthly_heatmap(gold.monthly_returns(silver_brand(spark, folder)))


_MONTHS = [f"{y}-{m:02d}" for y in range(1995, 2002) for m in range(1, 13)]
_MONTHS_WIDE = ", ".join(
    r6(f"avg(month_return * 100) FILTER (WHERE year = {y[:4]} AND month = {int(y[5:])}) AS \"{y}\"")
    for y in _MONTHS
)


@query(
    "monthly_heatmap_wide",
    oracle(f"SELECT upper(ticker) AS ticker, {_MONTHS_WIDE} FROM monthly GROUP BY ticker"),
)
def _(spark, folder):
    days = bars.table(spark, folder, "lineitem").agg(F.min("l_shipdate"), F.max("l_shipdate")).first()
    heatmap = report.monthly_heatmap(gold.monthly_returns(silver_brand(spark, folder)))
    whole_years = date(days[0].year, 1, 1), date(days[1].year, 12, 1)
    return report.heatmap_wide(heatmap, report.month_labels_between(*whole_years))


@query(
    "volatility_series",
    oracle(
        f"SELECT upper(ticker) AS ticker, trade_date, "
        f"{r6('coalesce(volatility_20d * 100, 0) AS volatility_pct')} FROM daily"
    ),
)
def _(spark, folder):
    return report.volatility_series(daily_brand(spark, folder))


@query(
    "risk_return",
    oracle(
        f"SELECT upper(ticker) AS ticker, {r6('avg_volatility * 100 AS volatility_pct', 'total_return * 100 AS return_pct')} "
        "FROM summary WHERE total_return IS NOT NULL AND avg_volatility IS NOT NULL"
    ),
)
def _(spark, folder):
    return report.risk_return(gold.portfolio_summary(daily_brand(spark, folder)))


_SUMMARY_TABLE = """
SELECT upper(ticker) AS ticker, strftime(first_date, '%d/%m/%y') AS first_date,
       strftime(last_date, '%d/%m/%y') AS last_date,
       printf('%.2f%%', coalesce(total_return, 0) * 100) AS total_return,
       printf('%.1fM', avg_daily_volume / 1e6) AS avg_volume,
       printf('%.1f%%', coalesce(avg_volatility, 0) * 100) AS avg_volatility,
       printf('R$%.2f', period_high) AS period_high, coalesce(total_return, 0) >= 0 AS is_gain
FROM summary ORDER BY summary.total_return DESC NULLS LAST, upper(ticker) LIMIT 12"""


@query("report_summary_table", oracle(_SUMMARY_TABLE))
def _(spark, folder):
    return report.report_summary_table(gold.portfolio_summary(daily_brand(spark, folder)))


@query("report_summary_table_events", oracle(_SUMMARY_TABLE, "events"))
def _(spark, folder):
    return report.report_summary_table(gold.portfolio_summary(daily_events(spark, folder)))


_SOME = ["Brand#13", "BRAND#21"]
_SOME_SQL = "upper(ticker) IN ('BRAND#13', 'BRAND#21')"


@query(
    "volatility_chosen",
    oracle(
        f"SELECT upper(ticker) AS ticker, trade_date, "
        f"{r6('coalesce(volatility_20d * 100, 0) AS volatility_pct')} FROM daily WHERE {_SOME_SQL}"
    ),
)
def _(spark, folder):
    return report.volatility_series(daily_brand(spark, folder), [t.upper() for t in _SOME])


@query("monthly_heatmap_chosen", oracle(_HEATMAP.replace("FROM monthly", f"FROM monthly WHERE {_SOME_SQL}")))
def _(spark, folder):
    monthly = gold.monthly_returns(silver_brand(spark, folder))
    return report.monthly_heatmap(monthly, [t.upper() for t in _SOME])


_QUARTILES = [("q25", 0.25), ("q50", 0.5), ("q75", 0.75)]


@query(
    "describe_quartile_ranks",
    oracle(
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS \"column\", '{q}' AS quartile, count({c}) > 0 AS sound FROM raw"
            for c in _RAW_COLUMNS[2:]
            for q, _ in _QUARTILES
        )
    ),
)
def _(spark, folder):
    """Whether each sketched quartile's rank is as near its target as the sketch promises."""
    rows = staged(raw_brand(spark, folder), "raw")
    described = profile.describe(rows)
    wanted = described.select(
        "column",
        F.inline(F.array(*[F.struct(F.lit(q).alias("quartile"), F.lit(p).alias("target"), F.col(q).alias("value")) for q, p in _QUARTILES])),
    )
    values = rows.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in _RAW_COLUMNS[2:]]))
    ).where("x is not null")
    ranks = values.join(F.broadcast(wanted), "column").groupBy("column", "quartile", "target").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("x") < F.col("value")).alias("below"), F.count_if(F.col("x") <= F.col("value")).alias("upto")
    )
    error = F.ceil(F.col("n") / profile.ACCURACY) + 1
    target = F.col("target") * F.col("n")
    sound = (F.col("below") <= target + error) & (F.col("upto") >= target - error)
    return ranks.select("column", "quartile", sound.alias("sound"))
