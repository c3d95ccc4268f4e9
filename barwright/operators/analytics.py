"""Questions asked of the daily metrics."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright import fixed
from barwright.functions import blocks
from barwright.functions.scalars import all_present, member_of
from barwright.functions.series import SERIES, compound_over_dates, rolling_mean, rolling_std


def ticker_stats(daily: DataFrame) -> DataFrame:
    """Trading days, mean close, mean volatility and best compound return per ticker, in SQL."""
    return daily.sparkSession.sql(
        """
        SELECT ticker,
               count(*) AS trading_days,
               round(avg(close_price), 2) AS avg_close,
               round(avg(volatility_20d) * 100, 2) AS avg_vol_pct,
               round(max(cum_return) * 100, 2) AS max_cum_return_pct
        FROM {gold_daily}
        GROUP BY ticker
        ORDER BY avg_vol_pct DESC NULLS LAST, ticker
        """,
        gold_daily=daily,
    )


def return_series(df: DataFrame, tickers=None, value: str = "daily_return") -> DataFrame:
    """(ticker, trade_date, value) of the given tickers, or of all."""
    series = df.select("ticker", "trade_date", value)
    return series if tickers is None else series.where(member_of("ticker", tickers))


def bollinger_bands(daily: DataFrame, ticker: str | None = None) -> DataFrame:
    """20-row mean of the close and two standard deviations around it.

    For one ticker the filter runs before the window, so it reaches the scan.
    """
    df = daily if ticker is None else daily.where(F.col("ticker") == ticker)
    return _bands(df.select("ticker", "trade_date", "close_price"))


def bollinger_bands_by_block(daily: DataFrame, block_days: int = 366) -> DataFrame:
    """``bollinger_bands`` of all tickers, with windows over one block of a ticker's days each."""
    closes = daily.select("ticker", "trade_date", "close_price")
    overlapped = blocks.with_overlap(closes, block_days, ["close_price"])
    return _bands(overlapped, blocks.KEYS).where(~F.col(blocks.AHEAD)).drop(blocks.AHEAD, blocks.BLOCK)


def _bands(closes: DataFrame, keys=SERIES) -> DataFrame:
    width = fixed.BOLLINGER_WIDTH * F.col("std_20")
    return (
        closes
        .withColumn("sma_20", rolling_mean("close_price", keys=keys))
        .withColumn("std_20", rolling_std("close_price", keys=keys))
        .withColumn("upper_band", F.col("sma_20") + width)
        .withColumn("lower_band", F.col("sma_20") - width)
    )


def volume_zscores(daily: DataFrame) -> DataFrame:
    """Distance of each volume from its 20-row mean in standard deviations.

    Null while the frame has fewer than five values, and null where the volume is constant.
    """
    return _zscores(daily.select("ticker", "trade_date", "volume"))


def volume_zscores_by_block(daily: DataFrame, block_days: int = 366) -> DataFrame:
    """``volume_zscores`` with windows over one block of a ticker's days each."""
    overlapped = blocks.with_overlap(daily.select("ticker", "trade_date", "volume"), block_days, ["volume"])
    return _zscores(overlapped, blocks.KEYS).where(~F.col(blocks.AHEAD)).drop(blocks.AHEAD, blocks.BLOCK)


def _zscores(volumes: DataFrame, keys=SERIES) -> DataFrame:
    enough = fixed.ZSCORE_MIN_VALUES
    return (
        volumes
        .withColumn("vol_mean", rolling_mean("volume", enough, keys=keys))
        .withColumn("vol_std", rolling_std("volume", enough, keys=keys))
        .withColumn("vol_zscore", F.try_divide(F.col("volume") - F.col("vol_mean"), "vol_std"))
    )


def volume_anomalies(daily: DataFrame, limit: float = fixed.ZSCORE_LIMIT) -> DataFrame:
    return (
        volume_zscores(daily)
        .where(F.abs("vol_zscore") > limit)
        .select("ticker", "trade_date", "volume", "vol_mean", "vol_zscore")
    )


def by_zscore(anomalies: DataFrame) -> DataFrame:
    return anomalies.orderBy(F.col("vol_zscore").desc(), "ticker", "trade_date")


def portfolio_returns(daily: DataFrame) -> DataFrame:
    """Mean return over all tickers, per date."""
    return daily.groupBy("trade_date").agg(F.avg("daily_return").alias("portfolio_return"))


def equal_weight_backtest(daily: DataFrame) -> DataFrame:
    return compound_over_dates(portfolio_returns(daily), "portfolio_return", "portfolio_cum_return")


def final_returns(daily: DataFrame) -> DataFrame:
    return daily.groupBy("ticker").agg(F.max_by("cum_return", "trade_date").alias("final_return"))


def top_cumulative(daily: DataFrame, n: int = fixed.TOP_SERIES) -> DataFrame:
    """Cumulative series of the ``n`` tickers that end highest. At most ``n`` rows are broadcast."""
    top = (
        final_returns(daily)
        .orderBy(F.col("final_return").desc_nulls_last(), "ticker")
        .limit(n)
        .select("ticker")
    )
    return daily.select("ticker", "trade_date", "cum_return").join(
        F.broadcast(top), "ticker", "left_semi"
    )


def mean_per_key(df: DataFrame, keys, value: str) -> DataFrame:
    """One mean per key; repeated keys must not distort a pivot."""
    return df.groupBy(*keys).agg(F.avg(value).alias(value))


def returns_wide(daily: DataFrame, tickers) -> DataFrame:
    """Dates as rows, the given tickers as columns, daily returns as cells.

    The column list is the caller's and sorted here, so the schema never depends on the data.
    """
    cells = mean_per_key(daily, ["ticker", "trade_date"], "daily_return")
    return cells.groupBy("trade_date").pivot("ticker", sorted(tickers)).agg(F.avg("daily_return"))


def return_histogram(
    daily: DataFrame, bins: int = fixed.HISTOGRAM_BINS, low=None, high=None
) -> DataFrame:
    """Returns per ticker counted in ``bins`` equal bins (1..bins) over one common range.

    Without a range it spans the smallest to the largest return, found by scalar subqueries that
    Spark merges into one; with a range, returns outside it land in bins 0 and bins + 1.
    """
    returns = daily.where(all_present("daily_return")).select("ticker", "daily_return")
    lo = F.lit(float(low)) if low is not None else returns.select(F.min("daily_return")).scalar()
    hi = F.lit(float(high)) if high is not None else returns.select(F.max("daily_return")).scalar()
    number = F.width_bucket("daily_return", lo, hi, F.lit(bins))
    # inside the range the number stays in 1..bins: at the top edge, for quotients rounded up to it
    # and for a range of zero width, whose number is null
    inside = F.col("daily_return").between(lo, hi)
    number = F.when(inside, F.least(F.lit(bins), F.greatest(F.lit(1), number))).otherwise(number)
    return (
        returns.select("ticker", number.cast("int").alias("bin"))
        .groupBy("ticker", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


#: Width of the finest cells of a mergeable histogram.
FINEST = 2.0**-10


def histogram_cells(daily: DataFrame, value: str = "daily_return", finest: float = FINEST) -> DataFrame:
    """(ticker, low, n): values counted in cells of one power-of-two width, from one scan.

    Cells of several frames, or of several loads of a table, add up by ``merged_cells``.
    """
    x = F.col(value)
    low = (x - F.pmod(x, F.lit(finest)) + F.lit(0.0)).alias("low")  # no negative zero
    known = daily.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return known.groupBy("ticker", low).agg(F.count(F.lit(1)).alias("n"))


def merged_cells(*cells: DataFrame) -> DataFrame:
    every = reduce(DataFrame.unionByName, cells)
    return every.groupBy("ticker", "low").agg(F.sum("n").alias("n"))


def bin_width(least: float, greatest: float, bins: int, finest: float = FINEST) -> float:
    """The smallest power of two times ``finest`` by which at most ``bins`` bins span the cells."""
    width = finest
    while greatest // width - least // width + 1 > bins:
        width *= 2
    return width


def folded_histogram(cells: DataFrame, bins: int = fixed.HISTOGRAM_BINS, finest: float = FINEST) -> DataFrame:
    """(ticker, low, width, n): cells folded until at most ``bins`` bins of one width span all of them.

    A bin is two bins of half its width, so nothing is counted anew when the range grows: cells that were
    stored earlier fold along. ``cells`` should be a stored table; its least and greatest cell come to the driver.
    """
    least, greatest = cells.agg(F.min("low"), F.max("low")).first()
    width = F.lit(finest if least is None else bin_width(least, greatest, bins, finest))
    low = F.col("low") - F.pmod("low", width) + F.lit(0.0)
    return cells.groupBy("ticker", low.alias("low"), width.alias("width")).agg(F.sum("n").alias("n"))
