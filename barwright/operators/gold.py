"""Analytical tables on top of clean bars."""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright import fixed
from barwright.functions import blocks
from barwright.functions.scalars import all_present, ratio_minus_one
from barwright.functions.series import compounded, growth, rolling_mean, rolling_std, to_date


def add_cum_return(df: DataFrame) -> DataFrame:
    return df.withColumn("cum_return", compounded("daily_return"))


def daily_metrics(silver: DataFrame) -> DataFrame:
    """Silver plus 20-row volume mean, annualised 20-row volatility, compound return, year, month.

    The three windows share one partitioning and one sort; on a frame that comes straight from
    ``transform_silver`` they reuse the ones its return was computed with.
    """
    yearly = math.sqrt(fixed.TRADING_DAYS_PER_YEAR)
    return (
        silver.withColumn("avg_volume_20d", rolling_mean("volume"))
        .withColumn("volatility_20d", rolling_std("daily_return") * yearly)
        .withColumn("year", F.year("trade_date"))
        .withColumn("month", F.month("trade_date"))
        .transform(add_cum_return)
    )


def _windows(df: DataFrame) -> DataFrame:
    """The columns of daily_metrics by block; copied rows ahead of a block are used and dropped."""
    yearly = math.sqrt(fixed.TRADING_DAYS_PER_YEAR)
    own = F.when(F.col(blocks.AHEAD), F.coalesce(blocks.CARRY, F.lit(1.0))).otherwise(growth("daily_return"))
    return (
        df.withColumn("avg_volume_20d", rolling_mean("volume", keys=blocks.KEYS))
        .withColumn("volatility_20d", rolling_std("daily_return", keys=blocks.KEYS) * yearly)
        .withColumn("year", F.year("trade_date"))
        .withColumn("month", F.month("trade_date"))
        .withColumn("cum_return", F.product(own).over(to_date(blocks.KEYS)) - 1)
        .where(~F.col(blocks.AHEAD))
    )


def daily_metrics_by_block(silver: DataFrame, block_days: int = 366) -> DataFrame:
    """``daily_metrics`` for series too long for one task: windows hold one block of a ticker's days.

    The rolling columns equal those of ``daily_metrics`` bit for bit, the compound return up to rounding.
    Reads ``silver`` four times, thrice for few columns, so it should be a stored table. A row without ticker or
    date belongs to no block and is left out.
    """
    dated = silver.where(all_present("ticker", "trade_date"))
    overlapped = blocks.with_overlap(dated, block_days, ["volume", "daily_return"], compounded="daily_return")
    return _windows(overlapped).select(*daily_metrics_columns(silver))


def daily_metrics_columns(silver: DataFrame) -> list[str]:
    return [*silver.columns, "avg_volume_20d", "volatility_20d", "year", "month", "cum_return"]


def month_states(silver: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Per ticker and month with rows, what later months need of all rows up to its end.

    Columns ticker, year, month, tail (the last 19 rows' date, volume and return) and growth (the product of
    1 + return). ``before`` has the states (ticker, tail, growth) that the rows of ``silver`` come after.
    """
    month = (F.year("trade_date") * 12 + F.month("trade_date") - 1)
    # a month has few rows, so one aggregate holds them all
    every = F.array_sort(F.collect_list(F.struct("trade_date", "volume", "daily_return")))
    states = silver.where(all_present("ticker", "trade_date")).groupBy("ticker", month.alias(blocks.BLOCK)).agg(
        blocks.last_of(every).alias("tail"), F.product(growth("daily_return")).alias("growth")
    )
    if before is not None:
        states = states.unionByName(before.select("ticker", F.lit(-1).alias(blocks.BLOCK), "tail", "growth"))
    rows = fixed.ROLLING_ROWS - 1
    so_far = Window.partitionBy("ticker").orderBy(blocks.BLOCK)
    states = states.withColumns(
        {
            "tail": blocks.joined_tails(so_far.rowsBetween(-rows, Window.currentRow), rows),
            "growth": F.product("growth").over(so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        }
    )
    block = F.col(blocks.BLOCK)
    return states.where(block >= 0).select(
        "ticker", F.floor(block / 12).cast("int").alias("year"), (block % 12 + 1).cast("int").alias("month"), "tail", "growth"
    )


def last_states(states: DataFrame, year: int, month: int) -> DataFrame:
    """Every ticker's state (ticker, tail, growth) at the start of a month: that of its last month before."""
    earlier = states.where((F.col("year") < year) | ((F.col("year") == year) & (F.col("month") < month)))
    last = earlier.groupBy("ticker").agg(F.max_by(F.struct("tail", "growth"), F.struct("year", "month")).alias("s"))
    return last.select("ticker", "s.tail", "s.growth")


def daily_metrics_after(silver: DataFrame, before: DataFrame) -> DataFrame:
    """``daily_metrics`` of the rows of ``silver``, which follow on the states ``before`` (ticker, tail, growth)."""
    ahead = blocks.copied_ahead(before.withColumnRenamed("growth", blocks.CARRY), "tail", "ticker")
    rows = silver.withColumn(blocks.AHEAD, F.lit(False)).unionByName(ahead, allowMissingColumns=True)
    return _windows(rows.withColumn(blocks.BLOCK, F.lit(0))).select(*daily_metrics_columns(silver))


def portfolio_summary(daily: DataFrame) -> DataFrame:
    """One row per ticker over the whole period."""
    return daily.groupBy("ticker").agg(
        F.min("trade_date").alias("first_date"),
        F.max("trade_date").alias("last_date"),
        F.max_by("cum_return", "trade_date").alias("total_return"),
        F.avg("volume").alias("avg_daily_volume"),
        F.avg("volatility_20d").alias("avg_volatility"),
        F.max("close_price").alias("period_high"),
        F.min("close_price").alias("period_low"),
    )


def by_total_return(summary: DataFrame) -> DataFrame:
    return summary.orderBy(F.col("total_return").desc_nulls_last(), "ticker")


def monthly_returns(silver: DataFrame) -> DataFrame:
    """Monthly bars per ticker. First and last come from min_by/max_by, so nothing is sorted."""
    return (
        silver.groupBy(
            "ticker", F.year("trade_date").alias("year"), F.month("trade_date").alias("month")
        )
        .agg(
            F.min_by("open_price", "trade_date").alias("month_open"),
            F.max_by("close_price", "trade_date").alias("month_close"),
            F.max("high_price").alias("month_high"),
            F.min("low_price").alias("month_low"),
            F.sum("volume").alias("month_volume"),
            F.avg("daily_return").alias("avg_daily_return"),
        )
        .withColumn("month_return", ratio_minus_one("month_close", "month_open"))
    )


def max_drawdown(daily: DataFrame) -> DataFrame:
    """Deepest fall of 1 + cum_return from its running peak, per ticker (0 if it never falls)."""
    value = 1 + F.col("cum_return")
    peak = F.max(value).over(to_date())
    return (
        daily.withColumn("_drawdown", ratio_minus_one(value, peak))
        .groupBy("ticker")
        .agg(F.min("_drawdown").alias("max_drawdown"))
    )


def sector_performance(summary: DataFrame, sectors: DataFrame) -> DataFrame:
    """Averages over the tickers of each sector. ``sectors`` has ticker and sector.

    The join carries no hint: Spark broadcasts the dimension while it is under the session's
    threshold and shuffles both sides (with adaptive skew handling) when it has outgrown it.
    """
    return (
        summary.join(sectors, "ticker")
        .groupBy("sector")
        .agg(
            F.count(F.lit(1)).alias("n_tickers"),
            F.avg("total_return").alias("avg_total_return"),
            F.avg("avg_volatility").alias("avg_volatility"),
            F.max_by("ticker", F.struct("total_return", "ticker")).alias("best_ticker"),
            F.max("total_return").alias("best_return"),
            F.min("total_return").alias("worst_return"),
        )
    )
