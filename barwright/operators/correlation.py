"""Pearson correlation of every pair of tickers over the dates both have a return."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.scalars import all_present
from barwright.operators.analytics import mean_per_key

MOMENTS = ["n", "sx", "sy", "sxx", "syy", "sxy"]
# a sum of squares this much smaller than its parts is rounding noise: the series is constant
NO_VARIATION = 1e-13

_PARTIAL = (
    "ticker_a string, ticker_b string, n double, sx double, sy double, "
    "sxx double, syy double, sxy double"
)


def _tile_moments():
    """The function that sums up one tile.

    Built in here, it travels to the executors by value: they need numpy and pandas, but not this
    package.
    """
    moments = list(MOMENTS)

    def grid(rows, dates):
        """Tickers, and a dates x tickers array of returns with its presence mask."""
        codes, tickers = pd.factorize(rows["ticker"], sort=True)
        values = np.zeros((len(dates), len(tickers)))
        present = np.zeros_like(values)
        at = np.searchsorted(dates, rows["day"].to_numpy())
        values[at, codes] = rows["x"].to_numpy()
        present[at, codes] = 1.0
        return np.asarray(tickers), values, present

    def tile_moments(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        left_group, right_group = key[0], key[1]
        dates = np.unique(rows["day"].to_numpy())
        ta, x, mx = grid(rows[rows["ticker_group"] == left_group], dates)
        if left_group == right_group:
            tb, y, my = ta, x, mx
        else:
            tb, y, my = grid(rows[rows["ticker_group"] == right_group], dates)
        sums = [mx.T @ my, x.T @ my, mx.T @ y, (x * x).T @ my, mx.T @ (y * y), x.T @ y]
        keep = sums[0] > 0
        if left_group == right_group:
            keep &= np.triu(np.ones_like(keep))
        ia, ib = np.nonzero(keep)
        columns = {"ticker_a": ta[ia], "ticker_b": tb[ib]}
        columns.update({name: s[ia, ib] for name, s in zip(moments, sums)})
        return pd.DataFrame(columns)

    return tile_moments


def correlation_matrix(
    daily: DataFrame, tile: int = 256, block_days: int = 2048, n_tickers: int | None = None
) -> DataFrame:
    """(ticker_a, ticker_b, n_days, correlation) for every ordered pair with a common date.

    A self-join on the date would emit dates x tickers^2 rows. Here the tickers are hashed into
    groups of about ``tile``, and each pair of groups is multiplied as one block of a matrix
    product: a row is copied once per group, not once per ticker, and a task holds at most
    2 x tile x block_days cells and returns tile^2 sums. Sums of all date blocks are then added up
    per pair. The number of tickers sets the number of groups; counting them scans one column of
    ``daily``, which should be a stored table.

    Null where a series does not vary over the common dates or where there is only one.
    """
    returns = mean_per_key(
        daily.where(all_present("daily_return")), ["ticker", "trade_date"], "daily_return"
    ).where(~F.isnan("daily_return"))
    if n_tickers is None:
        n_tickers = daily.select("ticker").distinct().count()
    n_groups = max(1, -(-n_tickers // tile))

    # Correlation ignores shifts; centring keeps the sums of squares accurate. A ticker whose
    # return never changes becomes exactly zero, so its variance does too.
    whole = Window.partitionBy("ticker")
    r = F.col("daily_return")
    centred = F.when(F.min(r).over(whole) == F.max(r).over(whole), 0.0).otherwise(
        r - F.avg(r).over(whole)
    )
    group = F.pmod(F.xxhash64("ticker"), F.lit(n_groups)).cast("int")
    day = F.datediff("trade_date", F.lit("1970-01-01").cast("date"))
    cells = returns.select(
        "ticker",
        day.alias("day"),
        centred.alias("x"),
        group.alias("ticker_group"),
        F.floor(day / block_days).cast("int").alias("date_block"),
    ).withColumn("_other", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))))

    partial = (
        cells.withColumn("left_group", F.least("ticker_group", "_other"))
        .withColumn("right_group", F.greatest("ticker_group", "_other"))
        .drop("_other")
        .groupBy("left_group", "right_group", "date_block")
        .applyInPandas(_tile_moments(), _PARTIAL)
    )
    total = partial.groupBy("ticker_a", "ticker_b").agg(*[F.sum(m).alias(m) for m in MOMENTS])

    n, sx, sy, sxx, syy, sxy = (F.col(m) for m in MOMENTS)
    cxx = sxx - sx * sx / n
    cyy = syy - sy * sy / n
    varies = (cxx > NO_VARIATION * sxx) & (cyy > NO_VARIATION * syy) & (n > 1)
    value = F.when(varies, (sxy - sx * sy / n) / F.sqrt(cxx * cyy))
    bounded = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))
    upper = total.select(
        "ticker_a",
        "ticker_b",
        n.cast("bigint").alias("n_days"),
        F.when(value.isNotNull(), bounded).alias("correlation"),
    )
    as_is = F.struct(F.col("ticker_a").alias("a"), F.col("ticker_b").alias("b"))
    mirrored = F.struct(F.col("ticker_b").alias("a"), F.col("ticker_a").alias("b"))
    sides = F.when(F.col("ticker_a") == F.col("ticker_b"), F.array(as_is)).otherwise(
        F.array(as_is, mirrored)
    )
    return upper.withColumn("_pair", F.explode(sides)).select(
        F.col("_pair.a").alias("ticker_a"),
        F.col("_pair.b").alias("ticker_b"),
        "n_days",
        "correlation",
    )
