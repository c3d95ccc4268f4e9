"""Daily loads that give the same result as a full recompute."""

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.functions.scalars import ratio_minus_one
from barwright.functions.series import by_date
from barwright.session import staged


def last_closes(silver: DataFrame, before) -> DataFrame:
    """The last close of every ticker ahead of ``before``, with its date."""
    return (
        silver.where(F.col("trade_date") < F.lit(before).cast("date"))
        .groupBy("ticker")
        .agg(
            F.max_by("close_price", "trade_date").alias("close_price"),
            F.max("trade_date").alias("trade_date"),
        )
    )


def prior_closes(
    silver: DataFrame, tickers: DataFrame, before, lookback_days: int = 45, held: list | None = None
) -> DataFrame:
    """``last_closes`` for the given tickers, reading old partitions only when somebody needs them.

    Nearly every ticker traded in the last few weeks, so those partitions are read first. Tickers
    with no bar there (newly listed, or long suspended) are looked up in the older ones; if there
    are none of them, the older partitions are not touched.
    """
    start = before if isinstance(before, datetime.date) else datetime.date.fromisoformat(before)
    edge = F.lit(start - datetime.timedelta(days=lookback_days)).cast("date")
    wanted = tickers.select("ticker").distinct()
    recent = last_closes(silver.where(F.col("trade_date") >= edge), start).join(
        wanted, "ticker", "left_semi"
    )
    recent = staged(recent, "prior", held)  # one row per ticker, read by the check and by the caller
    missing = wanted.join(recent, "ticker", "left_anti")
    if missing.isEmpty():
        return recent
    older = last_closes(
        silver.where(F.col("trade_date") < edge).join(missing, "ticker", "left_semi"), start
    )
    return recent.unionByName(older)


def add_return_after(df: DataFrame, prior: DataFrame) -> DataFrame:
    """Daily returns of new bars whose first return per ticker looks back at ``prior``.

    The prior close joins the new bars as one extra row per ticker, so one shuffle and one window
    serve both and the extra rows are dropped again.
    """
    seeds = prior.select("ticker", "trade_date", "close_price", F.lit(True).alias("_seed"))
    rows = df.withColumn("_seed", F.lit(False)).unionByName(seeds, allowMissingColumns=True)
    previous = F.lag("close_price").over(by_date())
    return (
        rows.withColumn("daily_return", ratio_minus_one("close_price", previous))
        .where(~F.col("_seed"))
        .drop("_seed")
    )
