"""Windows over one instrument's dated rows.

Every window here is partitioned by ticker, so its size matters: a task holds one ticker's rows.
The operators that use them take frames with one row per (ticker, trade_date) -- silver is
deduplicated before any window runs -- and trade_date is a calendar date. A ticker's partition is
therefore bounded by the number of days in the data (some 2,500 rows for ten years of trading),
however large its share of the raw input was. Raw rows, where one ticker or one copied bar may
hold a third of the input, only ever meet partial aggregation. ``functions.blocks`` cuts series that
are too long for one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright import fixed
from barwright.functions.scalars import col_of


SERIES = ("ticker",)


def by_date(keys=SERIES):
    return Window.partitionBy(*keys).orderBy("trade_date")


def trailing(rows: int = fixed.ROLLING_ROWS, keys=SERIES):
    return by_date(keys).rowsBetween(1 - rows, Window.currentRow)


def to_date(keys=SERIES):
    return by_date(keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def rolling_mean(c, min_values: int = 1, rows: int = fixed.ROLLING_ROWS, keys=SERIES) -> Column:
    return _with_at_least(min_values, c, F.avg(col_of(c)), rows, keys)


def rolling_std(c, min_values: int = 2, rows: int = fixed.ROLLING_ROWS, keys=SERIES) -> Column:
    # stddev_samp is already null for a single value
    return _with_at_least(max(min_values, 2), c, F.stddev_samp(col_of(c)), rows, keys, given=2)


def _with_at_least(min_values, c, aggregate, rows, keys, given=1):
    window = trailing(rows, keys)
    if min_values <= given:
        return aggregate.over(window)
    return F.when(F.count(col_of(c)).over(window) >= min_values, aggregate.over(window))


def growth(c) -> Column:
    """1 + r, a missing return counting as no change."""
    return 1 + F.coalesce(col_of(c), F.lit(0.0))


def compounded(c) -> Column:
    return F.product(growth(c)).over(to_date()) - 1


def compound_over_dates(df: DataFrame, value: str, name: str) -> DataFrame:
    """Running compound return over the dates of a frame with one row per trade_date.

    There is no key to partition by, so the product runs inside each calendar year and the years
    are chained through a table of yearly products: at most 9,999 rows, the years a date can have,
    which is also what makes it safe to broadcast.
    """
    dated = df.withColumn("_year", F.year("trade_date"))
    in_year = (
        Window.partitionBy("_year")
        .orderBy("trade_date")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier_years = (
        Window.partitionBy(F.lit(0)).orderBy("_year").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        dated.groupBy("_year")
        .agg(F.product(growth(value)).alias("_year_growth"))
        .select(
            F.col("_year").alias("_carry_year"),
            F.coalesce(F.product("_year_growth").over(earlier_years), F.lit(1.0)).alias("_carry"),
        )
    )
    # null-safe, so that both sides read the frame alike and its shuffle is run once for the two
    same_year = F.col("_year").eqNullSafe(F.col("_carry_year"))
    return (
        dated.withColumn("_growth", F.product(growth(value)).over(in_year))
        .join(F.broadcast(carried), same_year)
        .withColumn(name, F.col("_carry") * F.col("_growth") - 1)
        .drop("_year", "_carry_year", "_growth", "_carry")
    )
