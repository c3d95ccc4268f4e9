"""Long series in blocks: windows whose partition is a part of a ticker's dates.

A block is a span of calendar days. A ticker with no more rows than a block has days is one block. What a
window needs from the rows before the block is brought along: for a rolling window the last rows ahead of it,
for a running product the product of all earlier blocks, which the first of these rows carries. Blocks of sparse
series span more days, so that what is brought along grows with the rows and not with the blocks.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright import fixed
from barwright.functions.series import growth
from barwright.session import staged

#: A row of an earlier block, there for the windows only.
AHEAD = "_ahead"
BLOCK = "_block"
#: The product of all earlier blocks, on the first row ahead of a block.
CARRY = "_carry"
KEYS = ("ticker", BLOCK)
_DAYS = "_days"


def block_of(days) -> Column:
    """The number of the span of ``days`` days that a date lies in."""
    return F.floor(F.unix_date("trade_date") / days).cast("int")


def long_series(df: DataFrame, block_days: int) -> DataFrame:
    """The tickers with more rows than a block has days, and how many days each of their blocks spans (``_days``).

    These are ``block_days``, or as many as hold ``block_days`` rows on average. With n rows over s days a block
    has at most min(n, s * block_days / n) rows, which is never more than the square root of s * block_days.
    """
    span = F.datediff(F.max("trade_date"), F.min("trade_date")) + 1
    counted = df.groupBy("ticker").agg(F.count("trade_date").alias("_rows"), span.alias("_span"))
    days = F.greatest(F.lit(block_days), F.ceil(F.col("_span") * block_days / F.col("_rows")).cast("int"))
    return counted.where(F.col("_rows") > block_days).select("ticker", days.alias(_DAYS))


def last_rows(df: DataFrame, block, columns, rows: int = fixed.ROLLING_ROWS - 1) -> DataFrame:
    """Per ticker and block its last ``rows`` rows as an array ``tail`` of (trade_date, columns), by date."""
    latest = Window.partitionBy(*KEYS).orderBy(F.col("trade_date").desc())
    numbered = df.select("ticker", block.alias(BLOCK), "trade_date", *columns).withColumn("_n", F.row_number().over(latest))
    return numbered.where(F.col("_n") <= rows).groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.struct("trade_date", *columns))).alias("tail")
    )


def last_of(every: Column, rows: int = fixed.ROLLING_ROWS - 1) -> Column:
    return F.when(F.size(every) > rows, F.slice(every, F.size(every) - rows + 1, rows)).otherwise(every)


def joined_tails(before, rows: int = fixed.ROLLING_ROWS - 1) -> Column:
    """The last ``rows`` entries of several blocks' tails, over a window of blocks of one ticker."""
    return last_of(F.flatten(F.collect_list("tail").over(before)), rows)


def with_overlap(
    df: DataFrame, block_days: int, columns, rows: int = fixed.ROLLING_ROWS - 1, compounded: str | None = None
) -> DataFrame:
    """``df`` by block (column ``_block``), each with copies of the last ``rows`` rows ahead of it (``_ahead``).

    The copies have ticker, date and ``columns``, all else is null. No more than ``rows`` earlier blocks can
    hold them, as every block that exists has a row. With ``compounded`` named, the first copy ahead of a block
    has the product of 1 + its value over all earlier blocks (``_carry``). Which tickers are cut is staged.
    """
    long = staged(long_series(df, block_days), "series")
    block = block_of(F.col(_DAYS))
    cut = df.join(long, "ticker").withColumn(BLOCK, block)
    before = Window.partitionBy("ticker").orderBy(BLOCK).rowsBetween(-rows, -1)
    ahead = last_rows(cut, F.col(BLOCK), columns, rows).select(*KEYS, joined_tails(before, rows).alias("rows"))
    if compounded:
        ahead = ahead.join(block_growth(cut, F.col(BLOCK), compounded).select(*KEYS, F.col("carry").alias(CARRY)), list(KEYS))
    copies = copied_ahead(ahead, "rows", *KEYS)
    numbered = F.when(F.col(_DAYS).isNotNull(), block).otherwise(F.lit(0))
    own = df.join(long, "ticker", "left").withColumns({BLOCK: numbered, AHEAD: F.lit(False)}).drop(_DAYS)
    return own.unionByName(copies, allowMissingColumns=True)


def copied_ahead(blocks: DataFrame, rows: str, *keys) -> DataFrame:
    """The entries of the array ``rows`` as rows ahead of their block; the first has ``_carry``, if there is one."""
    found = blocks.select(*keys, *[c for c in (CARRY,) if c in blocks.columns], F.posexplode(rows).alias("_at", "row"))
    carry = [F.when(F.col("_at") == 0, F.col(CARRY)).alias(CARRY)] if CARRY in blocks.columns else []
    return found.select(*keys, "row.*", *carry, F.lit(True).alias(AHEAD))


def block_growth(df: DataFrame, block, value: str) -> DataFrame:
    """Per ticker and block the product of 1 + value over it (``own``) and over all earlier ones (``carry``)."""
    earlier = Window.partitionBy("ticker").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    own = df.groupBy("ticker", block.alias(BLOCK)).agg(F.product(growth(value)).alias("own"))
    return own.withColumn("carry", F.coalesce(F.product("own").over(earlier), F.lit(1.0)))
