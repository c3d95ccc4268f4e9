"""Daily bars from the supplied TPC-H-like tables, which hold no price bars of their own.

Each mapping is one grouped aggregate with partial aggregation, so a key with a third of the rows
reaches the shuffle as one row per map task. First and last prices are picked by a single number
that no two rows of different price share, so they do not depend on input order, and the aggregate
can hash: ordering by several columns would make Spark sort the whole table first.
"""

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.schemas import RAW_SCHEMA


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _bars(df: DataFrame, price, position, volume) -> DataFrame:
    return df.groupBy("ticker", "trade_date").agg(
        F.min_by(price, position).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, position).alias("close"),
        F.max_by(price, position).alias("adj_close"),
        volume.cast("bigint").alias("volume"),
    )


def bars_from_lineitem(spark: SparkSession, folder: str, by: str = "brand") -> DataFrame:
    """Unit prices per shipping day. ``by="brand"`` gives few long series, ``by="part"`` many.

    Lines have no time of day. Their position in the day is the order number, then the extended price
    in cents, then the quantity, packed into one decimal of 38 digits: 19 for the whole order number,
    14 for the cents and 5 for the quantity. Two lines at the same position have the same price. The
    pair (order, line) is not unique in the data. A position that needs more digits ends the job.

    The brand join carries no hint: part grows with the data, so Spark broadcasts it only under the
    session's size threshold and otherwise shuffles, splitting a part that dominates lineitem.
    """
    items = table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_extendedprice",
        "l_quantity",
        F.to_date("l_shipdate").alias("trade_date"),
    )
    if by == "brand":
        parts = table(spark, folder, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
        items = items.join(parts, items.l_partkey == parts.p_partkey)
    elif by == "part":
        items = items.withColumn("ticker", F.col("l_partkey"))
    else:
        raise ValueError(f"unknown series key: {by}")
    price = F.try_divide("l_extendedprice", "l_quantity")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    within = cents.cast("decimal(14,0)") * F.lit(10**5) + F.col("l_quantity").cast("decimal(5,0)")
    position = F.col("l_orderkey").cast("decimal(19,0)") * F.lit(Decimal(10**19)) + within
    position = position.cast("decimal(38,0)")
    found = _bars(items, price, position, F.sum("l_quantity"))
    # the number travels, its text is made from it afterwards
    return found if by == "brand" else found.withColumn("ticker", F.concat(F.lit("P"), F.col("ticker").cast("string")))


def bars_from_events(spark: SparkSession, folder: str, by: str = "event_type") -> DataFrame:
    """Event values per day; ``by`` is event_type (few series) or user_id (many)."""
    events = table(spark, folder, "events").select(
        F.col(by).cast("string").alias("ticker"),
        F.to_date("ts").alias("trade_date"),
        "event_id",
        "value",
    )
    return _bars(events, F.col("value"), F.col("event_id"), F.count(F.lit(1)))


def bars_from_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly order totals per priority: open = close = the mean.

    The mean is taken over whole cents, so it does not depend on the order of summation.
    """
    orders = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("ticker"),
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("trade_date"),
        "o_totalprice",
    )
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    mean = F.sum(cents).cast("double") / 100 / F.count(F.lit(1))
    return orders.groupBy("ticker", "trade_date").agg(
        mean.alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        mean.alias("close"),
        mean.alias("adj_close"),
        F.count(F.lit(1)).alias("volume"),
    )


def with_defects(bars: DataFrame) -> DataFrame:
    """Bars with the defects a feed has, placed by a fixed rule so that SQL can place them too.

    With k = days since 1995-01-01 + the number in the ticker: a missing close where 97 divides k,
    a negative low where 89 does, and where 53 does a second copy with close and adj_close up 1 %.
    Rows are added and spoilt, never left out; the copy is an explode, so bars are read once.
    """
    number = F.regexp_extract("ticker", r"(\d+)", 1).cast("int")
    k = F.datediff("trade_date", F.lit("1995-01-01").cast("date")) + number
    copies = F.when(F.col("_k") % 53 == 0, F.array(F.lit(1.0), F.lit(1.01))).otherwise(
        F.array(F.lit(1.0))
    )
    return (
        bars.withColumn("_k", k)
        .withColumn("_factor", F.explode(copies))
        .withColumn("low", F.when(F.col("_k") % 89 == 0, -F.col("low")).otherwise(F.col("low")))
        .withColumn(
            "close", F.when(F.col("_k") % 97 != 0, F.col("close") * F.col("_factor"))
        )
        .withColumn("adj_close", F.col("adj_close") * F.col("_factor"))
        .select(*RAW_SCHEMA.fieldNames())
    )
