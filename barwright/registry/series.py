"""Bars from the supplied tables, and feeds landed from them."""

from pyspark.sql import functions as F

from barwright.operators.silver import in_window
from barwright.registry.base import (
    LOAD_TIME,
    RAW_VALUES,
    oracle,
    query,
    raw_brand,
)
from barwright.session import new_folder, staged
from barwright.plans import medallion
from barwright.sources import bars, feeds, layers

_ALL_BARS = f"SELECT ticker, trade_date, {RAW_VALUES} FROM bars"


@query("bars_from_lineitem", oracle(_ALL_BARS))
def _(spark, folder):
    return bars.bars_from_lineitem(spark, folder)


@query("bars_from_lineitem_part", oracle(_ALL_BARS, "part"))
def _(spark, folder):
    return bars.bars_from_lineitem(spark, folder, by="part")


@query("bars_from_events", oracle(_ALL_BARS, "events"))
def _(spark, folder):
    return bars.bars_from_events(spark, folder)


@query("bars_from_events_user", oracle(_ALL_BARS, "users"))
def _(spark, folder):
    return bars.bars_from_events(spark, folder, by="user_id")


@query("bars_from_orders", oracle(_ALL_BARS, "orders"))
def _(spark, folder):
    return bars.bars_from_orders(spark, folder)


@query(
    "load_window",
    oracle(
        f"SELECT ticker, trade_date, {RAW_VALUES} FROM raw "
        "WHERE trade_date >= DATE '1996-01-01' AND trade_date < DATE '1998-01-01'"
    ),
)
def _(spark, folder):
    return in_window(raw_brand(spark, folder), "1996-01-01", "1998-01-01")


FEED_HEADER = ["Symbol", "Date", "Open", "High", "Low", "Close", "Adj Close", "Volume"]


def _landed_feed(spark, folder):
    """The raw bars as delimited files of four layouts.

    'Brand#1x' has no adj close and its columns in another order, 'Brand#2x' volumes written as floats,
    'Brand#3x' a file per brand with a blank first line, and a line too short at its end.
    """
    path = new_folder(spark, "feed")
    columns = [
        F.col("ticker").alias("Symbol"),
        F.concat(F.col("trade_date").cast("string"), F.lit(" 00:00:00")).alias("Date"),
        *[F.col(c.lower().replace(" ", "_")).alias(c) for c in FEED_HEADER[2:]],
    ]
    landed = staged(raw_brand(spark, folder), "landed").select(*columns)
    layouts = {
        "Brand#1": [c for c in reversed(FEED_HEADER) if c != "Adj Close"],
        "Brand#2": FEED_HEADER,
        "": FEED_HEADER,
    }
    for start, header in layouts.items():
        brand = F.substring("Symbol", 1, 7)
        rows = landed.where(brand == start if start else ~brand.isin("Brand#1", "Brand#2", "Brand#3"))
        if start == "Brand#2":
            rows = rows.withColumn("Volume", F.format_string("%.1f", F.col("Volume").cast("double")))
        rows.select(*header).write.mode("append").option("header", True).csv(path)
    own = landed.where(F.substring("Symbol", 1, 7) == "Brand#3")
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in FEED_HEADER])
    text = F.concat_ws("\n", F.lit(" "), F.lit(",".join(FEED_HEADER)), F.collect_list(line), F.lit("torn,line"))
    files = own.groupBy(F.col("Symbol").alias("own")).agg(text.alias("value"))
    files.repartition("own").write.mode("append").partitionBy("own").text(f"{path}/one_each")
    return path


@query(
    "normalize_feed",
    oracle(
        "SELECT ticker, trade_date, open, high, low, close, volume, "
        "CASE WHEN ticker LIKE 'Brand#1%' THEN close ELSE adj_close END AS adj_close FROM raw"
    ),
)
def _(spark, folder):
    path = _landed_feed(spark, folder)
    feed = feeds.read_feed_files(spark, [f"{path}/*.csv", f"{path}/one_each/*/*.txt"], FEED_HEADER)
    return feeds.normalize_feed(feeds.intact(feed), F.col("Symbol"))


@query(
    "feed_rejects",
    oracle("SELECT 'torn,line' AS line, count(DISTINCT ticker) AS n FROM raw WHERE ticker LIKE 'Brand#3%'"),
)
def _(spark, folder):
    """The lines that a load of landed files could not read, after it was repeated."""
    path, root = _landed_feed(spark, folder), new_folder(spark, "lake")
    for _ in range(2):
        medallion.load_feed_files(
            spark, [f"{path}/*.csv", f"{path}/one_each/*/*.txt"], FEED_HEADER, root, "landed", F.col("Symbol"), start="1995-01-01", end="1995-02-01"
        )
    return layers.read_unread(spark, root, "landed").groupBy("line").agg(F.count(F.lit(1)).alias("n"))


def _landed_histories(spark, folder):
    """The raw bars as JSON responses, one per ticker and month (so at most 62 entries each)."""
    entry = F.struct(
        F.col("trade_date").cast("string").alias("date"),
        F.col("open").cast("string").alias("open"),  # quoted in the JSON
        "high",
        "low",
        "close",
        F.col("adj_close").alias("adjustedClose"),
        F.col("volume").cast("double").alias("volume"),
    )
    responses = (
        raw_brand(spark, folder)
        .groupBy("ticker", F.trunc("trade_date", "month").alias("_month"))
        .agg(F.collect_list(entry).alias("historicalDataPrice"))
        .select(
            F.to_json(
                F.struct(
                    F.array(F.struct(F.col("ticker").alias("symbol"), "historicalDataPrice")).alias(
                        "results"
                    )
                )
            ).alias("value")
        )
    )
    path = new_folder(spark, "history")
    responses.write.text(path)
    return path


@query(
    "json_history_flatten",
    oracle(f"SELECT ticker || '.SA' AS ticker, trade_date, {RAW_VALUES} FROM raw"),
)
def _(spark, folder):
    return feeds.flatten_history(feeds.read_json_responses(spark, _landed_histories(spark, folder)))


@query(
    "json_rejects",
    oracle(
        """
SELECT kind AS reason, CAST(count(DISTINCT ticker) AS BIGINT) AS n
FROM raw, (VALUES ('no JSON'), ('no result'), ('no price history')) AS k(kind) GROUP BY kind"""
    ),
)
def _(spark, folder):
    """Three bad responses per ticker beside the sound ones of one ticker, kept with their reasons."""
    path, root = new_folder(spark, "history"), new_folder(spark, "lake")
    raw = raw_brand(spark, folder)
    tickers = raw.select("ticker").distinct()
    empty = F.to_json(F.struct(F.array(F.struct(F.col("ticker").alias("symbol"))).alias("results")))
    bad = F.array(F.concat(F.lit("<html>"), "ticker"), F.lit('{"results": []}'), empty)
    entry = F.struct(F.col("trade_date").cast("string").alias("date"), "open", "high", "low", "close", "volume")
    sound = raw.where("ticker = 'Brand#11'").select(
        F.to_json(F.struct(F.array(F.struct(F.col("ticker").alias("symbol"), F.array(entry).alias("historicalDataPrice"))).alias("results"))).alias("value")
    )
    tickers.select(F.explode(bad).alias("value")).union(sound).write.text(path)
    medallion.load_json_files(spark, path, root, "landed", start="1995-01-01", end="1995-02-01")
    return layers.read_unread(spark, root, "landed").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "json_quote_first",
    oracle(
        "SELECT ticker AS symbol, CAST(max(trade_date) AS VARCHAR) AS quote_date, "
        "arg_max(close, trade_date) AS price, arg_max(volume, trade_date) AS volume "
        "FROM bars GROUP BY ticker",
        "part",
    ),
)
def _(spark, folder):
    latest = (
        bars.bars_from_lineitem(spark, folder, by="part")
        .groupBy("ticker")
        .agg(
            F.max("trade_date").cast("string").alias("quote_date"),
            F.max_by("close", "trade_date").alias("price"),
            F.max_by("volume", "trade_date").alias("volume"),
        )
    )
    quote = F.struct(F.col("ticker").alias("symbol"), "quote_date", "price", "volume")
    other = F.struct(F.lit("other").alias("symbol"), "quote_date", "price", "volume")
    path = new_folder(spark, "quotes")
    latest.select(
        F.to_json(F.struct(F.array(quote, other).alias("results"))).alias("value")
    ).write.text(path)
    return feeds.first_quote(
        feeds.read_json_responses(spark, path),
        "symbol string, quote_date string, price double, volume bigint",
    )


@query(
    "multi_source_union",
    oracle(
        f"""
SELECT ticker, trade_date, {RAW_VALUES}, 'lineitem' AS source FROM raw
UNION ALL
SELECT event_type, CAST(ts AS DATE), arg_min(value, event_id), max(value), min(value),
       arg_max(value, event_id), NULL, count(*), 'events' FROM events GROUP BY 1, 2
UNION ALL
SELECT CAST(user_id AS VARCHAR), CAST(ts AS DATE), arg_min(value, event_id), max(value), min(value),
       arg_max(value, event_id), arg_max(value, event_id), count(*), 'users' FROM events GROUP BY 1, 2"""
    ),
)
def _(spark, folder):
    sources = {
        "lineitem": raw_brand(spark, folder),
        "events": bars.bars_from_events(spark, folder).drop("adj_close"),
        "users": bars.bars_from_events(spark, folder, by="user_id"),
    }
    return feeds.assemble(
        *[layers.with_load_columns(df, name, LOAD_TIME) for name, df in sources.items()]
    ).drop("ingested_at")
