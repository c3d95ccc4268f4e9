"""Registration, and the frames and SQL views most queries start from."""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.functions.scalars import rounded
from barwright.operators import gold, silver
from barwright.sources import bars

QUERIES = {}
ORACLES = {}

# clock columns get fixed stamps
LOAD_TIME = datetime(2024, 1, 2, 3, 4, 5)
PROCESS_TIME = datetime(2024, 1, 2, 4, 0, 0)


# Picked values, and quotients of picked values, are the same doubles in any engine. What sums or
# multiplies many values depends on their order in the last bits and is rounded on both sides.
EXACT = {
    "open",
    "high",
    "low",
    "close",
    "adj_close",
    "open_price",
    "high_price",
    "low_price",
    "close_price",
    "daily_return",
    "price",
    "month_open",
    "month_close",
    "month_high",
    "month_low",
    "month_return",
    "period_high",
    "period_low",
    "min",
    "q25",
    "q50",
    "q75",
    "max",
}


def query(name: str, sql: str | None = None):
    def register(build):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(spark, str(sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded to 6 places, as the SQL side does, except the exact ones."""

    def shown(field):
        c = F.col(f"`{field.name}`")
        inexact = isinstance(field.dataType, T.DoubleType) and field.name not in EXACT
        return rounded(c).alias(field.name) if inexact else c

    return df.select(*[shown(field) for field in df.schema.fields])


def raw_brand(spark, folder):
    return bars.with_defects(bars.bars_from_lineitem(spark, folder))


def raw_part(spark, folder):
    return bars.with_defects(bars.bars_from_lineitem(spark, folder, by="part"))


def silver_brand(spark, folder):
    return silver.transform_silver(raw_brand(spark, folder), PROCESS_TIME)


def silver_part(spark, folder):
    return silver.transform_silver(raw_part(spark, folder), PROCESS_TIME)


def silver_orders(spark, folder):
    return silver.transform_silver(bars.bars_from_orders(spark, folder), PROCESS_TIME)


def silver_events(spark, folder):
    return silver.transform_silver(bars.bars_from_events(spark, folder), PROCESS_TIME)


def daily_brand(spark, folder):
    return gold.daily_metrics(silver_brand(spark, folder))


def daily_part(spark, folder):
    return gold.daily_metrics(silver_part(spark, folder))


def daily_orders(spark, folder):
    return gold.daily_metrics(silver_orders(spark, folder))


def daily_events(spark, folder):
    return gold.daily_metrics(silver_events(spark, folder))


# --- SQL side ---------------------------------------------------------------------------------

_ITEM_BARS = """
  SELECT {ticker} AS ticker, CAST(l_shipdate AS DATE) AS trade_date,
         first(l_extendedprice / l_quantity {ascending}) AS open,
         max(l_extendedprice / l_quantity) AS high,
         min(l_extendedprice / l_quantity) AS low,
         first(l_extendedprice / l_quantity {descending}) AS close,
         first(l_extendedprice / l_quantity {descending}) AS adj_close,
         CAST(sum(l_quantity) AS BIGINT) AS volume
  FROM lineitem {join}
  GROUP BY 1, 2"""
_ORDER = "ORDER BY l_orderkey{0}, l_extendedprice{0}, l_quantity{0}"
_DIRECTIONS = {"ascending": _ORDER.format(""), "descending": _ORDER.format(" DESC")}
_EVENT_BARS = """
  SELECT CAST({ticker} AS VARCHAR) AS ticker, CAST(ts AS DATE) AS trade_date,
         arg_min(value, event_id) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, event_id) AS close, arg_max(value, event_id) AS adj_close,
         count(*) AS volume
  FROM events GROUP BY 1, 2"""
_BARS = {
    "brand": _ITEM_BARS.format(
        ticker="p_brand", join="JOIN part ON l_partkey = p_partkey", **_DIRECTIONS
    ),
    "part": _ITEM_BARS.format(ticker="'P' || l_partkey", join="", **_DIRECTIONS),
    "events": _EVENT_BARS.format(ticker="event_type"),
    "users": _EVENT_BARS.format(ticker="user_id"),
    "orders": """
  SELECT ticker, trade_date, mean AS open, high, low, mean AS close, mean AS adj_close, volume
  FROM (SELECT o_orderpriority AS ticker,
               CAST(date_trunc('month', o_orderdate) AS DATE) AS trade_date,
               CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100 / count(*) AS mean,
               max(o_totalprice) AS high, min(o_totalprice) AS low, count(*) AS volume
        FROM orders GROUP BY 1, 2) AS o""",
}
RAW_WITH_DEFECTS = """
  SELECT ticker, trade_date, open, high,
         CASE WHEN k % 89 = 0 THEN -low ELSE low END AS low,
         CASE WHEN k % 97 <> 0 THEN close * factor END AS close,
         adj_close * factor AS adj_close, volume
  FROM (SELECT *, datediff('day', DATE '1995-01-01', trade_date)
                  + CAST(regexp_extract(ticker, '(\\d+)', 1) AS INTEGER) AS k FROM bars) AS b
  JOIN (VALUES (CAST(1.0 AS DOUBLE)), (CAST(1.01 AS DOUBLE))) AS f(factor)
    ON factor = 1.0 OR k % 53 = 0"""
_FROM_RAW = {
    "clean": """
  SELECT ticker, trade_date, open AS open_price, high AS high_price, low AS low_price,
         close AS close_price, adj_close, volume
  FROM raw
  WHERE ticker IS NOT NULL AND trade_date IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL
    AND open > 0 AND high > 0 AND low > 0 AND close > 0
  QUALIFY row_number() OVER (PARTITION BY ticker, trade_date
                             ORDER BY adj_close DESC NULLS LAST, close DESC, volume DESC) = 1""",
    "silver": """
  SELECT *, close_price / nullif(lag(close_price) OVER (PARTITION BY ticker ORDER BY trade_date), 0)
            - 1 AS daily_return
  FROM clean""",
    "daily": """
  SELECT *,
         avg(volume) OVER w20 AS avg_volume_20d,
         stddev_samp(daily_return) OVER w20 * sqrt(252) AS volatility_20d,
         CAST(year(trade_date) AS INTEGER) AS year, CAST(month(trade_date) AS INTEGER) AS month,
         product(1 + coalesce(daily_return, 0)) OVER (
           PARTITION BY ticker ORDER BY trade_date ROWS UNBOUNDED PRECEDING) - 1 AS cum_return
  FROM silver
  WINDOW w20 AS (PARTITION BY ticker ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
    "summary": """
  SELECT ticker, min(trade_date) AS first_date, max(trade_date) AS last_date,
         arg_max(cum_return, trade_date) AS total_return, avg(volume) AS avg_daily_volume,
         avg(volatility_20d) AS avg_volatility, max(close_price) AS period_high,
         min(close_price) AS period_low
  FROM daily GROUP BY ticker""",
    "monthly": """
  SELECT *, month_close / nullif(month_open, 0) - 1 AS month_return
  FROM (SELECT ticker, CAST(year(trade_date) AS INTEGER) AS year,
               CAST(month(trade_date) AS INTEGER) AS month,
               arg_min(open_price, trade_date) AS month_open,
               arg_max(close_price, trade_date) AS month_close,
               max(high_price) AS month_high, min(low_price) AS month_low,
               CAST(sum(volume) AS BIGINT) AS month_volume, avg(daily_return) AS avg_daily_return
        FROM silver GROUP BY 1, 2, 3) AS m""",
}


def oracle(body: str, series: str = "brand") -> str:
    """``body`` with the views bars, raw, clean, silver, daily, summary and monthly in scope."""
    defects = series in ("brand", "part")
    views = {
        "bars": _BARS[series],
        "raw": RAW_WITH_DEFECTS if defects else "\n  SELECT * FROM bars",
        **_FROM_RAW,
    }
    return "WITH " + ",\n".join(f"{name} AS ({sql})" for name, sql in views.items()) + "\n" + body


def r6(*columns: str) -> str:
    """SELECT-list text rounding columns; ``"expr AS name"`` keeps its name."""
    parts = []
    for column in columns:
        expression, _, name = column.rpartition(" AS ")
        parts.append(f"round({expression or column}, 6) + 0.0 AS {name or column}")
    return ", ".join(parts)


RAW_VALUES = "open, high, low, close, adj_close, volume"
CLEAN_VALUES = "open_price, high_price, low_price, close_price, adj_close, volume"
DAILY_VALUES = (
    f"{CLEAN_VALUES}, daily_return, year, month, "
    + r6("avg_volume_20d", "volatility_20d", "cum_return")
)
SUMMARY_VALUES = "first_date, last_date, period_high, period_low, " + r6(
    "total_return", "avg_daily_volume", "avg_volatility"
)
MONTHLY_VALUES = (
    "year, month, month_open, month_close, month_high, month_low, month_volume, month_return, "
    + r6("avg_daily_return")
)
