"""Table schemas. Nothing in the library infers a type from data."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE_COLUMNS = ["open_price", "high_price", "low_price", "close_price"]
SERIES_KEYS = ["ticker", "trade_date"]


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, nullable) for name, kind, nullable in fields])


RAW_SCHEMA = _struct(
    ("ticker", T.StringType(), True),
    ("trade_date", T.DateType(), True),
    ("open", T.DoubleType(), True),
    ("high", T.DoubleType(), True),
    ("low", T.DoubleType(), True),
    ("close", T.DoubleType(), True),
    ("adj_close", T.DoubleType(), True),
    ("volume", T.LongType(), True),
)

BRONZE_SCHEMA = _struct(
    ("ticker", T.StringType(), False),
    ("trade_date", T.DateType(), False),
    ("open", T.DoubleType(), True),
    ("high", T.DoubleType(), True),
    ("low", T.DoubleType(), True),
    ("close", T.DoubleType(), True),
    ("adj_close", T.DoubleType(), True),
    ("volume", T.LongType(), True),
    ("source", T.StringType(), False),
    ("ingested_at", T.TimestampType(), False),
)

SILVER_SCHEMA = _struct(
    ("ticker", T.StringType(), False),
    ("trade_date", T.DateType(), False),
    ("open_price", T.DoubleType(), False),
    ("high_price", T.DoubleType(), False),
    ("low_price", T.DoubleType(), False),
    ("close_price", T.DoubleType(), False),
    ("adj_close", T.DoubleType(), True),
    ("volume", T.LongType(), False),
    ("daily_return", T.DoubleType(), True),
    ("processed_at", T.TimestampType(), False),
)

REJECTED_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType) for f in BRONZE_SCHEMA.fields]
    + [T.StructField("reject_reasons", T.ArrayType(T.StringType()))]
)

UNREAD_SCHEMA = _struct(
    ("file", T.StringType(), True),
    ("line", T.StringType(), True),
    ("reason", T.StringType(), True),
    ("load", T.StringType(), True),
)

LEDGER_SCHEMA = T.StructType(
    [T.StructField("trade_date", T.DateType())]
    + [
        T.StructField(name, T.LongType())
        for name in [
            "n_rows",
            "n_tickers",
            "null_ticker",
            "null_trade_date",
            "null_close_price",
            "null_volume",
            *[f"non_positive_{c}" for c in PRICE_COLUMNS],
            "nan_prices",
            "duplicate_rows",
        ]
    ]
)

DAILY_METRICS_SCHEMA = T.StructType(
    SILVER_SCHEMA.fields
    + _struct(
        ("avg_volume_20d", T.DoubleType(), True),
        ("volatility_20d", T.DoubleType(), True),
        ("year", T.IntegerType(), False),
        ("month", T.IntegerType(), False),
        ("cum_return", T.DoubleType(), True),
    ).fields
)

PORTFOLIO_SUMMARY_SCHEMA = _struct(
    ("ticker", T.StringType(), False),
    ("first_date", T.DateType(), True),
    ("last_date", T.DateType(), True),
    ("total_return", T.DoubleType(), True),
    ("avg_daily_volume", T.DoubleType(), True),
    ("avg_volatility", T.DoubleType(), True),
    ("period_high", T.DoubleType(), True),
    ("period_low", T.DoubleType(), True),
)

MONTHLY_RETURNS_SCHEMA = _struct(
    ("ticker", T.StringType(), False),
    ("year", T.IntegerType(), False),
    ("month", T.IntegerType(), False),
    ("month_open", T.DoubleType(), True),
    ("month_close", T.DoubleType(), True),
    ("month_high", T.DoubleType(), True),
    ("month_low", T.DoubleType(), True),
    ("month_volume", T.LongType(), True),
    ("avg_daily_return", T.DoubleType(), True),
    ("month_return", T.DoubleType(), True),
)

SERIES_STATES_SCHEMA = _struct(
    ("ticker", T.StringType(), False),
    ("year", T.IntegerType(), False),
    ("month", T.IntegerType(), False),
    (
        "tail",
        T.ArrayType(
            _struct(
                ("trade_date", T.DateType(), True),
                ("volume", T.LongType(), True),
                ("daily_return", T.DoubleType(), True),
            )
        ),
        True,
    ),
    ("growth", T.DoubleType(), True),
)

GOLD_SCHEMAS = {
    "series_states": SERIES_STATES_SCHEMA,
    "daily_metrics": DAILY_METRICS_SCHEMA,
    "portfolio_summary": PORTFOLIO_SUMMARY_SCHEMA,
    "monthly_returns": MONTHLY_RETURNS_SCHEMA,
}

HISTORY_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField(
            "results",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("symbol", T.StringType()),
                        T.StructField(
                            "historicalDataPrice",
                            T.ArrayType(
                                # text: a number may come quoted, or whole numbers as floats
                                _struct(
                                    ("date", T.StringType(), True),
                                    ("open", T.StringType(), True),
                                    ("high", T.StringType(), True),
                                    ("low", T.StringType(), True),
                                    ("close", T.StringType(), True),
                                    ("adjustedClose", T.StringType(), True),
                                    ("volume", T.StringType(), True),
                                )
                            ),
                        ),
                    ]
                )
            ),
        )
    ]
)


def with_decimal_prices(schema: T.StructType) -> T.StructType:
    """The same table with its price columns stored as decimal(18,4)."""
    prices = set(PRICE_COLUMNS) | {"adj_close"}
    return T.StructType(
        [
            T.StructField(f.name, T.DecimalType(18, 4), f.nullable) if f.name in prices else f
            for f in schema.fields
        ]
    )


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the schema's columns, in its order; a column the frame lacks becomes null."""
    have = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def empty(spark, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
