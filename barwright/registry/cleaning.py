"""Silver steps, quality checks and the incremental return."""

from pyspark.sql import functions as F

from barwright.functions.scalars import normalize_ticker
from barwright.operators import incremental, quality, silver
from barwright.registry.base import (
    CLEAN_VALUES,
    PROCESS_TIME,
    oracle,
    query,
    raw_brand,
    raw_part,
    silver_brand,
    silver_part,
)
from barwright.schemas import PRICE_COLUMNS
from barwright.session import staged
from barwright.sources import bars

_BAR_COLUMNS = ["ticker", "trade_date", *PRICE_COLUMNS, "adj_close", "volume"]
_TYPED = (
    "SELECT upper(ticker) AS ticker, trade_date, open AS open_price, high AS high_price, "
    "low AS low_price, close AS close_price, coalesce(adj_close, close) AS adj_close, volume FROM raw"
)
_RETURNS = "SELECT upper(ticker) AS ticker, trade_date, daily_return FROM silver"
_SILVER = f"SELECT upper(ticker) AS ticker, trade_date, {CLEAN_VALUES}, daily_return FROM silver"
_HAS_REQUIRED = (
    "ticker IS NOT NULL AND trade_date IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL"
)
_HAS_PRICES = "open > 0 AND high > 0 AND low > 0 AND close > 0"


def _typed(spark, folder):
    return silver.cast_types(raw_brand(spark, folder)).select(*_BAR_COLUMNS)


@query("cast_types", oracle(_TYPED))
def _(spark, folder):
    # every field as text, a missing close as text that is no number
    raw = raw_brand(spark, folder)
    text = raw.select(
        F.concat(F.lit(" \t"), F.lower("ticker"), F.lit("\n")).alias("ticker"),
        *[F.col(c).cast("string").alias(c) for c in raw.columns if c != "ticker"],
    ).fillna("n/a", subset=["close"])
    return silver.cast_types(text).select(*_BAR_COLUMNS)


@query(
    "normalize_ticker",
    "SELECT p_partkey, upper(p_brand) AS ticker FROM part",
)
def _(spark, folder):
    messy = F.concat(F.lit("\t "), F.lower("p_brand"), F.lit(" \n"))
    return bars.table(spark, folder, "part").select(
        "p_partkey", normalize_ticker(messy).alias("ticker")
    )


@query("remove_nulls", oracle(f"{_TYPED} WHERE {_HAS_REQUIRED}"))
def _(spark, folder):
    return silver.remove_nulls(_typed(spark, folder))


@query("remove_invalid_prices", oracle(f"{_TYPED} WHERE {_HAS_PRICES}"))
def _(spark, folder):
    return silver.remove_invalid_prices(_typed(spark, folder))


@query(
    "deduplicate",
    oracle(
        f"{_TYPED} QUALIFY row_number() OVER (PARTITION BY raw.ticker, trade_date "
        "ORDER BY raw.adj_close DESC NULLS LAST, close DESC NULLS LAST, volume DESC) = 1"
    ),
)
def _(spark, folder):
    return silver.deduplicate(_typed(spark, folder))


@query("daily_return", oracle(_RETURNS))
def _(spark, folder):
    clean = silver.clean_bars(raw_brand(spark, folder))
    return silver.add_daily_return(clean).select("ticker", "trade_date", "daily_return")


_SPLIT = "1998-01-01"


@query(
    "daily_return_incremental",
    oracle(_RETURNS, "part"),
)
def _(spark, folder):
    # bars before the split as loaded earlier, the rest as one later load: together a full run
    clean = staged(silver.clean_bars(raw_part(spark, folder)), "clean")
    before = F.col("trade_date") < F.lit(_SPLIT).cast("date")
    earlier = silver.add_daily_return(clean.where(before))
    bars = clean.where(~before)
    # some of the parts have no bar in the look-back window and are found in the older ones
    later = incremental.add_return_after(bars, incremental.prior_closes(earlier, bars, _SPLIT))
    columns = ["ticker", "trade_date", "daily_return"]
    return earlier.select(*columns).unionByName(later.select(*columns))


@query("silver_bars", oracle(_SILVER))
def _(spark, folder):
    return silver_brand(spark, folder).drop("processed_at")


@query("silver_bars_part", oracle(_SILVER, "part"))
def _(spark, folder):
    return silver_part(spark, folder).drop("processed_at")


@query(
    "silver_audit",
    oracle(
        f"""
, counts AS (SELECT count(*) AS n,
                    count(*) FILTER (WHERE {_HAS_REQUIRED}) AS n_usable,
                    count(*) FILTER (WHERE {_HAS_REQUIRED} AND {_HAS_PRICES}) AS n_priced,
                    (SELECT count(*) FROM clean) AS n_keys FROM raw)
SELECT 0 AS step_no, 'bronze_input' AS step, n AS rows_left FROM counts
UNION ALL SELECT 1, 'cast_types', n FROM counts
UNION ALL SELECT 2, 'remove_nulls', n_usable FROM counts
UNION ALL SELECT 3, 'remove_invalid_prices', n_priced FROM counts
UNION ALL SELECT 4, 'deduplicate', n_keys FROM counts
UNION ALL SELECT 5, 'daily_return', n_keys FROM counts"""
    ),
)
def _(spark, folder):
    return silver.silver_audit(raw_brand(spark, folder))


_AS_OF = "2001-06-30"


@query(
    "quality_report",
    oracle(
        f"""
, report AS (
  SELECT count(*) AS n_rows, max(trade_date) AS last_date,
         count(*) FILTER (WHERE ticker IS NULL) AS null_ticker,
         count(*) FILTER (WHERE trade_date IS NULL) AS null_trade_date,
         count(*) FILTER (WHERE close IS NULL) AS null_close_price,
         count(*) FILTER (WHERE volume IS NULL) AS null_volume,
         count(*) FILTER (WHERE open <= 0) AS non_positive_open_price,
         count(*) FILTER (WHERE high <= 0) AS non_positive_high_price,
         count(*) FILTER (WHERE low <= 0) AS non_positive_low_price,
         count(*) FILTER (WHERE close <= 0) AS non_positive_close_price,
         count(*) FILTER (WHERE isnan(open) OR isnan(high) OR isnan(low) OR isnan(close)) AS nan_prices,
         count(*) FILTER (WHERE trade_date > DATE '{_AS_OF}') AS future_dates,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT ticker, trade_date FROM raw) AS d)
           AS duplicate_rows
  FROM raw)
SELECT *, null_ticker + null_trade_date + null_close_price + null_volume + non_positive_open_price
          + non_positive_high_price + non_positive_low_price + non_positive_close_price + nan_prices
          + future_dates + duplicate_rows = 0 AS passed
FROM report"""
    ),
)
def _(spark, folder):
    return quality.quality_report(_typed(spark, folder), _AS_OF)


@query(
    "quality_report_clean",
    oracle(
        "SELECT count(*) AS n_rows, max(trade_date) AS last_date, "
        + ", ".join(
            f"CAST(0 AS BIGINT) AS {name}"
            for name in [
                "null_ticker",
                "null_trade_date",
                "null_close_price",
                "null_volume",
                *[f"non_positive_{c}" for c in PRICE_COLUMNS],
                "nan_prices",
                "future_dates",
                "duplicate_rows",
            ]
        )
        + ", true AS passed FROM clean",
        "part",
    ),
)
def _(spark, folder):
    return quality.quality_report(staged(silver_part(spark, folder), "silver"), PROCESS_TIME.date())


@query(
    "quarantine",
    oracle(
        """
SELECT upper(ticker) AS ticker, trade_date, open AS open_price, high AS high_price,
       low AS low_price, close AS close_price, coalesce(adj_close, close) AS adj_close, volume,
       concat_ws('; ', CASE WHEN close IS NULL THEN 'missing close_price' END,
                       CASE WHEN low < 0 THEN 'negative low_price' END) AS reasons
FROM raw WHERE close IS NULL OR low < 0"""
    ),
)
def _(spark, folder):
    rejected = quality.quarantine(_typed(spark, folder))
    return rejected.withColumn("reasons", F.concat_ws("; ", "reject_reasons")).drop("reject_reasons")


@query(
    "valid_rows",
    oracle(f"{_TYPED} WHERE close IS NOT NULL AND low >= 0"),
)
def _(spark, folder):
    return quality.valid_rows(_typed(spark, folder))
