"""Raw bars to clean bars with daily returns."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright import fixed
from barwright.functions.scalars import (
    all_present,
    normalize_ticker,
    ratio_minus_one,
    whole_number,
)
from barwright.functions.series import by_date
from barwright.schemas import PRICE_COLUMNS, SERIES_KEYS, SILVER_SCHEMA

WHOLE = {"bigint", "int", "smallint", "tinyint"}
REQUIRED_COLUMNS = ["ticker", "trade_date", "close_price", "volume"]


def cast_types(df: DataFrame) -> DataFrame:
    """Typed price columns next to the raw ones, typed keys, normal tickers.

    Text that is not a number or a date becomes null instead of ending the load; the null filter
    then drops the row and ``quality.quarantine`` keeps it with its reason.
    """

    def typed(name, kind):
        return F.col(name).try_cast(kind)

    adj_close = typed("adj_close", "double") if "adj_close" in df.columns else F.lit(None).cast("double")
    return df.withColumns(
        {
            "open_price": typed("open", "double"),
            "high_price": typed("high", "double"),
            "low_price": typed("low", "double"),
            "close_price": typed("close", "double"),
            "adj_close": F.coalesce(adj_close, typed("close", "double")),
            # a stored whole number stays a plain column, so that its filter reaches the scan
            "volume": typed("volume", "bigint") if dict(df.dtypes)["volume"] in WHOLE else whole_number("volume"),
            "trade_date": typed("trade_date", "date"),
            "ticker": normalize_ticker("ticker"),
        }
    )


def has_required() -> Column:
    return all_present(*REQUIRED_COLUMNS)


def has_valid_prices() -> Column:
    """All four prices are numbers above zero. A null price makes this null, which a filter drops."""
    return reduce(and_, [(F.col(c) > 0) & ~F.isnan(c) for c in PRICE_COLUMNS])


def remove_nulls(df: DataFrame) -> DataFrame:
    return df.where(has_required())


def remove_invalid_prices(df: DataFrame) -> DataFrame:
    return df.where(has_valid_prices())


def deduplicate(df: DataFrame) -> DataFrame:
    """One row per (ticker, trade_date): the largest adj_close; NaN loses to any number, null to both.

    Ties fall to the larger close, volume and load time, then to the other columns, so the winner
    never depends on the order of the input. As an aggregate (not a row_number window) it keeps one
    candidate per key and map task before anything is shuffled, so a bar copied into a third of all
    rows costs one row per task.
    """
    preferred = [c for c in ["adj_close", "close_price", "volume", "ingested_at"] if c in df.columns]
    others = [c for c in df.columns if c not in preferred and c not in SERIES_KEYS]
    ranked = []
    for c in preferred:
        if c in ("adj_close", "close_price"):  # NaN would be the largest value: numbers rank first
            ranked.append((F.col(c).isNotNull() & ~F.isnan(c)).alias(f"_number_{c}"))
        ranked.append(F.col(c))
    winner = df.groupBy(*SERIES_KEYS).agg(F.max(F.struct(*ranked, *others)).alias("_winner"))
    return winner.select(
        *[F.col(c) if c in SERIES_KEYS else F.col(f"_winner.{c}").alias(c) for c in df.columns]
    )


def add_daily_return(df: DataFrame) -> DataFrame:
    """close / previous close - 1 within a ticker; null on its first date."""
    previous = F.lag("close_price").over(by_date())
    return df.withColumn("daily_return", ratio_minus_one("close_price", previous))


def add_processed_at(df: DataFrame, processed_at=None) -> DataFrame:
    stamp = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp")
    return df.withColumn("processed_at", stamp)


def select_silver_columns(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in SILVER_SCHEMA.fieldNames() if c in df.columns])


def _reject_reasons(column) -> list[Column]:
    """What keeps a row from silver, each null where it doesn't hold; ``column`` gives a typed column."""
    checks = {f"missing {c}": column(c).isNull() for c in [*REQUIRED_COLUMNS, *PRICE_COLUMNS]}
    checks |= {f"not positive {c}": column(c) <= 0 for c in PRICE_COLUMNS}
    checks |= {f"no number {c}": F.isnan(column(c)) for c in PRICE_COLUMNS}
    return [F.when(bad, F.lit(name)) for name, bad in checks.items()]


def rejected_rows(df: DataFrame) -> DataFrame:
    """The raw rows that ``clean_bars`` drops other than as repeats, with ``reject_reasons``."""
    typed = cast_types(df.select("*", F.struct(*df.columns).alias("_raw")))
    marked = typed.select("_raw", F.array_compact(F.array(*_reject_reasons(F.col))).alias("reject_reasons"))
    return marked.where(F.size("reject_reasons") > 0).select("_raw.*", "reject_reasons")


def count_rejected() -> Column:
    """How many rows of stored raw bars ``rejected_rows`` would return: an aggregate over their columns."""
    stored = {name: name.removesuffix("_price") for name in PRICE_COLUMNS}
    return F.count_if(F.coalesce(*_reject_reasons(lambda c: F.col(stored.get(c, c)))).isNotNull())


def clean_bars(df: DataFrame) -> DataFrame:
    """Everything up to the return: typed, filtered, one row per (ticker, trade_date)."""
    keep = set(SILVER_SCHEMA.fieldNames()) | {"ingested_at"}
    typed = cast_types(df)
    return (
        typed.select(*[c for c in typed.columns if c in keep])
        .transform(remove_nulls)
        .transform(remove_invalid_prices)
        .transform(deduplicate)
    )


def transform_silver(df: DataFrame, processed_at=None) -> DataFrame:
    """Bronze rows to silver rows.

    Not sorted: every reader that needs an order states it, and the writer sorts within files.
    """
    return (
        clean_bars(df)
        .transform(add_daily_return)
        .transform(lambda d: add_processed_at(d, processed_at))
        .transform(select_silver_columns)
    )


def in_window(df: DataFrame, start=None, end=None, days: int = fixed.HISTORY_DAYS) -> DataFrame:
    """Dates from ``start`` (inclusive) to ``end`` (exclusive); by default the last ``days`` days."""
    last = F.current_date() if end is None else F.lit(end).cast("date")
    first = F.date_sub(last, days) if start is None else F.lit(start).cast("date")
    return df.where((F.col("trade_date") >= first) & (F.col("trade_date") < last))


def silver_audit(df: DataFrame) -> DataFrame:
    """Rows left after each silver step, from one pass over the raw rows.

    Counts are folded per (ticker, trade_date) first, which is what the deduplication step needs,
    and that fold happens before the shuffle.
    """
    usable = has_required()
    priced = F.coalesce(usable & has_valid_prices(), F.lit(False))
    per_key = (
        cast_types(df)
        .groupBy(*SERIES_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(usable).alias("n_usable"),
            F.count_if(priced).alias("n_priced"),
        )
    )
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("n_usable"), F.lit(0)).alias("n_usable"),
        F.coalesce(F.sum("n_priced"), F.lit(0)).alias("n_priced"),
        F.count_if(F.col("n_priced") > 0).alias("n_keys"),
    )
    steps = [
        ("bronze_input", "n"),
        ("cast_types", "n"),
        ("remove_nulls", "n_usable"),
        ("remove_invalid_prices", "n_priced"),
        ("deduplicate", "n_keys"),
        ("daily_return", "n_keys"),
    ]
    return totals.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i).alias("step_no"),
                        F.lit(step).alias("step"),
                        F.col(source).alias("rows_left"),
                    )
                    for i, (step, source) in enumerate(steps)
                ]
            )
        )
    )
