"""Stored layers: what was written is read back.

Bars of events and orders have tens of dates, those of lineitem thousands; a partition folder per
date is what the layers are for, but thousands of folders with a few rows each are not, so the
whole event and order tables make the round trips.
"""

from datetime import date

from pyspark.sql import functions as F

from barwright.operators import gold, quality
from barwright.plans import medallion
from barwright.registry.base import (
    CLEAN_VALUES,
    DAILY_VALUES,
    LOAD_TIME,
    MONTHLY_VALUES,
    PROCESS_TIME,
    RAW_VALUES,
    RAW_WITH_DEFECTS,
    SUMMARY_VALUES,
    daily_part,
    oracle,
    query,
    silver_brand,
    silver_events,
)
from barwright.schemas import LEDGER_SCHEMA
from barwright.session import new_folder
from barwright.sources import bars, layers

_DAY = "2024-01-15"
_START, _MIDDLE, _END = date(1900, 1, 1), date(2024, 1, 16), date(2100, 1, 1)


def _user_bars(spark, folder):
    return bars.bars_from_events(spark, folder, by="user_id")


_BRONZE = f"SELECT ticker, trade_date, {RAW_VALUES}, 'events' AS source FROM raw"


@query("bronze_roundtrip", oracle(_BRONZE, "users"))
def _(spark, folder):
    root = new_folder(spark, "lake")
    layers.write_bronze(_user_bars(spark, folder), root, "events", LOAD_TIME)
    return layers.read_bronze(spark, root, "events").drop("ingested_at")


@query("bronze_read_date", oracle(f"{_BRONZE} WHERE trade_date = DATE '{_DAY}'", "users"))
def _(spark, folder):
    root = new_folder(spark, "lake")
    layers.write_bronze(_user_bars(spark, folder), root, "events", LOAD_TIME)
    return layers.read_bronze(spark, root, "events", _DAY).drop("ingested_at")


_SILVER = f"SELECT upper(ticker) AS ticker, trade_date, {CLEAN_VALUES}, daily_return FROM silver"


@query("silver_roundtrip", oracle(_SILVER, "events"))
def _(spark, folder):
    root = new_folder(spark, "lake")
    layers.write_silver(silver_events(spark, folder), root)
    return layers.read_silver(spark, root).drop("processed_at")


@query("silver_read_date", oracle(f"{_SILVER} WHERE trade_date = DATE '{_DAY}'", "events"))
def _(spark, folder):
    root = new_folder(spark, "lake")
    layers.write_silver(silver_events(spark, folder), root)
    return layers.read_silver(spark, root, _DAY).drop("processed_at")


_MONTHLY = f"SELECT upper(ticker) AS ticker, {MONTHLY_VALUES} FROM monthly"


@query("gold_roundtrip", oracle(_MONTHLY))
def _(spark, folder):
    root = new_folder(spark, "lake")
    layers.write_gold(gold.monthly_returns(silver_brand(spark, folder)), root, "monthly_returns")
    return layers.read_gold(spark, root, "monthly_returns")


_DAILY = f"SELECT upper(ticker) AS ticker, trade_date, {DAILY_VALUES} FROM daily"


@query("gold_roundtrip_part", oracle(_DAILY, "part"))
def _(spark, folder):
    root = new_folder(spark, "lake")
    layers.write_gold(daily_part(spark, folder), root, "daily_metrics")
    return layers.read_gold(spark, root, "daily_metrics").drop("processed_at")


@query("full_batch", oracle(_DAILY, "users"))
def _(spark, folder):
    """Bronze, silver and gold, loaded in two runs of which the second is repeated."""
    root = new_folder(spark, "lake")
    raw = _user_bars(spark, folder)
    medallion.load_bronze(raw, root, "events", start=_START, end=_MIDDLE)
    for _ in range(2):
        medallion.load_bronze(raw, root, "events", start=_MIDDLE, end=_END)
    medallion.build_silver(spark, root, "events", processed_at=PROCESS_TIME)
    medallion.build_gold(spark, root)
    return layers.read_gold(spark, root, "daily_metrics").drop("processed_at")


@query("full_batch_since", oracle(_DAILY, "users"))
def _(spark, folder):
    """As two loads: silver for the first dates, then for the later ones on top of them."""
    root = new_folder(spark, "lake")
    raw = _user_bars(spark, folder)
    medallion.load_bronze(raw, root, "events", start=_START, end=_MIDDLE)
    medallion.build_silver(spark, root, "events", processed_at=PROCESS_TIME)
    medallion.load_bronze(raw, root, "events", start=_MIDDLE, end=_END)
    medallion.build_silver(spark, root, "events", since=_MIDDLE, processed_at=PROCESS_TIME)
    medallion.build_gold(spark, root)
    return layers.read_gold(spark, root, "daily_metrics").drop("processed_at")


@query(
    "full_batch_summary",
    oracle(f"SELECT upper(ticker) AS ticker, {SUMMARY_VALUES} FROM summary", "events"),
)
def _(spark, folder):
    """All four jobs, report included."""
    root = new_folder(spark, "lake")
    medallion.run_all(spark, bars.bars_from_events(spark, folder), root, "events", start=_START, end=_END)
    return layers.read_gold(spark, root, "portfolio_summary")


def _tickers(raw):
    """All tickers of a frame with few of them."""
    return sorted(r["ticker"] for r in raw.select("ticker").distinct().collect())


@query(
    "bronze_load_by_ticker",
    oracle(f"SELECT ticker, trade_date, {RAW_VALUES}, 'events' AS source FROM raw", "events"),
)
def _(spark, folder):
    """Some tickers, the others, and the first ones again."""
    root = new_folder(spark, "lake")
    raw = bars.bars_from_events(spark, folder)
    tickers = _tickers(raw)
    for some in (tickers[::2], [f" {t.lower()} " for t in tickers[1::2]], tickers[::2]):
        medallion.load_bronze(raw, root, "events", tickers=some, start=_START, end=_END)
    return layers.read_bronze(spark, root, "events").drop("ingested_at")


def _loaded_piecemeal(spark, folder):
    """Two loads that share all dates and no ticker, a wrong third one for some, and its correction."""
    root = new_folder(spark, "lake")
    raw = _user_bars(spark, folder)
    odd = F.crc32("ticker") % 2 == 1
    wrong = raw.where(odd).withColumn("close", F.col("close") + 1)
    for part in (raw.where(~odd), wrong, raw.where(odd), raw.where(~odd)):
        medallion.load_bronze(part, root, "events", ingested_at=LOAD_TIME)
    return root


@query("bronze_two_loads", oracle(_BRONZE, "users"))
def _(spark, folder):
    return layers.read_bronze(spark, _loaded_piecemeal(spark, folder), "events").drop("ingested_at")


@query("bronze_compacted", oracle(_BRONZE, "users"))
def _(spark, folder):
    root = _loaded_piecemeal(spark, folder)
    layers.compact_bronze(spark, root, "events")
    return layers.read_bronze(spark, root, "events").drop("ingested_at")


@query("bronze_read_since", oracle(f"{_BRONZE} WHERE trade_date >= DATE '{_DAY}'", "users"))
def _(spark, folder):
    root = new_folder(spark, "lake")
    layers.write_bronze(_user_bars(spark, folder), root, "events", LOAD_TIME)
    return layers.read_bronze(spark, root, "events", since=_DAY).drop("ingested_at")


@query("silver_two_sources", oracle(_SILVER, "events"))
def _(spark, folder):
    """Two sources that share some bars, through one silver table, built twice."""
    root = new_folder(spark, "lake")
    raw = bars.bars_from_events(spark, folder)
    tickers = _tickers(raw)
    medallion.load_bronze(raw, root, "first", tickers=tickers[:-1], start=_START, end=_END)
    medallion.load_bronze(raw, root, "second", tickers=tickers[1:], start=_START, end=_END)
    for _ in range(2):
        medallion.build_silver(spark, root, processed_at=PROCESS_TIME)
    return layers.read_silver(spark, root).drop("processed_at")


@query("silver_one_source", oracle(_SILVER, "events"))
def _(spark, folder):
    """A run for one source after one for all."""
    root = new_folder(spark, "lake")
    raw = bars.bars_from_events(spark, folder)
    first = F.crc32("ticker") % 2 == 0
    medallion.load_bronze(raw.where(first), root, "first")
    medallion.load_bronze(raw.where(~first), root, "second")
    medallion.build_silver(spark, root, processed_at=PROCESS_TIME)
    medallion.build_silver(spark, root, source="first", processed_at=PROCESS_TIME)
    return layers.read_silver(spark, root).drop("processed_at")


def _corrected(spark, folder, since):
    """A date whose bars are corrected to invalid prices after all layers were built."""
    root = new_folder(spark, "lake")
    raw = _user_bars(spark, folder)
    medallion.load_bronze(raw, root, "events", start=_START, end=_END)
    medallion.build_silver(spark, root, processed_at=PROCESS_TIME)
    medallion.build_gold(spark, root)
    spoilt = raw.where(F.col("trade_date") == F.lit(_DAY).cast("date")).withColumn("open", F.lit(-1.0))
    medallion.load_bronze(spoilt, root, "events", start=_START, end=_END)
    medallion.build_silver(spark, root, since=since, processed_at=PROCESS_TIME)
    medallion.build_gold(spark, root)
    return layers.read_gold(spark, root, "daily_metrics").drop("processed_at")


_WITHOUT_DAY = oracle(_DAILY, "users").replace(
    "SELECT * FROM bars", f"SELECT * FROM bars WHERE trade_date <> DATE '{_DAY}'"
)


@query("full_batch_corrected", _WITHOUT_DAY)
def _(spark, folder):
    return _corrected(spark, folder, None)


@query("full_batch_corrected_since", _WITHOUT_DAY)
def _(spark, folder):
    return _corrected(spark, folder, _DAY)


@query("full_batch_out_of_order", oracle(_DAILY, "users"))
def _(spark, folder):
    """One date comes after later ones."""
    root = new_folder(spark, "lake")
    raw = _user_bars(spark, folder)
    late = F.col("trade_date") == F.lit(_DAY).cast("date")
    medallion.load_bronze(raw.where(~late), root, "events", start=_START, end=_END)
    medallion.build_silver(spark, root, processed_at=PROCESS_TIME)
    medallion.load_bronze(raw.where(late), root, "events", start=_START, end=_END)
    medallion.build_silver(spark, root, trade_date=_DAY, processed_at=PROCESS_TIME)
    medallion.build_gold(spark, root)
    return layers.read_gold(spark, root, "daily_metrics").drop("processed_at")


@query(
    "silver_job_quarantine",
    oracle(
        """
, told AS (
  SELECT close IS NOT NULL AND volume IS NOT NULL AND open > 0 AND high > 0 AND low > 0 AND close > 0 AS sound
  FROM raw)
SELECT count(*) AS n_raw, (SELECT count(*) FROM clean) AS n_kept,
       count(*) FILTER (WHERE sound IS NOT TRUE) AS n_rejected,
       count(*) FILTER (WHERE sound) - (SELECT count(*) FROM clean) AS n_repeated
FROM told""",
        "users",
    ).replace("SELECT * FROM bars", RAW_WITH_DEFECTS),
)
def _(spark, folder):
    """Every row that goes into the silver job is kept, rejected with a reason, or a repeat."""
    root = new_folder(spark, "lake")
    raw = bars.with_defects(_user_bars(spark, folder))
    medallion.load_bronze(raw, root, "events", start=_START, end=_END)
    medallion.build_silver(spark, root, processed_at=PROCESS_TIME)
    counts = {
        "n_raw": layers.read_bronze(spark, root, "events"),
        "n_kept": layers.read_silver(spark, root),
        "n_rejected": layers.read_rejected(spark, root).where("size(reject_reasons) > 0"),
    }
    one = spark.range(1).select(*[df.agg(F.count(F.lit(1))).scalar().alias(n) for n, df in counts.items()])
    return one.withColumn("n_repeated", F.expr("n_raw - n_kept - n_rejected"))


@query(
    "rejects_after_correction",
    oracle(
        f"""
SELECT ticker, trade_date, {RAW_VALUES}, 'not positive low_price' AS reasons
FROM (SELECT * REPLACE (-low AS low) FROM raw) AS r WHERE trade_date < DATE '{_DAY}'""",
        "users",
    ),
)
def _(spark, folder):
    """All bars are rejected; those from a date on are corrected, and silver built again from there."""
    root = new_folder(spark, "lake")
    raw = _user_bars(spark, folder)
    medallion.load_bronze(raw.withColumn("low", -F.col("low")), root, "events", ingested_at=LOAD_TIME)
    medallion.build_silver(spark, root, processed_at=PROCESS_TIME)
    medallion.load_bronze(raw, root, "events", start=_DAY, end=_END, ingested_at=LOAD_TIME)
    medallion.build_silver(spark, root, since=_DAY, processed_at=PROCESS_TIME)
    rejected = layers.read_rejected(spark, root).drop("source", "ingested_at")
    return rejected.withColumn("reasons", F.concat_ws("; ", "reject_reasons")).drop("reject_reasons")


_LEDGER_ZEROS = ", ".join(
    f"CAST(0 AS BIGINT) AS {name}"
    for name in LEDGER_SCHEMA.fieldNames() + ["future_dates"]
    if name not in ("trade_date", "n_rows", "n_tickers")
)


@query(
    "quality_from_ledger",
    oracle(f"SELECT count(*) AS n_rows, max(trade_date) AS last_date, {_LEDGER_ZEROS}, true AS passed FROM clean", "users").replace(
        "SELECT * FROM bars", f"SELECT * FROM bars WHERE trade_date <> DATE '{_DAY}'"
    ),
)
def _(spark, folder):
    """The gate's figures over all of silver, after a date has lost its bars, from the runs' ledgers."""
    root = new_folder(spark, "lake")
    raw = _user_bars(spark, folder)
    medallion.load_bronze(raw, root, "events")
    medallion.build_silver(spark, root, processed_at=PROCESS_TIME)
    spoilt = raw.where(F.col("trade_date") == F.lit(_DAY).cast("date")).withColumn("open", F.lit(-1.0))
    medallion.load_bronze(spoilt, root, "events")
    medallion.build_silver(spark, root, since=_DAY, processed_at=PROCESS_TIME)
    return quality.report_of_ledger(layers.read_ledger(spark, root), _END)


@query(
    "coverage_by_date",
    oracle("SELECT trade_date, count(*) AS n_rows, count(DISTINCT ticker) AS n_tickers FROM clean GROUP BY 1", "users"),
)
def _(spark, folder):
    """Bars and tickers per date, from the ledger of two runs."""
    root = new_folder(spark, "lake")
    raw = _user_bars(spark, folder)
    for start, end in ((_START, _MIDDLE), (_MIDDLE, _END)):
        medallion.load_bronze(raw, root, "events", start=start, end=end)
        medallion.build_silver(spark, root, since=None if start == _START else start, processed_at=PROCESS_TIME)
    return layers.read_ledger(spark, root).select("trade_date", "n_rows", "n_tickers")
