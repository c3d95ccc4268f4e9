"""Layer jobs: what runs between the stored tables."""

from datetime import date, datetime, timezone
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barwright import fixed
from barwright.operators import gold, report
from barwright.operators.incremental import add_return_after, prior_closes
from barwright.operators.quality import checked_on_the_way, ledger, refuse
from barwright.operators.silver import (
    add_processed_at,
    clean_bars,
    count_rejected,
    in_window,
    rejected_rows,
    select_silver_columns,
    transform_silver,
)
from barwright.functions.scalars import normalize_ticker
from barwright.schemas import LEDGER_SCHEMA, SILVER_SCHEMA, conform
from barwright.session import remove, staged
from barwright.sources import feeds, layers


class Load(NamedTuple):
    """What a load stored, and how many rows it left out because of its window or tickers."""

    rows: int
    left_out: int


def load_bronze(
    raw: DataFrame,
    root: str,
    source: str = fixed.DEFAULT_SOURCE,
    tickers=None,
    start=None,
    end=None,
    days: int | None = None,
    ingested_at=None,
) -> Load:
    """Store raw bars: all of them, those from ``start`` up to ``end``, or of the last ``days`` days.

    With ``tickers`` named, in any case or spacing, only theirs. Every load adds to the ones before it;
    where tickers and dates meet, the latest load counts.
    """
    seen = Observation()
    rows = raw.observe(seen, F.count(F.lit(1)).alias("n"))
    if not (start is None and end is None and days is None):
        rows = in_window(rows, start, end, days or fixed.HISTORY_DAYS)
    if tickers is not None:
        rows = rows.where(normalize_ticker("ticker").isin([normalize_ticker(F.lit(t)) for t in tickers]))
    stored = layers.write_bronze(rows, root, source, ingested_at)
    # a plan that turns out empty is cut short, and what was counted below is lost with it
    return Load(stored, (seen.get["n"] if stored else raw.count()) - stored)


def load_feed_files(
    spark: SparkSession, path, columns, root: str, source: str = fixed.DEFAULT_SOURCE, ticker=None, sep: str = ",", **options
) -> Load:
    """Landed delimited files into bronze; lines that don't fit their header are kept (``layers.read_unread``).

    ``ticker`` is as in ``feeds.normalize_feed``, the other options as in ``load_bronze``.
    """
    feed = feeds.read_feed_files(spark, path, columns, sep).withColumn("_file", F.input_file_name())
    load = load_bronze(feeds.normalize_feed(feeds.intact(feed), ticker), root, source, **options)
    bad = feeds.rejected(feed).select(
        F.col("_file").alias("file"), F.col(feeds.CORRUPT).alias("line"), F.lit("another number of fields than the header").alias("reason")
    )
    layers.write_unread(bad, spark.read.text(path).inputFiles(), root, source)
    return load


def load_json_files(spark: SparkSession, path, root: str, source: str = fixed.DEFAULT_SOURCE, **options) -> Load:
    """Landed JSON responses into bronze; those without a price history are kept (``layers.read_unread``)."""
    responses = feeds.read_json_responses(spark, path)
    load = load_bronze(feeds.flatten_history(responses), root, source, **options)
    bad = feeds.rejected_responses(responses.withColumn("file", F.input_file_name()))
    layers.write_unread(bad.withColumnRenamed("value", "line"), responses.inputFiles(), root, source)
    return load


def build_silver(
    spark: SparkSession,
    root: str,
    source: str | None = None,
    trade_date=None,
    since=None,
    as_of=None,
    processed_at=None,
) -> int:
    """Bronze to silver: all dates, one ``trade_date``, or all dates from ``since`` on.

    All sources go in; bars that several have fold into one per ticker and date. With a ``source``
    named, the run starts at its first date, and takes in what the other sources have from there on.
    A partial run looks up each ticker's last close ahead of it, so its returns are those a full
    run would give. A date also settles the return of the bar after it: if silver holds later dates
    than ``trade_date``, the run goes on from there as with ``since``.

    Bars and rejected rows of the run are written aside, checked by the tasks that write them, and
    published together, with a ledger of the checks per date: a run that fails at any point leaves silver as it was. Dates of the run that
    have no valid bar (any more) have none from then on, and rejected rows are those of the last run
    over their date. Superseded folders go, but for those of the run before.
    """
    if source is not None and trade_date is None and since is None:
        since = min(layers.bronze_dates(spark, root, source), default=None)
        if since is None:
            return 0
    stored = layers.silver_dates(spark, root)
    if source is not None and trade_date is None:
        others = [d for s in layers.bronze_sources(spark, root) for d in layers.bronze_dates(spark, root, s)[:1]]
        if str(since) <= min([*others, *stored[:1]]):
            since = None  # nothing lies ahead of it: a full run
    if trade_date is not None and since is None and any(d > str(trade_date) for d in stored):
        trade_date, since = None, trade_date
    raw = layers.read_bronze(spark, root, None, trade_date, since)
    first = trade_date or since
    if first is None and raw.isEmpty():
        return 0
    held, bad = [], Observation()
    run = layers.SilverRun(spark, root, first, trade_date)
    try:
        watched = raw.observe(bad, count_rejected().alias("n"))
        if first is None:
            clean = transform_silver(watched, processed_at)
        else:
            bars = staged(clean_bars(watched), "clean", held)
            prior = prior_closes(layers.read_silver(spark, root), bars, first, held=held)
            clean = select_silver_columns(add_processed_at(add_return_after(bars, prior), processed_at))
        checked, seen = checked_on_the_way(clean, as_of)
        n_rows = run.write(conform(checked, SILVER_SCHEMA), "bars")
        refuse(seen.get)
        if not n_rows or bad.get["n"]:  # without a valid row, the plan was cut short and counted nothing
            run.write(rejected_rows(raw), "rejected")
        else:
            run.covers_without_rows("rejected")
        run.write(conform(ledger(run.written("bars", SILVER_SCHEMA)), LEDGER_SCHEMA), "ledger")
        run.publish()
        layers.expire_silver(spark, root)
        return n_rows
    finally:
        run.discard()
        remove(spark, *held)


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    daily = gold.daily_metrics(silver)
    return {
        "daily_metrics": daily,
        "portfolio_summary": gold.portfolio_summary(daily),
        "monthly_returns": gold.monthly_returns(silver),
    }


def build_gold(spark: SparkSession, root: str, states: bool = False) -> dict[str, int]:
    """Rebuild the gold tables from all of silver; returns rows per table.

    The summary reads the daily table just written instead of computing its windows again. With ``states``,
    the states that ``extend_gold`` goes on from are stored as well.
    """
    silver = layers.read_silver(spark, root)
    if silver.isEmpty():
        return {}
    rows = {"daily_metrics": layers.write_gold(gold.daily_metrics(silver), root, "daily_metrics")}
    daily = layers.read_gold(spark, root, "daily_metrics")
    tables = {
        "portfolio_summary": gold.portfolio_summary(daily),
        "monthly_returns": gold.monthly_returns(silver),
    }
    if states:
        tables["series_states"] = gold.month_states(silver)
    for name, table in tables.items():
        rows[name] = layers.write_gold(table, root, name)
    return rows


def extend_gold(spark: SparkSession, root: str, since) -> dict[str, int]:
    """Bring gold up to date after silver has changed from date ``since`` on; returns rows per table.

    Months from that of ``since`` on are computed from their own silver rows and every ticker's state at
    their start; earlier months are neither read nor written, whatever the order the dates came in. The
    summary is gathered from the daily table. Without stored states it is a full build that stores them.
    """
    states = layers.read_gold(spark, root, "series_states")
    if states.isEmpty():
        return build_gold(spark, root, states=True)
    first = date.fromisoformat(str(since)).replace(day=1)
    silver = layers.read_silver(spark, root, since=first)
    held = []
    try:
        before = staged(gold.last_states(states, first.year, first.month), "states", held)
        tables = {
            "daily_metrics": gold.daily_metrics_after(silver, before),
            "monthly_returns": gold.monthly_returns(silver),
            "series_states": gold.month_states(silver, before),
        }
        months = {(int(d[:4]), int(d[5:7])) for d in layers.silver_dates(spark, root)}
        rows = {name: layers.write_gold_since(table, root, name, first, months) for name, table in tables.items()}
    finally:
        remove(spark, *held)
    daily = layers.read_gold(spark, root, "daily_metrics")
    rows["portfolio_summary"] = layers.write_gold(gold.portfolio_summary(daily), root, "portfolio_summary")
    return rows


def report_sections(
    daily: DataFrame, summary: DataFrame, monthly: DataFrame, tickers=fixed.FOCUS_TICKERS, correlated=None
) -> dict[str, DataFrame]:
    """The dataset of every report section whose input has rows, in percent and with labels as shown.

    ``tickers`` are those of the volatility, heatmap and Bollinger sections. ``correlated`` names those of
    the correlation section; all of them by default, whose square is the section's size.
    """
    sections = {}
    if not summary.isEmpty():
        sections["summary_table"] = report.report_summary_table(summary)
        sections["risk_return"] = report.risk_return(summary)
    if not monthly.isEmpty():
        sections["monthly_heatmap"] = report.monthly_heatmap(monthly, tickers)
    if not daily.isEmpty():
        sections["cumulative_return"] = report.cumulative_series(daily)
        sections["volatility"] = report.volatility_series(daily, tickers)
        sections["correlation"] = report.correlations(daily, correlated)
        sections["portfolio_backtest"] = report.backtest_series(daily)
        shown = daily.where(F.col("ticker").isin(list(tickers))).agg(F.min("ticker")).first()[0]
        if shown is not None:
            sections["bollinger_bands"] = report.bollinger_series(daily, shown)
    return sections


def report_folder(root: str, report_time: datetime) -> str:
    return f"{root}/reports/{report_time.strftime(fixed.REPORT_NAME_FORMAT)}"


def build_report(
    spark: SparkSession, root: str, report_time: datetime | None = None, tickers=fixed.FOCUS_TICKERS, correlated=None
) -> str | None:
    """Write every section as Parquet under one folder and return it; None if gold is empty."""
    sections = report_sections(
        *[
            layers.read_gold(spark, root, name)
            for name in ("daily_metrics", "portfolio_summary", "monthly_returns")
        ],
        tickers=tickers,
        correlated=correlated,
    )
    if not sections:
        return None
    folder = report_folder(root, report_time or datetime.now(timezone.utc))
    for name, rows in sections.items():
        rows.write.mode("overwrite").parquet(f"{folder}/{name}")
    return folder


def run_all(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    source: str = fixed.DEFAULT_SOURCE,
    tickers=None,
    start: date | None = None,
    end: date | None = None,
    report_time: datetime | None = None,
) -> dict:
    """Raw bars through all layers; returns rows per table, rows left out, and the report folder."""
    load = load_bronze(raw, root, source, tickers, start, end)
    result = {"bronze": load.rows, "left_out": load.left_out}
    result["silver"] = build_silver(spark, root)
    result.update(build_gold(spark, root))
    result["report"] = build_report(spark, root, report_time)
    return result
