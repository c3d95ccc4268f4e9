"""The stored layers: Parquet tables that a load can be repeated into without doubling rows.

Bars are partitioned by trade_date and gold tables by year and month. Ahead of a write, rows are
rebalanced on the partition columns: one task writes many small partitions, and a partition too big
for one task is split, so neither small files nor one heavy day become a problem.

Bronze is a folder per load. Reads take, for every ticker and date of a source, the rows of the latest
load that has some: a load adds to the ones before it, repeating it changes nothing, and a correction
wins. Which dates have several loads is known from the folder names; only their older loads are matched
against the newer ones. ``compact_bronze`` folds them.

Silver is a folder per run, which holds the bars and the rejected rows of the dates it covers. For every
date the latest run that covers it counts. Both are written aside and published in one step, so a run
that fails leaves the table as it was.
"""

from collections import defaultdict
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright import fixed
from barwright.functions.scalars import normalize_ticker
from barwright.schemas import (
    BRONZE_SCHEMA,
    GOLD_SCHEMAS,
    LEDGER_SCHEMA,
    REJECTED_SCHEMA,
    SILVER_SCHEMA,
    UNREAD_SCHEMA,
    conform,
    empty,
)
from barwright.session import new_folder, remove
from barwright.sources import versions


def bronze_path(root: str, source: str = fixed.DEFAULT_SOURCE) -> str:
    return f"{root}/bronze/{source}"


def bronze_sources(spark: SparkSession, root: str) -> list[str]:
    """The sources that were loaded."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(bronze_path(root, "*"))
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return sorted(status.getPath().getName() for status in found or [])


def silver_path(root: str) -> str:
    """Bars and rejected rows, by run."""
    return f"{root}/silver"


def gold_path(root: str, name: str) -> str:
    return f"{root}/gold/{name}"


def _missing(spark: SparkSession, path: str) -> str | None:
    """The uppermost folder of ``path`` that isn't there yet."""
    place, missing = spark._jvm.org.apache.hadoop.fs.Path(path), None
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    while place is not None and not files.exists(place):
        place, missing = place.getParent(), place.toString()
    return missing


def _write(
    df: DataFrame, path: str, partitions, order, mode: str = "overwrite", whole: bool = False
) -> int:
    """Write and return the number of rows, counted by the write itself.

    With partitions only those with rows are touched, unless the ``whole`` table is replaced: then
    partitions without rows go. ``df`` must not read what a whole write replaces. Without rows no new
    folder is left.
    """
    made = _missing(df.sparkSession, path)
    counted = Observation()
    rows = df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *order)
    writer = (
        rows.observe(counted, F.count(F.lit(1)).alias("n"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "static" if whole else "dynamic")
    )
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(path)
    n_rows = counted.get["n"]
    if made and not n_rows:
        remove(df.sparkSession, made)
    return n_rows


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    try:
        stored = spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty(spark, schema)
    # partition columns come back last; restore the declared order
    return stored.select(*schema.fieldNames())


def with_load_columns(df: DataFrame, source: str, ingested_at=None) -> DataFrame:
    stamp = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    return df.withColumn("source", F.lit(source)).withColumn("ingested_at", stamp)


def _folders(spark: SparkSession, pattern: str) -> list[tuple[str, str, str]]:
    """(number, trade_date, path) of the date folders that match."""
    found = []
    for path in versions.listed(spark, f"{pattern}/trade_date=*"):
        numbered = next(part for part in path.split("/") if part.startswith(("load=", "version=")))
        found.append((numbered.split("=")[1], path.rsplit("=", 1)[1], path))
    return found


def _within(dates, trade_date, since):
    """Dates as folder names: one, those from ``since`` on, or all."""
    for d in dates:
        if trade_date is not None:
            if d == str(trade_date):
                yield d
        elif since is None or (d >= str(since) and d[0].isdigit()):
            yield d


def _read_folders(spark: SparkSession, base: str, paths, schema) -> DataFrame:
    if not paths:
        return empty(spark, schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*paths)


# --- bronze -----------------------------------------------------------------------------------

_LOAD = "load"


def write_bronze(
    df: DataFrame, root: str, source: str = fixed.DEFAULT_SOURCE, ingested_at=None
) -> int:
    """Store raw bars as a load of their own, plus source and load time; returns the rows written.

    What earlier loads brought stays, but for the tickers and dates that this one has, too. Nothing to
    write changes nothing.
    """
    spark, path = df.sparkSession, bronze_path(root, source)
    rows = conform(with_load_columns(df, source, ingested_at), BRONZE_SCHEMA)
    return _publish_load(spark, rows, path)


def _publish_load(spark: SparkSession, rows: DataFrame, path: str, number: str | None = None) -> int:
    made, folder = _missing(spark, path), versions.pending(path)
    try:
        n_rows = _write(rows, folder, ["trade_date"], ["ticker"])
        if n_rows:
            versions.publish(spark, path, folder, _LOAD, number)
            made = None
        return n_rows
    finally:
        remove(spark, folder, *([made] if made else []))


def _identity():
    """What a row of bronze is known by within its date: its ticker, or all of it if it has none."""
    values = [f.name for f in BRONZE_SCHEMA.fields if f.name not in ("ticker", "trade_date", "ingested_at")]
    ticker = normalize_ticker("ticker")
    return F.coalesce(ticker, F.concat(F.lit("\0"), F.xxhash64(*values).cast("string"))).alias("_identity")


def _resolved(spark: SparkSession, path: str, trade_date=None, since=None, only=None) -> DataFrame:
    """The rows of the latest load that has their ticker and date, of the wanted dates."""
    loads = defaultdict(list)
    for number, day, folder in _folders(spark, f"{path}/{_LOAD}=*"):
        loads[day].append((number, folder))
    wanted = [d for d in _within(sorted(loads), trade_date, since) if only is None or d in only]
    newest = [max(loads[d])[1] for d in wanted]
    several = [d for d in wanted if len(loads[d]) > 1]
    latest = _read_folders(spark, path, newest, BRONZE_SCHEMA)
    if not several:
        return latest.select(*BRONZE_SCHEMA.fieldNames())
    numbered = T.StructType([*BRONZE_SCHEMA.fields, T.StructField(_LOAD, T.StringType())])
    # the newest load of a date counts whole, so only the older ones are matched by ticker
    every = _read_folders(spark, path, [f for d in several for _, f in loads[d]], numbered)
    older = _read_folders(spark, path, [f for d in several for _, f in sorted(loads[d])[:-1]], numbered)
    last = every.groupBy(_identity(), "trade_date").agg(F.max(_LOAD).alias(_LOAD)).alias("last")
    mine = older.withColumn("_identity", _identity()).alias("mine")
    same = [F.col(f"mine.{c}").eqNullSafe(F.col(f"last.{c}")) for c in ("_identity", "trade_date", _LOAD)]
    kept = mine.join(last, same, "left_semi")
    return latest.select(*BRONZE_SCHEMA.fieldNames()).unionByName(kept.select(*BRONZE_SCHEMA.fieldNames()))


def read_bronze(
    spark: SparkSession, root: str, source: str | None = fixed.DEFAULT_SOURCE, trade_date=None, since=None
) -> DataFrame:
    """All dates, one, or those from ``since`` on (only their folders are read); each ticker's latest load.

    ``source=None`` reads all sources; a source never loaded gives no rows.
    """
    sources = bronze_sources(spark, root) if source is None else [source]
    stored = [_resolved(spark, bronze_path(root, s), trade_date, since) for s in sources]
    return reduce(DataFrame.unionByName, stored) if stored else empty(spark, BRONZE_SCHEMA)


def bronze_dates(spark: SparkSession, root: str, source: str) -> list[str]:
    """The dates that a source has bars for, by folder name."""
    folders = _folders(spark, f"{bronze_path(root, source)}/{_LOAD}=*")
    return sorted({day for _, day, _ in folders if day[0].isdigit()})


def compact_bronze(spark: SparkSession, root: str, source: str = fixed.DEFAULT_SOURCE) -> int:
    """Fold the dates with several loads into one; returns the rows written.

    The folded rows take a number right behind the last load they come from, so a load that comes in
    meanwhile is newer still. Loads of which a claim is open are left for the next time. The folders that
    were folded go once the result is published.
    """
    path = bronze_path(root, source)
    barrier = versions.unsettled(spark, path, _LOAD)
    folders = [f for f in _folders(spark, f"{path}/{_LOAD}=*") if barrier is None or f[0] < barrier]
    loads = defaultdict(list)
    for number, day, folder in folders:
        loads[day].append((number, folder))
    several = {d: found for d, found in loads.items() if len(found) > 1}
    if not several:
        return 0
    last = max(number for found in several.values() for number, _ in found)
    step = int(last.split(".")[1]) + 1 if "." in last else 1
    rows = _resolved(spark, path, only=set(several))
    n_rows = _publish_load(spark, rows, path, f"{last.split('.')[0]}.{step:06d}")
    remove(spark, *(folder for found in several.values() for _, folder in found))
    return n_rows


# --- input that could not be read -------------------------------------------------------------


def unread_path(root: str, source: str) -> str:
    return f"{root}/unread/{source}"


def write_unread(rows: DataFrame, files, root: str, source: str) -> int:
    """Keep the lines (file, line, reason) of a read of some files that gave no bar; returns how many.

    They take the place of those that earlier reads kept of the same files.
    """
    spark, path = rows.sparkSession, unread_path(root, source)
    folder, seen = versions.pending(path), Observation()
    read = spark.createDataFrame([(f,) for f in files], "file string").select("file", F.lit(None).cast("string").alias("line"), F.lit(None).cast("string").alias("reason"))
    try:
        rows.select("file", "line", "reason").observe(seen, F.count(F.lit(1)).alias("n")).unionByName(read).write.parquet(folder)
        versions.publish(spark, path, folder, _LOAD)
        return seen.get["n"]
    finally:
        remove(spark, folder)


def read_unread(spark: SparkSession, root: str, source: str) -> DataFrame:
    """The lines of landed files that gave no bar: file, line, reason."""
    stored = _read(spark, unread_path(root, source), UNREAD_SCHEMA)
    last = stored.groupBy("file").agg(F.max(_LOAD).alias(_LOAD))
    return stored.where(F.col("line").isNotNull()).join(last, ["file", _LOAD], "left_semi").select("file", "line", "reason")


# --- silver -----------------------------------------------------------------------------------

_RUN, _BARS, _REJECTED, _LEDGER, _ALL, _PRESENT = "version", "bars", "rejected", "ledger", "all", "present"


class SilverRun:
    """A run's bars and rejected rows, written aside until ``publish``.

    It covers all dates, or those from ``first`` to ``last`` (both may be left open); of these, dates that
    it has no rows for have none from then on.
    """

    def __init__(self, spark: SparkSession, root: str, first=None, last=None):
        self.spark, self.table = spark, silver_path(root)
        self.made = _missing(spark, self.table)
        self.folder = versions.pending(self.table)
        self.covers = _ALL if first is None and last is None else f"{first or ''}_{last or ''}"

    def write(self, df: DataFrame, kind: str, covers: str | None = None) -> int:
        n_rows = _write(df, f"{self.folder}/kind={kind}", ["trade_date"], [c for c in ["ticker"] if c in df.columns])
        versions.mark(self.spark, f"{self.folder}/_covers_{kind}_{covers or self.covers}")
        return n_rows

    def covers_without_rows(self, kind: str) -> None:
        versions.mark(self.spark, f"{self.folder}/_covers_{kind}_{self.covers}")

    def written(self, kind: str, schema) -> DataFrame:
        """What this run has written, before it is published."""
        return _read(self.spark, f"{self.folder}/kind={kind}", schema)

    def publish(self) -> None:
        versions.publish(self.spark, self.table, self.folder, _RUN)
        self.made = None

    def discard(self) -> None:
        """Take away what has not been published."""
        remove(self.spark, self.folder, *([self.made] if self.made else []))


def _current(spark: SparkSession, root: str, kind: str) -> dict[str, str]:
    """The folder that counts for every date."""
    covers = {}
    for path in versions.listed(spark, f"{silver_path(root)}/{_RUN}=*/_covers_{kind}_*"):
        run, marker = path.split("/")[-2:]
        covers[run.split("=")[1]] = marker.split("_", 3)[3]
    by_day = defaultdict(dict)
    for number, day, folder in _folders(spark, f"{silver_path(root)}/{_RUN}=*/kind={kind}"):
        by_day[day][number] = folder

    def covered(number, day):
        if covers[number] in (_ALL, _PRESENT):
            return covers[number] == _ALL or number in by_day[day]
        first, last = covers[number].split("_")
        return day[0].isdigit() and first <= day and (not last or day <= last)

    current = {}
    for day in by_day:
        run = next((n for n in sorted(covers, reverse=True) if covered(n, day)), None)
        if run in by_day[day]:
            current[day] = by_day[day][run]
    return current


def _read_current(spark, root, kind, schema, trade_date=None, since=None) -> DataFrame:
    current = _current(spark, root, kind)
    paths = [current[d] for d in _within(sorted(current), trade_date, since)]
    return _read_folders(spark, silver_path(root), paths, schema).select(*schema.fieldNames())


def expire_silver(spark: SparkSession, root: str, keep: int = 1) -> None:
    """Take away superseded folders of all runs but the ``keep`` latest; those may still have readers."""
    table = silver_path(root)
    runs = versions.numbers(spark, table, _RUN)
    old = set(runs[: len(runs) - keep] if keep else runs)
    for kind in (_BARS, _REJECTED, _LEDGER):
        current = set(_current(spark, root, kind).values())
        folders = _folders(spark, f"{table}/{_RUN}=*/kind={kind}")
        remove(spark, *(folder for number, _, folder in folders if number in old and folder not in current))


def write_silver(df: DataFrame, root: str, schema=SILVER_SCHEMA, whole: bool = False) -> int:
    """Store clean bars, replacing the dates present in ``df`` or the ``whole`` table."""
    run = SilverRun(df.sparkSession, root)
    try:
        n_rows = run.write(conform(df, schema), _BARS, _ALL if whole else _PRESENT)
        if n_rows or whole:
            run.publish()
        return n_rows
    finally:
        run.discard()


def silver_dates(spark: SparkSession, root: str) -> list[str]:
    return sorted(_current(spark, root, _BARS))


def read_silver(spark: SparkSession, root: str, trade_date=None, schema=SILVER_SCHEMA, since=None) -> DataFrame:
    return _read_current(spark, root, _BARS, schema, trade_date, since)


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """The rows that silver dropped, with their reasons."""
    return _read_current(spark, root, _REJECTED, REJECTED_SCHEMA)


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """The checks of every stored date, counted by the run that wrote it: one row per date."""
    return _read_current(spark, root, _LEDGER, LEDGER_SCHEMA)


# --- gold -------------------------------------------------------------------------------------


def write_gold(df: DataFrame, root: str, name: str) -> int:
    """Store a gold table, partitioned by year and month where it has them, in place of the old one.

    A table without them is staged first: whether there are rows to replace it with is only known
    once they are computed, and they should not be computed twice.
    """
    schema = GOLD_SCHEMAS.get(name)
    rows = df if schema is None else conform(df, schema)
    order = [c for c in ("ticker", "trade_date") if c in df.columns]
    path = gold_path(root, name)
    if {"year", "month"} <= set(df.columns):
        return _write(rows, path, ["year", "month"], order, whole=True)
    spark = df.sparkSession
    folder = new_folder(spark, name)
    n_rows = _write(rows, folder, [], order)
    if n_rows:
        _write(spark.read.schema(rows.schema).parquet(folder), path, [], order)
    remove(spark, folder)
    return n_rows


def write_gold_since(df: DataFrame, root: str, name: str, first, months) -> int:
    """Replace the months of a gold table from that of date ``first`` on; ``months`` are those ``df`` has."""
    path = gold_path(root, name)
    order = [c for c in ("ticker", "trade_date") if c in df.columns]
    n_rows = _write(conform(df, GOLD_SCHEMAS[name]), path, ["year", "month"], order)
    for folder in versions.listed(df.sparkSession, f"{path}/year=*/month=*"):
        month = tuple(int(part.split("=")[1]) for part in folder.split("/")[-2:])
        if month >= (first.year, first.month) and month not in months:
            remove(df.sparkSession, folder)
    return n_rows


def read_gold(spark: SparkSession, root: str, name: str, schema=None) -> DataFrame:
    schema = schema or GOLD_SCHEMAS.get(name)
    if schema is None:
        raise ValueError(f"no schema known for gold table {name!r}; pass one")
    return _read(spark, gold_path(root, name), schema)
