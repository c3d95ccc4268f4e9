"""Landed price feeds: delimited or Parquet history files, and JSON API responses."""

import csv
import os
import re
from collections import defaultdict
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright import fixed
from barwright.functions.scalars import whole_number
from barwright.schemas import HISTORY_PAYLOAD_SCHEMA, RAW_SCHEMA

CORRUPT = "_corrupt_record"


#: Bytes of a file, unpacked, within which its header must end.
HEADER_BYTES = 1 << 16
_READERS = 32


def _first_bytes(spark: SparkSession, path: str) -> str:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        plain = stream if codec is None else codec.createInputStream(stream)
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(plain, HEADER_BYTES)
        return jvm.org.apache.commons.io.IOUtils.toString(bounded, "UTF-8")
    finally:
        stream.close()


def header_of(text: str, sep: str) -> tuple[str, ...] | None:
    """The names in the first line that isn't blank, or None without one."""
    for line in text.removeprefix("\ufeff").splitlines(keepends=True):
        if line.strip():
            if not line.endswith(("\n", "\r")) and len(text.encode()) >= HEADER_BYTES:
                raise ValueError(f"no header within the first {HEADER_BYTES} bytes")
            return tuple(name.strip() for name in next(csv.reader([line.strip()], delimiter=sep)))
    return None


def files_by_header(spark: SparkSession, files, sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Header to the files that begin with it; from the first bytes of every file, many read at a time."""
    with ThreadPool(_READERS) as readers:
        headers = readers.map(lambda f: header_of(_first_bytes(spark, f), sep), files)
    groups = defaultdict(list)
    for file, header in zip(files, headers):
        if header is not None:
            groups[header].append(file)
    return dict(groups)


def _base(path) -> str:
    """The folder below which folder names are columns: the path up to its first wildcard."""
    paths = [path] if isinstance(path, str) else list(path)
    plain = [re.split(r"[*?\[{]", p)[0] for p in paths]
    folders = [p if p == whole else p.rpartition("/")[0] for p, whole in zip(plain, paths)]
    return folders[0] if len(set(folders)) == 1 else os.path.commonpath(folders)


def read_feed_files(spark: SparkSession, path, columns, sep: str = ",") -> DataFrame:
    """One read over any number of delimited files, the named columns as text.

    Each file's first line that isn't blank says where its columns lie; a column that a file lacks is null
    there. Files with the same header are read together by the engine's reader, which takes the data once.
    Lines with another number of fields than their file's header keep their text in ``_corrupt_record`` and
    do not stop the others. Folder names like ``ticker=A`` become columns.
    """
    lines = spark.read.text(path)
    partitions = [c for c in lines.columns if c != "value"]
    groups = files_by_header(spark, [_path_of(spark, f) for f in sorted(lines.inputFiles())], sep)
    wanted = [c for c in columns if c not in partitions]
    parts = [_read_group(spark, files, header, wanted, partitions, _base(path), sep) for header, files in sorted(groups.items())]
    if not parts:
        none = F.lit(None).cast("string")
        return lines.limit(0).select(*[none.alias(c) for c in wanted], *partitions, none.alias(CORRUPT))
    return reduce(DataFrame.unionByName, parts)


def _path_of(spark: SparkSession, file: str) -> str:
    """The path behind a file's address, whose special characters are encoded."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file)).toString()


def _read_group(spark, files, header, wanted, partitions, base, sep) -> DataFrame:
    # positions as names: a header may repeat one, or hold any character
    fields = [T.StructField(f"_c{k}", T.StringType()) for k in range(len(header))]
    schema = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).options(
        header=True, sep=sep, escape='"', mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT,
        ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True,
        columnPruning=False,  # else lines would only be held against the columns asked for
    )
    exactly = [re.sub(r"([\\\[\]{}*?])", r"\\\1", f) for f in files]
    rows = (reader.option("basePath", base) if partitions else reader).csv(exactly)
    sound = F.col(CORRUPT).isNull()
    named = [
        (F.when(sound, F.col(f"_c{header.index(c)}")) if c in header else F.lit(None).cast("string")).alias(c) for c in wanted
    ]
    # the reader refuses to give nothing but its corrupt lines, so they come with an empty piece of a field
    corrupt = F.concat(CORRUPT, F.substring(F.coalesce("_c0", F.lit("")), 1, 0)).alias(CORRUPT)
    return rows.select(*named, *partitions, corrupt)


def read_parquet_feed(spark: SparkSession, path) -> DataFrame:
    """Landed Parquet history files; a column that a file lacks is null there."""
    return spark.read.option("mergeSchema", True).parquet(path)


def intact(feed: DataFrame) -> DataFrame:
    return feed.where(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in feed.columns else feed


def rejected(feed: DataFrame) -> DataFrame:
    return feed.where(F.col(CORRUPT).isNotNull())


def normalize_feed(feed: DataFrame, ticker: str | Column | None = None) -> DataFrame:
    """Feed columns to raw bars.

    ``ticker`` is a symbol for single-instrument files or a column; without it the feed must have a
    ticker column. The date may come under any of the known names and carry a time; a missing
    adj_close falls back to close.
    """
    df = feed
    if ticker is not None:
        df = df.withColumn("ticker", F.lit(ticker) if isinstance(ticker, str) else ticker)
    dated = [name for name in fixed.FEED_DATE_ALIASES if name in df.columns]
    if "trade_date" not in df.columns:
        if not dated:
            raise ValueError(f"feed has no date column among {fixed.FEED_DATE_ALIASES}")
        df = df.withColumnRenamed(dated[0], "trade_date")
    df = df.withColumnsRenamed(fixed.FEED_COLUMNS)
    return typed_bars(df)


def typed_bars(df: DataFrame) -> DataFrame:
    """Raw-bar columns with their types; text that does not parse becomes null."""

    def typed(name, kind):
        if name not in df.columns:
            return F.lit(None).cast(kind)
        return F.col(name).try_cast(kind)

    columns = {f.name: typed(f.name, f.dataType.simpleString()) for f in RAW_SCHEMA.fields}
    if "volume" in df.columns:
        columns["volume"] = whole_number("volume")
    columns["adj_close"] = F.coalesce(columns["adj_close"], columns["close"])
    return df.select(*[c.alias(name) for name, c in columns.items()])


def read_json_responses(spark: SparkSession, path) -> DataFrame:
    """One JSON response per line, as text in column ``value``."""
    return spark.read.text(path)


def flatten_history(responses: DataFrame, suffix: str = fixed.TICKER_SUFFIX) -> DataFrame:
    """One raw bar per entry of the first result's price history.

    Responses without results, without a history or that are no JSON give no rows.
    """
    payload = F.from_json("value", HISTORY_PAYLOAD_SCHEMA)
    first = responses.select(F.get(payload["results"], F.lit(0)).alias("r"))
    entries = first.select(
        F.concat(F.col("r.symbol"), F.lit(suffix)).alias("ticker"),
        F.inline("r.historicalDataPrice"),
    )
    return typed_bars(
        entries.select(
            "ticker",
            F.try_to_date("date", "yyyy-MM-dd").alias("trade_date"),
            "open",
            "high",
            "low",
            "close",
            F.col("adjustedClose").alias("adj_close"),
            "volume",
        )
    )


def rejected_responses(responses: DataFrame) -> DataFrame:
    """The responses that ``flatten_history`` gets no row from, as they are, and why."""
    payload = F.from_json("value", HISTORY_PAYLOAD_SCHEMA)
    first = F.get(payload["results"], F.lit(0))
    reason = (
        F.when(F.try_parse_json("value").isNull(), "no JSON")
        .when(first.isNull(), "no result")
        .when(F.coalesce(F.size(first["historicalDataPrice"]), F.lit(0)) < 1, "no price history")
    )
    return responses.withColumn("reason", reason).where(F.col("reason").isNotNull() & (F.btrim("value") != ""))


def first_quote(responses: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The first result of every response as columns; a response without results gives no row."""
    text = F.get_json_object("value", "$.results[0]")
    return (
        responses.select(text.alias("_quote"))
        .where(F.col("_quote").isNotNull())
        .select(F.from_json("_quote", schema).alias("_quote"))
        .select("_quote.*")
    )


def assemble(*sources: DataFrame) -> DataFrame:
    """All sources in one frame, columns matched by name, absent ones null."""
    if not sources:
        raise ValueError("no sources given")
    result = sources[0]
    for other in sources[1:]:
        result = result.unionByName(other, allowMissingColumns=True)
    return result
