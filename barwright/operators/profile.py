"""Looking at a table: coverage, null counts, basic statistics."""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Days whose presence one number tells.
MASK_DAYS = 64


def ticker_coverage(df: DataFrame) -> DataFrame:
    """First date, last date and number of trading days per ticker.

    Days are marked as bits, a number per ticker and 64 days: copies of a bar vanish before the first shuffle,
    what reaches a ticker's task is at most one row per 64 days, and no task holds its days more than once.
    """
    day = F.unix_date("trade_date")
    marked = df.select(
        "ticker",
        "trade_date",
        F.floor(day / MASK_DAYS).cast("int").alias("_span"),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(MASK_DAYS))).alias("_bit"),
    )
    spans = marked.groupBy("ticker", "_span").agg(
        F.min("trade_date").alias("_first"), F.max("trade_date").alias("_last"), F.bit_or("_bit").alias("_days")
    )
    return spans.groupBy("ticker").agg(
        F.min("_first").alias("first_date"),
        F.max("_last").alias("last_date"),
        F.when(F.count("_span") > 0, F.sum(F.bit_count("_days"))).otherwise(F.lit(0)).alias("trading_days"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """One row, one count per column, from one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


ACCURACY = 10_000
QUARTILES = (0.25, 0.5, 0.75)
#: Ranges that a pass cuts every searched range into, and values that are few enough to look at one by one.
RANGES, FEW = 1024, 1000


def _ranges(df: DataFrame, searched: dict) -> dict:
    """(target, range number) to (rows, least, greatest) of the values between each target's bounds.

    At most RANGES rows per target come to the driver; rows are counted per range in every map task first.
    """
    cells = []
    for target, (name, low, high) in searched.items():
        c = F.col(name).cast("double")
        # in halves where the width itself is beyond a double
        part = 2.0 if math.isinf(high - low) else 1.0
        place = (c / part - low / part) / F.lit((high / part - low / part) or 1.0) * RANGES
        number = F.least(F.lit(RANGES - 1), F.greatest(F.lit(0), F.floor(place))).cast("int")
        cells.append(F.when(c.between(low, high), F.struct(F.lit(target).alias("t"), number.alias("r"), c.alias("v"))))
    rows = df.select(F.explode(F.array_compact(F.array(*cells))).alias("s")).select("s.*")
    found = rows.groupBy("t", "r").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    return {(r["t"], r["r"]): (r["n"], r["low"], r["high"]) for r in found.collect()}


def exact_quantiles(df: DataFrame, columns, shares=QUARTILES) -> dict[str, list]:
    """Per numeric column the values at rank ceil(share * n) of its n numbers, in order; null without any.

    Selection by narrowing: a pass counts all searched ranges, each rank falls into one of them, and the
    next pass looks at its values only, cut anew between the least and greatest of them. Ranges with few
    values are fetched and sorted. Two or three passes do, whatever the size; NaN and infinity take no part.
    ``df`` should be a stored table.
    """
    finite = {c: F.abs(F.col(c).cast("double")) < float("inf") for c in columns}
    plain = df.select(*[F.when(ok, F.col(c).cast("double")).alias(c) for c, ok in finite.items()])
    bounds = plain.agg(*[F.struct(F.count(c).alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).alias(c) for c in columns]).first()
    values = {c: [None] * len(shares) for c in columns}
    searched, ranks, few = {}, {}, {}
    for c in columns:
        for k, share in enumerate(shares):
            if bounds[c]["n"]:
                target = f"{k} {c}"
                searched[target] = (c, bounds[c]["low"], bounds[c]["high"])
                ranks[target] = max(1, math.ceil(share * bounds[c]["n"]))
    while searched:
        found, narrowed = _ranges(plain, searched), {}
        for target, (c, _, _) in searched.items():
            for number in sorted(r for t, r in found if t == target):
                n, low, high = found[target, number]
                if ranks[target] <= n:
                    break
                ranks[target] -= n
            if low == high:
                values[c][int(target.split()[0])] = low
            elif n <= FEW:
                few[target] = (c, low, high)
            else:
                narrowed[target] = (c, low, high)
        searched = narrowed
    if few:
        wanted = [
            F.when(F.col(c).between(low, high), F.struct(F.lit(t).alias("t"), F.col(c).alias("v"))) for t, (c, low, high) in few.items()
        ]
        rows = plain.select(F.explode(F.array_compact(F.array(*wanted))).alias("s")).select("s.*").collect()
        for target, (c, _, _) in few.items():
            own = sorted(r["v"] for r in rows if r["t"] == target)
            values[c][int(target.split()[0])] = own[ranks[target] - 1]
    return values


def describe(df: DataFrame, quartile_accuracy: int = ACCURACY, exact: bool = False) -> DataFrame:
    """Count, nulls, mean, std, min, quartiles and max of every numeric column, one row each.

    One aggregate over one scan. Quartiles come from a mergeable sketch whose rank error is at most
    n / quartile_accuracy; its size grows with the accuracy, not with the rows. ``exact`` ones take
    two or three scans more.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    found = exact_quantiles(df, numeric) if exact else {}

    def quartiles(name):
        if exact:
            return F.array(*[F.lit(v).cast("double") for v in found[name]])
        return F.percentile_approx(F.col(name).cast("double"), list(QUARTILES), quartile_accuracy)

    def stats(name):
        c = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("column"),
            F.count(c).alias("count"),
            F.count_if(c.isNull()).alias("null_count"),
            F.avg(c).alias("mean"),
            F.stddev_samp(c).alias("std"),
            F.min(c).alias("min"),
            quartiles(name).alias("quartiles"),
            F.max(c).alias("max"),
        )

    one_row = df.agg(F.array(*[stats(c) for c in numeric]).alias("stats"))
    return one_row.select(F.inline("stats")).select(
        "column",
        "count",
        "null_count",
        "mean",
        "std",
        "min",
        F.get("quartiles", 0).alias("q25"),
        F.get("quartiles", 1).alias("q50"),
        F.get("quartiles", 2).alias("q75"),
        "max",
    )
