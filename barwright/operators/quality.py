"""Quality gate and row validation for clean bars."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from barwright.functions.series import by_date
from barwright.operators.silver import REQUIRED_COLUMNS
from barwright.schemas import PRICE_COLUMNS, SERIES_KEYS
from barwright.session import staged


class QualityError(AssertionError):
    """A check of the quality gate failed."""


def _row_checks(columns, as_of):
    """name -> row condition that counts as a violation; columns the frame lacks are skipped."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    nulls = {f"null_{c}": F.col(c).isNull() for c in REQUIRED_COLUMNS if c in columns}
    prices = {f"non_positive_{c}": F.col(c) <= 0 for c in PRICE_COLUMNS if c in columns}
    nans = [F.isnan(c) for c in PRICE_COLUMNS if c in columns]
    nan = {"nan_prices": reduce(or_, nans)} if nans else {}
    return {**nulls, **prices, **nan, "future_dates": F.col("trade_date") > today}


def _counts(checks):
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.max("trade_date").alias("last_date"),
        *[F.count_if(condition).alias(name) for name, condition in checks.items()],
    ]


def quality_report(df: DataFrame, as_of=None, keys=SERIES_KEYS) -> DataFrame:
    """All checks as one row of violation counts.

    One scan: rows are folded per key within each map task, which is what counting repeated keys needs,
    and the checks are counted in the same fold.
    """
    checks = _row_checks(df.columns, as_of)
    per_key = df.groupBy(*keys).agg(*_counts(checks))

    def total(column, name):
        return F.coalesce(F.sum(column), F.lit(0)).alias(name)

    report = per_key.agg(
        total("n_rows", "n_rows"),
        F.max("last_date").alias("last_date"),
        *[total(name, name) for name in checks],
        total(F.col("n_rows") - 1, "duplicate_rows"),
    )
    violations = sum((F.col(name) for name in [*checks, "duplicate_rows"]), F.lit(0))
    return report.withColumn("passed", violations == 0)


def ledger(silver: DataFrame) -> DataFrame:
    """The checks of ``quality_report`` counted per date, with the number of tickers: sums of it are the report.

    One row per trade_date. Whether a date is in the future is known from the date itself.
    """
    checks = {name: check for name, check in _row_checks(silver.columns, None).items() if name != "future_dates"}
    per_key = silver.groupBy(*SERIES_KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(condition).alias(name) for name, condition in checks.items()]
    )
    return per_key.groupBy("trade_date").agg(
        F.sum("n_rows").alias("n_rows"), F.count("ticker").alias("n_tickers"),
        *[F.sum(name).alias(name) for name in checks], F.sum(F.col("n_rows") - 1).alias("duplicate_rows"),
    )


def report_of_ledger(counts: DataFrame, as_of=None) -> DataFrame:
    """``quality_report`` from the rows of a ledger: it reads a row per date, not the bars."""
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    names = [c for c in counts.columns if c not in ("trade_date", "n_rows", "n_tickers", "duplicate_rows")]

    def total(column, name):
        return F.coalesce(F.sum(column), F.lit(0)).alias(name)

    report = counts.agg(
        total("n_rows", "n_rows"), F.max("trade_date").alias("last_date"), *[total(c, c) for c in names],
        total(F.when(F.col("trade_date") > today, F.col("n_rows")), "future_dates"), total("duplicate_rows", "duplicate_rows"),
    )
    violations = sum((F.col(name) for name in [*names, "future_dates", "duplicate_rows"]), F.lit(0))
    return report.withColumn("passed", violations == 0)


def refuse(counts: dict):
    """QualityError naming every check with a count above zero, if there is one."""
    figures = {k: v for k, v in counts.items() if k not in ("n_rows", "last_date", "passed")}
    failed = {name: count for name, count in figures.items() if count}
    if failed:
        raise QualityError(f"quality checks failed: {failed}, last date {counts['last_date']}")


def require_quality(df: DataFrame, as_of=None, keys=SERIES_KEYS) -> DataFrame:
    """``df`` unchanged if every check passes, else QualityError naming the failures.

    Works on any frame, at the price of scanning it once more; brings one row to the driver.
    """
    refuse(quality_report(df, as_of, keys).first().asDict())
    return df


def checked_on_the_way(df: DataFrame, as_of=None) -> tuple[DataFrame, Observation]:
    """A silver frame whose checks are counted by whatever computes it; the counts are for ``refuse``.

    For frames with one row per (ticker, trade_date) meant, such as ``transform_silver`` returns:
    a repeated key then is a row with the date of the row before it, which the window that
    computes the return can tell without another shuffle or sort.
    """
    previous = F.lag("trade_date").over(by_date())
    repeated = (F.row_number().over(by_date()) > 1) & previous.eqNullSafe(F.col("trade_date"))
    seen = Observation()
    checked = (
        df.withColumn("_repeated", repeated)
        .observe(
            seen,
            *_counts(_row_checks(df.columns, as_of)),
            F.count_if("_repeated").alias("duplicate_rows"),
        )
        .drop("_repeated")
    )
    return checked, seen


def staged_if_sound(df: DataFrame, as_of=None, held: list | None = None) -> DataFrame:
    """Stage a silver frame and check it in the same pass; QualityError if it fails.

    The staged table's folder goes to ``held``.
    """
    checked, seen = checked_on_the_way(df, as_of)
    stored = staged(checked, "silver", held)
    refuse(seen.get)
    return stored


def add_reject_reasons(df: DataFrame) -> DataFrame:
    """``reject_reasons``: what keeps a typed row from being a valid clean bar (empty if nothing)."""
    required = ["ticker", "trade_date", *PRICE_COLUMNS, "adj_close", "volume"]
    not_negative = [*PRICE_COLUMNS, "adj_close", "volume"]
    reasons = [
        F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required if c in df.columns
    ] + [F.when(F.col(c) < 0, F.lit(f"negative {c}")) for c in not_negative if c in df.columns]
    return df.withColumn("reject_reasons", F.array_compact(F.array(*reasons)))


def valid_rows(df: DataFrame) -> DataFrame:
    return add_reject_reasons(df).where(F.size("reject_reasons") == 0).drop("reject_reasons")


def quarantine(df: DataFrame) -> DataFrame:
    return add_reject_reasons(df).where(F.size("reject_reasons") > 0)
