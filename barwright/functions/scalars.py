"""Column expressions shared by the operators. All of them are built-in functions."""

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from barwright import fixed


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_ticker(c) -> Column:
    """Strip any white space at both ends (plain trim keeps all but blanks) and upper-case."""
    return F.upper(F.btrim(col_of(c), F.lit(fixed.WHITE_SPACE)))


def ratio_minus_one(numerator, denominator) -> Column:
    """a / b - 1, null where b is zero."""
    return F.try_divide(col_of(numerator), col_of(denominator)) - 1


def ticker_label(c) -> Column:
    return F.replace(col_of(c), F.lit(fixed.TICKER_SUFFIX), F.lit(""))


def month_label(year, month) -> Column:
    return F.concat_ws("-", col_of(year).cast("string"), F.lpad(col_of(month).cast("string"), 2, "0"))


def date_label(c) -> Column:
    return F.coalesce(F.date_format(col_of(c), fixed.DATE_LABEL_FORMAT), F.lit("-"))


def as_percent(c) -> Column:
    return col_of(c) * 100


def number_label(pattern: str, c) -> Column:
    return F.format_string(pattern, F.coalesce(col_of(c), F.lit(0.0)))


def all_present(*names) -> Column:
    """No listed column is null. Unlike dropna this keeps NaN, and it can reach the scan."""
    return reduce(and_, [F.col(name).isNotNull() for name in names])


def member_of(c, values) -> Column:
    return col_of(c).isin(list(values))


def rounded(c, places: int = 6) -> Column:
    """Rounded to ``places``, with negative zero folded into zero."""
    return F.round(col_of(c), places) + F.lit(0.0)


def whole_number(column: str) -> Column:
    """A whole number, also when it is written as a float (``12000000.0``, ``1.2E7``); else null."""
    number = F.col(column).try_cast("double")
    as_float = F.when(number == F.floor(number), F.col(column).cast("string").try_cast("decimal(38,6)").try_cast("bigint"))
    return F.coalesce(F.col(column).cast("string").try_cast("bigint"), as_float)
