"""Column expressions shared by the operators.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage code generation.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOAT_TYPES = (T.FloatType, T.DoubleType)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def is_boolean(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.BooleanType)


def null_nan(c, dtype: T.DataType | None = None) -> Column:
    """Missing is one thing: turn floating NaN into NULL."""
    c = col_(c)
    if dtype is not None and not isinstance(dtype, FLOAT_TYPES):
        return c
    return F.when(~F.isnan(c), c)


def as_double(c, dtype: T.DataType | None = None) -> Column:
    """Numeric (or boolean) column as double with NaN mapped to NULL."""
    c = col_(c)
    if dtype is not None and is_boolean(dtype):
        return c.cast("double")
    return null_nan(c.cast("double"))


def adj_skew(c) -> Column:
    """Bias-adjusted sample skewness G1 (n<3 -> NULL, constant -> 0)."""
    c = col_(c)
    n = F.count(c).cast("double")
    return (F.when(n < 3, F.lit(None).cast("double"))
            .when(F.var_pop(c) == 0, F.lit(0.0))
            .otherwise(F.sqrt(n * (n - 1)) / (n - 2) * F.skewness(c)))


def adj_kurt(c) -> Column:
    """Bias-adjusted excess kurtosis G2 (n<4 -> NULL, constant -> 0)."""
    c = col_(c)
    n = F.count(c).cast("double")
    return (F.when(n < 4, F.lit(None).cast("double"))
            .when(F.var_pop(c) == 0, F.lit(0.0))
            .otherwise((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(c) + 6)))


def rnd(c, digits: int = 6) -> Column:
    """Half-up rounding that is stable at exact ties: a tiny offset (1e-4 of the last
    kept digit) moves decimal ties off the grid so float noise cannot flip them."""
    return F.round(col_(c) + F.lit(10.0 ** -(digits + 4)), digits)


# The five accepted input date layouts, tried in this order
# (year-month-day, day-month-year, month/day/year, "5 Jan 2016", "January 5, 2016").
DATE_INPUT_PATTERNS = ["yyyy-M-d", "d-M-yyyy", "M/d/yyyy", "d MMM yyyy", "MMMM d, yyyy"]


def try_parse_date(c) -> Column:
    """First layout that parses wins; anything else (NULL, blanks, junk, 30 Feb) -> NULL."""
    c = col_(c).cast("string")
    return F.coalesce(*[F.try_to_date(c, p) for p in DATE_INPUT_PATTERNS])


def python_to_spark_date_format(fmt: str) -> str:
    """Translate a strftime layout into a Spark datetime pattern (common directives)."""
    table = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%b": "MMM", "%B": "MMMM", "%y": "yy",
             "%H": "HH", "%M": "mm", "%S": "ss", "%A": "EEEE", "%a": "EEE", "%j": "DDD"}
    out, i = [], 0
    while i < len(fmt):
        if fmt[i] == "%" and i + 1 < len(fmt):
            out.append(table.get(fmt[i:i + 2], fmt[i:i + 2]))
            i += 2
        else:
            ch = fmt[i]
            out.append(f"'{ch}'" if ch.isalpha() else ch)
            i += 1
    return "".join(out)
