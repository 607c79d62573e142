"""Dates in the formats the sources use. Unreadable text becomes null."""

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from ledgerloom.functions.text import _col


def partial_date(value):
    """Day, month or year precision; the missing part is the first."""
    value = _col(value)
    return F.coalesce(*[F.try_to_date(value, f) for f in ("yyyy-MM-dd", "yyyy-MM", "yyyy")])


def compact_date(value):
    """``yyyyMMdd`` with or without a decimal tail, as a date."""
    digits = F.substring_index(_col(value), ".", 1)
    return F.when(F.length(digits) >= 8, F.try_to_date(digits, "yyyyMMdd"))


def dashed_date(value):
    """``yyyyMMdd`` as the text ``yyyy-MM-dd``."""
    value = _col(value)
    return F.concat(
        F.substring(value, 1, 4), F.lit("-"), F.substring(value, 5, 2), F.lit("-"),
        F.substring(value, 7, 2),
    )


def first_date(values, fmt="M/d/yyyy"):
    """The first text that is there, read as a date."""
    return F.try_to_date(F.coalesce(*[_col(value) for value in values]), fmt)


def reformat_date(df, column, fmt):
    """A text column, or an array of texts, read as dates."""
    if isinstance(df.schema[column].dataType, ArrayType):
        return df.withColumn(column, F.transform(column, lambda x: F.try_to_date(x, fmt)))
    return df.withColumn(column, F.try_to_date(column, fmt))


def date_keys(value):
    """The integer keys yyyy, yyyymm and yyyymmdd of a date."""
    value = _col(value)
    year, month, day = F.year(value), F.month(value), F.dayofmonth(value)
    return {
        "yyyy": year,
        "yyyymm": year * 100 + month,
        "yyyymmdd": year * 10000 + month * 100 + day,
    }
