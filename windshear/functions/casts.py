"""C20: tolerant casts. Spark 4 runs in ANSI mode, where a plain cast of a bad
string raises; one bad row must never fail the job, so every parse is a
``try_cast`` that yields NULL instead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def to_int(c: Column | str) -> Column:
    """Numeric text such as ``'-5.50'`` -> -5 (via double, truncating toward zero).

    A direct string-to-int cast rejects the decimal point, so the value goes
    through double first; out-of-range or unparsable text gives NULL.
    """
    return _col(c).try_cast("double").try_cast("int")


def to_float(c: Column | str) -> Column:
    return _col(c).try_cast("float")


def to_date(c: Column | str) -> Column:
    return _col(c).try_cast("date")


def to_timestamp_ntz(c: Column | str) -> Column:
    """ISO text (``2019-11-03T05:30:00Z``) to a wall-clock timestamp that
    keeps the written fields whatever the session time zone is."""
    return _col(c).try_cast("timestamp_ntz")
