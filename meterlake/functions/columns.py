"""Column-level building blocks.  All are built-in Spark expressions, so they
stay inside whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seasons by calendar month.
WINTER_MONTHS = (12, 1, 2)
SUMMER_MONTHS = (6, 7, 8)
OTHER_MONTHS = (3, 4, 5, 9, 10, 11)

# Spark day-of-week numbering, 1 = Sunday ... 7 = Saturday.
WEEKDAYS = (2, 3, 4, 5, 6)
WEEKEND_DAYS = (1, 7)

# Imputation defaults of the cleaning rules.
DEFAULT_VOLTAGE = 230.0
DEFAULT_ANCHOR = "2006-12-16 17:24:00"
RAW_TIMESTAMP_FORMAT = "d/M/yyyy HH:mm:ss"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: str | Column) -> Column:
    """NULL or NaN (numeric columns only)."""
    c = col(c)
    return c.isNull() | F.isnan(c)


def fill_missing(c: str | Column, default) -> Column:
    c = col(c)
    return F.when(is_missing(c), F.lit(default)).otherwise(c)


def non_nan(c: str | Column) -> Column:
    """NaN -> NULL, so aggregates skip it like a missing value."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def to_double(c: str | Column) -> Column:
    """Text or number -> DOUBLE; unparsable text (e.g. '?') -> NULL."""
    return col(c).try_cast("double")


def parse_raw_timestamp(date: str | Column, time: str | Column,
                        fmt: str = RAW_TIMESTAMP_FORMAT) -> Column:
    """Date + Time text -> TIMESTAMP_NTZ; bad text -> NULL (never raises)."""
    ts = F.try_to_timestamp(F.concat_ws(" ", col(date), col(time)), F.lit(fmt))
    return ts.cast("timestamp_ntz")


def season_of(month: str | Column) -> Column:
    m = col(month)
    return (F.when(m.isin(*WINTER_MONTHS), F.lit("winter"))
            .when(m.isin(*SUMMER_MONTHS), F.lit("summer"))
            .when(m.isin(*OTHER_MONTHS), F.lit("other")))


def r6(c: str | Column) -> Column:
    """Round a floating result to 6 decimals for stable comparison."""
    return F.round(col(c), 6)


def half_up(c: str | Column, digits: int) -> Column:
    """Round half up in binary arithmetic, the same in every engine."""
    scale = F.lit(float(10 ** digits))
    return F.floor(col(c) * scale + F.lit(0.5)) / scale


def device_number(device_id: str | Column) -> Column:
    """'meter_17' -> 17 (NULL when the suffix is not a number)."""
    return F.element_at(F.split(col(device_id), "_"), -1).try_cast("int")
