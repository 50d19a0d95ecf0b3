"""Date lists and the business-day calendar (Mon-Fri; no holiday table).

Date inputs follow one contract everywhere:

* a single ``str``/``date`` -> that date;
* a ``list`` -> explicit dates, sorted, unique, weekends kept;
* a 2-``tuple`` ``(start, end)`` -> inclusive range of business days;
* any other tuple length -> ``ValueError``; any other type -> ``TypeError``.

The range expands on the executors (``sequence`` + ``explode``); an empty
result keeps its schema instead of failing.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    if isinstance(value, str):
        return _dt.date.fromisoformat(value)
    raise TypeError(f"expected a date or ISO text, got {type(value).__name__}")


def is_business_day(d: Column) -> Column:
    return F.weekday(d) < 5  # 0 = Monday


def dates_frame(spark: SparkSession, dates) -> DataFrame:
    """DataFrame ``(d DATE)`` for a date input (see module doc)."""
    if isinstance(dates, (str, _dt.date)):
        return spark.createDataFrame([(parse_date(dates),)], "d date")
    if isinstance(dates, tuple):
        if len(dates) != 2:
            raise ValueError(f"a date range is a (start, end) pair, got {len(dates)} items")
        start, end = (parse_date(x) for x in dates)
        # a range that ends before it starts holds no day; sequence() would count down
        days = F.sequence(F.lit(start), F.lit(end)) if start <= end else F.array().cast("array<date>")
        one = spark.range(1).select(F.explode(days).alias("d"))
        return one.where(is_business_day(F.col("d")))
    if isinstance(dates, list):
        unique = sorted({parse_date(x) for x in dates})
        return spark.createDataFrame([(d,) for d in unique], "d date")
    raise TypeError(f"dates must be a date, text, list or (start, end) tuple, "
                    f"got {type(dates).__name__}")


def date_filter(column: Column, dates) -> Column:
    """The date contract as a filter; on a partition column it prunes folders."""
    if isinstance(dates, (str, _dt.date)):
        return column == F.lit(parse_date(dates))
    if isinstance(dates, tuple):
        if len(dates) != 2:
            raise ValueError(f"a date range is a (start, end) pair, got {len(dates)} items")
        start, end = (parse_date(x) for x in dates)
        return column.between(F.lit(start), F.lit(end)) & is_business_day(column)
    if isinstance(dates, list):
        return column.isin(*sorted({parse_date(x) for x in dates}))
    raise TypeError(f"dates must be a date, text, list or (start, end) tuple, got {type(dates).__name__}")


def resolve_dates(spark: SparkSession, dates) -> list[_dt.date]:
    """Driver-side list (only for small, user-given inputs and tests)."""
    return [r.d for r in dates_frame(spark, dates).orderBy("d").collect()]


def next_business_day(d: Column) -> Column:
    wd = F.weekday(d)
    return F.date_add(d, F.when(wd == 4, 3).when(wd == 5, 2).otherwise(1))


def previous_business_day(d: Column) -> Column:
    wd = F.weekday(d)
    return F.date_sub(d, F.when(wd == 0, 3).when(wd == 6, 2).otherwise(1))


def exchange_today(tz: str = "America/Sao_Paulo") -> Column:
    """Current date in the exchange zone, independent of the session zone."""
    return F.to_date(F.convert_timezone(F.lit(tz), F.current_timestamp().cast("timestamp_ntz")))
