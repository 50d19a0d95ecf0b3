"""Strict text-to-value conversions as Column expressions.

Nothing here guesses: every conversion has an explicit, anchored pattern
(``\\A...\\z``; Java's ``$`` also matches before a trailing newline) and a
``try_*`` cast, so bad input yields a null or a ``False`` check instead of an
exception (ANSI mode stays on).  ``[0-9]`` is spelled out, never ``\\d``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contract as C

# --- Fixed values ---
ISO_DATE_PATTERN = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
PRICE_PATTERN = r"\A-?[0-9]+(?:\.[0-9]+)?\z"
# HHMMSSmmm with real hour/minute/second ranges (second 60 is not a time).
TIME_PATTERN = r"\A(?:[01][0-9]|2[0-3])[0-5][0-9][0-5][0-9][0-9]{3}\z"
DMY_DATE_PATTERN = r"\A[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z"
REPORT_INT_PATTERN = r"\A[+-]?[0-9]+(?:,0*)?\z"
# Spellings a report boolean may take.
TRUE_WORDS = ("True", "TRUE", "true")
FALSE_WORDS = ("False", "FALSE", "false")
# Report cells meaning "no value" by default; the spreadsheet words are opt-in.
DEFAULT_NA = ("", "-")
SPREADSHEET_NA = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def anchored(c: Column | str, pattern: str) -> Column:
    """Full-match test; null input gives False."""
    return F.coalesce(_col(c).rlike(pattern), F.lit(False))


def digit_limit(max_value: int) -> int:
    return len(str(max_value))


def uint_pattern_ok(c: Column | str, max_value: int) -> Column:
    """1..k ASCII digits, k = digits of the type maximum; no sign, no blank."""
    return anchored(c, r"\A[0-9]{1,%d}\z" % digit_limit(max_value))


def uint_range_ok(c: Column | str, max_value: int) -> Column:
    """Value <= type maximum (meaningful only where the pattern holds)."""
    return F.coalesce(
        _col(c).try_cast("decimal(20,0)") <= F.lit(max_value).cast("decimal(20,0)"),
        F.lit(False),
    )


def uint_value(c: Column | str, spark_type: str) -> Column:
    return _col(c).try_cast("decimal(20,0)").try_cast(spark_type)


def price_text(c: Column | str) -> Column:
    """Decimal comma to point: every comma is replaced."""
    return F.replace(_col(c), F.lit(","), F.lit("."))


def price_ok(c: Column | str) -> Column:
    return anchored(price_text(c), PRICE_PATTERN)


def price_value(c: Column | str) -> Column:
    return price_text(c).try_cast("double")


def iso_date_ok(c: Column | str) -> Column:
    """``YYYY-MM-DD`` that is a real calendar date of year >= 1."""
    c = _col(c)
    # the anchored pattern fixes the layout, so the (fast) cast path can
    # decide whether it is a real date; no formatter per row
    return (
        anchored(c, ISO_DATE_PATTERN)
        & F.coalesce(c.try_cast("date").isNotNull(), F.lit(False))
        & (F.substring(c, 1, 4) != F.lit("0000"))
    )


def time_ok(c: Column | str) -> Column:
    return anchored(c, TIME_PATTERN)


def _time_fields(date_text: Column, time_text: Column):
    year = F.substring(date_text, 1, 4).try_cast("int")
    month = F.substring(date_text, 6, 2).try_cast("int")
    day = F.substring(date_text, 9, 2).try_cast("int")
    hour = F.substring(time_text, 1, 2).try_cast("int")
    minute = F.substring(time_text, 3, 2).try_cast("int")
    second = F.concat(F.substring(time_text, 5, 2), F.lit("."),
                      F.substring(time_text, 7, 3)).try_cast("decimal(8,3)")
    return year, month, day, hour, minute, second


def local_timestamp(date_text: Column | str, time_text: Column | str,
                    tz: str = C.TIMEZONE) -> Column:
    """Instant of a local wall time in ``tz``; null unless the time is valid.

    Independent of the session time zone.  A wall time that falls in a DST
    gap is shifted forward by Spark; :func:`local_time_invalid` flags it.
    """
    date_text, time_text = _col(date_text), _col(time_text)
    y, mo, d, h, mi, s = _time_fields(date_text, time_text)
    return F.when(
        time_ok(time_text),
        F.try_make_timestamp(y, mo, d, h, mi, s, F.lit(tz)),
    )


def local_time_invalid(date_text: Column | str, time_text: Column | str,
                       tz: str = C.TIMEZONE) -> Column:
    """True when a valid-looking wall time does not exist (DST gap) or
    exists twice (DST overlap) in ``tz``."""
    date_text, time_text = _col(date_text), _col(time_text)
    y, mo, d, h, mi, s = _time_fields(date_text, time_text)
    wall = F.try_make_timestamp_ntz(y, mo, d, h, mi, s)
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)
    back = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)
    later = F.convert_timezone(F.lit("UTC"), F.lit(tz), utc + F.expr("INTERVAL 1 HOUR"))
    return F.coalesce(time_ok(time_text) & wall.isNotNull() & ((back != wall) | (later == wall)),
                      F.lit(False))


_DST_DAYS: dict = {}
# Years whose transition days are tabled; other days take the full check.
FIRST_DST_YEAR, LAST_DST_YEAR = 1900, 2100


def dst_transition_days(spark, tz: str = C.TIMEZONE, first_year: int = FIRST_DST_YEAR,
                        last_year: int = LAST_DST_YEAR):
    """``(day DATE)`` of every local day whose UTC offset changes in ``tz``.

    Bounded by construction (about two days a year over the range), so it
    is a dimension that can be broadcast; wall-time checks for DST gaps and
    overlaps only need to run on rows of these days.  Computed by Spark from
    the JVM's zone rules once per zone, then kept as a small local table.
    """
    key = (tz, first_year, last_year)
    if key not in _DST_DAYS:
        days = spark.range(1).select(F.explode(F.sequence(
            F.make_date(F.lit(first_year), F.lit(1), F.lit(1)),
            F.make_date(F.lit(last_year), F.lit(12), F.lit(31)))).alias("day"))
        start = F.col("day").cast("timestamp_ntz")
        end = F.date_add("day", 1).cast("timestamp_ntz")
        # offset = wall clock minus UTC, at the start and at the end of the day
        off0 = (F.unix_seconds(F.to_utc_timestamp(start, tz))
                - F.unix_seconds(F.to_utc_timestamp(start, "UTC")))
        off1 = (F.unix_seconds(F.to_utc_timestamp(end, tz))
                - F.unix_seconds(F.to_utc_timestamp(end, "UTC")))
        _DST_DAYS[key] = [r.day for r in days.where(off0 != off1).collect()]
    return spark.createDataFrame([(d,) for d in _DST_DAYS[key]], "day date")


def empty_to_null(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c != F.lit(""), c)


# --- Report cells ---

def na_to_null(c: Column | str, na_values=DEFAULT_NA) -> Column:
    c = _col(c)
    return F.when(~c.isin(*na_values), c)


def percent_fraction(c: Column | str) -> Column:
    """``'2,92%'`` -> 0.0292; null stays null."""
    text = F.replace(F.replace(_col(c), F.lit("%"), F.lit("")), F.lit(","), F.lit("."))
    return F.trim(text).try_cast("double") / F.lit(100.0)


def comma_double(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit(".")).try_cast("double")


def comma_double_ok(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | comma_double(c).isNotNull()


def dmy_date(c: Column | str) -> Column:
    """``dd/MM/yyyy`` (one or two digit day/month) or null; ``31/12/9999`` is real."""
    c = _col(c)
    return F.when(anchored(c, DMY_DATE_PATTERN), F.try_to_date(c, "d/M/yyyy"))


def dmy_date_ok(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | dmy_date(c).isNotNull()


def report_int(c: Column | str) -> Column:
    c = _col(c)
    return F.when(anchored(c, REPORT_INT_PATTERN),
                  F.regexp_extract(c, r"\A([+-]?[0-9]+)", 1).try_cast("bigint"))


def report_int_ok(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | report_int(c).isNotNull()


def report_bool(c: Column | str) -> Column:
    c = _col(c)
    return (F.when(c.isin(*TRUE_WORDS), F.lit(True))
            .when(c.isin(*FALSE_WORDS), F.lit(False)))


def report_bool_ok(c: Column | str) -> Column:
    c = _col(c)
    return c.isNull() | c.isin(*TRUE_WORDS, *FALSE_WORDS)
