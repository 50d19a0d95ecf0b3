"""File names and archive keys: formatting dates into names and back.

Templates are Spark datetime patterns over the file date; parsing is the
inverse, by anchored regex plus a strict date cast, so a name that does not
match the template exactly (or is not a real date) gives null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import contract as C

_FEEDS = {f[0]: f for f in C.FEEDS}


def basename(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+)$", 1)


def _parse(name: Column, pattern: str, slices) -> Column:
    # Anchored regex guard, then fixed-position slices and the cast path: no
    # date formatter (a failed formatter parse costs an exception per row
    # inside Spark; a failed cast does not).
    y, m, d = (F.substring(name, pos, length) for pos, length in slices)
    return F.when(name.rlike(pattern), F.concat_ws("-", y, m, d).try_cast("date"))


def name_date(name: Column, feed: str) -> Column:
    """Date encoded in an archive name of ``feed``, or null."""
    pattern, groups = C.FEED_NAME_PATTERNS[feed]
    return _parse(name, pattern, groups)


def ticks_name_date(name: Column) -> Column:
    """Date of a ``YYYY-MM-DD.parquet`` ticks file name, or null."""
    pattern, groups = C.TICKS_NAME_PATTERN
    return _parse(name, pattern, groups)


def archive_name_date(name: Column) -> list[Column]:
    """``[feed, file_date]`` of an archive *file name*; both null for strangers.

    Pass a column that already holds the base name, so it is computed once.
    """
    dates = {feed: name_date(name, feed) for feed in _FEEDS}
    feed = F.lit(None).cast("string")
    for f, d in dates.items():
        feed = F.when(d.isNotNull(), F.lit(f)).otherwise(feed)
    return [feed.alias("feed"), F.coalesce(*dates.values()).alias("file_date")]


def _by_feed(feed: Column, date: Column, index: int) -> Column:
    out = F.lit(None).cast("string")
    for f, conf in _FEEDS.items():
        out = F.when(feed == f, F.date_format(date, conf[index])).otherwise(out)
    return out


def archive_name(feed: Column, date: Column) -> Column:
    """Archive (ZIP) file name of a feed-day."""
    return _by_feed(feed, date, 1)


def txt_prefix(feed: Column, date: Column) -> Column:
    """Prefix the TXT member name of a feed-day must start with."""
    return _by_feed(feed, date, 2)


def _prefix(feed: Column, index: int) -> Column:
    out = F.lit(None).cast("string")
    for f, conf in _FEEDS.items():
        out = F.when(feed == f, F.lit(conf[index])).otherwise(out)
    return out


def archive_key(feed: Column, date: Column) -> Column:
    """Object key of the archived ZIP: flat under the feed prefix."""
    return F.concat(_prefix(feed, 3), archive_name(feed, date))


def ticks_key(feed: Column, date: Column) -> Column:
    """Hive-style key of a feed-day ticks file: ``.../year=YYYY/YYYY-MM-DD.parquet``."""
    return F.concat(_prefix(feed, 4), F.lit("year="), F.date_format(date, "yyyy"), F.lit("/"),
                    F.date_format(date, "yyyy-MM-dd"), F.lit(".parquet"))


def report_key(section: Column, api_name: Column, date: Column) -> Column:
    """Raw report archive key: ``b3/bdi/reports/{section}/{api}/year=YYYY/YYYY-MM-DD.csv``."""
    return F.concat(F.lit("b3/bdi/reports/"), section, F.lit("/"), api_name, F.lit("/year="),
                    F.date_format(date, "yyyy"), F.lit("/"), F.date_format(date, "yyyy-MM-dd"),
                    F.lit(".csv"))
