"""Session-versus-calendar logic and consumer operators over typed ticks.

A file covers one calendar day (``reference_date``); ``trade_date`` is the
session a trade counts for.  Trades of session *D* can sit in the files of
the previous trading day, *D* and the next trading day; there is no holiday
calendar, so "trading day" means a date present in the archive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import contract as C


def file_calendar(files: DataFrame) -> DataFrame:
    """``(feed, file_date, prev_file_date, next_file_date)`` over present dates.

    The window runs over the distinct (feed, date) list - a few thousand
    rows per feed at most - never over ticks.
    """
    d = files.select("feed", "file_date").distinct()
    w = Window.partitionBy("feed").orderBy("file_date")
    return d.select("feed", "file_date",
                    F.lag("file_date").over(w).alias("prev_file_date"),
                    F.lead("file_date").over(w).alias("next_file_date"))


def files_for_sessions(calendar: DataFrame, sessions: DataFrame) -> DataFrame:
    """File dates to read for each wanted ``(feed, session_date)``.

    Use the result as a partition filter before reading (JOIN-9 recipe).
    """
    c = calendar.withColumnRenamed("file_date", "session_date")
    s = sessions.join(c, ["feed", "session_date"], "inner")
    return s.select("feed", "session_date", F.explode(F.array(
        "prev_file_date", "session_date", "next_file_date")).alias("file_date")
    ).where(F.col("file_date").isNotNull())


def session_trades(ticks: DataFrame, calendar: DataFrame) -> DataFrame:
    """Every trade with the session it belongs to and the file it came from.

    ``from_file`` is ``own``, ``previous`` or ``next`` inside the three-file
    window, else ``outside``: the session has no file of its own, or lies
    further away.  No trade is left out.  ``ticks`` needs ``feed, file_date,
    trade_date``.  The calendar side is bounded by the number of archive
    dates, so AQE broadcasts it.
    """
    c = calendar.select("feed", F.col("file_date").alias("session_date"),
                        "prev_file_date", "next_file_date", F.lit(True).alias("_known"))
    t = ticks.withColumn("session_date", F.try_to_date("trade_date", "yyyy-MM-dd"))
    j = t.join(c, ["feed", "session_date"], "left")
    where = (F.when(F.col("file_date") == F.col("session_date"), "own")
              .when(F.col("file_date") == F.col("prev_file_date"), "previous")
              .when(F.col("file_date") == F.col("next_file_date"), "next"))
    # the own file needs a calendar row as well: a session date without one is outside
    known = F.col("prev_file_date").isNotNull() | F.col("next_file_date").isNotNull() | F.col("_known")
    return j.withColumn("from_file", F.when(known, where)).withColumn(
        "from_file", F.coalesce("from_file", F.lit("outside"))).drop("_known")


def session_summary(ticks: DataFrame, calendar: DataFrame) -> DataFrame:
    st = session_trades(ticks, calendar)
    return st.groupBy("feed", "session_date").agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.count_if(F.col("from_file") == "previous").alias("from_previous_file"),
        F.count_if(F.col("from_file") == "own").alias("from_own_file"),
        F.count_if(F.col("from_file") == "next").alias("from_next_file"),
        F.count_if(F.col("from_file") == "outside").alias("outside_window"),
        F.sum("quantity").alias("volume"),
    )


def own_session(ticks: DataFrame) -> DataFrame:
    """Shortcut for consumers that ignore cross-session products."""
    return ticks.where(F.col("trade_date") == F.col("reference_date"))


def off_session(ticks: DataFrame) -> DataFrame:
    return ticks.where(F.col("trade_date") != F.col("reference_date"))


def daily_code_counts(ticks: DataFrame) -> DataFrame:
    """Per-file counts by code; unknown codes are counted, never dropped."""
    return ticks.groupBy("feed", "file_date").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("update_action") == C.UPDATE_ACTION_NEW).alias("n_new"),
        F.count_if(F.col("update_action") == C.UPDATE_ACTION_CANCELLED).alias("n_cancelled"),
        F.count_if(~F.col("update_action").isin(C.UPDATE_ACTION_NEW, C.UPDATE_ACTION_CANCELLED))
        .alias("n_other_action"),
        F.count_if(F.col("session_type") == C.SESSION_REGULAR).alias("n_regular"),
        F.count_if(F.col("session_type") == C.SESSION_AFTER_HOURS).alias("n_after_hours"),
        F.count_if(F.col("trade_date") == F.col("reference_date")).alias("n_own_session"),
        F.count_if(F.col("trade_date") != F.col("reference_date")).alias("n_other_session"),
        F.count_if(F.col("buyer_broker").isNull()).alias("n_anonymous_buyer"),
    )


# Bar units and their length on the wall clock.
BAR_MILLIS = {"minute": 60_000, "hour": 3_600_000, "day": 86_400_000}


def bars(ticks: DataFrame, unit: str = "minute") -> DataFrame:
    """OHLCV bars per (feed, symbol, bar start), valid timestamps only.

    Ties within one millisecond are broken by ``source_row`` (TXT order),
    never by ``trade_id``.  Cancelled trades are excluded.  Bars start on
    whole minutes, hours or days of the exchange's local time, whatever the
    session zone is.  A pure partial aggregate: no window, no per-symbol
    collection.
    """
    if unit not in BAR_MILLIS:
        raise ValueError(f"bars are by {sorted(BAR_MILLIS)}, got {unit!r}")
    t = ticks.where(F.col("timestamp").isNotNull()
                    & (F.col("update_action") != C.UPDATE_ACTION_CANCELLED))
    # from_utc_timestamp shifts an instant by the zone's offset, so the shifted
    # millis are wall-clock millis and their whole units are local ones
    wall = F.unix_millis(F.from_utc_timestamp("timestamp", C.TIMEZONE))
    offset = F.pmod(wall, F.lit(BAR_MILLIS[unit]))
    start = F.to_utc_timestamp(F.timestamp_millis(wall - offset), C.TIMEZONE)
    t = t.withColumn("bar_start", start)
    # Order inside a bar = (time, TXT line).  The wall offset (< 2^27 ms in a
    # day) and the line (an int, < 2^31) pack into one BIGINT, so
    # min_by/max_by keep fixed-width buffers (hash aggregate).  On a day whose
    # clock is set back, the repeated hour is ordered by TXT line.
    order = F.shiftleft(offset, 32) + F.col("source_row").cast("bigint")
    return t.groupBy("feed", "symbol", "bar_start").agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.sum("quantity").alias("volume"),
        F.count(F.lit(1)).alias("n_trades"),
    )
