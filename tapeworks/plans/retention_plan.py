"""Retention over real listings: which local files may go, given what the store holds.

Local files lie in ``{feed}/{raw|zip|ticks}/`` (feed in lower case); the store
has archives and ticks under their keys, a day's ticks as one file or, as
:mod:`.publish` writes them, as a folder.  Both sides are listings, no file is
opened, and the decision is a join of names.  A store that can't be listed
keeps every file that would need it (``error``); one that is not there holds
nothing.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys as K
from ..operators import retention
from ..sources.inventory import list_files

LOCAL_PATTERN = r"/([a-z]+)/(raw|zip|ticks)/[^/]+$"
DAY_FOLDER = r"/([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+\.parquet$"


def local_files(spark: SparkSession, root: str, feeds=("RV", "DERIV")) -> DataFrame:
    """``(path, feed, kind, name, length, file_date, archive_key)``; a name of another form has no date."""
    found = list_files(spark, root)
    feed = F.upper(F.regexp_extract("path", LOCAL_PATTERN, 1))
    named = found.select("path", "name", "length", feed.alias("feed"), F.regexp_extract("path", LOCAL_PATTERN, 2).alias("kind"))
    named = named.where(F.col("feed").isin(*feeds))
    of_zip: Column = F.lit(None).cast("date")
    for f in feeds:
        of_zip = F.when(F.col("feed") == f, K.name_date(F.col("name"), f)).otherwise(of_zip)
    dated = named.withColumn("file_date", F.when(F.col("kind") == "zip", of_zip).otherwise(K.ticks_name_date(F.col("name"))))
    key = (F.when(F.col("kind") == "zip", K.archive_key(F.col("feed"), F.col("file_date")))
            .when(F.col("kind") == "ticks", K.ticks_key(F.col("feed"), F.col("file_date"))))
    return dated.withColumn("archive_key", key)


def store_keys(spark: SparkSession, store: str) -> DataFrame:
    """``(archive_key)`` of everything in the store, a day's folder under the key of its file."""
    name = re.escape(store.rstrip("/").rsplit("/", 1)[-1])
    rel = F.regexp_extract("path", rf"/{name}/(b3/.*)$", 1)  # every key begins so
    return list_files(spark, store).select(F.regexp_replace(rel, DAY_FOLDER, "/$1.parquet").alias("archive_key")).distinct()


def plan(spark: SparkSession, local: str, store: str, today: dt.date, retention_days: int) -> DataFrame:
    """One decision per local file (see :mod:`..operators.retention`)."""
    try:
        keys, failed = store_keys(spark, store), False
    except Exception:  # noqa: BLE001 - whatever keeps the store from being listed
        keys, failed = spark.createDataFrame([], "archive_key string"), True
    files = local_files(spark, local).withColumn("check_failed", F.lit(failed))
    return retention.decide(files, keys, F.lit(today), retention_days)
