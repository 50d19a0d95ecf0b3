"""Session summaries as a stream over the lake's commits.

Every commit says, per published file, how many trades and how much volume it
holds of each session.  The stream keeps those few numbers per feed as keyed
state, finds each session's previous and next file among the files seen so
far, and emits a session once a file later than it has come: trades of a
session can sit in the file before it, its own and the one after.  It is
emitted again if a late or rebuilt file changes it.  With ``wait``, a session
that no later file follows is emitted by a timer when that time has passed;
timers need a stream that keeps running (Spark goes on looking at them for
ever, so a run over what is there now has none).  Ticks are never read again,
and one key's state is one row per file and one per session and file.

Rows carry the commit version they follow from.  The sink overwrites one
partition per session, so a replayed micro-batch writes what it wrote before.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..plans.lake import COMMIT_SCHEMA

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SESSION_SCHEMA = ("feed string, session_date date, n_trades long, from_previous_file long, from_own_file long, "
                  "from_next_file long, outside_window long, volume long, complete boolean, version long")
PLACES = ("from_previous_file", "from_own_file", "from_next_file", "outside_window")


def neighbours(files: list[str], day: str) -> tuple[str | None, str | None]:
    """The files before and after ``day`` (ISO text, sorted)."""
    before = [f for f in files if f < day]
    after = [f for f in files if f > day]
    return (max(before, default=None), min(after, default=None))


def summary(day: str, files: list[str], parts: dict[str, list[int]]) -> dict:
    """One session from its parts ``{file: [n_trades, volume]}``, by the rule of the batch summary."""
    previous, following = neighbours(files, day)
    out = dict.fromkeys(PLACES, 0) | {"n_trades": 0, "volume": 0}
    for f, (n, volume) in parts.items():
        place = ("outside_window" if day not in files else "from_own_file" if f == day else
                 "from_previous_file" if f == previous else "from_next_file" if f == following else "outside_window")
        out[place] += n
        out["n_trades"] += n
        out["volume"] += volume
    return out | {"session_date": dt.date.fromisoformat(day), "complete": following is not None}


class Sessions(StatefulProcessor):
    """State of one feed: its files (version and sessions) and its sessions (numbers per file)."""

    def __init__(self, wait_ms: int | None):
        self.wait_ms = wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.files = handle.getMapState("files", "file string", "version long, sessions string")
        self.parts = handle.getMapState("parts", "session string", "files string")
        self.pending = handle.getMapState("pending", "session string", "version long")

    def close(self) -> None:
        pass

    def _take(self, file: str, version: int, sessions: list) -> set[str]:
        """Puts a file's numbers in place of those it had; the sessions that this touches."""
        known = self.files.getValue((file,)) if self.files.containsKey((file,)) else None
        if known and known[0] >= version:
            return set()
        new = {str(s["session_date"]): [int(s["n_trades"]), int(s["volume"])] for s in sessions if s["session_date"] is not None}
        old = json.loads(known[1]) if known else []
        for day in {*old, *new}:
            parts = json.loads(self.parts.getValue((day,))[0]) if self.parts.containsKey((day,)) else {}
            parts.pop(file, None)
            if day in new:
                parts[file] = new[day]
            if parts:
                self.parts.updateValue((day,), (json.dumps(parts),))
            elif self.parts.containsKey((day,)):
                self.parts.removeKey((day,))
        self.files.updateValue((file,), (version, json.dumps(sorted(new))))
        return {*old, *new, file}

    def _rows(self, feed: str, days: dict[str, int], files: list[str], now: bool) -> pd.DataFrame:
        out = []
        for day, version in sorted(days.items()):
            if not self.parts.containsKey((day,)):
                continue
            row = summary(day, files, json.loads(self.parts.getValue((day,))[0]))
            if row["complete"] or now:
                out.append({"feed": feed, "version": version, **row})
                if self.pending.containsKey((day,)):
                    self.pending.removeKey((day,))
            else:
                self.pending.updateValue((day,), (version,))
        return pd.DataFrame(out, columns=[c.split()[0] for c in SESSION_SCHEMA.split(", ")])

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = sorted(((int(r["version"]), str(r["file_date"]), list(r["sessions"])) for pdf in rows for _, r in pdf.iterrows()),
                        key=lambda e: e[:2])
        before, touched = sorted(k[0] for k in self.files.keys()), {}
        for version, file, sessions in events:
            touched |= dict.fromkeys(self._take(file, version, sessions), version)
        files = sorted({*before, *(f for _, f, _ in events)})
        version = max((v for v, _, _ in events), default=0)
        for f in set(files) - set(before):  # a new file is a neighbour of the files beside it, and of sessions without one
            touched |= {d: version for d in neighbours(files, f) if d is not None and d not in touched}
        waiting = {k[0]: version for k in self.pending.keys()}
        out = self._rows(key[0], waiting | touched, files, False)
        if self.wait_ms is not None and any(True for _ in self.pending.keys()):
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)
        if len(out):
            yield out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """What still waits for a later file is emitted as it stands."""
        waiting = {k[0]: v[0] for k, v in self.pending.iterator()}
        out = self._rows(key[0], waiting, sorted(k[0] for k in self.files.keys()), True)
        if len(out):
            yield out


def session_stream(spark: SparkSession, lake: str, wait: dt.timedelta | None = None,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of :data:`SESSION_SCHEMA` over the commits of ``lake``."""
    reader = spark.readStream.schema(COMMIT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    files = reader.json(f"{lake}/commits").select("feed", "file_date", "version", "sessions")
    return files.groupBy("feed").transformWithStateInPandas(
        statefulProcessor=Sessions(None if wait is None else int(wait.total_seconds() * 1000)),
        outputStructType=SESSION_SCHEMA, outputMode="Update", timeMode="None" if wait is None else "ProcessingTime")


def run_session_stream(spark: SparkSession, lake: str, checkpoint: str, available_now: bool = True,
                       every: str = "1 minute", wait: dt.timedelta | None = None, max_files_per_trigger: int | None = None):
    """Keeps ``{lake}/sessions`` up to date; with ``available_now`` it ends when all commits are taken."""
    if available_now and wait is not None:
        raise ValueError("timers need a stream that keeps running: wait goes with available_now=False")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        # one row per session, the newest; a session is one partition, so writing again changes nothing
        newest = batch.groupBy("feed", "session_date").agg(F.max_by(F.struct("*"), "version").alias("_r")).select("_r.*")
        (newest.repartition("feed").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("feed", "session_date").parquet(f"{lake}/sessions"))

    writer = (session_stream(spark, lake, wait, max_files_per_trigger).writeStream.outputMode("update")
              .foreachBatch(each_batch).option("checkpointLocation", checkpoint))
    query = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=every)).start()
    if available_now:
        query.awaitTermination()
    return query


def read_sessions(spark: SparkSession, lake: str) -> DataFrame:
    """The newest summary of every session emitted so far."""
    return spark.read.schema(SESSION_SCHEMA).parquet(f"{lake}/sessions")
