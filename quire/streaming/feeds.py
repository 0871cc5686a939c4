"""Structured Streaming counterparts of the status feed, the seen-item set, hourly counts and the staleness timeout.

Each takes a streaming DataFrame (or a static one, with the same result on the same rows) of events: event_id, ts, user_id,
event_type, value.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quire.operators.merge import upsert

EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def event_stream(spark: SparkSession, folder: str, pattern: str = "events*.parquet", files: int = 1) -> DataFrame:
    """The event files of a folder as a stream, ``files`` at a time."""
    return spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).option("pathGlobFilter", pattern).parquet(folder)


def with_time(events: DataFrame) -> DataFrame:
    return events.withColumn("at", F.col("ts").cast("timestamp"))


def deduplicated(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event_id once; the state of a stream is dropped behind the watermark."""
    rows = with_time(events)
    return rows.withWatermark("at", late).dropDuplicatesWithinWatermark(["event_id"]) if rows.isStreaming else rows.dropDuplicates(["event_id"])


def hourly(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """(hour, event_type, n, total) in tumbling windows."""
    rows = with_time(events)
    if rows.isStreaming:
        rows = rows.withWatermark("at", late)
    return rows.groupBy(F.window("at", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.date_format("window.start", "yyyy-MM-dd HH:00").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """(user_id, start, n) of runs of events without a gap."""
    rows = with_time(events)
    if rows.isStreaming:
        rows = rows.withWatermark("at", late)
    return rows.groupBy("user_id", F.session_window("at", gap)).agg(F.count(F.lit(1)).alias("n")).select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


def stale_users(events: DataFrame, quiet_ms: int = 7_200_000) -> DataFrame:
    """A stream of (user_id, last_event, events) for users that send nothing for a while: custom state with a timeout."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, n = state.get if state.exists else (-1, 0)
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"user_id": [key[0]], "last_event": [last], "events": [n]})
            return
        for frame in frames:
            last, n = max(last, int(frame["event_id"].max())), n + len(frame)
        state.update((last, n))
        state.setTimeoutDuration(quiet_ms)

    return events.groupBy("user_id").applyInPandasWithState(step, "user_id long, last_event long, events long", "last long, n long", "append", GroupStateTimeout.ProcessingTimeTimeout)


def latest_status(events: DataFrame) -> DataFrame:
    """(user_id, event_id, event_type): the newest event of each user."""
    return events.groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.max_by("event_type", "event_id").alias("event_type"))


def upsert_sink(path: str, key: list[str], seq: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: keeps snapshots ``path/v<batch>`` of the upserted rows. A batch that runs again writes the same
    snapshot again, so the result is exactly once."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        rows = batch
        if number:
            rows = upsert(spark.read.parquet(f"{path}/v{number - 1}"), batch, key, seq)
        else:
            rows = upsert(batch.limit(0), batch, key, seq)
        rows.write.mode("overwrite").parquet(f"{path}/v{number}")

    return write
