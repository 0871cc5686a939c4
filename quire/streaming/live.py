"""Streams that are started: each reads what is there (``Trigger.AvailableNow``), keeps its state and progress in a folder that all
executors share, and gives its result as a table. Run again on the same folder they go on where they ended."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.catalog import Catalog
from quire.operators import search
from quire.session import shared_dir
from quire.streaming import feeds


def new_folder(c: Catalog, name: str) -> str:
    return f"{shared_dir(c.spark)}/{name}-{uuid.uuid4().hex}"


def source(c: Catalog) -> DataFrame:
    """The events of a catalogue as a stream of files."""
    return feeds.event_stream(c.spark, c.path)


def finished(stream: DataFrame, folder: str, mode: str, each: Callable[[DataFrame, int], None]) -> None:
    """Runs a stream until its input is used up; every batch goes to ``each``."""
    stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start().awaitTermination()


def snapshot(folder: str) -> Callable[[DataFrame, int], None]:
    """For a complete result: each batch replaces the table, and writes the same one when it runs again."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/table")


def appended(folder: str) -> Callable[[DataFrame, int], None]:
    """For new rows: each batch has a part of its own, so a batch that runs again adds nothing."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/table/batch={number}")


def hourly_dashboard(c: Catalog) -> DataFrame:
    """Counts by hour and type that are refreshed as a whole with every batch."""
    folder = new_folder(c, "hourly")
    finished(feeds.hourly(source(c)), folder, "complete", snapshot(folder))
    return c.spark.read.parquet(f"{folder}/table")


def sliding(c: Catalog) -> DataFrame:
    """(start, event_type, n) in windows of two hours that begin every hour."""
    folder = new_folder(c, "sliding")
    rows = feeds.with_time(source(c)).withWatermark("at", "1 hour").groupBy(F.window("at", "2 hours", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    finished(rows.select(F.date_format("window.start", "yyyy-MM-dd HH:00").alias("start"), "event_type", "n"), folder, "complete", snapshot(folder))
    return c.spark.read.parquet(f"{folder}/table")


def status_feed(c: Catalog) -> DataFrame:
    """The newest event of each user: each batch is folded first, and only a newer event replaces one."""
    folder = new_folder(c, "status")
    state = {"last": None}

    def each(batch: DataFrame, number: int) -> None:
        rows = batch if state["last"] is None else batch.unionByName(c.spark.read.parquet(state["last"]))
        feeds.latest_status(rows).write.mode("overwrite").parquet(f"{folder}/v{number}")
        state["last"] = f"{folder}/v{number}"

    finished(source(c).select("user_id", "event_id", "event_type"), folder, "append", each)
    return c.spark.read.parquet(state["last"])


def clicks_after_views(c: Catalog, minutes: int = 30) -> DataFrame:
    """(user_id, view_id, click_id): clicks within half an hour of a view of the same user, as a join of two streams on event time;
    the state of either side is dropped behind the watermark."""
    folder = new_folder(c, "joined")
    rows = lambda kind, name: feeds.with_time(source(c)).filter(F.col("event_type") == kind).select(F.col("user_id").alias(f"{name}_user"), F.col("event_id").alias(f"{name}_id"), F.col("at").alias(f"{name}_at")).withWatermark(f"{name}_at", "1 hour")
    near = F.expr(f"view_user = click_user and click_at >= view_at and click_at <= view_at + interval {minutes} minutes")
    joined = rows("view", "view").join(rows("click", "click"), near).select(F.col("view_user").alias("user_id"), "view_id", "click_id")
    finished(joined, folder, "append", appended(folder))
    return c.spark.read.parquet(f"{folder}/table").drop("batch")


def sequential_workers(c: Catalog) -> DataFrame:
    """(user_id, done, stopped, queued): one ordered queue for each key; the first failure stops a key's worker and leaves the rest
    queued. What a worker gets done is known from where its first failure stands, so a long queue is never held by one task."""
    rows = c.read("events").select("user_id", "event_id", "event_type")
    first = rows.groupBy("user_id").agg(F.min(F.when(F.col("event_type") == "error", F.col("event_id"))).alias("at"), F.count(F.lit(1)).alias("n"))
    before = rows.join(first, "user_id").filter(F.col("at").isNull() | (F.col("event_id") < F.col("at"))).groupBy("user_id").agg(F.count(F.lit(1)).alias("done"))
    joined = first.join(before, "user_id", "left").withColumn("done", F.coalesce("done", F.lit(0)))
    stopped = F.col("at").isNotNull()
    return joined.select("user_id", "done", stopped.alias("stopped"), (F.col("n") - F.col("done") - stopped.cast("int")).alias("queued"))


def indexed_search(c: Catalog, terms: list[str]) -> DataFrame:
    """The scores of a search over an index written for it."""
    folder = new_folder(c, "index")
    search.write_index(search.indexed_texts(c), folder)
    return search.search_index(c.spark, folder, terms)
