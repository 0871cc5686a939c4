"""Upserts as pure functions of the current rows and the changes; each is one shuffle on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.catalog import latest
from quire.session import cut


def upsert(current: DataFrame, changes: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The last row of each key by ``seq``; current rows come before all changes, columns that one side lacks are null."""
    both = current.withColumn("_new", F.lit(0)).unionByName(changes.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    return latest(both, key, [F.desc("_new"), F.desc_nulls_last(seq)]).drop("_new")


def add_missing(current: DataFrame, changes: DataFrame, key: list[str], order: str) -> DataFrame:
    """The changes whose key is not there yet, the first of each key."""
    first = latest(changes, key, [F.asc(order)])
    condition = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in key]
    return first.alias("x").join(current.select(*key).alias("y"), condition, "left_anti")


def merge_categories(current: DataFrame, changes: DataFrame) -> DataFrame:
    """(name, description, keywords_json, dynamic): new descriptions and keywords where there are any; dynamic stays once set."""
    new = changes.select("name", F.col("description").alias("d"), F.col("keywords_json").alias("k"), F.col("dynamic").alias("y"))
    joined = current.join(new, "name", "full")
    keywords = F.when(F.coalesce("k", F.lit("[]")) != "[]", F.col("k")).otherwise(F.coalesce("keywords_json", "k", F.lit("[]")))
    return joined.select("name", F.coalesce("d", "description").alias("description"), keywords.alias("keywords_json"), F.greatest(F.coalesce("dynamic", F.lit(0)), F.coalesce("y", F.lit(0))).alias("dynamic"))


def fold_events(events: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The state that a log of events leads to: its last status, the number of its rows, its last error that is not null."""
    stamp = F.struct(*order)
    return events.groupBy(key).agg(
        F.count(F.lit(1)).alias("events"),
        F.max_by("status", stamp).alias("status"),
        F.max_by(F.when(F.col("error").isNotNull(), F.col("error")), F.when(F.col("error").isNotNull(), stamp)).alias("last_error"),
    )


def keep_better(current: DataFrame, changes: DataFrame, key: str, good: str) -> DataFrame:
    """Changes replace rows, but never one whose status is already ``good`` by one that is not."""
    new = changes.select(F.col(key), F.col("status").alias("new_status"))
    joined = current.select(key, "status").join(new, key, "full")
    kept = F.when((F.col("status") == good) & (F.coalesce("new_status", F.lit("")) != good), F.col("status")).otherwise(F.coalesce("new_status", "status"))
    return joined.select(key, kept.alias("status"))


def expire(downloads: DataFrame, now: str, hours: int = 2) -> DataFrame:
    """Downloads under way since more than ``hours`` before ``now`` become failed ones."""
    old = (F.col("status") == "downloading") & (F.col("updated_at") < F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(0), F.lit(max(1, hours))))
    return downloads.select("id", "file_id", F.when(old, "failed").otherwise(F.col("status")).alias("status"), F.coalesce(old, F.lit(False)).alias("expired"))


def batches(df: DataFrame, key: str, size: int, within: str) -> DataFrame:
    """(…, batch): rows of each ``within`` in fixed-size chunks by key. Rows are laid out by range and numbered within each partition;
    a ``within`` that holds a third of all rows spans many partitions, whose counts (a row for each) shift the numbers."""
    laid = cut(df.repartitionByRange(within, key).sortWithinPartitions(within, key).withColumn("_part", F.spark_partition_id()))
    n = F.row_number().over(Window.partitionBy("_part", within).orderBy(key))
    counts = laid.groupBy("_part", within).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select(F.col("_part").alias("_p"), F.col(within).alias("_w"), before.alias("_before"))
    joined = laid.withColumn("_n", n).join(shifts, (F.col("_part") == F.col("_p")) & F.col(within).eqNullSafe(F.col("_w")))
    return joined.withColumn("batch", F.floor((F.col("_n") + F.col("_before") - 1) / size)).drop("_part", "_n", "_p", "_w", "_before")


def budget_prefix(entries: DataFrame, group: str, order: str, cost: str, budget: int) -> DataFrame:
    """The newest rows of each group until their cost exceeds the budget for the first time."""
    spent = F.sum(cost).over(Window.partitionBy(group).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0))
    return entries.withColumn("spent", spent).filter(F.col("spent") <= budget)
