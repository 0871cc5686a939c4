"""The catalogue's tables as DataFrames: works 1-N files 1-0..1 downloads 1-N extractions 1-0..1 documents."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.session import table


def latest(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The last row of each key: replayed and superseded rows go. One shuffle on the key; ties need a total order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


@dataclass(frozen=True)
class Catalog:
    """Lazily read tables of one catalogue directory."""

    spark: SparkSession
    path: str

    def read(self, name: str) -> DataFrame:
        return table(self.spark, self.path, name)

    @cached_property
    def works(self) -> DataFrame:
        return self.read("works")

    @cached_property
    def files(self) -> DataFrame:
        return self.read("files")

    @cached_property
    def downloads(self) -> DataFrame:
        """At most one row for each file: the newest state."""
        return latest(self.read("downloads"), ["file_id"], [F.desc_nulls_last("updated_at"), F.desc("id")])

    @cached_property
    def extractions(self) -> DataFrame:
        return self.read("extractions")

    @cached_property
    def documents(self) -> DataFrame:
        return self.read("documents")

    @cached_property
    def chain(self) -> DataFrame:
        """Files with their download and extractions, if any; a download with two extractors gives two rows."""
        f, d, e = self.files, self.downloads, self.extractions
        return (
            f.select(F.col("id").alias("file_id"), "work_id", "site", "format", "url", "file_size", "download_url", "trust_level", "download_disabled_at", F.col("created_at").alias("file_created_at"))
            .join(d.select("file_id", F.col("id").alias("download_id"), F.col("status").alias("download_status"), "bytes", "attempts", "error", "scan_status", F.col("updated_at").alias("download_updated_at")), "file_id", "left")
            .join(e.select("download_id", F.col("id").alias("extraction_id"), "extractor", F.col("status").alias("extraction_status"), "text_uri", "text_sha256", "char_count", "category", "quality_status", "processed_at"), "download_id", "left")
        )
