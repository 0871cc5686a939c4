"""Counts, breakdowns, histograms and time series over the catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.catalog import Catalog
from quire.predicates import or_else, usable_text


def count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def distinct_if(condition: Column, column: str) -> Column:
    return F.count_distinct(F.when(condition, F.col(column)))


def is_downloaded() -> Column:
    return F.col("download_status") == "downloaded"


def is_failed() -> Column:
    return F.col("download_status") == "failed"


def is_processed() -> Column:
    return F.col("extraction_status") == "processed"


def stats(c: Catalog) -> DataFrame:
    """(metric, key, value): global counts and counts by group in long form."""

    def one(metric: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(metric).alias("metric"), F.lit("").alias("key"), "value")

    def by(metric: str, df: DataFrame, key: Column) -> DataFrame:
        return df.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("value")).select(F.lit(metric).alias("metric"), "key", "value")

    parts = [
        one("works", c.works),
        one("files", c.files),
        by("files_by_site", c.files, or_else("site", "")),
        by("downloads", c.downloads, or_else("status", "")),
        by("extractions", c.extractions, or_else("status", "")),
        by("scans", c.downloads, or_else("scan_status", "unscanned")),
        by("raw_archives", c.downloads, optional(c.downloads, "raw_archive_status", "local")),
        one("corpus_specs", c.read("corpus_specs")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def summary(c: Catalog) -> DataFrame:
    """One row of key figures over the left-joined chain; bytes repeat for each extraction of a download, as defined."""
    return c.chain.agg(
        F.count_distinct("work_id").alias("works"),
        F.count_distinct("file_id").alias("files"),
        F.sum("bytes").alias("bytes"),
        F.sum(F.when(is_processed(), F.col("char_count"))).alias("chars"),
        distinct_if(is_downloaded(), "file_id").alias("downloaded"),
        distinct_if(is_failed(), "file_id").alias("failed"),
        distinct_if(F.col("download_id").isNull(), "file_id").alias("untried"),
        distinct_if(is_processed(), "extraction_id").alias("processed"),
        distinct_if(F.col("extraction_status") == "failed", "extraction_id").alias("extraction_failed"),
        distinct_if(F.col("extraction_status") == "skipped", "extraction_id").alias("skipped"),
        distinct_if(usable_text(), "extraction_id").alias("usable_texts"),
    )


def site_breakdown(c: Catalog, known: tuple[str, ...] = ("nowhere.example.org",)) -> DataFrame:
    """Files, downloads and texts by site, with zero rows for known sites without any."""
    counted = c.chain.groupBy("site").agg(
        F.count_distinct("work_id").alias("works"),
        F.count("file_id").alias("files"),
        count_if(is_downloaded()).alias("downloaded"),
        count_if(is_failed()).alias("failed"),
        count_if(F.col("download_status").isin("pending", "downloading")).alias("active"),
        count_if(F.col("trust_level") != "trusted").alias("untrusted"),
        count_if(is_processed()).alias("processed"),
        count_if(usable_text()).alias("usable"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.when(is_processed(), F.col("char_count"))), F.lit(0)).alias("chars"),
    )
    sites = c.spark.createDataFrame([(s,) for s in known], "site string")  # a short configured list
    missing = sites.join(counted.select("site"), "site", "left_anti")
    numbers = [n for n in counted.columns if n != "site"]
    return counted.unionByName(missing.select("site", *[F.lit(0).cast("long").alias(n) for n in numbers])).orderBy(F.desc("files"), F.desc("works"), "site")


def format_breakdown(c: Catalog) -> DataFrame:
    return c.chain.groupBy(or_else("format", "unknown").alias("format")).agg(
        F.count("file_id").alias("files"), count_if(is_downloaded()).alias("downloaded"), count_if(is_failed()).alias("failed"), count_if(is_processed()).alias("processed"), count_if(usable_text()).alias("usable")
    )


def trust_breakdown(c: Catalog) -> DataFrame:
    return c.chain.groupBy(or_else("trust_level", "trusted").alias("trust_level")).agg(
        F.count(F.lit(1)).alias("rows"), count_if(is_downloaded()).alias("downloaded"), count_if(is_failed()).alias("failed"), count_if(F.col("scan_status") == "infected").alias("infected"), count_if(is_processed()).alias("processed"), count_if(usable_text()).alias("usable")
    )


def category_breakdown(c: Catalog) -> DataFrame:
    """Texts of downloaded files by category; a name outside the table of categories is reported as it is."""
    names = c.read("categories").select(F.col("name").alias("category"), F.lit(True).alias("known"))
    rows = c.chain.filter(is_downloaded()).withColumn("category", or_else("category", "unprocessed"))
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("char_count"), F.lit(0)).alias("chars")).join(F.broadcast(names), "category", "left").select("category", "rows", "chars", F.coalesce("known", F.lit(False)).alias("known"))  # categories do not grow


def category_rollup(c: Catalog) -> DataFrame:
    """Categories with invalid names folded into one, with the description and keywords of the first that has any, dynamic
    where any is, ordered by count, characters and name."""
    from quire.functions.text import valid_category

    about = c.read("categories").select(F.col("name").alias("category"), "description", "keywords_json", "dynamic")
    rows = category_breakdown(c).join(F.broadcast(about), "category", "left")  # categories do not grow
    folded = rows.withColumn("source", F.col("category")).withColumn("category", F.when(valid_category(F.col("category")), F.col("category")).otherwise("uncategorized"))
    first = lambda c, empty: F.min_by(c, F.when(F.coalesce(c, F.lit(empty)) != empty, F.col("source")))
    rolled = folded.groupBy("category").agg(F.sum("rows").alias("rows"), F.sum("chars").alias("chars"), first("description", "").alias("description"), F.coalesce(first("keywords_json", "[]"), F.lit("[]")).alias("keywords_json"), F.max(F.coalesce("dynamic", F.lit(0))).alias("dynamic"))
    return rolled.orderBy(F.desc("rows"), F.desc("chars"), "category")


def category_counts(c: Catalog) -> DataFrame:
    """Every category with its texts, zero included."""
    used = c.extractions.groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.sum("char_count").alias("chars"))
    return c.read("categories").select("name", "dynamic").join(used, F.col("name") == F.col("category"), "left").select("name", "dynamic", F.coalesce("n", F.lit(0)).alias("texts"), F.coalesce("chars", F.lit(0)).alias("chars"))


def optional(df: DataFrame, column: str, default: str) -> Column:
    """A column that a catalogue may lack."""
    return or_else(column, default) if column in df.columns else F.lit(default)


def status_hist(c: Catalog) -> DataFrame:
    """(kind, status, n): downloads, scans and raw archives by downloads, extractions and quality by extractions."""

    def counted(df: DataFrame, **kinds: Column) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), status.alias("status")) for kind, status in kinds.items()])).alias("p")
        return df.select(pairs).groupBy("p.kind", "p.status").agg(F.count(F.lit(1)).alias("n"))

    d, e = c.downloads, c.extractions
    loads = counted(d, download=F.col("status"), scan=or_else("scan_status", "unscanned"), raw=optional(d, "raw_archive_status", "local"))
    return loads.unionByName(counted(e, extraction=F.col("status"), quality=or_else("quality_status", "unvalidated")))


def timeseries(df: DataFrame, column: str, bucket: str, total: str | None = None, limit: int = 90) -> DataFrame:
    """The newest ``limit`` day or hour buckets with their counts, and a total where asked for."""
    pattern = {"day": "yyyy-MM-dd", "hour": "yyyy-MM-dd HH:00"}[bucket]
    aggs = [F.count(F.lit(1)).alias("n"), *([F.coalesce(F.sum(total), F.lit(0)).alias("total")] if total else [])]
    return df.filter(F.col(column).isNotNull()).groupBy(F.date_format(column, pattern).alias("bucket")).agg(*aggs).orderBy(F.desc("bucket")).limit(limit)


def dimensions(c: Catalog) -> DataFrame:
    """(dimension, value, n) of the filters that listings offer: sites, formats and trust of files, scans and raw archives of
    downloads, the categories with their texts (invalid names as one), the queries of works."""

    def counted(df: DataFrame, **columns: Column) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), v.alias("value")) for d, v in columns.items()])).alias("p")
        return df.select(pairs).groupBy("p.dimension", "p.value").agg(F.count(F.lit(1)).alias("n"))

    from quire.functions.text import valid_category

    files = counted(c.files, site=F.col("site"), format=F.col("format"), trust=F.col("trust_level"))
    loads = counted(c.downloads, scan=or_else("scan_status", "unscanned"), raw=optional(c.downloads, "raw_archive_status", "local"))
    named = category_counts(c).withColumn("value", F.when(valid_category(F.col("name")), F.col("name")).otherwise("uncategorized"))
    categories = named.groupBy(F.lit("category").alias("dimension"), "value").agg(F.sum("texts").alias("n"))
    queries = counted(c.works.filter("search_query is not null"), search_query=F.col("search_query"))
    return files.unionByName(loads).unionByName(categories).unionByName(queries)


def list_works(c: Catalog, limit: int = 50, offset: int = 0, query: str | None = None, site: str | None = None) -> DataFrame:
    """Works with their file counts, newest first, a page at a time."""
    from quire.predicates import ascii_contains

    works = c.works
    if query:
        works = works.filter(ascii_contains(F.col("title"), query) | ascii_contains(F.col("author"), query) | ascii_contains(F.col("search_query"), query))
    if site:
        works = works.join(c.files.filter(F.col("site") == site).select(F.col("work_id").alias("id")), "id", "left_semi")
    page = works.orderBy(F.desc("created_at"), F.desc("id")).offset(offset).limit(limit)
    # the page is at most ``limit`` rows, so its semi join keeps the counting to the files of the page
    counts = c.chain.join(F.broadcast(page.select(F.col("id").alias("work_id"))), "work_id", "left_semi").groupBy("work_id").agg(F.count_distinct("file_id").alias("files"), distinct_if(is_downloaded(), "file_id").alias("downloaded"), distinct_if(usable_text(), "extraction_id").alias("usable"))
    return page.join(counts, page["id"] == counts["work_id"], "left").select("id", "title", "author", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("files", "downloaded", "usable")])


def list_files(c: Catalog, limit: int = 100, download: str | None = None, extraction: str | None = None, site: str | None = None) -> DataFrame:
    rows = c.chain.withColumn("download_state", or_else("download_status", "pending")).withColumn("extraction_state", or_else("extraction_status", "pending"))
    for column, value in (("download_state", download), ("extraction_state", extraction), ("site", site)):
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows.orderBy(F.desc("file_id"), F.desc_nulls_last("extraction_id")).limit(limit).select("file_id", "extraction_id", "work_id", "site", "format", "download_state", "extraction_state")


def list_texts(c: Catalog, limit: int = 100, quality: str | None = None, category: str | None = None) -> DataFrame:
    rows = c.chain.filter(is_processed() & F.col("text_uri").isNotNull()).withColumn("quality", or_else("quality_status", "unvalidated")).withColumn("label", or_else("category", "uncategorized"))
    if quality:
        rows = rows.filter(F.col("quality") == quality)
    if category:
        rows = rows.filter(F.col("label") == category)
    works = c.works.select(F.col("id").alias("work_id"), "title")
    return rows.join(works, "work_id").orderBy(F.desc("extraction_id"), F.desc("file_id")).limit(limit).select("extraction_id", "file_id", "title", "site", "quality", "label", "char_count")


def works_with_files(c: Catalog) -> DataFrame:
    """Each work with the formats of its files as one sorted list."""
    per = c.files.groupBy("work_id").agg(F.count(F.lit(1)).alias("files"), F.concat_ws(",", F.sort_array(F.collect_set("format"))).alias("formats"))
    return c.works.select(F.col("id").alias("work_id"), "title").join(per, "work_id", "left").select("work_id", "title", F.coalesce("files", F.lit(0)).alias("files"), F.coalesce("formats", F.lit("")).alias("formats"))


def recent_activity(c: Catalog, limit: int = 25) -> DataFrame:
    """The newest events of the catalogue, of three kinds."""
    parts = [
        c.works.select(F.lit("work").alias("kind"), "id", F.col("created_at").alias("at")),
        c.downloads.select(F.lit("download").alias("kind"), "id", F.col("updated_at").alias("at")),
        c.extractions.select(F.lit("extraction").alias("kind"), "id", F.col("processed_at").alias("at")),
    ]
    newest = [p.filter(F.col("at").isNotNull()).orderBy(F.desc("at"), F.desc("id")).limit(limit) for p in parts]
    return newest[0].unionByName(newest[1]).unionByName(newest[2]).orderBy(F.desc("at"), "kind", F.desc("id")).limit(limit).select("kind", "id", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))
