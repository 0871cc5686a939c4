"""Candidate queues: what is pending, what failed and what to try next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.catalog import Catalog
from quire.functions.urls import is_onion, is_torrent, part
from quire.predicates import blocking, effective_url, format_rank, or_else, size_bytes, url_present, usable_text

#: Errors that will not go away, and those that may (fixed values); more can be given to ``fallback_plan``.
TERMINAL = ("http 404", "refusing bulk archive torrent", "fast_download_not_member")
RETRYABLE = ("timed out", "timeout", "temporarily", "connection", "rate limit", "http 429", "http 500", "http 502", "http 503", "http 504", "stale download attempt")


def blocked_works(c: Catalog) -> DataFrame:
    """The works with a download or text under way or usable: computed once, then anti-joined by work."""
    return c.chain.filter(blocking()).select("work_id").distinct()


def is_runnable(gates: str | None = None, onion: bool = False, torrents: bool = False) -> Column:
    """Whether the URL of a row can be fetched: a file with a path, or http with a host that is no hidden service and no
    torrent, unless these are allowed, and no page of a host and path that match ``gates`` (host before path). A malformed URL cannot."""
    url = effective_url()
    web = part(url, "scheme").isin("http", "https") & (part(url, "host") != "")
    if not onion:
        web = web & ~is_onion(url)
    if not torrents:
        web = web & ~is_torrent(url, F.col("format"), F.col("download_source"))
    if gates:
        web = web & ~F.concat(part(url, "host"), part(url, "path")).rlike(gates)
    return F.coalesce(web | ((part(url, "scheme") == "file") & (part(url, "path") != "")), F.lit(False))


def runnable(df: DataFrame) -> DataFrame:
    return df.filter(is_runnable())


def best_file(df: DataFrame) -> DataFrame:
    """One file for each work: best format, smallest size, best mirror (where there is a rank of mirrors), then the URL and the
    id as text; only files with a URL that can be fetched. A struct minimum: one partial and one final aggregate, no sort of a work's files."""
    mirror = F.coalesce(F.col("mirror_rank"), F.lit(0)) if "mirror_rank" in df.columns else F.lit(0)
    key = F.struct(format_rank(F.col("format")).alias("rank"), size_bytes(F.col("file_size")).alias("size"), mirror.alias("mirror"), F.coalesce(effective_url(), F.lit("")).alias("link"), F.col("file_id").cast("string").alias("name"))
    row = F.struct(*[F.col(x) for x in df.columns if x != "work_id"])
    return runnable(df.filter(url_present())).groupBy("work_id").agg(F.min_by(row, key).alias("r")).select("work_id", "r.*")


def untried_files(c: Catalog) -> DataFrame:
    """Files with a URL that no download was tried of."""
    return c.files.withColumnRenamed("id", "file_id").filter(url_present()).join(c.downloads.select("file_id").distinct(), "file_id", "left_anti")


def pending_files(c: Catalog) -> DataFrame:
    """Untried files with a URL of works that nothing blocks."""
    return untried_files(c).join(blocked_works(c), "work_id", "left_anti")


def pending_downloads(c: Catalog) -> DataFrame:
    return best_file(pending_files(c)).select("work_id", "file_id", "site", "format")


def pending_for_works(c: Catalog, works: DataFrame) -> DataFrame:
    """As ``pending_downloads`` for the works of ``works`` (work_id), without disabled files."""
    return best_file(pending_files(c).filter(F.col("download_disabled_at").isNull()).join(works.select("work_id").distinct(), "work_id", "left_semi")).select("work_id", "file_id", "site", "format")


def pending_for_files(c: Catalog, files: DataFrame) -> DataFrame:
    """The files of ``files`` (file_id) that are enabled and were not tried, whatever else their work has."""
    return untried_files(c).filter(F.col("download_disabled_at").isNull()).join(files.select("file_id").distinct(), "file_id", "left_semi").select("work_id", "file_id", "site", "format")


def works_for_queries(c: Catalog, wanted: list[str]) -> DataFrame:
    return c.works.filter(F.col("search_query").isin([w for w in wanted if w])).select("id")


def best_file_per_work(c: Catalog) -> DataFrame:
    best = best_file(c.files.withColumnRenamed("id", "file_id"))
    return best.select("work_id", "file_id", format_rank(F.col("format")).alias("rank"), size_bytes(F.col("file_size")).alias("size"))


def summary_pending(c: Catalog) -> DataFrame:
    """(pending_works): works with an untried file and no download of any of their files."""
    tried = c.files.select(F.col("id").alias("file_id"), "work_id").join(c.downloads.select("file_id"), "file_id", "left_semi").select("work_id").distinct()
    return untried_files(c).join(tried, "work_id", "left_anti").agg(F.count_distinct("work_id").alias("pending_works"))


def active_failures(c: Catalog) -> DataFrame:
    """Failed downloads of enabled files with a URL, of works that nothing blocks and that have no other file to try."""
    failed = c.chain.filter((F.col("download_status") == "failed") & F.col("download_disabled_at").isNull() & url_present()).dropDuplicates(["download_id"])
    untried = untried_files(c).filter(F.col("download_disabled_at").isNull()).select("work_id").distinct()
    return failed.join(blocked_works(c), "work_id", "left_anti").join(untried, "work_id", "left_anti")


def active_failed(c: Catalog) -> DataFrame:
    return active_failures(c).select("file_id", "work_id", "site", or_else("error", "").alias("error"), "attempts")


def recent_failed(c: Catalog, limit: int = 25) -> DataFrame:
    """The newest active failures with their works."""
    rows = active_failures(c).join(c.works.select(F.col("id").alias("work_id"), "title", "author"), "work_id")
    return rows.orderBy(F.desc("download_updated_at"), F.desc("download_id")).limit(min(25, max(1, limit))).select("download_id", "file_id", "site", "format", "title", "author", "error")


def stuck_downloads(c: Catalog, limit: int = 100) -> DataFrame:
    """The oldest active failures, with the host of their URL."""
    rows = active_failures(c).join(c.works.select(F.col("id").alias("work_id"), "title", "author"), "work_id")
    first = rows.orderBy(F.asc("download_updated_at"), F.asc("download_id")).limit(min(100, max(1, limit)))
    return first.select("download_id", "file_id", "work_id", "title", "author", "site", "format", part(effective_url(), "host").alias("host"), "attempts", "error")


def fallback_plan(failures: DataFrame, terminal: tuple[str, ...] = TERMINAL, retryable: tuple[str, ...] = RETRYABLE) -> DataFrame:
    """(file_id, action, reason) for failed downloads (file_id, attempts, error): disable what will not go away, retry what
    was tried at most twice or may go away, leave the rest for later."""
    error = F.coalesce("error", F.lit(""))
    low = F.lower(error)
    has = lambda words: F.exists(F.array(*[F.lit(w.lower()) for w in words]), lambda w: F.contains(low, w))
    tries = F.coalesce("attempts", F.lit(0))
    action = F.when(has(terminal), "disable").when((tries <= 2) | has(retryable), "retry").otherwise("defer")
    count = tries.cast("string")
    head = F.when(action == "disable", F.concat(F.lit("terminal download error after "), count, F.lit(" attempt(s): "))).when(action == "retry", F.concat(F.lit("retrying potentially transient failure after "), count, F.lit(" attempt(s): "))).otherwise("needs alternate-source discovery; leaving failed row visible: ")
    return failures.select("file_id", action.alias("action"), F.concat(head, F.substring(error, 1, 180)).alias("reason"))


def judged_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``plan`` (file_id, action, download_url) with the action that counts: 'invalid' for files that are not in ``rows``,
    unknown actions and replacements without a public URL."""
    verb = F.lower(F.coalesce("action", F.lit("")))
    public = part(F.col("download_url"), "scheme").isin("http", "https") & (part(F.col("download_url"), "host") != "")
    known = rows.select("file_id").distinct().withColumn("_known", F.lit(True))
    counts = F.when(F.col("_known").isNull() | ~verb.isin("retry", "replace_url", "disable", "defer"), "invalid").when((verb == "replace_url") & ~F.coalesce(public, F.lit(False)), "invalid").otherwise(verb)
    return plan.join(known, "file_id", "left").withColumn("outcome", counts).drop("_known")


def apply_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(outcome, n, requeued): how many actions of each kind a plan comes to, and how many files go back to the queue."""
    again = F.col("outcome").isin("retry", "replace_url")
    return judged_plan(rows, plan).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(again, F.col("file_id"))).alias("requeued"))


def after_plan(files: DataFrame, downloads: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files and downloads after a plan (file_id, outcome, download_url, reason): replaced and disabled URLs, and failed
    downloads of requeued files gone. One join on the file each; the last action of a file counts."""
    last = plan.groupBy("file_id").agg(F.max_by(F.struct("outcome", F.col("download_url").alias("new_url"), "reason"), "reason").alias("p")).select("file_id", "p.*")
    joined = files.join(last.withColumnRenamed("file_id", "id"), "id", "left")
    replaced, off = F.col("outcome") == "replace_url", F.col("outcome") == "disable"
    changed = joined.withColumn("download_url", F.when(replaced, F.col("new_url")).otherwise(F.col("download_url")))
    changed = changed.withColumn("download_disabled_reason", F.when(replaced, F.lit(None)).when(off, F.substring("reason", 1, 1000)).otherwise(F.col("download_disabled_reason"))).withColumn("disabled", F.when(replaced, False).when(off, True).otherwise(F.col("download_disabled_at").isNotNull()))
    gone = last.filter(F.col("outcome").isin("retry", "replace_url")).select("file_id")
    kept = downloads.filter("status = 'failed'").join(gone, "file_id", "left_anti").unionByName(downloads.filter("status is null or status <> 'failed'"))
    return changed.select("id", "download_url", "disabled", "download_disabled_reason"), kept


def pending_extractions(c: Catalog, extractor: str = "plaintext.v2", works: DataFrame | None = None) -> DataFrame:
    """Downloaded files without a row of the extractor; of some works only where ``works`` (work_id) is given."""
    done = c.extractions.filter(F.col("extractor") == extractor).select(F.col("download_id").alias("id"))
    rows = c.downloads.filter("status = 'downloaded'").join(done, "id", "left_anti")
    if works is not None:
        rows = rows.join(c.files.select(F.col("id").alias("file_id"), "work_id").join(works.select("work_id").distinct(), "work_id", "left_semi"), "file_id", "left_semi")
    return rows.select(F.col("id").alias("download_id"), "file_id", "bytes")


def raw_candidates(c: Catalog) -> DataFrame:
    """(download_id, file_id, work_id): local raw files with a processed text that are not archived yet; the text's URI stands
    in where the downloads have no URI of their own."""
    texts = c.extractions.filter("status = 'processed'").select("download_id", "text_uri")
    local = texts.filter(F.lower("text_uri").startswith("file:")).select(F.col("download_id").alias("id"))
    works = c.files.select(F.col("id").alias("file_id"), "work_id")
    return c.downloads.filter("status = 'downloaded'").join(local, "id", "left_semi").join(works, "file_id").select(F.col("id").alias("download_id"), "file_id", "work_id")


def quality_candidates(c: Catalog, validated: bool = False) -> DataFrame:
    """Texts whose quality is not known yet (or all), those never judged first, then the newest."""
    rows = c.extractions.filter("status = 'processed' and text_uri is not null")
    if not validated:
        rows = rows.filter("quality_status is null or quality_status = 'error'")
    return rows.orderBy(F.col("quality_status").isNotNull(), F.desc_nulls_last("processed_at"), F.desc("id")).select("id", "download_id", "char_count")


def unusable_texts(c: Catalog) -> DataFrame:
    return c.extractions.filter("status = 'processed' and quality_status = 'unusable'").select("id", "download_id", "char_count")


def munge_candidates(c: Catalog, munges: DataFrame, version: str, again: bool = False) -> DataFrame:
    """(extraction_id, file_id, work_id, char_count) of usable texts without a processed munge (extraction_id,
    munger_version, status) of the version; of all usable texts where they are to be made ``again``."""
    rows = c.chain.filter(usable_text()).select("extraction_id", "file_id", "work_id", "char_count")
    done = munges.filter((F.col("munger_version") == version) & (F.col("status") == "processed")).select("extraction_id")
    return rows if again else rows.join(done, "extraction_id", "left_anti")


def backlog_counts(c: Catalog) -> DataFrame:
    """(queue, n) of the queues above. Raw files count once for each processed text, as defined."""
    texts = c.extractions.filter("status = 'processed' and lower(text_uri) like 'file:%'").select(F.col("download_id").alias("id"))
    parts = {
        "pending_downloads": runnable(pending_files(c).filter(F.col("download_disabled_at").isNull())).agg(F.count_distinct("work_id").alias("n")),
        "failed_downloads": active_failures(c).agg(F.count(F.lit(1)).alias("n")),
        "pending_extractions": pending_extractions(c).agg(F.count(F.lit(1)).alias("n")),
        "pending_raw_archives": c.downloads.filter("status = 'downloaded'").join(texts, "id").agg(F.count(F.lit(1)).alias("n")),
        "unvalidated_texts": quality_candidates(c).agg(F.count(F.lit(1)).alias("n")),
    }
    out = None
    for name, df in parts.items():
        row = df.select(F.lit(name).alias("queue"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def pipeline_failures(c: Catalog, limit: int = 25) -> DataFrame:
    """The newest failures of each stage, texts before downloads, ``limit`` in all."""
    texts = c.extractions.filter("status = 'failed'").join(c.downloads.select(F.col("id").alias("download_id"), "file_id"), "download_id").select(F.lit(0).alias("priority"), F.lit("text").alias("stage"), "id", F.coalesce("processed_at", "created_at").alias("at"))
    loads = active_failures(c).select(F.lit(1).alias("priority"), F.lit("download").alias("stage"), F.col("download_id").alias("id"), F.col("download_updated_at").alias("at"))
    newest = [x.orderBy(F.desc_nulls_last("at"), F.desc("id")).limit(limit) for x in (texts, loads)]
    return newest[0].unionByName(newest[1]).orderBy("priority", F.desc_nulls_last("at"), F.desc("id")).limit(limit).select("priority", "stage", "id")


def assigned(rows: DataFrame, per_domain: int, domains: int, without: tuple[str, ...] = ()) -> DataFrame:
    """(domain, slot, file_id): the first files of each host, for the first hosts by name; a row without a host counts under its
    site. The ranking of hosts runs over the distinct hosts, not over the files."""
    from quire.functions.text import safe_segment

    host = part(effective_url(), "host")
    placed = rows.withColumn("domain", F.when(host != "", host).otherwise(safe_segment(F.col("site")))).filter(~F.col("domain").isin(*without) if without else F.lit(True))
    first = placed.select("domain").distinct().orderBy("domain").limit(domains)
    ranked = placed.join(first, "domain", "left_semi").withColumn("slot", F.row_number().over(Window.partitionBy("domain").orderBy("file_id")))
    return ranked.filter(F.col("slot") <= per_domain).select("domain", "slot", "file_id")


def domain_assignment(c: Catalog, per_domain: int = 3, domains: int = 4, without: tuple[str, ...] = (), works: DataFrame | None = None) -> DataFrame:
    rows = best_file(pending_files(c)) if works is None else best_file(pending_files(c).filter(F.col("download_disabled_at").isNull()).join(works.select("work_id").distinct(), "work_id", "left_semi"))
    return assigned(rows, per_domain, domains, without)


def domain_outcomes(c: Catalog) -> DataFrame:
    """(domain, downloaded, failed, unavailable): what came of the downloads of each host; a host is unavailable where a
    connection failed."""
    rows = c.files.withColumnRenamed("id", "file_id").join(c.downloads.select("file_id", "status", "error"), "file_id")
    done, failed = F.col("status") == "downloaded", F.col("status") == "failed"
    lost = failed & F.coalesce(F.lower("error").rlike("connection|timed out|timeout"), F.lit(False))
    return rows.groupBy(part(effective_url(), "host").alias("domain")).agg(F.count_if(done).alias("downloaded"), F.count_if(failed).alias("failed"), F.max(F.coalesce(lost, F.lit(False))).alias("unavailable"))


def work_activity(c: Catalog) -> DataFrame:
    """(work_id, active): whether anything of a work is under way or usable."""
    return c.works.select(F.col("id").alias("work_id")).join(blocked_works(c).withColumn("active", F.lit(True)), "work_id", "left").select("work_id", F.coalesce("active", F.lit(False)).alias("active"))


def query_text(c: Catalog) -> DataFrame:
    """(work_id, query): the title and author of each work as a search."""
    from quire.functions.text import collapse

    tidy = lambda x: collapse(F.coalesce(x, F.lit("")))
    return c.works.select(F.col("id").alias("work_id"), F.rtrim(F.concat_ws(" ", tidy("title"), tidy("author"))).alias("query"))


def affected_works(c: Catalog, family: str, pages: str) -> DataFrame:
    """(work_id): works one of whose files was downloaded as an HTML page of a ``family`` of hosts at a path of ``pages``, that
    have no usable text themselves or in a work of the same title and author."""
    url = effective_url()
    html = c.downloads.filter("status = 'downloaded' and content_type like '%text/html%'").select("file_id")
    hit = c.files.withColumnRenamed("id", "file_id").filter(F.contains(part(url, "host"), F.lit(family)) & part(url, "path").rlike(pages)).join(html, "file_id", "left_semi").select("work_id").distinct()
    key = lambda x: F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), "[^a-z0-9]+", " "))
    named = c.works.select(F.col("id").alias("work_id"), key("title").alias("title_key"), key("author").alias("author_key"))
    usable = c.chain.filter(usable_text()).select("work_id").distinct()
    solved = named.join(usable, "work_id", "left_semi").filter(F.length("title_key") >= 8).select("title_key", "author_key").distinct()
    return hit.join(usable, "work_id", "left_anti").join(named, "work_id").join(solved, ["title_key", "author_key"], "left_anti").select("work_id")
