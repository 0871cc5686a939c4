"""State transitions as pure functions of the current rows and what happened to them: one shuffle on the key each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import collapse


def changed(current: DataFrame, changes: DataFrame, key: list[str], values: dict[str, str]) -> DataFrame:
    """``current`` with the columns of ``changes`` by ``values`` (column: rule) where a key has any: 'new' overwrites, 'keep'
    takes the new value only where there was none, 'fill' only where there is a new one. Keys of one side only stay."""
    new = changes.select(*key, *[F.col(c).alias(f"_new_{c}") for c in values], F.lit(True).alias("_hit"))
    joined = current.join(new, key, "full")
    rules = {"new": lambda c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)), "keep": lambda c: F.coalesce(c, f"_new_{c}"), "fill": lambda c: F.coalesce(f"_new_{c}", c)}
    return joined.select(*key, *[rules[rule](c).alias(c) for c, rule in values.items()])


def seen_items(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Seen items of feeds (feed_url, item_id, item_url, work_id, archived_at): new URLs and works replace old ones where
    there are any, the first time of archiving stays."""
    return changed(current, changes, ["feed_url", "item_id"], {"item_url": "fill", "work_id": "fill", "archived_at": "keep"})


def fold_extractions(events: DataFrame) -> DataFrame:
    """The state of each (download_id, extractor) after its events (seq, kind, text_uri, char_count, message): started clears
    the error; processed sets the text and clears it; skipped keeps the message as a warning; failed as the error, both cut
    to 1 000 characters. One aggregate, no sort."""
    at = lambda c, when: F.max_by(F.when(when, F.col(c)), F.when(when, F.col("seq")))
    kind = F.col("kind")
    last = F.max_by(kind, F.col("seq"))
    status = F.when(last == "started", "processing").otherwise(last)
    return events.groupBy("download_id", "extractor").agg(
        status.alias("status"),
        at("text_uri", kind == "processed").alias("text_uri"),
        at("char_count", kind == "processed").alias("char_count"),
        F.when(last == "failed", F.substring(at("message", kind == "failed"), 1, 1000)).alias("error"),
        F.substring(at("message", kind.isin("skipped", "processed")), 1, 1000).alias("warnings"),
    )


def fold_archiving(downloads: DataFrame, events: DataFrame) -> DataFrame:
    """(id, raw_status, raw_uri, raw_error, local_deleted) of downloads after archiving events (id, seq, kind, uri, message,
    delete_local): archived sets the URI and clears the error, missing also marks the local file as gone."""
    kind = F.col("kind")
    last = events.groupBy("id").agg(
        F.max_by("kind", "seq").alias("raw_status"),
        F.max_by(F.when(kind == "archived", F.col("uri")), F.when(kind == "archived", F.col("seq"))).alias("raw_uri"),
        F.max_by(F.when(kind == "archived", F.lit(None).cast("string")).otherwise(F.substring("message", 1, 1000)), "seq").alias("raw_error"),
        F.max((kind == "missing") | ((kind == "archived") & F.col("delete_local"))).alias("local_deleted"),
    )
    return downloads.select("id").join(last, "id", "left").select("id", F.coalesce("raw_status", F.lit("local")).alias("raw_status"), "raw_uri", "raw_error", F.coalesce("local_deleted", F.lit(False)).alias("local_deleted"))


def fold_munges(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Munges (extraction_id, munger_version, status, sha256, chars, error) after ``changes`` of the same columns: a success
    overwrites and clears the error, a failure never downgrades a processed row."""
    names = ["status", "sha256", "chars", "error"]
    new = changes.select("extraction_id", "munger_version", *[F.col(n).alias(f"_new_{n}") for n in names])
    joined = current.join(new, ["extraction_id", "munger_version"], "full")
    won, lost = F.col("_new_status") == "processed", (F.col("_new_status") == "failed") & (F.coalesce("status", F.lit("")) != "processed")
    return joined.select(
        "extraction_id", "munger_version", F.when(won | lost, F.col("_new_status")).otherwise(F.col("status")).alias("status"),
        *[F.when(won, F.col(f"_new_{n}")).otherwise(F.col(n)).alias(n) for n in ("sha256", "chars")],
        F.when(won, F.lit(None).cast("string")).when(lost, F.col("_new_error")).otherwise(F.col("error")).alias("error"),
    )


def mark_quality(extractions: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(id, quality_status, quality_score) of extractions after verdicts (id, status, score)."""
    new = verdicts.select("id", F.col("status").alias("_status"), F.col("score").alias("_score"))
    hit = F.col("_status").isNotNull()
    return extractions.join(new, "id", "left").select("id", F.coalesce("_status", "quality_status").alias("quality_status"), F.when(hit, F.col("_score")).otherwise(F.col("quality_score")).alias("quality_score"))


def reject(extractions: DataFrame, reason: str = "rejected by text quality validation") -> DataFrame:
    """(id, status, text_uri, warnings, removed_uri) of extractions once the unusable texts are taken out: those are skipped,
    lose their URI, which is given as the one to remove."""
    bad = F.coalesce((F.col("status") == "processed") & (F.col("quality_status") == "unusable"), F.lit(False))
    return extractions.select(
        "id", F.when(bad, "skipped").otherwise(F.col("status")).alias("status"), F.when(~bad, F.col("text_uri")).alias("text_uri"),
        F.when(bad, F.lit(reason[:1000])).otherwise(F.col("warnings")).alias("warnings"), F.when(bad, F.col("text_uri")).alias("removed_uri"),
    )


def supersede(goals: DataFrame, replacement: Column, at: str, reason: str = "superseded by another goal") -> DataFrame:
    """Goals (id, status, events array<struct<ts, kind, content>>) once all active ones but the replacement are superseded:
    the change is appended to their events."""
    hit = F.coalesce(F.col("status").isin("active", "running"), F.lit(False)) & ~F.coalesce(F.col("id") == replacement, F.lit(False))
    event = F.array(F.struct(F.lit(at).alias("ts"), F.lit("superseded").alias("kind"), F.lit(reason).alias("content")))
    return goals.select("id", F.when(hit, "superseded").otherwise(F.col("status")).alias("status"), F.when(hit, F.concat("events", event)).otherwise(F.col("events")).alias("events"))


def latest_by(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, as an aggregate."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(key, "_r.*")


def worker_counts(workers: DataFrame) -> DataFrame:
    """(total, running, idle, failed) of workers (id, status)."""
    n = lambda *names: F.count_if(F.coalesce(F.col("status").isin(*names), F.lit(False)))
    return workers.agg(F.count(F.lit(1)).alias("total"), n("running").alias("running"), n("idle", "complete").alias("idle"), n("failed").alias("failed"))


def replace_plugins(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Source plugins (slug, name, base_url, search_url_template, trust_level, enabled) with those of ``changes`` in place of
    the ones of the same slug, by slug."""
    from quire.functions.text import slug

    new = changes.select(
        slug(F.coalesce("name", "base_url"), "archive").alias("slug"), F.coalesce("name", "base_url").alias("name"), F.regexp_replace("base_url", "/+$", "").alias("base_url"),
        F.coalesce(F.nullif("search_url_template", F.lit("")), F.concat(F.regexp_replace("base_url", "/+$", ""), F.lit("/search?q={query}"))).alias("search_url_template"),
        F.coalesce("trust_level", F.lit("untrusted")).alias("trust_level"), F.coalesce("enabled", F.lit(True)).alias("enabled"),
    ).filter(F.col("base_url").rlike("^https?://[^/]+"))
    last = new.groupBy("slug").agg(F.max(F.struct(*[c for c in new.columns if c != "slug"])).alias("r")).select("slug", "r.*")
    return current.join(last, "slug", "left_anti").unionByName(last).orderBy("slug")


def replace_specs(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Corpus recipes by name: the values of ``changes`` overwrite, ids stay; new names get the ids after the last one."""
    names = [c for c in changes.columns if c != "name"]
    joined = current.join(changes.select("name", *[F.col(c).alias(f"_new_{c}") for c in names], F.lit(True).alias("_hit")), "name", "full")
    last = current.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_last"))
    fresh = F.row_number().over(Window.partitionBy(F.col("id").isNull()).orderBy("name"))  # recipes are a handful of rows
    numbered = joined.crossJoin(F.broadcast(last)).withColumn("_fresh", fresh)  # one row on the right
    return numbered.select(F.coalesce(F.col("id"), F.col("_last") + F.col("_fresh")).alias("id"), "name", *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in names])


def replace_items(current: DataFrame, items: DataFrame) -> DataFrame:
    """Items of builds with those of the builds in ``items`` replaced as a whole."""
    return current.join(items.select("build").distinct(), "build", "left_anti").unionByName(items)


def registered(records: DataFrame, works: DataFrame, each: int) -> DataFrame:
    """(site, title, author, known, record_id): the first ``each`` records of every site, one row for each work they name
    (by title and author, or by the title alone where no author is named), and whether the catalogue has it."""
    listed = records.filter("listed_title is not null").select("record_id", "site", F.col("listed_title").alias("title"), F.coalesce("listed_author", F.lit("")).alias("author")).distinct()
    first = listed.withColumn("_n", F.row_number().over(Window.partitionBy("site").orderBy("record_id"))).filter(F.col("_n") <= each).drop("_n")
    once = first.groupBy("title", "author").agg(F.min_by("site", "record_id").alias("site"), F.min("record_id").alias("record_id"))
    exact = works.select("title", F.coalesce("author", F.lit("")).alias("author")).distinct().withColumn("exact", F.lit(True))
    named = works.select("title").distinct().withColumn("named", F.lit(True))
    joined = once.join(exact, ["title", "author"], "left").join(named, "title", "left")
    return joined.select("site", "title", "author", F.coalesce(F.when(F.col("author") == "", F.col("named")).otherwise(F.col("exact")), F.lit(False)).alias("known"), "record_id")


#: What stands before the message of a batch or tool, and what it becomes (fixed values).
PREFIXES = ((r"(?i)^Batch\s+[-\w]+\s+complete:\s*", ""), (r"(?i)^Batch\s+[-\w]+\s+started:\s*", ""), (r"(?i)^Batch\s+[-\w]+\s+failed:\s*", "failed "), (r"(?i)^Tool\s+[-\w]+\s+complete:\s*", ""), (r"(?i)^Tool\s+[-\w]+\s+failed:\s*", "failed "))


def message(text: Column) -> Column:
    """A message without what batches and tools put before it."""
    out = collapse(F.coalesce(text, F.lit("")))
    for pattern, new in PREFIXES:
        out = F.regexp_replace(out, pattern, new)
    return out


def activity(phase: Column, text: Column) -> Column:
    """The label of a movement: fail, run, wait, done, or note."""
    low = F.lower(F.coalesce(phase, F.lit("")))
    return (
        F.when(F.contains(F.lower(message(text)), F.lit("failed")) | low.isin("error", "failed"), "fail").when(low.isin("start", "started"), "run").when(low.isin("idle", "waiting"), "wait")
        .when(low.isin("end", "complete", "completed"), "done").otherwise(F.when(F.substring(low, 1, 4).isin("done", "run", "wait", "fail"), F.substring(low, 1, 4)).otherwise("note"))
    )


def health(counts: DataFrame) -> DataFrame:
    """(state, reason, pending, failures) from one row of counts: infected, worker_failed, worker_running, extraction_failed,
    raw_failed, pending_downloads, pending_extractions, pending_raw, stale; the first trouble that applies decides."""
    failures = F.col("extraction_failed") + F.col("raw_failed") + F.col("worker_failed")
    pending = F.col("pending_downloads") + F.col("pending_extractions") + F.col("pending_raw")
    rules = (
        (F.col("infected") > 0, "quarantine", "infected files require review"), (F.col("worker_failed") > 0, "worker issue", "a background worker failed"),
        (failures > 0, "attention", "pipeline failures need triage"), (F.col("worker_running") > 0, "running", "background work is active"),
        (F.col("stale"), "stale", "no recent agent activity"), (pending > 0, "queued", "pipeline has work ready"),
    )
    state = reason = F
    for condition, name, text in rules:
        state, reason = state.when(condition, name), reason.when(condition, text)
    return counts.select(state.otherwise("clear").alias("state"), reason.otherwise("no queued work").alias("reason"), pending.alias("pending"), failures.alias("failures"))


def ratio(done: Column, total: Column) -> Column:
    """A share within 0 and 1; 0 of nothing."""
    return F.when(F.coalesce(total, F.lit(0)) <= 0, 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(done, F.lit(0)) / total)))


def percent(done: Column, total: Column) -> Column:
    """A share in whole hundredths; halves go to the even one."""
    return F.bround(ratio(done, total) * 100, 0).cast("int")


def duration(text: Column) -> Column:
    """Seconds of a number with s, m, h or d, seconds without a unit; null for anything else."""
    low = F.lower(F.trim(text))
    number = F.regexp_extract(low, r"^([0-9]+(?:\.[0-9]*)?|\.[0-9]+)([smhd]?)$", 1).try_cast("double")
    unit = F.regexp_extract(low, r"([smhd]?)$", 1)
    return F.floor(number * F.when(unit == "m", 60).when(unit == "h", 3600).when(unit == "d", 86400).otherwise(1)).cast("long")


def backoff(errors: Column, base: int, most: int) -> Column:
    """Seconds to wait after so many failed cycles in a row."""
    return F.least(F.lit(most), F.lit(base) * F.greatest(F.lit(1), errors))


def age(seconds: Column) -> Column:
    """A span in the largest unit that fits, days only from two on; 'unknown' for null."""
    s = F.greatest(F.lit(0), seconds)
    part = lambda n, unit: F.concat(F.floor(s / n).cast("string"), F.lit(unit))
    return F.when(seconds.isNull(), "unknown").when(s < 60, part(1, "s")).when(s < 3600, part(60, "m")).when(s < 172800, part(3600, "h")).otherwise(part(86400, "d"))


def timestamp(text: Column) -> Column:
    """A time in one of the usual forms, without a zone or in UTC; null for any other text."""
    forms = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "yyyy-MM-dd")
    return F.coalesce(*[F.call_function("try_to_timestamp", F.trim(text), F.lit(f)) for f in forms])
