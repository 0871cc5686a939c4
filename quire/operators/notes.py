"""Logs of notes: their tokens, search, compaction, and the queries that a collection makes up for itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CONTEXT, RATIO = 32_768, 0.55


def tokens(text: Column) -> Column:
    """A quarter of the characters, one at least."""
    return F.greatest(F.lit(1), F.floor(F.length(text) / 4)).cast("long")


def search(notes: DataFrame, needle: str, last: int = 20) -> DataFrame:
    """The last notes (n, kind, content, metadata) whose content or metadata hold the needle, whatever the case."""
    hit = F.contains(F.lower("content"), F.lit(needle.lower())) | F.contains(F.lower("metadata"), F.lit(needle.lower()))
    return notes.filter(hit).orderBy(F.desc("n")).limit(last).select("n", "kind", "content")


def should_compact(notes: DataFrame, context: int = CONTEXT, ratio: float = RATIO) -> DataFrame:
    """(tokens, threshold, compact): whether the notes, a line each, are longer than their share of the context."""
    size = F.coalesce(F.sum(F.length("content") + 1), F.lit(1)) - 1
    return notes.agg(F.greatest(F.lit(1), F.floor(size / 4)).cast("long").alias("tokens")).select("tokens", F.lit(int(context * ratio)).cast("long").alias("threshold"), (F.col("tokens") > int(context * ratio)).alias("compact"))


def compacted(notes: DataFrame, summaries: int = 3, others: int = 10, lines: int = 25) -> DataFrame:
    """(place, kind, content) of notes (n, kind, content) after a compaction: the last summaries, a new one, and the last other
    notes. The new summary is made of the last lines of all other notes. Only the ends of the log are gathered."""
    kept = notes.filter("kind = 'summary'").orderBy(F.desc("n")).limit(summaries).select(F.lit(1).alias("part"), "n", "kind", "content")
    rest = notes.filter("kind <> 'summary'").orderBy(F.desc("n"))
    line = F.concat(F.lit("["), "kind", F.lit("] "), "content")
    made = rest.limit(lines).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", line.alias("line")))), lambda x: x["line"]), "\n").alias("content"))
    new = made.select(F.lit(2).alias("part"), F.lit(0).cast("long").alias("n"), F.lit("summary").alias("kind"), "content")
    last = rest.limit(others).select(F.lit(3).alias("part"), "n", "kind", "content")
    out = kept.unionByName(new).unionByName(last)
    return out.select(F.row_number().over(Window.orderBy("part", "n")).alias("place"), "kind", "content")  # a bounded handful of rows


def context_length(models: DataFrame, wanted: DataFrame, default: int = CONTEXT) -> DataFrame:
    """(model, context): of the models (id, slug, provider_length, length) the one of that id or slug; the provider's length
    before the model's, the default without any."""
    both = models.select(F.col("id").alias("model"), F.coalesce("provider_length", "length").alias("n")).unionByName(models.select(F.col("slug").alias("model"), F.coalesce("provider_length", "length").alias("n")))
    best = both.groupBy("model").agg(F.max("n").alias("n"))
    return wanted.join(best, "model", "left").select("model", F.coalesce("n", F.lit(default)).alias("context"))


def rotated(items: list[str], by: int) -> list[str]:
    by = by % len(items) if items else 0
    return items[by:] + items[:by]


def own_queries(counts: DataFrame, by_category: dict[str, list[str]], lists: list[list[str]], cycle: int, focus: str | None = None, extra: list[str] = (), limit: int = 12) -> DataFrame:
    """(place, query): the queries of a cycle: for a focus, then two for each category with the fewest texts first, then the
    lists, all rotated by the cycle, then the extra ones; each once whatever its case, ``limit`` in all.

    ``counts`` (name, texts, chars) are the categories; the lists are configuration, a few rows."""
    spark = counts.sparkSession
    ranked = counts.filter(F.col("name").isin(*by_category)).select("name", F.row_number().over(Window.orderBy("texts", "chars", "name")).alias("rank"))  # a handful of named categories
    pairs = [(name, k, q) for name, queries in by_category.items() for k, q in enumerate(rotated(queries, cycle - 1)[:2])]
    sparse = spark.createDataFrame(pairs, "name string, k int, query string").join(ranked, "name").select(F.lit(2).alias("part"), F.col("rank").alias("a"), F.col("k").alias("b"), "query")
    fixed = [(1, 0, k, q.format(focus)) for k, q in enumerate(("public domain {}", "{} complete works", "{} essays")) if focus]
    fixed += [(3 + i, 0, k, q) for i, items in enumerate(lists) for k, q in enumerate(rotated(items, cycle - 1))] + [(99, 0, k, q) for k, q in enumerate(extra)]
    every = sparse.unionByName(spark.createDataFrame(fixed, "part int, a int, b int, query string"))
    tidy = every.withColumn("query", F.trim(F.regexp_replace("query", r"\s+", " "))).filter("query <> ''")
    once = tidy.groupBy(F.lower("query").alias("key")).agg(F.min_by("query", F.struct("part", "a", "b")).alias("query"), F.min(F.struct("part", "a", "b")).alias("at"))
    return once.select(F.row_number().over(Window.orderBy("at")).alias("place"), "query").filter(F.col("place") <= limit)  # the configured lists


def packed(notes: DataFrame, group: str, order: str, text: str, budget: int) -> DataFrame:
    """The newest notes of each group that fit the budget of tokens, up to the first that does not."""
    spent = F.sum(tokens(F.col(text))).over(Window.partitionBy(group).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0))
    return notes.withColumn("spent", spent).filter(F.col("spent") <= budget)
