"""Deterministic corpus builds: selection, order, items, integrity, manifest and combined text."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.catalog import Catalog
from quire.functions.text import corpus_normalize, digest, substitute
from quire.predicates import ascii_contains, or_else, usable_text
from quire.session import cut


def keys(c: Catalog, category: str | None = None, site: str | None = None, query: str | None = None, limit: int | None = None, munges: DataFrame | None = None) -> DataFrame:
    """(doc_id, text_uri, extraction_id, work_id, title, author, category, site, format, text_sha256) of the usable texts; with
    ``munges`` (extraction_id, sha256) only those munged, under the hash of the munged text. ``query`` is a substring of title,
    author, search or category. A limit is applied in the order of titles, before any other order."""
    rows = c.chain.filter(usable_text())
    if category is not None:
        rows = rows.filter(or_else("category", "uncategorized") == category)
    if site is not None:
        rows = rows.filter(F.col("site") == site)
    works = c.works.select(F.col("id").alias("work_id"), "title", "author", "search_query")
    texts = c.documents.filter("text is not null").select("doc_id", "text_uri")
    out = rows.join(works, "work_id").join(texts, "text_uri")
    if query is not None:
        out = out.filter(F.exists(F.array("title", "author", "search_query", "category"), lambda x: ascii_contains(x, query)))
    if munges is not None:
        out = out.drop("text_sha256").join(munges.select("extraction_id", F.col("sha256").alias("text_sha256")), "extraction_id")
    out = out.select("doc_id", "text_uri", "extraction_id", "work_id", "title", "author", or_else("category", "uncategorized").alias("category"), "site", "format", "text_sha256")
    return out.orderBy(F.lower("title"), "text_sha256", "extraction_id").limit(limit) if limit is not None else out


def select(c: Catalog, **kwargs) -> DataFrame:
    """``keys`` with their texts."""
    return keys(c, **kwargs).join(c.documents.select("doc_id", "text"), "doc_id")


def order_columns(strategy: str, seed: int = 0) -> list:
    """A total order for each strategy."""
    last = [F.col("text_sha256"), F.col("extraction_id"), F.col("doc_id")]
    if strategy == "title":
        return [F.lower(F.coalesce("title", F.lit(""))), F.lower(F.coalesce("author", F.lit(""))), *last]
    if strategy == "hash":
        return last
    if strategy == "created":
        return [F.col("extraction_id"), F.col("doc_id")]
    if strategy == "seeded":
        return [F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("text_sha256", F.lit(""))), 256), *last]
    raise ValueError(f"unknown order: {strategy}")


def numbered(rows: DataFrame, order: list) -> DataFrame:
    """``rows`` with item_index from 1 in a total order, without bringing all rows to one task: rows are range-partitioned, the
    partitions' counts (one number each) shift the numbers within them. Number keys, not texts: the rows are shuffled and
    checkpointed, as the ranges come from a sample and both uses must see one laying-out."""
    laid = cut(rows.withColumn("_order", F.struct(*order)).repartitionByRange("_order").sortWithinPartitions("_order").withColumn("_part", F.spark_partition_id()))
    within = F.row_number().over(Window.partitionBy("_part").orderBy("_order"))
    counts = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = counts.select("_part", before.alias("_before"))
    return laid.withColumn("_within", within).join(F.broadcast(shifts), "_part").withColumn("item_index", F.col("_within") + F.col("_before")).drop("_order", "_part", "_within", "_before")  # a row for each partition


def ordered(c: Catalog, strategy: str, seed: int = 0, **kwargs) -> DataFrame:
    return numbered(keys(c, **kwargs), order_columns(strategy, seed)).select("item_index", "extraction_id", "doc_id")


def numbered_texts(c: Catalog, order: str = "title", seed: int = 0, **kwargs) -> DataFrame:
    """The keys with item_index, and their texts joined once the keys are numbered: no text is shuffled to be sorted."""
    return numbered(keys(c, **kwargs), order_columns(order, seed)).join(c.documents.select("doc_id", "text"), "doc_id")


def items(c: Catalog, pairs: list[tuple[str, str]] = (), order: str = "title", seed: int = 0, **kwargs) -> DataFrame:
    """(item_index, extraction_id, doc_id, sha256, chars, ...): normalised and substituted texts by their hash, in order."""
    rows = numbered_texts(c, order, seed, **kwargs)
    text = substitute(corpus_normalize(F.col("text")), list(pairs))
    about = ("item_index", "extraction_id", "doc_id", "work_id", "title", "author", "site", "format", "category", "text_uri", "text_sha256")
    return rows.select(*about, digest(text).alias("sha256"), F.length(text).cast("long").alias("chars"))


def integrity(c: Catalog) -> DataFrame:
    """(extraction_id, doc_id, ok): whether the stored hash is that of the text."""
    rows = c.extractions.filter("status = 'processed' and text_uri is not null").select(F.col("id").alias("extraction_id"), "text_uri", "text_sha256")
    texts = c.documents.filter("text is not null").select("doc_id", "text_uri", digest(F.col("text")).alias("actual"))
    return rows.join(texts, "text_uri").select("extraction_id", "doc_id", F.coalesce(F.col("actual") == F.col("text_sha256"), F.lit(False)).alias("ok"))


def totals(c: Catalog, pairs: list[tuple[str, str]] = ()) -> DataFrame:
    text = substitute(corpus_normalize(F.col("text")), list(pairs))
    return select(c).groupBy("category").agg(F.count(F.lit(1)).alias("items"), F.sum(F.length(text).cast("long")).alias("chars"))


def combined(c: Catalog, pairs: list[tuple[str, str]] = (), **kwargs) -> DataFrame:
    """(item_index, block): each text between its begin and end lines under a header of four lines, to be written in the order of item_index."""
    rows = numbered_texts(c, **kwargs).withColumn("text", substitute(corpus_normalize(F.col("text")), list(pairs)))
    n = F.col("item_index").cast("string")
    head = [F.concat(F.lit("--- BEGIN DOCUMENT "), n, F.lit(" ---")), *[F.concat(F.lit(f"{k}: "), F.coalesce(v, F.lit(""))) for k, v in (("title", F.col("title")), ("author", F.col("author")), ("source_text_sha256", F.col("text_sha256")), ("transformed_sha256", digest(F.col("text"))))]]
    return rows.select("item_index", F.concat_ws("\n", *head, F.col("text"), F.concat(F.lit("--- END DOCUMENT "), n, F.lit(" ---"))).alias("block"))


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def json_text(value: Column) -> Column:
    """A string as canonical JSON writes it: only quotes, backslashes and control characters are escaped; null is null."""
    inner = F.regexp_replace(F.to_json(F.struct(value.alias("x")), {"ignoreNullFields": "false"}), r"^\{\"x\":|\}$", "")
    return F.coalesce(inner, F.lit("null"))


#: The name of the normaliser (a fixed value).
NORMALIZER = "corpus-normalize.v1"


def manifest_items(rows: DataFrame) -> DataFrame:
    """(item_index, json): each item of ``items`` as canonical JSON."""
    fields = {"author": json_text(F.col("author")), "category": json_text(F.col("category")), "char_count": F.col("chars").cast("string"), "extraction_id": F.col("extraction_id").cast("string"), "format": json_text(F.col("format")), "item_index": F.col("item_index").cast("string"), "site": json_text(F.col("site")), "text_sha256": json_text(F.col("text_sha256")), "text_uri": json_text(F.col("text_uri")), "title": json_text(F.col("title")), "transformed_sha256": json_text(F.col("sha256")), "work_id": F.col("work_id").cast("string")}
    body = F.concat_ws(",", *[F.concat(F.lit(f'"{k}":'), F.coalesce(v, F.lit("null"))) for k, v in fields.items()])
    return rows.select("item_index", F.concat(F.lit("{"), body, F.lit("}")).alias("json"))


def manifest_hash(c: Catalog, name: str, selection: dict | None = None, pairs: list[tuple[str, str]] = (), order: str = "title", seed: int = 0, form: str = "corpus.v1") -> str:
    """The hash of the whole canonical manifest. It is one hash over one text by definition: the items' JSON streams through the
    driver in order, a partition at a time, and is never held together."""
    rows = cut(items(c, pairs, order, seed, **(selection or {})))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("chars"), F.lit(0)).alias("chars")).first()
    changes = [{"from": a, "to": b} for a, b in pairs]
    chosen = {k: None for k in ("category", "site", "query", "limit")} | {"use_munged": False} | (selection or {})
    whole = {"format": form, "name": name, "selection": chosen, "ordering_strategy": order, "seed": seed, "normalizer_version": NORMALIZER, "substitutions_sha256": hashlib.sha256(canonical_json(changes).encode()).hexdigest(), "substitutions": changes, "item_count": total["n"], "total_chars": total["chars"], "items": "\x00"}
    before, after = canonical_json(whole).split('"\\u0000"')
    running = hashlib.sha256((before + "[").encode())
    comma = ""
    for row in manifest_items(rows).orderBy("item_index").toLocalIterator():
        running.update((comma + row["json"]).encode())
        comma = ","
    running.update(("]" + after).encode())
    return running.hexdigest()


def manifest(c: Catalog, name: str, selection: dict | None = None, pairs: list[tuple[str, str]] = ()) -> DataFrame:
    """(name, items, chars, sha256): the identity of a build where the items are too many for one hash: the digests of their lines, by
    item, are added up modulo 2 ** 64 in four parts, so the order counts through item_index and no list is gathered."""
    rows = items(c, pairs, **(selection or {}))
    line = F.sha2(F.concat_ws(" ", F.col("item_index").cast("string"), F.col("extraction_id").cast("string"), "sha256", F.col("chars").cast("string")), 256)
    parts = [F.sum(F.conv(F.substring(line, 1 + 15 * k, 15), 16, 10).cast("decimal(20,0)")).alias(f"p{k}") for k in range(4)]
    head = canonical_json({"name": name, "selection": selection or {}, "substitutions": [list(p) for p in pairs], "ordering": "title"})
    folded = rows.agg(F.count(F.lit(1)).alias("items"), F.sum("chars").alias("chars"), *parts)
    return folded.select(F.lit(name).alias("name"), "items", "chars", F.sha2(F.concat_ws(" ", F.lit(head), *[F.col(f"p{k}").cast("string") for k in range(4)]), 256).alias("sha256"))
