"""Full-text retrieval: postings, boolean, phrase and prefix queries, weighted BM25 and snippets."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quire.catalog import Catalog
from quire.functions.text import bind
from quire.predicates import or_else, usable_text



def _accents() -> tuple[str, str]:
    """The letters of Latin and Cyrillic that are a plain letter with marks, and those plain letters, by their decomposition."""
    pairs = []
    for code in (*range(0xC0, 0x250), *range(0x400, 0x460), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))
        if len(base) > 1 and all(unicodedata.combining(c) for c in base[1:]):
            pairs.append((chr(code), base[0]))
    low = [(a, b) for a, b in pairs if a == a.lower() and b == b.lower()]
    return "".join(a for a, _ in low), "".join(b for _, b in low)


ACCENTED, PLAIN = _accents()
WEIGHTS = {"title": 8.0, "author": 5.0, "category": 4.0, "site": 2.0, "body": 1.0}


def tokens(text: Column) -> Column:
    """Runs of letters and digits, folded to lower case without accents."""
    folded = F.translate(F.lower(F.coalesce(text, F.lit(""))), ACCENTED, PLAIN)
    return F.regexp_extract_all(folded, F.lit(r"[\p{L}\p{N}]+"), 0)


def indexed_texts(c: Catalog) -> DataFrame:
    """(doc_id, title, author, category, site, body): the newest extraction of each document."""
    rows = c.chain.filter(F.col("text_uri").isNotNull()).select("text_uri", "extraction_id", "work_id", "site", "category")
    newest = rows.groupBy("text_uri").agg(F.max_by(F.struct("work_id", "site", "category"), F.struct("extraction_id", "work_id")).alias("r"))
    docs = c.documents.filter("text is not null").select("doc_id", "text_uri", F.col("text").alias("body"))
    works = c.works.select(F.col("id").alias("work_id"), "title", "author")
    return docs.join(newest, "text_uri").select("doc_id", "body", "r.work_id", "r.site", or_else("r.category", "uncategorized").alias("category")).join(works, "work_id", "left").select("doc_id", "title", "author", "category", "site", "body")


def postings(texts: DataFrame) -> DataFrame:
    """(doc_id, field, token, pos), one row for each token; built once and kept by the caller where many queries follow."""
    fields = [F.struct(F.lit(f).alias("field"), tokens(F.col(f)).alias("tokens")) for f in WEIGHTS]
    return texts.select("doc_id", F.explode(F.array(*fields)).alias("f")).select("doc_id", "f.field", F.posexplode("f.tokens").alias("pos", "token"))


def body_tokens(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(tokens(F.col("text"))).alias("pos", "token"))


# A document is tested on the array of its tokens where it is read: nothing is exploded and nothing shuffled.


def has_all(words: Column, terms: list[str]) -> Column:
    out = F.lit(True)
    for term in terms:
        out = out & F.array_contains(words, term)
    return out


def has_any(words: Column, terms: list[str]) -> Column:
    return F.arrays_overlap(words, F.array(*map(F.lit, terms)))


def phrase_hits(words: Column, phrase: list[str]) -> Column:
    """How often the words of a phrase stand one after the other."""
    starts = F.transform(words, lambda w, i: F.when(w == phrase[0], i))
    found = F.filter(starts, lambda i: i.isNotNull())
    return F.size(F.filter(found, lambda i: F.slice(words, i + 1, len(phrase)) == F.array(*map(F.lit, phrase))))


def tested(docs: DataFrame, test) -> DataFrame:
    """``docs`` (doc_id, text) with ``hits``, what ``test`` gives of a document's tokens."""
    return docs.select("doc_id", bind(tokens(F.col("text")), test).alias("hits"))


def match_all(docs: DataFrame, terms: list[str]) -> DataFrame:
    """Documents whose text holds every term."""
    return tested(docs, lambda w: has_all(w, terms)).filter("hits").select("doc_id")


def match_any(docs: DataFrame, terms: list[str]) -> DataFrame:
    return tested(docs, lambda w: has_any(w, terms)).filter("hits").select("doc_id")


def match_not(docs: DataFrame, wanted: str, unwanted: str) -> DataFrame:
    return tested(docs, lambda w: F.array_contains(w, wanted) & ~F.array_contains(w, unwanted)).filter("hits").select("doc_id")


def match_prefix(docs: DataFrame, prefix: str) -> DataFrame:
    return tested(docs, lambda w: F.size(F.filter(w, lambda t: t.startswith(prefix))).cast("long")).filter("hits > 0")


def match_phrase(docs: DataFrame, words: list[str]) -> DataFrame:
    """Documents in which the words stand one after the other, and how often."""
    return tested(docs, lambda w: phrase_hits(w, words).cast("long")).filter("hits > 0")


def match_query(docs: DataFrame, text: str, mode: str = "all") -> DataFrame:
    """Documents that fit what a user typed: every phrase and word, any of them ('any'), or all as one phrase."""
    mode, parts = parse_query(text, mode)

    def one(w: Column) -> Column:
        tests = [F.array_contains(w, p[0]) if len(p) == 1 else phrase_hits(w, p) > 0 for p in parts]
        out = tests[0]
        for t in tests[1:]:
            out = out | t if mode == "any" else out & t
        return out

    return tested(docs, one).filter("hits").select("doc_id")


def bm25(texts: DataFrame, terms: list[str], weights: dict[str, float] | None = None) -> DataFrame:
    """(doc_id, score) of the documents with any term, lower is better; lengths count the tokens of all fields. One pass over
    the texts; only one row of totals leaves the tasks."""
    weights = weights or WEIGHTS

    def times(w: Column, term: str) -> Column:
        return F.size(F.filter(w, lambda t: t == term))

    def counted(w: Column) -> Column:
        return F.struct(F.size(w).alias("size"), *[times(w, x).alias(f"n{k}") for k, x in enumerate(terms)])

    fields = texts.select("doc_id", *[bind(tokens(F.col(f)), counted).alias(f"_{f}") for f in WEIGHTS])
    tf = [sum((weights.get(f, 0.0) * F.col(f"_{f}.n{k}") for f in WEIGHTS), F.lit(0.0)).alias(f"tf{k}") for k in range(len(terms))]
    per = fields.select("doc_id", sum((F.col(f"_{f}.size") for f in WEIGHTS), F.lit(0)).alias("size"), *tf)
    total = per.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean"), *[F.count_if(F.col(f"tf{k}") > 0).alias(f"df{k}") for k in range(len(terms))])
    any_term = F.greatest(*[F.col(f"tf{k}") for k in range(len(terms))], F.lit(0.0)) > 0
    joined = per.filter(any_term).crossJoin(F.broadcast(total))  # one row on the right
    return joined.select("doc_id", F.round(bm25_score(terms), 6).alias("score"))


def bm25_score(terms: list[str]) -> Column:
    """The score of a row (size, mean, n, tf*, df*)."""
    score = F.lit(0.0)
    for k in range(len(terms)):
        idf = F.log((F.col("n") - F.col(f"df{k}") + 0.5) / (F.col(f"df{k}") + 0.5))
        tf = F.col(f"tf{k}")
        score = score - F.when(idf > 0, idf).otherwise(1e-6) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * F.col("size") / F.col("mean")))
    return score


def search(c: Catalog, terms: list[str], site: str | None = None, category: str | None = None, limit: int = 50, offset: int = 0) -> DataFrame:
    """A page of the best documents with all the terms in their text, with their rank among all."""
    texts = indexed_texts(c)
    hits = match_all(c.documents, terms)
    about = texts.select("doc_id", "title", "site", "category")
    if site:
        about = about.filter(F.col("site") == site)
    if category:
        about = about.filter(F.col("category") == category)
    scored = bm25(texts, terms).join(hits, "doc_id", "left_semi").join(about, "doc_id")
    top = scored.orderBy("score", F.desc("doc_id")).limit(offset + limit)
    ranked = top.withColumn("rank", F.row_number().over(Window.orderBy("score", F.desc("doc_id"))))  # at most a page more than ``offset`` rows
    return ranked.filter(F.col("rank") > offset).select("rank", "doc_id", "title", "site", "score")


# --- a stored index


def shard(token: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(shards)).cast("int")


def write_index(texts: DataFrame, path: str, shards: int = 64) -> None:
    """Writes the index of ``texts`` to a folder that all executors share: postings by shard of their token (doc_id, field,
    token, n), and a row for each document (doc_id, size, digest). A search reads the shards of its terms alone. A third of a
    shard may be one token, so rows are dealt by token and document."""
    fields = [F.struct(F.lit(f).alias("field"), tokens(F.col(f)).alias("tokens")) for f in WEIGHTS]
    rows = texts.select("doc_id", F.explode(F.array(*fields)).alias("f")).select("doc_id", "f.field", F.explode("f.tokens").alias("token"))
    counted = rows.groupBy("doc_id", "field", "token").agg(F.count(F.lit(1)).alias("n")).withColumn("shard", shard(F.col("token"), shards))
    counted.repartition("shard", F.pmod(F.xxhash64("doc_id"), F.lit(8))).write.mode("overwrite").partitionBy("shard").parquet(f"{path}/postings")
    size = sum((F.size(tokens(F.col(f))) for f in WEIGHTS), F.lit(0))
    texts.select("doc_id", size.alias("size"), F.sha2(F.coalesce("body", F.lit("")), 256).alias("digest")).write.mode("overwrite").parquet(f"{path}/documents")


def search_index(spark: SparkSession, path: str, terms: list[str], weights: dict[str, float] | None = None, shards: int = 64) -> DataFrame:
    """(doc_id, score) as ``bm25``, from a stored index: partition pruning leaves the shards of the terms, and only their rows
    are read."""
    weights = weights or WEIGHTS
    numbers = [r[0] for r in spark.createDataFrame([(t,) for t in terms], "t string").select(shard(F.col("t"), shards)).collect()]  # a row for each term
    weight = F.create_map(*[x for f, w in weights.items() for x in (F.lit(f), F.lit(w))])[F.col("field")]
    rows = spark.read.parquet(f"{path}/postings").filter(F.col("shard").isin(numbers) & F.col("token").isin(terms))
    per = rows.groupBy("doc_id").agg(*[F.sum(F.when(F.col("token") == t, weight * F.col("n")).otherwise(0.0)).alias(f"tf{k}") for k, t in enumerate(terms)])
    docs = spark.read.parquet(f"{path}/documents")
    total = docs.agg(F.count(F.lit(1)).alias("n"), F.avg("size").alias("mean"))
    df = per.agg(*[F.count_if(F.col(f"tf{k}") > 0).alias(f"df{k}") for k in range(len(terms))])
    joined = per.join(docs.select("doc_id", "size"), "doc_id").crossJoin(F.broadcast(total.crossJoin(F.broadcast(df))))  # one row on the right
    return joined.select("doc_id", F.round(bm25_score(terms), 6).alias("score"))


def snippets(docs: DataFrame, term: str, around: int = 6) -> DataFrame:
    """(doc_id, snippet): the words around the first hit, which is marked."""
    words = F.split(F.trim(F.regexp_replace("text", r"\s+", " ")), " ")
    folded = F.transform(words, lambda w: F.translate(F.lower(F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")), ACCENTED, PLAIN))
    rows = docs.filter("text is not null").select("doc_id", words.alias("words"), F.array_position(folded, term).cast("int").alias("at")).filter("at > 0")
    begin = F.greatest(F.lit(1), F.col("at") - around)
    left = F.slice("words", begin, F.col("at") - begin)
    right = F.slice("words", F.col("at") + 1, F.lit(around))
    return rows.select("doc_id", F.trim(F.concat_ws(" ", F.array_join(left, " "), F.concat(F.lit("<mark>"), F.element_at("words", F.col("at")), F.lit("</mark>")), F.array_join(right, " "))).alias("snippet"))


def sync_diff(c: Catalog, indexed: DataFrame) -> DataFrame:
    """(doc_id, action) that bring an index (doc_id, digest) up to date with the documents."""
    now = c.documents.filter("text is not null").select("doc_id", F.sha2("text", 256).alias("now"))
    joined = now.join(indexed.select("doc_id", F.col("digest").alias("old")), "doc_id", "full")
    action = F.when(F.col("now").isNull(), "delete").when(F.col("old").isNull(), "insert").when(F.col("old") != F.col("now"), "update")
    return joined.select("doc_id", action.alias("action")).filter("action is not null")


def parse_query(text: str, mode: str = "all") -> tuple[str, list[list[str]]]:
    """(mode, phrases) of what a user typed: quoted phrases first, then single words."""
    if not text or not text.strip():
        raise ValueError("the query is empty")
    if mode not in ("all", "any", "phrase"):
        raise ValueError(f"unknown mode: {mode}")
    table = str.maketrans(ACCENTED, PLAIN)
    fold = lambda s: re.findall(r"[^\W_]+", s.lower().translate(table))
    if mode == "phrase":
        parts = [fold(text)]
    else:
        parts = [fold(p) for p in re.findall(r'"([^"]+)"', text)]
        parts += [[w] for w in fold(re.sub(r'"[^"]*"', " ", text))]
    parts = [p for p in parts if p]
    if not parts:
        raise ValueError("the query has no words")
    return mode, parts


def stale_rows(c: Catalog, indexed: DataFrame) -> DataFrame:
    """(doc_id) of an index (doc_id, digest) that must go: no text any more, or no usable extraction."""
    usable = c.chain.filter(usable_text()).select("text_uri").distinct()
    kept = c.documents.filter("text is not null").join(usable, "text_uri", "left_semi").select("doc_id")
    return indexed.select("doc_id").distinct().join(kept, "doc_id", "left_anti")
