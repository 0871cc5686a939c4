"""Text functions as Column expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Category names that are always valid (fixed values).
STATIC = ("philosophy", "political_economy", "history", "literature", "law", "natural_science", "medicine", "software", "sport", "music", "uncategorized", "unprocessed")
#: Words of file formats that never make a category (fixed values).
ARTEFACTS = ("aacode", "asciihexdecode", "binary", "bitspercomponent", "ccittfaxdecode", "decode", "dictionary", "endobj", "endstream", "filter", "flatedecode", "fontdescriptor", "length", "obj", "objstm", "startxref", "stream", "trailer", "xref")
#: Words too general to be a category (fixed values).
GENERIC = ("archive", "author", "book", "books", "chapter", "file", "files", "library", "page", "pages", "text", "texts", "unknown", "work", "works")
#: Words of the field that are valid without a dictionary (fixed values).
DOMAIN = ("alchemy", "alchemical", "anarchist", "anarchism", "babylonian", "chaos", "esoteric", "grimoire", "hermetic", "kabalah", "magick", "occult", "pagan", "qabbalah", "ritual", "thelema", "thelemic", "theosophy", "witchcraft")
NOT_WORDS = (*ARTEFACTS, *GENERIC)
#: Words that say nothing of a subject (fixed values).
COMMON = (
    "about", "after", "again", "against", "also", "among", "because", "before", "being", "between", "could", "every", "first", "from", "have", "into",
    "more", "most", "other", "over", "shall", "should", "such", "than", "that", "their", "there", "these", "they", "this", "those", "through",
    "under", "upon", "were", "what", "when", "where", "which", "while", "with", "without", "would", "your", "the", "and", "for", "not", "are",
    "but", "you", "was", "his", "her", "its", "has", "had", "who", "one", "all", "can", "our", "out", "may", "will", "been", "them", "then",
    "some", "only", "many", "much", "very", "chapter", "page", "book", "archive", "archives", "author", "books", "file", "files",
    "library", "pages", "text", "texts", "work", "works",
)
#: Signs written in a plainer form (fixed values).
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"}
PUNCTUATION = {"\u2018": "'", "\u2019": "'", "\u201c": '"', "\u201d": '"', "\u2013": "-", "\u2014": "--", "\u00a0": " "}
#: Lines that begin and end the text between a publisher's notices (fixed values).
NOTICES = (("*** START OF THE PROJECT GUTENBERG", "*** END OF THE PROJECT GUTENBERG"), ("*** START OF THIS PROJECT GUTENBERG", "*** END OF THIS PROJECT GUTENBERG"))


def bind(value: Column, make: Callable[[Column], Column]) -> Column:
    """``make(value)`` with the value computed once, however often ``make`` names it."""
    return F.transform(F.array(value), make)[0]


def collapse(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\r\n\f]+", " "))


def shorten(text: Column, limit: int) -> Column:
    """At most ``limit`` characters, the last three of which tell that some are missing."""
    return F.when(F.length(text) > limit, F.concat(F.rtrim(F.substring(text, 1, limit - 3)), F.lit("..."))).otherwise(text)


def normalize(text: Column) -> Column:
    """Line ends as LF, runs of blanks as one, at most one blank line, nothing around."""
    out = F.regexp_replace(text, "\r\n?", "\n")
    out = F.regexp_replace(out, "[ \t]+", " ")
    out = F.regexp_replace(out, "\n{3,}", "\n\n")
    return F.regexp_replace(out, r"^[ \t\r\n\f]+|[ \t\r\n\f]+$", "")


def corpus_normalize(text: Column) -> Column:
    """As ``normalize``, without blanks beside line ends."""
    out = F.regexp_replace(text, "\r\n?", "\n")
    out = F.regexp_replace(out, "[ \t]+", " ")
    out = F.regexp_replace(out, " ?\n ?", "\n")
    out = F.regexp_replace(out, "\n{3,}", "\n\n")
    return F.regexp_replace(out, r"^[ \t\r\n\f]+|[ \t\r\n\f]+$", "")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def dehyphenate(text: Column) -> Column:
    return F.regexp_replace(text, r"([A-Za-z]{2,})-\n([a-z]{2,})", "$1$2")


def safe_segment(text: Column, fallback: str = "unknown") -> Column:
    kept = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9._-]+", "-")
    kept = F.substring(F.regexp_replace(kept, "^[.-]+|[.-]+$", ""), 1, 96)
    return F.when(kept == "", fallback).otherwise(kept)


def slug(text: Column, fallback: str = "uncategorized") -> Column:
    kept = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(kept == "", fallback).otherwise(kept)


def valid_category(name: Column, dictionary: tuple[str, ...] = ()) -> Column:
    """A static name, or one to three words of four letters or more, none of them an artefact or too general, one with a
    vowel; with a dictionary each word must stand in it or be a word of the field."""

    def sound(p: Column) -> Column:
        ok = (F.length(p) >= 4) & ~p.isin(*NOT_WORDS)
        return ok & p.isin(*DOMAIN, *dictionary) if dictionary else ok

    def judged(low: Column) -> Column:
        parts = F.split(low, "_")
        return F.length(low).between(4, 48) & low.rlike("^[a-z]+(_[a-z]+){0,2}$") & F.forall(parts, sound) & F.exists(parts, lambda p: p.rlike("[aeiouy]"))

    return F.coalesce(bind(slug(name), lambda low: low.isin(*STATIC) | judged(low)), F.lit(False))


def useful(text: Column, least: int = 200) -> Column:
    """Whether a text has enough ASCII letters and digits to be of use."""
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z0-9]", "")) >= least


def quality_metrics(text: Column) -> dict[str, Column]:
    size = F.greatest(F.length(text), F.lit(1))
    return {
        "controls": F.length(text) - F.length(F.regexp_replace(text, "[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f-\\x9f]", "")),
        "replacements": F.length(text) - F.length(F.replace(text, F.lit("�"), F.lit(""))),
        "wordish": F.regexp_count(text, F.lit(r"[\p{L}\p{N}_]{3,}")),
        "size": size,
    }


def quality_heuristic(text: Column) -> Column:
    """struct<status, score>: the first rule that fits decides; the whole text is looked at."""
    text = F.coalesce(text, F.lit(""))
    m = quality_metrics(text)
    bare = F.regexp_replace(text, r"^[ \t\r\n\f]+|[ \t\r\n\f]+$", "")

    def verdict(status: str, score: float) -> Column:
        return F.struct(F.lit(status).alias("status"), F.lit(score).alias("score"))

    return (
        F.when(bare == "", verdict("unusable", 0.0))
        .when(F.contains(F.substring(text, 1, 200), F.lit("\x00")) | text.startswith("\x1f\ufffd") | text.startswith("\x1f\x8b") | text.startswith("\x8b"), verdict("unusable", 0.02))
        .when(m["controls"] / m["size"] > 0.03, verdict("unusable", 0.05))
        .when(m["replacements"] / m["size"] > 0.02, verdict("unusable", 0.10))
        .when((F.length(bare) < 120) | (m["wordish"] < 12), verdict("suspect", 0.45))
        .otherwise(verdict("usable", 0.75))
    )


def final_quality(text: Column, verdict: Column | None = None) -> Column:
    """struct<status, score, model>: the heuristic where no verdict of a reader (struct<status, score, model>) is given, by
    which a suspect text passes; a verdict counts only for texts that are not plainly unusable."""

    def merged(h: Column) -> Column:
        own = F.struct(F.when(h["status"] == "suspect", "usable").otherwise(h["status"]).alias("status"), h["score"].alias("score"), F.lit("local-heuristic").alias("model"))
        return own if verdict is None else F.when((h["status"] != "unusable") & verdict["status"].isNotNull(), verdict).otherwise(own)

    return bind(quality_heuristic(text), merged)


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line) with lines counted from 1."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select("doc_id", (F.col("pos") + 1).alias("line_no"), F.regexp_replace("line", "\r$", "").alias("line"))


def running_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no) of bare page numbers and of short lines that, digits masked, occur three times or more."""
    bare = F.regexp_replace("line", r"^[ \t]+|[ \t]+$", "")
    keyed = lines(docs).withColumn("bare", bare).withColumn("key", F.regexp_replace(F.lower("bare"), "[0-9]+", "#"))
    counted = keyed.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("doc_id", "key")))
    repeated = (F.col("n") >= 3) & F.length("key").between(1, 90)
    return counted.filter(F.col("bare").rlike("^[-–— ]*[0-9]+[-–— ]*$") | repeated).select("doc_id", "line_no")


_SIGN = r"[\p{L}\p{N}_]"
#: Four single letters or digits with blanks between them.
SPACED = rf"(^|[^\p{{L}}\p{{N}}_]){_SIGN}\s+{_SIGN}\s+{_SIGN}\s+{_SIGN}($|[^\p{{L}}\p{{N}}_])"


def suspicious_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no) of lines with replacement characters, three odd signs, spaced letters, or words joined by a bar."""
    bare = F.regexp_replace("line", r"^\s+|\s+$", "")
    line = F.col("bare")
    odd = line.contains("�") | (F.length(line) - F.length(F.regexp_replace(line, r"[^A-Za-z0-9\s.,;:'\"!?()\[\]{}-]", "")) >= 3) | line.rlike(SPACED) | line.rlike(r"[A-Za-z]{2,}\|[A-Za-z]{2,}")
    return lines(docs).withColumn("bare", bare).filter((line != "") & odd).select("doc_id", "line_no")


def unwrap(text: Column) -> Column:
    """Paragraphs whose lines run on: single lines, lists and short verse stay as they are."""

    def one(paragraph: Column) -> Column:
        parts = F.filter(F.transform(F.split(paragraph, "\n"), lambda x: F.regexp_replace(x, r"^[ \t\r]+|[ \t\r]+$", "")), lambda x: x != "")
        listed = F.exists(parts, lambda x: x.rlike(r"^([-*•]|[0-9]+[.)])[ \t]+"))
        verse = F.forall(parts, lambda x: F.length(x) <= 72) & (F.size(parts) <= 8)
        return F.when((F.size(parts) <= 1) | listed | verse, F.array_join(parts, "\n")).otherwise(F.array_join(parts, " "))

    return F.array_join(F.filter(F.transform(F.split(text, "\n{2,}"), one), lambda x: x != ""), "\n\n")


def subject_words(text: Column) -> Column:
    """The words of a text that could name a subject, each as often as it stands."""
    pieces = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z][a-z0-9_'-]{3,}"), 0)
    words = F.transform(pieces, lambda w: F.regexp_replace(w, "[^a-z]", ""))
    return F.filter(words, lambda w: F.length(w).between(4, 48) & ~w.isin(*COMMON, *NOT_WORDS) & w.rlike("[aeiouy]"))


def token_counts(docs: DataFrame, most: int | None = None) -> DataFrame:
    """(token, documents, total) of the words that could name a subject."""
    per = docs.select("doc_id", F.explode(subject_words(F.col("text"))).alias("token")).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    out = per.groupBy("token").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("total"))
    return out.orderBy(F.desc("total"), "token").limit(most) if most else out


def keyword_category(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """``rows`` (title, author, site, text, ...) with ``category``: the first category, static ones first, of which a keyword
    stands in them; null without one. A category without keywords has its name, with blanks. The whole text is searched.

    The categories are a small table; their ordered array goes to every task."""
    keywords = F.from_json("keywords_json", "array<string>")
    named = categories.select(F.coalesce("dynamic", F.lit(0)).alias("dynamic"), "name", F.when(F.size(keywords) > 0, keywords).otherwise(F.array(F.replace("name", F.lit("_"), F.lit(" ")))).alias("keywords"))
    ordered = named.agg(F.sort_array(F.collect_list(F.struct("dynamic", "name", "keywords"))).alias("_categories"))
    whole = F.lower(F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in ("title", "author", "site", "text")]))
    first = bind(whole, lambda low: F.get(F.filter("_categories", lambda c: F.exists(c["keywords"], lambda k: F.contains(low, k))), F.lit(0))["name"])
    return rows.crossJoin(F.broadcast(ordered)).withColumn("category", first).drop("_categories")  # one row on the right


def word_category(rows: DataFrame) -> DataFrame:
    """(doc_id, name, keywords) of ``rows`` (doc_id, title, search_query, text): the word that names a document's subject, by
    three times its count in title and query plus that in the text; without any word there, the most frequent of those that
    stand three times in the text; 'uncategorized' without one. Ties go by the alphabet. The eight keywords are the most frequent words, those of the title first by two."""
    title = subject_words(F.concat_ws(" ", "title", "search_query"))
    both = F.concat(F.transform(title, lambda w: F.struct(w.alias("w"), F.lit(1).alias("t"))), F.transform(subject_words(F.col("text")), lambda w: F.struct(w.alias("w"), F.lit(0).alias("t"))))
    counted = rows.select("doc_id", F.explode(both).alias("x")).groupBy("doc_id", F.col("x.w").alias("w")).agg(F.sum("x.t").alias("t"), F.sum(1 - F.col("x.t")).alias("n"))
    weight = F.when(F.col("t") > 0, F.col("n") + F.col("t") + 2).otherwise(F.col("n"))
    picked = counted.groupBy("doc_id").agg(
        F.min(F.when(F.col("t") > 0, F.struct((-(3 * F.col("t") + F.col("n"))).alias("rank"), "w"))).alias("titled"),
        F.min(F.when(F.col("n") >= 3, F.struct((-F.col("n")).alias("rank"), "w"))).alias("repeated"),
        F.max(F.col("t") > 0).alias("has_title"),
        F.slice(F.array_sort(F.collect_list(F.struct((-weight).alias("rank"), "w"))), 1, 8).alias("top"),
    )
    name = F.when(F.col("has_title"), F.col("titled.w")).otherwise(F.col("repeated.w"))
    found = picked.select("doc_id", name.alias("name"), F.array_join(F.col("top.w"), ",").alias("words"))
    every = rows.select("doc_id").join(found, "doc_id", "left")
    return every.select("doc_id", F.coalesce("name", F.lit("uncategorized")).alias("name"), F.when(F.col("name").isNotNull(), F.col("words")).otherwise("").alias("keywords"))


def between_notices(text: Column) -> Column:
    """What stands between the lines of a publisher's notices. As defined, the place of the end is taken before the beginning
    is cut off, so that with both some of the end stays."""
    for start, end in NOTICES:
        text = bind(text, _between(start, end))
    return text


def _between(start: str, end: str) -> Callable[[Column], Column]:
    def one(t: Column) -> Column:
        a, b = F.instr(F.upper(t), F.lit(start)), F.instr(F.upper(t), F.lit(end))
        line_end = F.call_function("locate", F.lit("\n"), t, F.greatest(a, F.lit(1)))
        body = F.when(a > 0, F.substr(t, F.when(line_end > 0, line_end + 1).otherwise(a))).otherwise(t)
        return F.when(b > 0, F.substr(body, F.lit(1), b - 1)).otherwise(body)

    return one


def substitute(text: Column, pairs) -> Column:
    """Literal replacements, one after the other."""
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def replace_some(text: Column, pattern: str, new: str, most: int) -> Column:
    """The first ``most`` matches of a pattern replaced by a plain string."""
    return F.array_join(F.split(text, pattern, most + 1), new)


def checked_rules(rules) -> list[dict]:
    """The rules that may be applied, of the first fifty: literal or regex, with a source of 1 to 200 characters that compiles;
    a rule replaces 1 to 10 000 matches, 1 000 where it does not say."""
    import re

    if not isinstance(rules, list):
        raise ValueError("rules come as a list")
    out = []
    for rule in rules[:50]:
        kind, source = (rule.get("type"), str(rule.get("from") or "")) if isinstance(rule, dict) else (None, "")
        if kind in ("literal", "regex") and 0 < len(source) <= 200:
            try:
                re.compile(source if kind == "regex" else "")
            except re.error:
                continue
            out.append({"type": kind, "from": source, "to": str(rule.get("to") or ""), "reason": str(rule.get("reason") or "")[:200], "most": min(10_000, max(1, int(rule.get("max_replacements") or 1000)))})
    return out


def apply_rules(text: Column, rules: list[dict]) -> tuple[Column, list[Column]]:
    """The text after the checked rules, one after the other, and how often each was applied. Patterns are those of the JVM,
    and the new text is taken as it stands."""
    counts = []
    for rule in rules:
        pattern = rule["from"] if rule["type"] == "regex" else "\\Q" + rule["from"].replace("\\E", "\\E\\\\E\\Q") + "\\E"
        counts.append(F.size(F.split(text, pattern, rule["most"] + 1)) - 1)
        text = replace_some(text, pattern, rule["to"], rule["most"])
    return text, counts


def first_json(answer: Column, schema: str) -> Column:
    """The first JSON value of an answer, in a fenced block or from the first bracket on; null where there is none."""
    trimmed = F.trim(answer)
    fenced = F.regexp_extract(trimmed, r"(?s)```(?:json)?\s*([\[{].*?[\]}])\s*```", 1)
    bare = F.regexp_extract(trimmed, r"(?s)([\[{].*[\]}])", 1)
    return F.from_json(F.when(fenced != "", fenced).otherwise(bare), schema)


_WANTED = "[\\p{C}&&[^\\n\\t]]|\ufffd"


@F.pandas_udf(StringType())
def _compatible(texts: pd.Series) -> pd.Series:
    import unicodedata

    return texts.map(lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t), na_action="ignore")


def plain_signs(text: Column) -> Column:
    """Compatibility forms without ligatures, typographic signs, control characters and replacement characters. The forms are
    the only step outside the JVM, in Arrow batches."""
    return F.regexp_replace(_compatible(substitute(text, [*LIGATURES.items(), *PUNCTUATION.items()])), _WANTED, "")


def without_running_lines(text: Column) -> Column:
    """struct<text, removed>: without bare page numbers and lines of up to 90 characters that, digits masked, stand three
    times or more. A sorted copy of the keys shows the repeated ones, so a document never leaves its task."""

    def keyed(parts: Column) -> Column:
        rows = F.transform(parts, lambda x: F.struct(x.alias("line"), F.regexp_replace(x, r"^\s+|\s+$", "").alias("bare")))
        return F.transform(rows, lambda r: F.struct(r["line"].alias("line"), r["bare"].alias("bare"), F.regexp_replace(F.lower(r["bare"]), "[0-9]+", "#").alias("key")))

    def repeated(rows: Column) -> Column:
        keys = F.array_sort(F.filter(F.transform(rows, lambda r: r["key"]), lambda k: F.length(k).between(1, 90)))
        return bind(keys, lambda ks: F.array_distinct(F.filter(ks, lambda k, i: F.get(ks, i + 2) == k)))

    def kept(rows: Column) -> Column:
        def left(again: Column) -> Column:
            return F.filter(rows, lambda r: ~r["bare"].rlike("^[-–— ]*[0-9]+[-–— ]*$") & ~(F.array_contains(again, r["key"]) & (F.length(r["bare"]) <= 90)))

        return bind(bind(repeated(rows), left), lambda out: F.struct(F.array_join(F.transform(out, lambda r: r["line"]), "\n").alias("text"), (F.size(rows) - F.size(out)).alias("removed")))

    return bind(keyed(F.split(text, "[\n\u2028\u2029]")), kept)


def munged(text: Column) -> Column:
    """struct<text, original_chars, cleaned_chars, removed_running_lines, replacement_chars_removed>: a text made ready for
    training, in this order: plain signs, notices, divided words, blanks, running lines, paragraphs, blank lines. Null stays
    null; a text of nothing but noise becomes the empty string."""
    blanks = lambda t: F.regexp_replace(t, "[ \t]+", " ")
    laid = F.regexp_replace(blanks(dehyphenate(between_notices(plain_signs(text)))), " *\n *", "\n")

    def last(r: Column) -> Column:
        tidy = blanks(F.regexp_replace(unwrap(r["text"]), "\n{3,}", "\n\n"))
        return F.struct(F.regexp_replace(tidy, r"^\s+|\s+$", "").alias("text"), r["removed"].alias("removed"))

    def told(r: Column) -> Column:
        lost = F.length(text) - F.length(F.replace(text, F.lit("\ufffd"), F.lit("")))
        return F.struct(r["text"].alias("text"), F.length(text).alias("original_chars"), F.length(r["text"]).alias("cleaned_chars"), r["removed"].alias("removed_running_lines"), lost.alias("replacement_chars_removed"))

    return F.when(text.isNotNull(), bind(bind(without_running_lines(laid), last), told))
