"""Predicates and defaults that several queries share, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def or_else(column: str, value: str) -> Column:
    return F.coalesce(F.col(column), F.lit(value))


def url_present(download_url: str = "download_url", url: str = "url") -> Column:
    """An empty download_url is not replaced by url here."""
    return F.coalesce(F.col(download_url), F.col(url), F.lit("")) != ""


def effective_url(download_url: str = "download_url", url: str = "url") -> Column:
    """The URL to fetch: an empty download_url gives way to url."""
    return F.coalesce(F.nullif(F.col(download_url), F.lit("")), F.col(url))


def http_url(column: Column) -> Column:
    return F.coalesce(column.rlike("^https?://[^/]+"), F.lit(False))


def usable_text(status: str = "extraction_status", quality: str = "quality_status", uri: str = "text_uri") -> Column:
    """A processed extraction with a text that is not known to be unusable; an unknown quality passes."""
    return F.coalesce((F.col(status) == "processed") & F.col(uri).isNotNull() & (or_else(quality, "usable") != "unusable"), F.lit(False))


def blocking() -> Column:
    """A download under way, or one whose text is under way or usable."""
    no_text = F.col("extraction_id").isNull()
    under_way = F.col("extraction_status").isin("pending", "processing")
    good = (F.col("extraction_status") == "processed") & (or_else("quality_status", "usable") != "unusable")
    return F.coalesce(F.col("download_status").isin("pending", "downloading") | ((F.col("download_status") == "downloaded") & (no_text | under_way | good)), F.lit(False))


def ascii_fold(column: Column) -> Column:
    """Lower case for ASCII letters only."""
    return F.translate(column, UPPER, UPPER.lower())


def ascii_contains(column: Column, needle: str) -> Column:
    """Substring test that ignores the case of ASCII letters only; null is false."""
    return F.coalesce(F.contains(ascii_fold(column), F.lit("".join(c.lower() if c in UPPER else c for c in needle))), F.lit(False))


#: Formats in the order of preference: the first name contained in the lower-cased format wins (fixed values).
FORMAT_RANKS = (("text", 0), ("plain text", 0), ("txt", 0), ("muse", 0), ("html", 1), ("htm", 1), ("epub", 2), ("fb2", 3), ("rtf", 3), ("docx", 4), ("doc", 5), ("pdf", 6), ("mobi", 7), ("kindle", 7), ("azw", 8), ("daisy", 9), ("djvu", 10), ("torrent", 99))


def format_rank(column: Column) -> Column:
    low = F.lower(F.coalesce(column, F.lit("")))
    rank = F
    for name, value in FORMAT_RANKS:
        rank = rank.when(F.contains(low, F.lit(name)), value)
    return rank.otherwise(50)


def size_bytes(column: Column) -> Column:
    """The first number of a free-form size times the unit right after it; 10**12 without a readable number."""
    low = F.lower(F.coalesce(column, F.lit("")))
    number = F.regexp_extract(low, r"([0-9.]+)\s*(b|kb|mb|gb)?", 1)
    unit = F.regexp_extract(low, r"([0-9.]+)\s*(b|kb|mb|gb)?", 2)
    factor = F.when(unit == "gb", 1073741824.0).when(unit == "mb", 1048576.0).when(unit == "kb", 1024.0).otherwise(1.0)
    return F.coalesce(number.try_cast("double") * factor, F.lit(1e12))
