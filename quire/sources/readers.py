"""Readers of raw artefacts: bytes with unknown encoding, gzip, HTML, EPUB, feeds, logs and line files."""

from __future__ import annotations

import gzip
import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SKIPPED = ("script", "style", "meta", "noscript")
BLOCKS = ("p", "div", "br", "li", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "section", "article", "title", "table", "ul", "ol", "blockquote", "pre")


class _Text(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.parts: list[str] = []
        self.hidden = 0

    def handle_starttag(self, tag: str, attrs) -> None:
        self.hidden += tag in SKIPPED[:2] or tag == "noscript"
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_endtag(self, tag: str) -> None:
        if tag in SKIPPED and self.hidden:
            self.hidden -= 1
        if tag in BLOCKS:
            self.parts.append("\n")

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.parts.append(data)


def html_text(markup: str | None) -> str | None:
    """The visible text of a page, one line for each block; null for null."""
    if markup is None:
        return None
    parser = _Text()
    parser.feed(markup)
    parser.close()
    lines = (re.sub(r"\s+", " ", line).strip() for line in "".join(parser.parts).split("\n"))
    return "\n".join(line for line in lines if line)


def decode_bytes(raw: bytes | None) -> str | None:
    """UTF-8, else UTF-16, else Latin-1, which never fails."""
    if raw is None:
        return None
    for name in ("utf-8-sig", "utf-16", "latin-1"):
        try:
            return raw.decode(name)
        except UnicodeDecodeError:
            continue
    return None


def gunzip(raw: bytes | None) -> bytes | None:
    """The content of gzip bytes, other bytes as they are; broken gzip is null."""
    if raw is None or raw[:2] != b"\x1f\x8b":
        return raw
    try:
        return gzip.decompress(raw)
    except (OSError, EOFError):
        return None


def epub_text(raw: bytes | None) -> str | None:
    """The text of the chapters of an EPUB in the order of its spine, of their names without one; null where it can't be read."""
    if raw is None:
        return None
    try:
        with zipfile.ZipFile(io.BytesIO(raw)) as book:
            names = _spine(book) or sorted(n for n in book.namelist() if n.lower().endswith((".xhtml", ".html", ".htm")))
            return "\n\n".join(filter(None, (html_text(decode_bytes(book.read(n))) for n in names)))
    except (zipfile.BadZipFile, KeyError):
        return None


def _spine(book: zipfile.ZipFile) -> list[str]:
    """The chapters that the package file of a book lists, in reading order."""
    package = next((n for n in book.namelist() if n.lower().endswith(".opf")), None)
    if package is None:
        return []
    try:
        root = ElementTree.fromstring(book.read(package))
    except ElementTree.ParseError:
        return []
    local = lambda e: e.tag.rpartition("}")[2]
    items = {e.get("id"): e.get("href") for e in root.iter() if local(e) == "item"}
    base = package.rpartition("/")[0]
    names = [(f"{base}/" if base else "") + items[e.get("idref")] for e in root.iter() if local(e) == "itemref" and items.get(e.get("idref"))]
    return [n for n in names if n in book.namelist()]


def mode_of(name: Column, content_type: Column, file_format: Column | None = None) -> Column:
    """How an artefact is to be read, from the suffix of its name and what content type and format hint at; what cannot be
    read is skipped, not failed."""
    suffix = F.regexp_extract(F.lower(F.coalesce(name, F.lit(""))), r"\.[a-z0-9]+$", 0)
    hint = F.lower(F.concat_ws(" ", F.coalesce(content_type, F.lit("")), F.coalesce(file_format, F.lit("")) if file_format is not None else F.lit("")))
    ends = lambda *names: suffix.isin(*names)
    has = lambda word: F.contains(hint, F.lit(word))
    return (
        F.when(has("encrypted") | ends(".lcpdf"), "skip:encrypted")
        .when(ends(".torrent", ".aria2", ".part", ".resume"), "skip:torrent")
        .when(ends(".gz"), "gzip")
        .when(ends(".html", ".htm", ".xml", ".fb2") | has("html") | has("fb2"), "html")
        .when(ends(".txt", ".text", ".md", ".muse", ".json", ".csv") | has("text") | has("muse"), "text")
        .when(ends(".pdf") | has("pdf"), "pdf")
        .when(ends(".epub") | has("epub"), "epub")
        .when(ends(".png", ".jpg", ".jpeg", ".tif", ".tiff", ".bmp") | has("image/"), "image")
        .otherwise("skip:unsupported")
    )


def read_artifacts(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, mode, text) of the files of a folder and its subfolders; Arrow batches of whole files, one file at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(folder).filter("length > 0")
    rows = files.select("path", mode_of(F.col("path"), F.lit("")).alias("mode"), "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            texts = []
            for mode, raw in zip(frame["mode"], frame["content"], strict=True):
                raw = bytes(raw)
                if mode == "gzip":
                    raw = gunzip(raw)
                    mode = "html" if raw and raw[:200].lstrip().lower().startswith((b"<!doctype html", b"<html")) else "text"
                if mode == "html":
                    texts.append(html_text(decode_bytes(raw)))
                elif mode == "text":
                    texts.append(decode_bytes(raw))
                elif mode == "epub":
                    texts.append(epub_text(raw))
                else:
                    texts.append(None)
            yield pd.DataFrame({"path": frame["path"], "mode": frame["mode"], "text": texts})

    return rows.mapInPandas(run, "path string, mode string, text string")


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """(ts, kind, content, corrupt) of a JSON-lines log; a broken line is kept as a row of kind corrupt."""
    schema = "ts string, kind string, content string, _corrupt_record string"
    rows = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    broken = F.col("_corrupt_record").isNotNull()
    return rows.select("ts", F.when(broken, "corrupt").otherwise(F.col("kind")).alias("kind"), F.when(broken, F.col("_corrupt_record")).otherwise(F.col("content")).alias("content"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) of a text file without blank lines and those that begin with #."""
    return spark.read.text(path).select(F.trim("value").alias("line")).filter("line <> '' and not startswith(line, '#')")


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """The items of the RSS or Atom files of a path (see ``pages.feed_rows``); each file is a feed named by its path."""
    from quire.sources.pages import feed_rows

    @F.pandas_udf("string")
    def decoded(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: decode_bytes(bytes(b)))

    files = spark.read.format("binaryFile").load(path)
    return feed_rows(files.select(F.col("path").alias("feed_url"), F.col("path").alias("feed_name"), decoded("content").alias("xml")))


def select_payloads(spark: SparkSession, folder: str, extensions: tuple[str, ...], most: int) -> DataFrame:
    """(path, length) of the files of a folder and its subfolders that have one of the extensions, are not empty and not
    larger than ``most`` bytes; only the listing is read, no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", "length")
    suffix = F.regexp_extract(F.lower("path"), r"\.[a-z0-9]+$", 0)
    return files.filter(suffix.isin(*extensions) & (F.col("length") > 0) & (F.col("length") <= most))


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """(word) of a dictionary file: those of four letters a to z or more, each once."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).filter(F.col("word").rlike("^[a-z]{4,}$")).distinct()


def read_strict(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text) of files that must be UTF-8: reading any other file fails."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", F.call_function("validate_utf8", F.col("content").cast("string")).alias("text"))
