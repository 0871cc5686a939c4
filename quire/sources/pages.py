"""Pages, feeds and JSON answers of sources as rows. Markup is parsed in Arrow batches, one document at a time; what comes
after the parsing (formats, sites, sizes, ranks, duplicates) are Column expressions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions import urls as U
from quire.functions.text import collapse

VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
HIDDEN = ("script", "style", "noscript", "head")
FURNITURE = (*HIDDEN, "header", "footer", "nav")


def tidy(text: str | None) -> str:
    return " ".join((text or "").split())


class Page(HTMLParser):
    """One pass over a page: its metadata, its first headings, what stands in elements of a class or relation, and its links."""

    def __init__(self, markup: str):
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.marked: dict[str, str] = {}
        self.links: list[tuple[str, str]] = []
        self.labels: dict[str, str] = {}
        self.blocks: list[str] = []
        self.body: list[str] = []
        self._open: list[tuple[str, str, list[str], str | None]] = []  # (tag, name to keep the text under, text, href)
        self.feed(markup)
        self.close()
        while self._open:
            self._shut()

    def handle_starttag(self, tag: str, attrs) -> None:
        own = dict(attrs)
        if tag == "meta":
            name = (own.get("property") or own.get("name") or "").lower()
            if name and own.get("content"):
                self.meta.setdefault(name, tidy(own["content"]))
        if tag in VOID:
            return
        classes = (own.get("class") or "").split()
        name = next((f".{c}" for c in ("author", "authors") if c in classes), "") or ("rel" if own.get("rel") == "author" else tag if tag in ("title", "h1", "h2", "strong") else "")
        self._open.append((tag, name, [], own.get("href") if tag == "a" else None))

    def handle_data(self, data: str) -> None:
        for _, _, parts, _ in self._open:
            parts.append(data)
        if not any(t in FURNITURE for t, *_ in self._open):
            self.body.append(data)

    def handle_endtag(self, tag: str) -> None:
        if any(t == tag for t, *_ in self._open):
            while self._shut() != tag:
                pass
        if tag in ("p", "li", "div", "td"):
            self.body.append("\n")

    def _shut(self) -> str:
        tag, name, parts, href = self._open.pop()
        text = tidy("".join(parts))
        if name and text:
            self.marked.setdefault(name, text)
        if href:
            self.links.append((href, text))
        if tag in ("p", "li", "div", "td", "dd") and text:
            if ":" in text[:40]:
                label, _, value = text.partition(":")
                self.labels.setdefault(label.strip().lower(), value.strip())
            self.blocks.append(text)
        return tag

    @property
    def title(self) -> str:
        return self.meta.get("og:title") or self.meta.get("twitter:title") or self.marked.get("h1") or self.labels.get("title") or self.marked.get("title") or "Untitled work"

    @property
    def author(self) -> str | None:
        named = self.meta.get("author") or self.meta.get("article:author") or self.meta.get("book:author") or self.labels.get("author(s)")
        return named or next((self.marked[k][:240] for k in (".author", ".authors", "rel", "h2") if self.marked.get(k)), None)

    @property
    def text(self) -> str:
        return "\n".join(filter(None, map(tidy, "".join(self.body).split("\n"))))


def each(df: DataFrame, schema: str, rows: Callable[..., list[tuple]]) -> DataFrame:
    """``rows(*values)`` of each row of ``df``; a document that can't be read gives none."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out: list[tuple] = []
            for values in frame.itertuples(index=False):
                try:
                    out += rows(*values)
                except (ElementTree.ParseError, ValueError):
                    continue
            yield pd.DataFrame(out, columns=names)

    return df.mapInPandas(run, schema)


def page_metadata(pages: DataFrame) -> DataFrame:
    """(page_url, title, author, description) of pages (page_url, markup): of the metadata, else of headings and labelled
    values; the description is the first block of text, at most 240 characters."""

    def one(url: str, markup: str | None) -> list[tuple]:
        page = Page(markup or "")
        return [(url, page.title, page.author, page.meta.get("description") or next((b[:240] for b in page.blocks if len(b) > 40), None))]

    return each(pages.select("page_url", "markup"), "page_url string, title string, author string, description string", one)


def page_text(pages: DataFrame) -> DataFrame:
    """(page_url, text) without scripts, styles and page furniture."""
    return each(pages.select("page_url", "markup"), "page_url string, text string", lambda url, markup: [(url, Page(markup or "").text)])


def raw_links(pages: DataFrame) -> DataFrame:
    """(page_url, place, link, label): the absolute links of pages in their order."""

    def one(url: str, markup: str | None) -> list[tuple]:
        out = []
        for place, (href, label) in enumerate(Page(markup or "").links):
            try:
                out.append((url, place, urljoin(url or "", href.strip()), label))
            except ValueError:
                continue
        return out

    return each(pages.select("page_url", "markup"), "page_url string, place int, link string, label string", one)


def page_links(pages: DataFrame, html: bool = False) -> DataFrame:
    """(page_url, link, format, site, label): the links to files of a known format, each once without its fragment."""
    rows = raw_links(pages).withColumn("link", U.without_fragment(F.col("link"))).withColumn("format", U.link_format(F.col("link")))
    wanted = rows.filter(U.public(F.col("link")) & F.col("format").isNotNull() & (F.lit(html) | (F.col("format") != "HTML")))
    first = wanted.groupBy("page_url", "link").agg(F.min_by("label", "place").alias("label"), F.first("format").alias("format"))
    return first.select("page_url", "link", "format", U.part(F.col("link"), "host").alias("site"), "label")


def filter_mirrors(links: DataFrame, family: str, paths: str = "^/(slow_download|fast_download)/") -> DataFrame:
    """Of links (page_url, link, label), those of other hosts and, of the ``family`` of mirrors, the downloads without their
    query; where a page has slow downloads without a waiting list, only these stand for the family."""
    own = F.contains(U.part(F.col("link"), "host"), F.lit(family))
    rows = links.withColumn("own", own).filter(~F.col("own") | U.part(F.col("link"), "path").rlike(paths))
    rows = rows.withColumn("link", F.when(F.col("own"), F.regexp_replace("link", r"[?#].*$", "")).otherwise(F.col("link")))
    slow = F.contains("link", F.lit("/slow_download/")) & ~F.contains(F.lower(F.coalesce("label", F.lit(""))), F.lit("waitlist"))
    pages = rows.filter(slow).select("page_url").distinct().withColumn("any_slow", F.lit(True))
    joined = rows.withColumn("slow", slow).join(pages, "page_url", "left")
    return joined.filter(F.col("any_slow").isNull() | F.col("slow") | ~F.col("own")).select("page_url", "link", "label")


def format_size(text):
    """struct<format, size> of the text of a detail page: between dots, after labels, or the first format named."""
    dotted = r"(?i)(?:^|\s)·\s*([A-Za-z0-9]{2,8})\s*·\s*([0-9][0-9.,]*\s*(?:KB|MB|GB))\s*·"
    label = F.regexp_extract(text, r"(?i)\b(?:Ext\.|Extension):\s*([A-Za-z0-9]{2,8})", 1)
    sized = F.regexp_extract(text, r"(?i)\b(?:Size|Filesize):\s*([0-9][0-9.,]*\s*(?:B|KB|MB|GB)(?:\s*\([^)]+\))?)", 1)
    named = F.regexp_extract(text, r"(?i)\b(PDF|EPUB|MOBI|AZW3|DJVU|TXT|RTF)\b", 1)
    a, b = F.regexp_extract(text, dotted, 1), F.regexp_extract(text, dotted, 2)
    kind = F.when(a != "", a).when(label != "", label).when(named != "", named)
    size = F.when(b != "", F.replace(b, F.lit(" "), F.lit(""))).when(sized != "", F.trim(sized))
    return F.struct(F.coalesce(F.upper(kind), F.lit("Unknown")).alias("format"), F.coalesce(size, F.lit("Unknown")).alias("size"))


def plugin_results(pages: DataFrame, query: str, limit: int = 10) -> DataFrame:
    """(page_url, place, title, link, site): the first links of result pages whose title, URL or site hold a term of the
    query, each URL once."""
    rows = raw_links(pages).withColumn("site", U.part(F.col("link"), "host")).withColumn("title", F.coalesce(F.nullif(F.substring("label", 1, 240), F.lit("")), F.col("link")))
    hits = rows.filter(U.public(F.col("link")) & U.term_match(F.lit(query), F.col("title"), F.col("link"), F.col("site")))
    once = hits.groupBy("page_url", "link").agg(F.min("place").alias("at"), F.min_by("title", "place").alias("title"), F.first("site").alias("site"))
    ranked = once.withColumn("place", F.row_number().over(Window.partitionBy("page_url").orderBy("at")))
    return ranked.filter(F.col("place") <= limit).select("page_url", "place", "title", "link", "site")


# --- feeds


def _name(element) -> str:
    return element.tag.rpartition("}")[2].lower() if isinstance(element.tag, str) else ""


def _all(element, name: str) -> list:
    return [e for e in element if _name(e) == name]


def _value(element, name: str) -> str:
    return next((tidy(e.text) for e in _all(element, name)), "")


def rss_item(item) -> tuple[str, str, str, str]:
    """(title, link, author, id) of an item: the enclosure, else the link, else a permanent id is the link."""
    guid = next(iter(_all(item, "guid")), None)
    enclosure = next((e.get("url", "").strip() for e in _all(item, "enclosure")), "")
    lasting = tidy(guid.text) if guid is not None and guid.get("isPermaLink") == "true" else ""
    return _value(item, "title"), enclosure or _value(item, "link") or lasting, _value(item, "creator") or _value(item, "author"), _value(item, "guid")


def atom_entry(entry) -> tuple[str, str, str, str]:
    links = [((e.get("rel") or "alternate").lower(), (e.get("href") or "").strip()) for e in _all(entry, "link")]
    link = next((h for rel, h in links if h and rel == "alternate"), "") or next((h for _, h in links if h), "")
    return _value(entry, "title"), link, next((_value(e, "name") for e in _all(entry, "author")), ""), _value(entry, "id")


FEED = "feed_url string, feed_name string, place int, title string, link string, author string, item string"


def feed_rows(feeds: DataFrame) -> DataFrame:
    """(id, feed_url, place, title, author, link, site, format) of the items of feeds (feed_url, feed_name, xml), RSS or Atom by
    their root; items without title or link are left out, the feed's name stands for a missing author. A broken feed has none."""

    def one(url: str, name: str, xml: str | None) -> list[tuple]:
        root = ElementTree.fromstring(xml or "")
        if _name(root) == "feed":
            items = map(atom_entry, _all(root, "entry"))
        else:
            items = map(rss_item, _all(next(iter(_all(root, "channel")), root), "item"))
        return [(url, name, place, *item) for place, item in enumerate(items) if item[0] and item[1]]

    rows = each(feeds.select("feed_url", "feed_name", "xml"), FEED, one)
    ident = F.concat("feed_url", F.lit("#"), F.coalesce(F.nullif("item", F.lit("")), F.col("link")))
    return rows.select(ident.alias("id"), "feed_url", "place", "title", F.coalesce(F.nullif("author", F.lit("")), F.col("feed_name")).alias("author"), "link", U.site_of(F.col("link"), F.col("feed_name")).alias("site"), U.feed_format(F.col("link")).alias("format"))


def preprint_rows(feeds: DataFrame) -> DataFrame:
    """(title, author, summary, detail_url, link) of the entries of preprint feeds (xml) that have a title and a PDF: a link
    that says so, else the page's address with /pdf/ for /abs/; all authors named."""

    def one(xml: str | None) -> list[tuple]:
        out = []
        for entry in _all(ElementTree.fromstring(xml or ""), "entry"):
            ident, links = _value(entry, "id"), [e.attrib for e in _all(entry, "link") if e.get("href")]
            pdf = [a["href"] for a in links if a.get("title") == "pdf" or a.get("type") == "application/pdf"]
            pages = [a["href"] for a in links if a.get("rel") == "alternate" and a["href"] not in pdf]
            link = pdf[-1] if pdf else ident.replace("/abs/", "/pdf/") if "/abs/" in ident else ""
            if _value(entry, "title") and link:
                names = list(filter(None, (_value(a, "name") for a in _all(entry, "author"))))
                out.append((_value(entry, "title"), ", ".join(names) or "Unknown", _value(entry, "summary"), pages[-1] if pages else ident, link))
        return out

    return each(feeds.select("xml"), "title string, author string, summary string, detail_url string, link string", one)


def publication_rows(feeds: DataFrame, most: int = 10) -> DataFrame:
    """The first items of a publication's RSS feed (feed_url, feed_name, xml), under the site of the publication."""
    rows = feed_rows(feeds).withColumn("rank", F.row_number().over(Window.partitionBy("feed_url").orderBy("place")))
    return rows.filter(F.col("rank") <= most).select("feed_url", "title", "author", "link", U.part(F.col("feed_url"), "host").alias("site"))


def feed_summary(items: DataFrame, seen: DataFrame, limit: int = 25, dry_run: bool = False) -> DataFrame:
    """(feed_url, items, seen, archived, skipped) of a run over feed items (feed_url, id, place): the first ``limit`` of each feed,
    those in ``seen`` (feed_url, id) counted apart."""
    first = items.withColumn("_n", F.row_number().over(Window.partitionBy("feed_url").orderBy("place", "id"))).filter(F.col("_n") <= limit)
    joined = first.join(seen.select("feed_url", "id").distinct().withColumn("old", F.lit(True)), ["feed_url", "id"], "left")
    new = F.count_if(F.col("old").isNull())
    none = F.lit(0).cast("long")
    return joined.groupBy("feed_url").agg(F.count(F.lit(1)).alias("items"), F.count_if(F.col("old").isNotNull()).alias("seen"), (none if dry_run else new).alias("archived"), (new if dry_run else none).alias("skipped"))


POSTS = "focused array<struct<post:{p}>>, results array<{p}>, resultsWithTrackingParams array<struct<post:{p}>>".replace("{p}", "struct<canonical_url:string,url:string,web_url:string,slug:string,title:string,subtitle:string,publication:struct<subdomain:string>,publishedBylines:array<struct<name:string>>>")


def post_rows(answers: DataFrame, domain: str) -> DataFrame:
    """(answer, title, author, link): the posts of search answers (answer, payload JSON) in three lists, each URL once; a URL
    made of subdomain and slug where none is given; only those of the domain."""
    parsed = answers.select("answer", F.from_json("payload", POSTS).alias("j"))
    inner = lambda c: F.transform(F.coalesce(F.col(f"j.{c}"), F.array()), lambda x: x["post"])
    posts = F.concat(inner("focused"), F.coalesce(F.col("j.results"), F.array()), inner("resultsWithTrackingParams"))
    rows = parsed.select("answer", F.posexplode(posts).alias("place", "p"))
    made = F.concat(F.lit("https://"), F.col("p.publication.subdomain"), F.lit(f".{domain}/p/"), F.col("p.slug"))
    link = F.coalesce(*[F.nullif(f"p.{c}", F.lit("")) for c in ("canonical_url", "url", "web_url")], made)
    title = F.coalesce(F.nullif("p.title", F.lit("")), F.nullif("p.subtitle", F.lit("")))
    rows = rows.select("answer", "place", link.alias("link"), title.alias("title"), F.get("p.publishedBylines", F.lit(0))["name"].alias("author"))
    good = rows.filter(U.public(F.col("link")) & F.contains(U.part(F.col("link"), "host"), F.lit(domain)))
    first = good.groupBy("answer", "link").agg(F.min_by(F.struct("title", "author"), "place").alias("r"))
    return first.select("answer", F.coalesce(collapse(F.col("r.title")), U.title_of(F.col("link"))).alias("title"), "r.author", "link")


def item_files(items: DataFrame, base: str) -> DataFrame:
    """(identifier, name, format, size, link) of the files of items (identifier, metadata JSON) in a format that is read."""
    parsed = items.select("identifier", F.explode(F.from_json("metadata", "files array<struct<name:string,format:string,size:string>>")["files"]).alias("f"))
    wanted = F.lower("f.format").rlike("pdf|epub|mobi|kindle|text|daisy|torrent")
    return parsed.filter(wanted & (F.col("f.name") != "")).select("identifier", "f.name", "f.format", U.pretty_size(F.col("f.size")).alias("size"), F.concat(F.lit(f"{base}/download/"), "identifier", F.lit("/"), "f.name").alias("link"))
