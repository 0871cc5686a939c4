"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Formats by the suffix of a link's path, longer suffixes before their endings (fixed values).
SUFFIXES = ((".html", "HTML"), (".htm", "HTML"), (".xml", "HTML"), (".text", "Text"), (".txt", "Text"), (".muse", "Muse"), (".md", "Text"), (".pdf", "PDF"), (".epub", "EPUB"), (".fb2", "FB2"), (".mobi", "MOBI"), (".azw3", "AZW3"), (".djvu", "DJVU"), (".gz", "Text"))
#: Suffixes of programs, which tell nothing of what they answer with (fixed values).
DYNAMIC = (".php", ".asp", ".aspx", ".cgi", ".do")
#: Suffixes of content types (fixed values).
OF_TYPE = (("text/html", ".html"), ("application/pdf", ".pdf"), ("application/epub+zip", ".epub"), ("text/plain", ".txt"), ("application/json", ".json"), ("text/xml", ".xml"), ("application/xml", ".xml"), ("image/png", ".png"), ("image/jpeg", ".jpg"), ("application/gzip", ".gz"), ("application/zip", ".zip"))
#: Formats that are their own suffix (fixed values).
NAMED = ("pdf", "epub", "mobi", "txt", "html", "htm", "xml", "json")
#: Marks of torrents of whole collections (fixed values).
BULK = ("/torrents/managed_by", "/torrents/external/", "pilimi-", "zlib2-", "libgen-", "libgen_rs_fic")


def part(url: Column, name: str) -> Column:
    """scheme, host, path or query; a malformed URL has none."""
    pattern = {"scheme": r"^([A-Za-z][A-Za-z0-9+.-]*):", "host": r"^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)", "path": r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", "query": r"^[^?#]*\?([^#]*)"}[name]
    value = F.regexp_extract(F.coalesce(url, F.lit("")), pattern, 1)
    return F.lower(value) if name in ("scheme", "host") else value


def link_format(url: Column) -> Column:
    path = F.lower(part(url, "path"))
    out = F
    for suffix, name in SUFFIXES:
        out = out.when(path.endswith(suffix), name)
    return out.otherwise(F.lit(None).cast("string"))


def feed_format(url: Column) -> Column:
    """The format of a feed's link; a page where the suffix says nothing."""
    path = F.lower(part(url, "path"))
    return F.when(path.endswith(".pdf"), "PDF").when(path.endswith(".epub"), "EPUB").when(path.endswith(".txt") | path.endswith(".text"), "Text").otherwise("HTML")


def extension(url: Column, content_type: Column, file_format: Column | None = None) -> Column:
    """A short suffix of the path that is no program's, else that of the content type, else of the format, else .bin."""
    suffix = F.regexp_extract(F.lower(part(url, "path")), r"\.([a-z0-9]{1,8})$", 0)
    kind = F.trim(F.substring_index(F.lower(F.coalesce(content_type, F.lit(""))), ";", 1))
    out = F.when((suffix != "") & ~suffix.isin(*DYNAMIC), suffix)
    for name, ending in OF_TYPE:
        out = out.when(kind == name, ending)
    if file_format is not None:
        for name in NAMED:
            out = out.when(F.contains(F.lower(F.coalesce(file_format, F.lit(""))), F.lit(name)), f".{name}")
    return out.otherwise(".bin")


def is_onion(url: Column) -> Column:
    return part(url, "host").endswith(".onion")


def is_torrent(url: Column, file_format: Column, source: Column | None = None) -> Column:
    out = F.contains(F.lower(F.coalesce(file_format, F.lit(""))), F.lit("torrent")) | F.lower(part(url, "path")).endswith(".torrent")
    return out if source is None else out | F.contains(F.lower(F.coalesce(source, F.lit(""))), F.lit("torrent"))


def is_bulk(url: Column) -> Column:
    low = F.lower(F.coalesce(url, F.lit("")))
    return F.exists(F.array(*[F.lit(m) for m in BULK]), lambda m: F.contains(low, m))


def url_class(url: Column, file_format: Column, source: Column) -> Column:
    """What a URL leads to: bulk, torrent, onion, file, web, or other."""
    torrent = is_torrent(url, file_format, source)
    return (
        F.when(torrent & is_bulk(url), "bulk").when(torrent, "torrent").when(is_onion(url), "onion").when((part(url, "scheme") == "file") & (part(url, "path") != ""), "file")
        .when(part(url, "scheme").isin("http", "https") & (part(url, "host") != ""), "web").otherwise("other")
    )


def without_fragment(url: Column) -> Column:
    return F.regexp_replace(url, "#.*$", "")


def parameter(url: Column, name: str) -> Column:
    """The first value of a query parameter, decoded; null without it."""
    value = F.regexp_extract(part(url, "query"), rf"(?:^|&){name}=([^&]*)", 1)
    return F.when(value != "", F.url_decode(value))


def detail_key(url: Column, entries: tuple[str, ...] = ("edition.php", "file.php")) -> Column:
    """What names the same page whatever the host: the hash after /md5/, the program and id of an entry, else path and query."""
    path = F.lower(part(url, "path"))
    md5 = F.trim(F.regexp_extract(path, "/md5/([^/]*)", 1))
    program = F.regexp_extract(path, "([^/]*)$", 1)
    query = part(url, "query")
    rest = F.concat(part(url, "path"), F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    ident = parameter(url, "id")
    return F.when(md5 != "", F.concat(F.lit("md5:"), md5)).when(program.isin(*entries) & ident.isNotNull(), F.concat(F.lit("entry:"), program, F.lit(":"), ident)).otherwise(rest)


def quoted(text: Column) -> Column:
    """Percent-encoding in which a blank is %20 and a slash stays."""
    return F.replace(F.replace(F.replace(F.replace(F.url_encode(text), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/")), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def search_url(template: str, query: Column) -> Column:
    """A template with {query} (encoded) and {raw_query} filled in."""
    return F.replace(F.replace(F.lit(template), F.lit("{query}"), quoted(query)), F.lit("{raw_query}"), query)


def export_url(url: Column, suffix: str, root: str = "/") -> Column:
    """The URL of another format of a page below ``root``: the last segment without its suffix, with ``suffix`` instead."""
    path = F.regexp_replace(part(url, "path"), "/+$", "")
    bare = F.regexp_replace(path, r"\.[^./]*$", "")
    return F.when(path.startswith(root) & (path != ""), F.concat(part(url, "scheme"), F.lit("://"), part(url, "host"), bare, F.lit(suffix)))


def title_of(url: Column) -> Column:
    """The last segment of a URL with blanks for dashes."""
    return F.replace(F.regexp_extract(F.regexp_replace(url, "/+$", ""), "([^/]*)$", 1), F.lit("-"), F.lit(" "))


def site_of(url: Column, fallback: Column) -> Column:
    host = part(url, "host")
    return F.when(host != "", host).otherwise(fallback)


def public(url: Column) -> Column:
    return part(url, "scheme").isin("http", "https") & (part(url, "host") != "")


def pretty_size(size: Column) -> Column:
    """Bytes as MB above 1 MiB, else as KB, with two places (halves to the even one); other text as it is, 'Unknown' without any."""
    n = size.try_cast("bigint")
    return F.when(size.isNull() | (size == ""), "Unknown").when(n.isNull(), size).when(n > 1048576, F.format_string("%.2f MB", F.bround(n / 1048576.0, 2))).otherwise(F.format_string("%.2f KB", F.bround(n / 1024.0, 2)))


def term_match(query: Column, *fields: Column, most: int | None = None) -> Column:
    """Whether any term of four letters or digits of the query stands in the fields; a query without terms matches all."""
    terms = F.regexp_extract_all(F.lower(F.coalesce(query, F.lit(""))), F.lit("[a-z0-9]{4,}"), 0)
    if most is not None:
        terms = F.slice(terms, 1, most)
    hay = F.lower(F.concat_ws(" ", *[F.coalesce(f, F.lit("")) for f in fields]))
    return (F.size(terms) == 0) | F.exists(terms, lambda t: F.contains(hay, t))


def mirror_rank(label: Column, path: Column) -> Column:
    """How good a mirror is, 0 the best: waiting lists last, then other ways than slow downloads, servers by their distance from the fifth."""
    low = F.lower(F.coalesce(label, F.lit("")))
    server = F.regexp_extract(low, r"partner server\s*#?\s*([0-9]+)", 1)
    return F.when(F.contains(low, F.lit("waitlist")), 100).when(~F.contains(path, F.lit("/slow_download/")), 50).when(server == "5", 0).when(server != "", 10 + F.abs(server.try_cast("int") - 5)).otherwise(20)


def decode_redirect(href: Column, name: str = "uddg") -> Column:
    """The address that a redirect carries as a parameter, else the link itself."""
    return F.coalesce(parameter(href, name), href)
