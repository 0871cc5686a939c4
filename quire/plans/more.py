"""More registered queries of the catalogue: queues and plans, transitions, pages and feeds, full text, builds, notes and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.catalog import Catalog
from quire.functions import text as T
from quire.functions import urls as U
from quire.operators import analytics, corpus, notes, queues, search, state, titles
from quire.plans.queries import ACCENTS, BEST, CORPUS, CTE, EFF, HOST, PAIRS, PATH, RANK, RUNS, SCHEME, SELECTED, SIZE, SUBSTITUTED, TEXTS, TOKENS, TORRENT, TRIM, USABLE, Entry, _bm25_sql, _docs, _texts
from quire.predicates import effective_url, or_else
from quire.sources import pages
from quire.sources.readers import mode_of
from quire.streaming import feeds, live


def listed(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


SPACE = "regexp_replace({}, '[ \\t\\r\\n\\f]+', ' ', 'g')"
#: Blanks of all kinds, which the parsers of pages and feeds take for one.
ANY_SPACE = "regexp_replace({}, '[\\s\\x0b\\x{{1c}}-\\x{{1f}}\\x{{85}}\\x{{a0}}\\x{{1680}}\\x{{2000}}-\\x{{200a}}\\x{{2028}}\\x{{2029}}\\x{{202f}}\\x{{205f}}\\x{{3000}}]+', ' ', 'g')"
PICKED = f"SELECT work_id, file_id, site, format FROM (SELECT *, {BEST} FROM {{}} WHERE {RUNS}) WHERE rn = 1"
LOW = "coalesce(nullif(trim(regexp_replace(lower(coalesce({0}, '')), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'uncategorized')"
VALID = f"""(low IN ({listed(T.STATIC)}) OR (length(low) BETWEEN 4 AND 48 AND regexp_matches(low, '^[a-z]+(_[a-z]+){{0,2}}$') AND len(list_filter(string_split(low, '_'), lambda p: length(p) < 4 OR p IN ({listed(T.NOT_WORDS)}))) = 0
  AND len(list_filter(string_split(low, '_'), lambda p: regexp_matches(p, '[aeiouy]'))) > 0))"""
WORDS = f"list_filter(list_transform(regexp_extract_all(lower(coalesce({{}}, '')), '[a-z][a-z0-9_''-]{{{{3,}}}}'), lambda w: regexp_replace(w, '[^a-z]', '', 'g')), lambda w: length(w) BETWEEN 4 AND 48 AND w NOT IN ({listed((*T.COMMON, *T.NOT_WORDS))}) AND regexp_matches(w, '[aeiouy]'))"
ABOUT = TEXTS.replace("SELECT d.doc_id, w.title", "SELECT d.doc_id, w.search_query, w.title") + ", about AS (SELECT d.doc_id, t.title, t.author, t.site, t.search_query, d.text FROM documents d LEFT JOIN texts t ON t.doc_id = d.doc_id)"


def _about(c: Catalog) -> DataFrame:
    """(doc_id, title, author, site, search_query, text): documents with the work and site of their newest extraction."""
    rows = c.chain.filter(F.col("text_uri").isNotNull()).select("text_uri", "extraction_id", "work_id", "site")
    newest = rows.groupBy("text_uri").agg(F.max_by(F.struct("work_id", "site"), F.struct("extraction_id", "work_id")).alias("r")).select("text_uri", "r.*")
    works = c.works.select(F.col("id").alias("work_id"), "title", "author", "search_query")
    docs = c.documents.select("doc_id", "text", "text_uri")
    known = docs.filter("text is not null").select("doc_id", "text_uri").join(newest, "text_uri").join(works, "work_id", "left").select("doc_id", "title", "author", "site", "search_query")
    return docs.select("doc_id", "text").join(known, "doc_id", "left")


def _categorized(c: Catalog) -> DataFrame:
    about = _about(c)
    static = T.keyword_category(about, c.read("categories")).select("doc_id", "category")
    made = T.word_category(about).select("doc_id", "name")
    return static.join(made, "doc_id").select("doc_id", F.coalesce("category", "name").alias("category"))


KEYWORDS = """k AS (SELECT coalesce(dynamic, 0) dynamic, name, CASE WHEN len(from_json(keywords_json, '["VARCHAR"]')) > 0 THEN from_json(keywords_json, '["VARCHAR"]') ELSE [replace(name, '_', ' ')] END ks FROM categories), o AS (SELECT dynamic, name, unnest(ks) kw FROM k),
  hay AS (SELECT doc_id, lower(concat_ws(' ', coalesce(title, ''), coalesce(author, ''), coalesce(site, ''), coalesce(text, ''))) h FROM about), hit AS (SELECT doc_id, name, row_number() OVER (PARTITION BY doc_id ORDER BY dynamic, name) rn FROM hay JOIN o ON contains(h, kw)),
  static AS (SELECT doc_id, name FROM hit WHERE rn = 1)"""
NAMED = f"""tw AS (SELECT doc_id, unnest({WORDS.format("concat_ws(' ', title, search_query)")}) w, 1 t, 0 n FROM about UNION ALL SELECT doc_id, unnest({WORDS.format('text')}), 0, 1 FROM about), cw AS (SELECT doc_id, w, sum(t) t, sum(n) n FROM tw GROUP BY 1, 2),
  has AS (SELECT doc_id, max(t) > 0 titled FROM cw GROUP BY 1), rk AS (SELECT cw.doc_id, w, row_number() OVER (PARTITION BY cw.doc_id ORDER BY CASE WHEN titled THEN 3 * t + n ELSE n END DESC, w) rn FROM cw JOIN has USING (doc_id) WHERE CASE WHEN titled THEN t > 0 ELSE n >= 3 END),
  kw AS (SELECT doc_id, string_agg(w, ',' ORDER BY v DESC, w) ws FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY v DESC, w) rn FROM (SELECT *, CASE WHEN t > 0 THEN n + t + 2 ELSE n END v FROM cw)) WHERE rn <= 8 GROUP BY 1),
  made AS (SELECT d.doc_id, coalesce(r.w, 'uncategorized') AS name, CASE WHEN r.w IS NULL THEN '' ELSE kw.ws END AS keywords FROM documents d LEFT JOIN (SELECT * FROM rk WHERE rn = 1) r ON r.doc_id = d.doc_id LEFT JOIN kw ON kw.doc_id = d.doc_id)"""
#: Failed downloads as the plans see them.
FAILED = CTE + ", fr AS (SELECT file_id, attempts, coalesce(error, '') AS error, lower(coalesce(error, '')) low FROM act)"
PLAN = f"""CASE WHEN len(list_filter([{listed(queues.TERMINAL)}], lambda m: contains(low, m))) > 0 THEN 'disable' WHEN coalesce(attempts, 0) <= 2 OR len(list_filter([{listed(queues.RETRYABLE)}], lambda m: contains(low, m))) > 0 THEN 'retry' ELSE 'defer' END"""


def _plan(c: Catalog) -> DataFrame:
    """A plan for the failed downloads, with some rows that can't be carried out: every fifth file is replaced, of which every
    tenth has no public URL, and files that never failed are named."""
    rows = queues.fallback_plan(queues.active_failures(c))
    own = rows.select("file_id", F.when(F.col("file_id") % 5 == 0, "replace_url").otherwise(F.col("action")).alias("action"), F.when(F.col("file_id") % 10 == 0, "ftp://x/y").otherwise("https://new.example.org/f").alias("download_url"), "reason")
    strange = c.files.filter("id % 50 = 7").select((F.col("id") + 10_000_000).alias("file_id"), F.lit("Retry").alias("action"), F.lit(None).cast("string").alias("download_url"), F.lit("").alias("reason"))
    return own.unionByName(strange)


def _pages(c: Catalog) -> DataFrame:
    """A page for each work: its title and author, and a link to each of its files, under navigation and a script."""
    esc = lambda x: F.replace(F.replace(F.replace(F.coalesce(x, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    link = F.concat(F.lit('<a href="'), esc(F.replace(effective_url(), F.lit(" "), F.lit("%20"))), F.lit('#top"><b>'), esc(or_else("format", "")), F.lit("</b> file</a>"))
    files = c.files.filter("url is not null").groupBy("work_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", link.alias("l")))), lambda x: x["l"]), "\n").alias("links"))
    works = c.works.filter("title is not null").join(files, F.col("id") == F.col("work_id"))
    head = F.concat(F.lit('<html><head><title>Site</title><meta name="author" content="'), esc(F.col("author")), F.lit('"><script>var x = "<p>";</script></head><body><nav>Home Search</nav><h1>'), esc(F.col("title")), F.lit("</h1>\n<p>"), esc(F.col("search_query")), F.lit("</p>"))
    return works.select(F.concat(F.lit("https://pages.example.org/"), F.col("id").cast("string")).alias("page_url"), F.concat(head, "links", F.lit("</body></html>")).alias("markup"))


def _feeds(c: Catalog, kind: str) -> DataFrame:
    """A feed for each site with its files as items."""
    esc = lambda x: F.replace(F.replace(F.coalesce(x, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    rows = c.files.withColumnRenamed("id", "file_id").join(c.works.select(F.col("id").alias("work_id"), "title", "author"), "work_id")
    rss = F.concat(F.lit("<item><title>"), esc(F.col("title")), F.lit("</title><link>"), esc(F.col("url")), F.lit('</link><guid isPermaLink="false">f'), F.col("file_id").cast("string"), F.lit("</guid><dc:creator>"), esc(F.col("author")), F.lit("</dc:creator></item>"))
    atom = F.concat(F.lit('<entry><title>'), esc(F.col("title")), F.lit('</title><id>f'), F.col("file_id").cast("string"), F.lit('</id><link rel="self" href="x"/><link href="'), F.replace(esc(F.col("url")), F.lit('"'), F.lit("&quot;")), F.lit('"/><author><name>'), esc(F.col("author")), F.lit("</name></author></entry>"))
    item, head, tail = {"rss": (rss, '<rss xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>', "</channel></rss>"), "atom": (atom, '<feed xmlns="http://www.w3.org/2005/Atom">', "</feed>")}[kind]
    each = rows.groupBy("site").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("file_id", item.alias("x")))), lambda r: r["x"]), "").alias("items"))
    return each.select(F.concat(F.lit("https://"), "site", F.lit("/feed")).alias("feed_url"), F.col("site").alias("feed_name"), F.concat(F.lit(head), "items", F.lit(tail)).alias("xml"))


def _preprints(c: Catalog) -> DataFrame:
    esc = lambda x: F.replace(F.replace(F.coalesce(x, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    entry = F.concat(F.lit('<entry><id>http://p.example.org/abs/'), F.col("id").cast("string"), F.lit("</id><title>"), esc(F.col("title")), F.lit("</title><summary>s  "), esc(F.col("search_query")), F.lit("</summary><author><name>"), esc(F.col("author")), F.lit("</name></author><author><name>B. Second</name></author>"),
                     F.when(F.col("id") % 2 == 0, F.lit('<link title="pdf" href="http://p.example.org/x.pdf"/>')).otherwise(""), F.lit("</entry>"))
    return c.works.select(F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), entry, F.lit("</feed>")).alias("xml"))


FEEDROWS = f"""WITH r AS (SELECT f.id, f.site, trim({ANY_SPACE.format("coalesce(w.title, '')")}, ' ') t, trim({ANY_SPACE.format("coalesce(w.author, '')")}, ' ') a, trim(coalesce(f.url, ''), ' ') u FROM files f JOIN works w ON w.id = f.work_id WHERE f.site IS NOT NULL)"""
FEEDSQL = FEEDROWS + """ SELECT 'https://' || site || '/feed#f' || id::VARCHAR AS id, t AS title, CASE WHEN a = '' THEN site ELSE a END AS author, u AS link, coalesce(nullif(lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)), ''), site) AS site,
  CASE WHEN ends_with(p, '.pdf') THEN 'PDF' WHEN ends_with(p, '.epub') THEN 'EPUB' WHEN ends_with(p, '.txt') OR ends_with(p, '.text') THEN 'Text' ELSE 'HTML' END AS format FROM (SELECT *, lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) p FROM r WHERE t <> '' AND u <> '')"""


def _notes(c: Catalog) -> DataFrame:
    """Events as a log of notes; sign-ups stand for summaries."""
    return c.read("events").select(F.col("event_id").alias("n"), F.when(F.col("event_type") == "signup", "summary").otherwise(F.col("event_type")).alias("kind"), F.concat_ws(" ", "event_type", "props").alias("content"), F.col("props").alias("metadata"))


NOTES = "WITH notes AS (SELECT event_id n, CASE WHEN event_type = 'signup' THEN 'summary' ELSE event_type END kind, concat_ws(' ', event_type, props) AS content, props metadata FROM events)"


def _workers(c: Catalog) -> DataFrame:
    """The last event of each user as the state of a worker."""
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "click", "running").when(F.col("event_type") == "view", "idle").when(F.col("event_type") == "signup", "complete").otherwise("waiting")
    return state.latest_by(c.read("events").select("user_id", "event_id", status.alias("status")), "user_id", "event_id").select(F.col("user_id").alias("id"), "status")


WORKERS = "workers AS (SELECT user_id id, CASE arg_max(event_type, event_id) WHEN 'error' THEN 'failed' WHEN 'click' THEN 'running' WHEN 'view' THEN 'idle' WHEN 'signup' THEN 'complete' ELSE 'waiting' END status FROM events GROUP BY 1)"


def _goals(c: Catalog) -> DataFrame:
    """A goal for each user, active where the last event was a view or a click, with an event of its own."""
    none = F.array(F.struct(F.lit("2024-01-01T00:00:00Z").alias("ts"), F.lit("created").alias("kind"), F.lit("").alias("content")))
    last = state.latest_by(c.read("events").select("user_id", "event_id", "event_type"), "user_id", "event_id")
    return last.select(F.col("user_id").alias("id"), F.when(F.col("event_type") == "view", "active").when(F.col("event_type") == "click", "running").otherwise("done").alias("status"), none.alias("events"))


def _health(c: Catalog) -> DataFrame:
    """One row of the counts that the health of a pipeline is told from."""
    backlog = queues.backlog_counts(c).groupBy().pivot("queue", ["pending_downloads", "pending_extractions", "pending_raw_archives"]).agg(F.first("n"))
    workers = state.worker_counts(_workers(c)).select(F.col("failed").alias("worker_failed"), F.col("running").alias("worker_running"))
    loads = c.downloads.agg(F.count_if(F.coalesce(F.col("scan_status") == "infected", F.lit(False))).alias("infected"))
    texts = c.extractions.agg(F.count_if(F.col("status") == "failed").alias("extraction_failed"))
    one = backlog.withColumnRenamed("pending_raw_archives", "pending_raw")
    for row in (workers, loads, texts):
        one = one.crossJoin(F.broadcast(row))  # one row on either side
    return state.health(one.withColumn("raw_failed", F.lit(0)).withColumn("stale", F.lit(True)))


def _munges(c: Catalog) -> DataFrame:
    """Extractions of every third id as munges that were made, of which every ninth failed."""
    e = c.extractions.filter("id % 3 = 0")
    return e.select(F.col("id").alias("extraction_id"), F.lit("v1").alias("munger_version"), F.when(F.col("id") % 9 == 0, "failed").otherwise("processed").alias("status"), F.col("text_sha256").alias("sha256"), F.col("char_count").alias("chars"), F.when(F.col("id") % 9 == 0, "gave up").alias("error"))


MUNGES = "munges AS (SELECT id extraction_id, 'v1' munger_version, CASE WHEN id % 9 = 0 THEN 'failed' ELSE 'processed' END status, text_sha256 sha256, char_count chars, CASE WHEN id % 9 = 0 THEN 'gave up' END error FROM extractions WHERE id % 3 = 0)"


def _extraction_events(c: Catalog) -> DataFrame:
    e = c.extractions.select("id", "download_id", "extractor", "status", "text_uri", "char_count", F.coalesce("warnings", F.lit("")).alias("warnings"))
    started = e.select("download_id", "extractor", (F.col("id") * 2).alias("seq"), F.lit("started").alias("kind"), F.lit(None).cast("string").alias("text_uri"), F.lit(None).cast("long").alias("char_count"), F.lit(None).cast("string").alias("message"))
    ended = e.filter("status in ('processed', 'skipped', 'failed')").select("download_id", "extractor", (F.col("id") * 2 + 1).alias("seq"), F.col("status").alias("kind"), "text_uri", "char_count", F.col("warnings").alias("message"))
    return started.unionByName(ended)


def _archiving(c: Catalog) -> DataFrame:
    d = c.downloads
    kind = F.when(F.col("id") % 3 == 0, "archived").when(F.col("id") % 3 == 1, "failed").otherwise("missing")
    return d.filter("status = 'downloaded'").select("id", F.lit(1).alias("seq"), kind.alias("kind"), F.concat(F.lit("raw/"), F.col("id").cast("string")).alias("uri"), F.lit("no space").alias("message"), (F.col("id") % 2 == 0).alias("delete_local"))


def _answers(c: Catalog) -> DataFrame:
    """Events' properties as what a model answered: bare, fenced, or after other words."""
    e = F.col("event_id") % 3
    return c.read("events").select("event_id", F.when(e == 0, F.col("props")).when(e == 1, F.concat(F.lit("Here:\n```json\n"), "props", F.lit("\n```\nDone."))).otherwise(F.concat(F.lit("I suggest "), "props")).alias("answer"))


def _posts(c: Catalog) -> DataFrame:
    """Files of three ids as a search answer: a focused post, a result without URL and a repeated one."""
    site = F.lit("posts.example.org")
    post = lambda url, slug: F.struct(url.alias("canonical_url"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("web_url"), slug.alias("slug"), F.col("title").alias("title"), F.lit(None).cast("string").alias("subtitle"), F.struct(F.lit("letters").alias("subdomain")).alias("publication"), F.array(F.struct(F.col("author").alias("name"))).alias("publishedBylines"))
    ident = F.col("id").cast("string")
    url = F.concat(F.lit("https://a."), site, F.lit("/p/"), ident)
    none = F.lit(None).cast("string")
    payload = F.to_json(F.struct(F.array(F.struct(post(url, none).alias("post"))).alias("focused"), F.array(post(none, F.concat(F.lit("s-"), ident)), post(url, none)).alias("results"), F.array(F.struct(post(F.lit("https://other.example.com/x"), none).alias("post"))).alias("resultsWithTrackingParams")))
    return c.works.select(F.col("id").alias("answer"), payload.alias("payload"))


RULES = T.checked_rules([{"type": "literal", "from": "the ", "to": "THE ", "max_replacements": 3}, {"type": "regex", "from": "[0-9]+", "to": "#"}, {"type": "regex", "from": "(", "to": ""}, {"type": "literal", "from": ""}])
FAMILY = "mirror-b.example.com"
QUERIES = {"history": ["history of towns", "old annals", "chronicles"], "law": ["court records", "statutes"], "music": ["part songs"]}
LISTS = [["public domain letters", "Old  Annals", "travel accounts"], ["essays"]]
KEYSQL = "trim(regexp_replace(lower(coalesce({}, '')), '[^a-z0-9]+', ' ', 'g'), ' ')"
#: What plain titles are written in.
LETTERS = " abcdefghijklmnopqrstuvwxyz0123456789"
#: (t, u): the plain titles of w that match in 0.9 of their characters as difflib.SequenceMatcher counts them, in either order: of
#: two pieces the longest run of both, the first of them in t and then in u, and so on with the pieces before and after it; the
#: letters that are frequent in a u of 200 characters and more only lengthen runs.
RATIOSQL = f"""v AS (SELECT t, length(t) n, list_transform(string_split('{LETTERS}', ''), lambda c: length(t) - length(replace(t, c, ''))) hs FROM (SELECT DISTINCT t FROM w)),
  c AS (SELECT x.t t, y.t u, x.n + y.n size FROM v x JOIN v y ON x.t < y.t AND 20 * least(x.n, y.n) >= 9 * (x.n + y.n) AND 20 * list_sum(list_transform(list_zip(x.hs, y.hs), lambda z: least(z[1], z[2]))) >= 9 * (x.n + y.n)),
  o AS (SELECT t, u, size, CASE WHEN length(u) < 200 THEN '' ELSE list_aggregate(list_filter(string_split('{LETTERS}', ''), lambda e: length(u) - length(replace(u, e, '')) > length(u) // 100 + 1), 'string_agg', '') END often FROM (SELECT * FROM c UNION ALL SELECT u, t, size FROM c)),
  m AS (SELECT t, u, size, 0 met, t x, u y, translate(t, often, repeat('<', length(often))) f, translate(u, often, repeat('>', length(often))) g FROM o UNION ALL
    SELECT t, u, size, s.met, s.x, s.y, s.f, s.g FROM (SELECT t, u, size, unnest([{{'met': k, 'x': '', 'y': '', 'f': '', 'g': ''}}, {{'met': 0, 'x': substr(x, 1, i), 'y': substr(y, 1, j), 'f': substr(f, 1, i), 'g': substr(g, 1, j)}}, {{'met': 0, 'x': substr(x, i + k + 1), 'y': substr(y, j + k + 1), 'f': substr(f, i + k + 1), 'g': substr(g, j + k + 1)}}]) s
      FROM (SELECT * REPLACE (i - before AS i, j - before AS j, before + k + len(list_filter(range(1, least(length(x) - i, length(y) - j) - k + 1), lambda l: substr(x, i + k + 1, l) = substr(y, j + k + 1, l))) AS k) FROM (SELECT *, len(list_filter(range(1, least(i, j) + 1), lambda l: substr(x, i - l + 1, l) = substr(y, j - l + 1, l))) before
        FROM (SELECT *, CASE WHEN k = 0 THEN 0 ELSE strpos(g, substr(f, i + 1, k)) - 1 END j FROM (SELECT *, CASE WHEN k = 0 THEN 0 ELSE list_position(ks, k) - 1 END i FROM (SELECT *, list_max(ks) k
        FROM (SELECT *, list_transform(range(1, length(f) + 1), lambda p: len(list_filter(range(1, length(f) - p + 2), lambda l: contains(g, substr(f, p, l))))) ks FROM m WHERE x <> '' AND y <> '')))))) WHERE k > 0) WHERE s.met > 0 OR (s.x <> '' AND s.y <> '')),
  r AS (SELECT DISTINCT least(t, u) t, greatest(t, u) u FROM (SELECT t, u, size, sum(met) met FROM m GROUP BY 1, 2, 3) WHERE 2 * met::DOUBLE / size >= {titles.RATIO}::DOUBLE)"""
TITLESQL = f"""WITH RECURSIVE t AS (SELECT id, {KEYSQL.format('title')} t, {KEYSQL.format('author')} p FROM works), w AS (SELECT *, list_distinct(list_filter(string_split(t, ' '), lambda x: length(x) > 2 AND x NOT IN ({listed(titles.TITLE_STOP)}))) ws FROM t WHERE t <> ''),
  j AS (SELECT x.id a, y.id b, x.t t, y.t u, x.p p, y.p q, len(list_intersect(x.ws, y.ws)) both_n, least(len(x.ws), len(y.ws)) least_n FROM w x JOIN w y ON x.id < y.id),
  {RATIOSQL}
  SELECT a, b FROM j LEFT JOIN r ON r.t = least(j.t, j.u) AND r.u = greatest(j.t, j.u) WHERE j.t = j.u OR r.t IS NOT NULL OR (length(j.t) >= 12 AND length(j.u) >= 12 AND (contains(j.t, j.u) OR contains(j.u, j.t))) OR (least_n > 0 AND ((p <> '' AND q <> '' AND (contains(p, q) OR contains(q, p)) AND both_n >= 2 AND both_n >= 0.85 * least_n) OR (both_n >= 3 AND both_n >= least_n)))"""


def _scalars(c: Catalog, **columns: Column) -> DataFrame:
    return c.read("events").select("event_id", *[v.alias(k) for k, v in columns.items()])


def _phase() -> Column:
    k = F.col("event_id") % 5
    return F.when(k == 0, "start").when(k == 1, "complete").when(k == 2, "idle").when(k == 3, "error").otherwise("update")


def _message() -> Column:
    k = F.col("event_id") % 4
    return F.when(k == 0, F.concat(F.lit("Batch b-1 complete:  "), "event_type")).when(k == 1, F.concat(F.lit("batch x_2 FAILED: "), "event_type")).when(k == 2, F.concat(F.lit("Tool t started: "), "event_type")).otherwise(F.col("event_type"))


MESSAGE = "CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'failed ' || event_type WHEN 2 THEN 'Tool t started: ' || event_type ELSE event_type END"
PHASE = "CASE event_id % 5 WHEN 0 THEN 'start' WHEN 1 THEN 'complete' WHEN 2 THEN 'idle' WHEN 3 THEN 'error' ELSE 'update' END"
LABEL = f"CASE WHEN contains(lower({MESSAGE}), 'failed') OR {PHASE} = 'error' THEN 'fail' WHEN {PHASE} = 'start' THEN 'run' WHEN {PHASE} = 'idle' THEN 'wait' WHEN {PHASE} = 'complete' THEN 'done' ELSE 'note' END"
BODY = "text"

ENTRIES: dict[str, Entry] = {
    # --- counts
    "stats": (analytics.stats, CTE + """SELECT 'works' AS metric, '' AS key, count(*) AS value FROM works UNION ALL SELECT 'files', '', count(*) FROM files UNION ALL SELECT 'corpus_specs', '', count(*) FROM corpus_specs
      UNION ALL SELECT 'files_by_site', coalesce(site, ''), count(*) FROM files GROUP BY 2 UNION ALL SELECT 'downloads', coalesce(status, ''), count(*) FROM dl GROUP BY 2 UNION ALL SELECT 'raw_archives', 'local', count(*) FROM dl GROUP BY 2
      UNION ALL SELECT 'extractions', coalesce(status, ''), count(*) FROM extractions GROUP BY 2 UNION ALL SELECT 'scans', coalesce(scan_status, 'unscanned'), count(*) FROM dl GROUP BY 2"""),
    "status_hist": (analytics.status_hist, CTE + """SELECT 'download' AS kind, status, count(*) AS n FROM dl GROUP BY 2 UNION ALL SELECT 'scan', coalesce(scan_status, 'unscanned'), count(*) FROM dl GROUP BY 2 UNION ALL SELECT 'raw', 'local', count(*) FROM dl GROUP BY 2
      UNION ALL SELECT 'extraction', status, count(*) FROM extractions GROUP BY 2 UNION ALL SELECT 'quality', coalesce(quality_status, 'unvalidated'), count(*) FROM extractions GROUP BY 2"""),
    "dimensions": (analytics.dimensions, CTE + f""", cc AS (SELECT c.name, {LOW.format('c.name')} low, count(e.id) n FROM categories c LEFT JOIN extractions e ON e.category = c.name GROUP BY 1) SELECT 'site' AS dimension, site AS value, count(*) AS n FROM files GROUP BY 2 UNION ALL SELECT 'format', format, count(*) FROM files GROUP BY 2
      UNION ALL SELECT 'trust', trust_level, count(*) FROM files GROUP BY 2 UNION ALL SELECT 'scan', coalesce(scan_status, 'unscanned'), count(*) FROM dl GROUP BY 2 UNION ALL SELECT 'raw', 'local', count(*) FROM dl GROUP BY 2
      UNION ALL SELECT 'category', CASE WHEN {VALID} THEN name ELSE 'uncategorized' END, sum(n)::BIGINT FROM cc GROUP BY 2 UNION ALL SELECT 'search_query', search_query, count(*) FROM works WHERE search_query IS NOT NULL GROUP BY 2"""),
    "category_rollup": (analytics.category_rollup, CTE + f""", named AS (SELECT coalesce(ch.category, 'unprocessed') source, char_count, {LOW.format("coalesce(ch.category, 'unprocessed')")} low FROM ch WHERE download_status = 'downloaded'), j AS (SELECT n.*, c.description, c.keywords_json, coalesce(c.dynamic, 0) dynamic FROM named n LEFT JOIN categories c ON c.name = n.source)
      SELECT CASE WHEN {VALID} THEN source ELSE 'uncategorized' END AS category, count(*) AS rows, coalesce(sum(char_count), 0)::BIGINT AS chars, arg_min(description, source) FILTER (coalesce(description, '') <> '') AS description, coalesce(arg_min(keywords_json, source) FILTER (coalesce(keywords_json, '[]') <> '[]'), '[]') AS keywords_json, max(dynamic)::INT AS dynamic FROM j GROUP BY 1"""),
    "summary_pending": (queues.summary_pending, CTE + "SELECT count(DISTINCT work_id) AS pending_works FROM untried WHERE work_id NOT IN (SELECT f.work_id FROM files f JOIN dl ON dl.file_id = f.id WHERE f.work_id IS NOT NULL)"),
    "backlog_counts": (queues.backlog_counts, CTE + """SELECT 'pending_downloads' AS queue, count(DISTINCT work_id) AS n FROM runnable WHERE download_disabled_at IS NULL UNION ALL SELECT 'failed_downloads', count(*) FROM act
      UNION ALL SELECT 'pending_extractions', count(*) FROM dl WHERE status = 'downloaded' AND NOT EXISTS (SELECT 1 FROM extractions e WHERE e.download_id = dl.id AND e.extractor = 'plaintext.v2')
      UNION ALL SELECT 'pending_raw_archives', count(*) FROM dl JOIN extractions e ON e.download_id = dl.id WHERE dl.status = 'downloaded' AND e.status = 'processed' AND starts_with(lower(e.text_uri), 'file:')
      UNION ALL SELECT 'unvalidated_texts', count(*) FROM extractions WHERE status = 'processed' AND text_uri IS NOT NULL AND (quality_status IS NULL OR quality_status = 'error')"""),
    "domain_outcomes": (queues.domain_outcomes, CTE + f"SELECT {HOST} AS domain, count(*) FILTER (status = 'downloaded') AS downloaded, count(*) FILTER (status = 'failed') AS failed, max(coalesce(status = 'failed' AND regexp_matches(lower(error), 'connection|timed out|timeout'), false)) AS unavailable FROM files f JOIN dl ON dl.file_id = f.id GROUP BY 1".replace("FROM files f JOIN dl", "FROM (SELECT f.id fid, download_url, url FROM files f) f JOIN dl").replace("dl.file_id = f.id", "dl.file_id = f.fid")),
    "worker_counts": (lambda c: state.worker_counts(_workers(c)), f"WITH {WORKERS} SELECT count(*) AS total, count(*) FILTER (status = 'running') AS running, count(*) FILTER (status IN ('idle', 'complete')) AS idle, count(*) FILTER (status = 'failed') AS failed FROM workers"),
    "activity_counts": (lambda c: _scalars(c, label=state.activity(_phase(), _message())).groupBy("label").agg(F.count(F.lit(1)).alias("n")), f"SELECT {LABEL} AS label, count(*) AS n FROM events GROUP BY 1"),
    "activity_messages": (lambda c: _scalars(c, message=state.message(_message())), f"SELECT event_id, {MESSAGE} AS message FROM events"),
    "health_state": (_health, CTE + f""", {WORKERS}, k AS (SELECT (SELECT count(*) FROM dl WHERE scan_status = 'infected') infected, (SELECT count(*) FROM workers WHERE status = 'failed') wf, (SELECT count(*) FROM workers WHERE status = 'running') wr, (SELECT count(*) FROM extractions WHERE status = 'failed') ef,
      (SELECT count(DISTINCT work_id) FROM runnable WHERE download_disabled_at IS NULL) + (SELECT count(*) FROM dl WHERE status = 'downloaded' AND NOT EXISTS (SELECT 1 FROM extractions e WHERE e.download_id = dl.id AND e.extractor = 'plaintext.v2'))
      + (SELECT count(*) FROM dl JOIN extractions e ON e.download_id = dl.id WHERE dl.status = 'downloaded' AND e.status = 'processed' AND starts_with(lower(e.text_uri), 'file:')) pending)
      SELECT CASE WHEN infected > 0 THEN 'quarantine' WHEN wf > 0 THEN 'worker issue' WHEN ef + wf > 0 THEN 'attention' WHEN wr > 0 THEN 'running' ELSE 'stale' END AS state, CASE WHEN infected > 0 THEN 'infected files require review' WHEN wf > 0 THEN 'a background worker failed' WHEN ef + wf > 0 THEN 'pipeline failures need triage' WHEN wr > 0 THEN 'background work is active' ELSE 'no recent agent activity' END AS reason, pending, ef + wf AS failures FROM k"""),
    "progress": (lambda c: c.files.select(F.col("id").alias("file_id"), "site").join(c.downloads.select("file_id", "status"), "file_id", "left").groupBy("site").agg(F.count_if(F.coalesce(F.col("status") == "downloaded", F.lit(False))).alias("done"), F.count(F.lit(1)).alias("total")).select("site", F.round(state.ratio(F.col("done"), F.col("total")), 6).alias("ratio"), state.percent(F.col("done"), F.col("total")).alias("percent")),
      CTE + "SELECT site, round(count(*) FILTER (dl.status = 'downloaded') / count(*), 6) AS ratio, round_even(100 * (count(*) FILTER (dl.status = 'downloaded') / count(*)), 0)::INT AS percent FROM files f LEFT JOIN dl ON dl.file_id = f.id GROUP BY 1"),
    "stage_outcomes": (lambda c: c.downloads.select(F.lit("download").alias("stage"), F.col("status").alias("outcome")).unionByName(c.extractions.select(F.lit("extraction").alias("stage"), F.col("status").alias("outcome"))).groupBy("stage", "outcome").agg(F.count(F.lit(1)).alias("n")), CTE + "SELECT 'download' AS stage, status AS outcome, count(*) AS n FROM dl GROUP BY 2 UNION ALL SELECT 'extraction', status, count(*) FROM extractions GROUP BY 2"),
    # --- queues
    "pending_downloads": (queues.pending_downloads, CTE + PICKED.format("pending")),
    "best_file_per_work": (queues.best_file_per_work, f"SELECT work_id, file_id, rank, size FROM (SELECT work_id, file_id, {RANK} AS rank, {SIZE} AS size, {BEST} FROM (SELECT *, id AS file_id FROM files) WHERE coalesce(download_url, url, '') <> '' AND {RUNS}) WHERE rn = 1"),
    "pending_for_works": (lambda c: queues.pending_for_works(c, c.works.filter("id % 3 = 1").select(F.col("id").alias("work_id"))), CTE + PICKED.format("pending").replace("WHERE ((", "WHERE download_disabled_at IS NULL AND work_id IN (SELECT id FROM works WHERE id % 3 = 1) AND ((")),
    "pending_for_files": (lambda c: queues.pending_for_files(c, c.files.filter("id % 2 = 0").select(F.col("id").alias("file_id"))), CTE + "SELECT work_id, file_id, site, format FROM untried WHERE download_disabled_at IS NULL AND file_id % 2 = 0"),
    "work_ids_for_queries": (lambda c: queues.works_for_queries(c, ["political economy", "old letters", ""]), "SELECT id FROM works WHERE search_query IN ('political economy', 'old letters')"),
    "active_failed": (queues.active_failed, CTE + "SELECT file_id, work_id, site, coalesce(error, '') AS error, attempts FROM act"),
    "recent_failed": (queues.recent_failed, CTE + "SELECT download_id, file_id, site, format, w.title, w.author, error FROM act JOIN works w ON w.id = act.work_id ORDER BY d_updated DESC NULLS LAST, download_id DESC LIMIT 25"),
    "stuck_downloads": (queues.stuck_downloads, CTE + f"SELECT download_id, file_id, work_id, w.title, w.author, site, format, {HOST} AS host, attempts, error FROM act JOIN works w ON w.id = act.work_id ORDER BY d_updated NULLS FIRST, download_id LIMIT 100"),
    "pipeline_failures": (queues.pipeline_failures, CTE + """, u AS (SELECT * FROM (SELECT 0 AS priority, 'text' AS stage, e.id, coalesce(e.processed_at, e.created_at) t FROM extractions e JOIN dl ON dl.id = e.download_id WHERE e.status = 'failed' ORDER BY t DESC NULLS LAST, e.id DESC LIMIT 25)
      UNION ALL SELECT * FROM (SELECT 1, 'download', download_id, d_updated FROM act ORDER BY d_updated DESC NULLS LAST, download_id DESC LIMIT 25)) SELECT priority, stage, id FROM u ORDER BY priority, t DESC NULLS LAST, id DESC LIMIT 25"""),
    "pending_extractions_for_works": (lambda c: queues.pending_extractions(c, works=c.works.filter("id % 2 = 0").select(F.col("id").alias("work_id"))), CTE + "SELECT dl.id AS download_id, file_id, bytes FROM dl JOIN files f ON f.id = dl.file_id WHERE status = 'downloaded' AND f.work_id % 2 = 0 AND NOT EXISTS (SELECT 1 FROM extractions e WHERE e.download_id = dl.id AND e.extractor = 'plaintext.v2')"),
    "raw_archive_candidates": (queues.raw_candidates, CTE + "SELECT dl.id AS download_id, dl.file_id, f.work_id FROM dl JOIN files f ON f.id = dl.file_id WHERE dl.status = 'downloaded' AND dl.id IN (SELECT download_id FROM extractions WHERE status = 'processed' AND starts_with(lower(text_uri), 'file:'))"),
    "quality_candidates": (queues.quality_candidates, "SELECT id, download_id, char_count FROM extractions WHERE status = 'processed' AND text_uri IS NOT NULL AND (quality_status IS NULL OR quality_status = 'error')"),
    "munge_candidates": (lambda c: queues.munge_candidates(c, _munges(c), "v1"), CTE + f", {MUNGES} SELECT extraction_id, file_id, work_id, char_count FROM ch WHERE {USABLE} AND extraction_id NOT IN (SELECT extraction_id FROM munges WHERE status = 'processed')"),
    "domain_assignment": (queues.domain_assignment, CTE + f""", best AS (SELECT file_id, {HOST} AS domain FROM (SELECT *, {BEST} FROM pending WHERE {RUNS}) WHERE rn = 1),
      cut AS (SELECT DISTINCT domain FROM best ORDER BY domain LIMIT 4) SELECT domain, slot::INT AS slot, file_id FROM (SELECT domain, file_id, row_number() OVER (PARTITION BY domain ORDER BY file_id) slot FROM best WHERE domain IN (SELECT domain FROM cut)) WHERE slot <= 3"""),
    "domain_assignment_for_works": (lambda c: queues.domain_assignment(c, without=("annals.example.org",), works=c.works.filter("id % 3 = 1").select(F.col("id").alias("work_id"))), CTE + f""", best AS (SELECT file_id, {HOST} AS domain FROM (SELECT *, {BEST} FROM pending WHERE {RUNS} AND download_disabled_at IS NULL AND work_id % 3 = 1) WHERE rn = 1),
      cut AS (SELECT DISTINCT domain FROM best WHERE domain <> 'annals.example.org' ORDER BY domain LIMIT 4) SELECT domain, slot::INT AS slot, file_id FROM (SELECT domain, file_id, row_number() OVER (PARTITION BY domain ORDER BY file_id) slot FROM best WHERE domain IN (SELECT domain FROM cut)) WHERE slot <= 3"""),
    "unstick_plan": (lambda c: queues.fallback_plan(queues.active_failures(c)), FAILED + f", p AS (SELECT file_id, error, coalesce(attempts, 0)::VARCHAR n, {PLAN} AS action FROM fr) SELECT file_id, action, CASE action WHEN 'disable' THEN 'terminal download error after ' || n || ' attempt(s): ' WHEN 'retry' THEN 'retrying potentially transient failure after ' || n || ' attempt(s): ' ELSE 'needs alternate-source discovery; leaving failed row visible: ' END || substring(error, 1, 180) AS reason FROM p"),
    "apply_plan": (lambda c: queues.apply_plan(queues.active_failures(c), _plan(c)), FAILED + f""", p AS (SELECT file_id, CASE WHEN file_id % 10 = 0 THEN 'invalid' WHEN file_id % 5 = 0 THEN 'replace_url' ELSE {PLAN} END o FROM fr UNION ALL SELECT id + 10000000, 'invalid' FROM files WHERE id % 50 = 7)
      SELECT o AS outcome, count(*) AS n, count(DISTINCT CASE WHEN o IN ('retry', 'replace_url') THEN file_id END) AS requeued FROM p GROUP BY 1"""),
    "after_plan_files": (lambda c: queues.after_plan(c.files, c.downloads, queues.judged_plan(queues.active_failures(c), _plan(c)))[0], FAILED + f""", p AS (SELECT file_id, error, coalesce(attempts, 0)::VARCHAR n, CASE WHEN file_id % 10 = 0 THEN 'invalid' WHEN file_id % 5 = 0 THEN 'replace_url' ELSE {PLAN} END o FROM fr)
      SELECT f.id, CASE WHEN o = 'replace_url' THEN 'https://new.example.org/f' ELSE f.download_url END AS download_url, CASE WHEN o = 'replace_url' THEN false WHEN o = 'disable' THEN true ELSE f.download_disabled_at IS NOT NULL END AS disabled, CASE WHEN o = 'replace_url' THEN NULL WHEN o = 'disable' THEN 'terminal download error after ' || n || ' attempt(s): ' || substring(error, 1, 180) ELSE f.download_disabled_reason END AS download_disabled_reason FROM files f LEFT JOIN p ON p.file_id = f.id"""),
    "after_plan_downloads": (lambda c: queues.after_plan(c.files, c.downloads, queues.judged_plan(queues.active_failures(c), _plan(c)))[1].select("id", "file_id", "status"), FAILED + f", p AS (SELECT file_id, CASE WHEN file_id % 10 = 0 THEN 'invalid' WHEN file_id % 5 = 0 THEN 'replace_url' ELSE {PLAN} END o FROM fr) SELECT id, file_id, status FROM dl WHERE NOT (coalesce(status, '') = 'failed' AND file_id IN (SELECT file_id FROM p WHERE o IN ('retry', 'replace_url')))"),
    "query_text": (queues.query_text, f"SELECT id AS work_id, rtrim(concat_ws(' ', trim({SPACE.format("coalesce(title, '')")}, ' '), trim({SPACE.format("coalesce(author, '')")}, ' ')), ' ') AS query FROM works"),
    "affected_works": (lambda c: queues.affected_works(c, FAMILY, "^/(get|item)/"), CTE + f""", hit AS (SELECT DISTINCT work_id FROM files f JOIN dl ON dl.file_id = f.id WHERE dl.status = 'downloaded' AND contains(content_type, 'text/html') AND contains({HOST}, '{FAMILY}') AND regexp_matches({PATH}, '^/(get|item)/')), us AS (SELECT DISTINCT work_id FROM ch WHERE {USABLE}),
      nm AS (SELECT id work_id, {KEYSQL.format('title')} tk, {KEYSQL.format('author')} ak FROM works), ok AS (SELECT DISTINCT tk, ak FROM nm WHERE work_id IN (SELECT work_id FROM us) AND length(tk) >= 8)
      SELECT hit.work_id FROM hit JOIN nm ON nm.work_id = hit.work_id WHERE hit.work_id NOT IN (SELECT work_id FROM us) AND NOT EXISTS (SELECT 1 FROM ok WHERE ok.tk = nm.tk AND ok.ak = nm.ak)"""),
    "auto_queries": (lambda c: notes.own_queries(analytics.category_counts(c).select("name", "texts", "chars"), QUERIES, LISTS, 2, focus="letters", extra=["Essays", "last one"], limit=12), """WITH n AS (SELECT c.name, count(e.id) t, coalesce(sum(e.char_count), 0) ch FROM categories c LEFT JOIN extractions e ON e.category = c.name GROUP BY 1), r AS (SELECT name, row_number() OVER (ORDER BY t, ch, name) rk FROM n WHERE name IN ('history', 'law', 'music')),
      v AS (SELECT * FROM (VALUES ('history', 0, 'old annals'), ('history', 1, 'chronicles'), ('law', 0, 'statutes'), ('law', 1, 'court records'), ('music', 0, 'part songs')) v(name, k, q)),
      a AS (SELECT 2 p, rk a, k b, q FROM v JOIN r USING (name) UNION ALL SELECT * FROM (VALUES (1, 0, 0, 'public domain letters'), (1, 0, 1, 'letters complete works'), (1, 0, 2, 'letters essays'), (3, 0, 0, 'Old Annals'), (3, 0, 1, 'travel accounts'), (3, 0, 2, 'public domain letters'), (4, 0, 0, 'essays'), (99, 0, 0, 'Essays'), (99, 0, 1, 'last one'))),
      d AS (SELECT arg_min(q, (p, a, b)) q, min((p, a, b)) m FROM a GROUP BY lower(q)) SELECT place::INT AS place, query FROM (SELECT row_number() OVER (ORDER BY m) AS place, q AS query FROM d) WHERE place <= 12"""),
    # --- transitions
    "rss_seen": (lambda c: state.seen_items(c.files.filter("id % 3 <> 0 and url is not null").groupBy(F.col("site").alias("feed_url"), F.col("url").alias("item_id")).agg(F.max("download_url").alias("item_url"), F.min("work_id").alias("work_id"), F.min("created_at").alias("archived_at")), c.files.filter("id % 2 = 0 and url is not null").groupBy(F.col("site").alias("feed_url"), F.col("url").alias("item_id")).agg(F.max("download_url").alias("item_url"), F.lit(None).cast("long").alias("work_id"), F.max("created_at").alias("archived_at"))).withColumn("archived_at", F.date_format("archived_at", "yyyy-MM-dd HH:mm:ss")),
      """WITH a AS (SELECT site, url, max(download_url) i, min(work_id) w, min(created_at) t FROM files WHERE id % 3 <> 0 AND url IS NOT NULL GROUP BY 1, 2), b AS (SELECT site, url, max(download_url) i, max(created_at) t FROM files WHERE id % 2 = 0 AND url IS NOT NULL GROUP BY 1, 2)
      SELECT coalesce(a.site, b.site) AS feed_url, coalesce(a.url, b.url) AS item_id, coalesce(b.i, a.i) AS item_url, a.w AS work_id, strftime(coalesce(a.t, b.t), '%Y-%m-%d %H:%M:%S') AS archived_at FROM a FULL JOIN b ON a.site = b.site AND a.url = b.url"""),
    "extraction_fold": (lambda c: state.fold_extractions(_extraction_events(c)), """WITH l AS (SELECT *, row_number() OVER (PARTITION BY download_id, extractor ORDER BY id DESC) rn FROM extractions), e AS (SELECT download_id, extractor, arg_max(text_uri, id) FILTER (status = 'processed' AND text_uri IS NOT NULL) u, arg_max(char_count, id) FILTER (status = 'processed' AND char_count IS NOT NULL) n, arg_max(substring(coalesce(warnings, ''), 1, 1000), id) FILTER (status IN ('processed', 'skipped')) w, arg_max(substring(coalesce(warnings, ''), 1, 1000), id) FILTER (status = 'failed') f FROM extractions GROUP BY 1, 2)
      SELECT l.download_id, l.extractor, CASE WHEN l.status IN ('processed', 'skipped', 'failed') THEN l.status ELSE 'processing' END AS status, e.u AS text_uri, e.n AS char_count, CASE WHEN l.status = 'failed' THEN e.f END AS error, e.w AS warnings FROM l JOIN e ON e.download_id = l.download_id AND e.extractor = l.extractor WHERE rn = 1"""),
    "raw_fold": (lambda c: state.fold_archiving(c.downloads, _archiving(c)), CTE + "SELECT id, CASE WHEN status IS DISTINCT FROM 'downloaded' THEN 'local' WHEN id % 3 = 0 THEN 'archived' WHEN id % 3 = 1 THEN 'failed' ELSE 'missing' END AS raw_status, CASE WHEN status = 'downloaded' AND id % 3 = 0 THEN 'raw/' || id::VARCHAR END AS raw_uri, CASE WHEN status = 'downloaded' AND id % 3 <> 0 THEN 'no space' END AS raw_error, coalesce(status = 'downloaded' AND (id % 3 = 2 OR (id % 3 = 0 AND id % 2 = 0)), false) AS local_deleted FROM dl"),
    "munge_fold": (lambda c: state.fold_munges(_munges(c), c.extractions.filter("id % 2 = 0").select(F.col("id").alias("extraction_id"), F.lit("v1").alias("munger_version"), F.when(F.col("id") % 4 == 0, "failed").otherwise("processed").alias("status"), F.lit("new").alias("sha256"), F.lit(1).cast("long").alias("chars"), F.lit("again").alias("error"))),
      f"""WITH {MUNGES}, n AS (SELECT id extraction_id, CASE WHEN id % 4 = 0 THEN 'failed' ELSE 'processed' END s FROM extractions WHERE id % 2 = 0), j AS (SELECT coalesce(m.extraction_id, n.extraction_id) extraction_id, m.status, m.sha256, m.chars, m.error, n.s, coalesce(n.s = 'processed', false) won, coalesce(n.s = 'failed' AND coalesce(m.status, '') <> 'processed', false) lost FROM munges m FULL JOIN n ON n.extraction_id = m.extraction_id)
      SELECT extraction_id, 'v1' AS munger_version, CASE WHEN won OR lost THEN s ELSE status END AS status, CASE WHEN won THEN 'new' ELSE sha256 END AS sha256, CASE WHEN won THEN 1 ELSE chars END AS chars, CASE WHEN won THEN NULL WHEN lost THEN 'again' ELSE error END AS error FROM j"""),
    "mark_quality": (lambda c: state.mark_quality(c.extractions, c.extractions.filter("id % 4 = 1").select("id", F.lit("usable").alias("status"), F.lit(0.75).alias("score"))), "SELECT id, CASE WHEN id % 4 = 1 THEN 'usable' ELSE quality_status END AS quality_status, CASE WHEN id % 4 = 1 THEN 0.75 ELSE quality_score END AS quality_score FROM extractions"),
    "reject_unusable": (lambda c: state.reject(c.extractions), "WITH b AS (SELECT *, coalesce(status = 'processed' AND quality_status = 'unusable', false) bad FROM extractions) SELECT id, CASE WHEN bad THEN 'skipped' ELSE status END AS status, CASE WHEN NOT bad THEN text_uri END AS text_uri, CASE WHEN bad THEN 'rejected by text quality validation' ELSE warnings END AS warnings, CASE WHEN bad THEN text_uri END AS removed_uri FROM b"),
    "goals_supersede": (lambda c: state.supersede(_goals(c), F.lit(5), "2025-01-01T00:00:00Z").select("id", "status", F.size("events").alias("events"), F.element_at("events", -1)["kind"].alias("last")), """WITH g AS (SELECT user_id id, arg_max(event_type, event_id) t FROM events GROUP BY 1), h AS (SELECT id, CASE t WHEN 'view' THEN 'active' WHEN 'click' THEN 'running' ELSE 'done' END s FROM g)
      SELECT id, CASE WHEN s <> 'done' AND id <> 5 THEN 'superseded' ELSE s END AS status, CASE WHEN s <> 'done' AND id <> 5 THEN 2 ELSE 1 END AS events, CASE WHEN s <> 'done' AND id <> 5 THEN 'superseded' ELSE 'created' END AS last FROM h"""),
    "active_goals": (lambda c: _goals(c).filter(F.col("status").isin("active", "running")).agg(F.count(F.lit(1)).alias("active"), F.max("id").alias("last")), "WITH g AS (SELECT user_id id, arg_max(event_type, event_id) t FROM events GROUP BY 1) SELECT count(*) AS active, max(id) AS last FROM g WHERE t IN ('view', 'click')"),
    "plugin_upsert": (lambda c: state.replace_plugins(state.replace_plugins(c.spark.createDataFrame([], "slug string, name string, base_url string, search_url_template string, trust_level string, enabled boolean"), _sites(c, "trusted", "")), _sites(c, None, "/find?{query}", "id % 97 = 1")), """WITH s AS (SELECT DISTINCT site FROM files WHERE site IS NOT NULL), n AS (SELECT DISTINCT site FROM files WHERE id % 97 = 1 AND site IS NOT NULL)
      SELECT trim(regexp_replace(lower(site), '[^a-z0-9]+', '_', 'g'), '_') AS slug, site AS name, 'https://' || site AS base_url, CASE WHEN site IN (SELECT site FROM n) THEN 'https://' || site || '/find?{query}' ELSE 'https://' || site || '/search?q={query}' END AS search_url_template, CASE WHEN site IN (SELECT site FROM n) THEN 'untrusted' ELSE 'trusted' END AS trust_level, true AS enabled FROM s"""),
    "corpus_upsert": (lambda c: state.replace_specs(c.read("corpus_specs").select("id", "name", "ordering_strategy"), c.read("corpus_specs").filter("id % 2 = 0").select("name", F.lit("hash").alias("ordering_strategy")).unionByName(c.spark.createDataFrame([("a_new_one", "title")], "name string, ordering_strategy string"))), "SELECT id, name, CASE WHEN id % 2 = 0 THEN 'hash' ELSE ordering_strategy END AS ordering_strategy FROM corpus_specs UNION ALL SELECT max(id) + 1, 'a_new_one', 'title' FROM corpus_specs"),
    "corpus_replace_items": (lambda c: state.replace_items(c.files.select((F.col("id") % 7).alias("build"), F.col("id").alias("item")), c.files.filter("id % 7 in (2, 3) and id % 2 = 0").select((F.col("id") % 7).alias("build"), (-F.col("id")).alias("item"))), "SELECT id % 7 AS build, id AS item FROM files WHERE id % 7 NOT IN (2, 3) UNION ALL SELECT id % 7, -id FROM files WHERE id % 7 IN (2, 3) AND id % 2 = 0"),
    "crawl_register": (lambda c: state.registered(c.read("catalog_records"), c.works, 20), """WITH l AS (SELECT DISTINCT record_id, site, listed_title title, coalesce(listed_author, '') author FROM catalog_records WHERE listed_title IS NOT NULL), f AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY record_id) n FROM l), o AS (SELECT title, author, arg_min(site, record_id) site, min(record_id) record_id FROM f WHERE n <= 20 GROUP BY 1, 2)
      SELECT site, title, author, CASE WHEN author = '' THEN title IN (SELECT title FROM works WHERE title IS NOT NULL) ELSE EXISTS (SELECT 1 FROM works w WHERE w.title = o.title AND coalesce(w.author, '') = o.author) END AS known, record_id FROM o"""),
    # --- text
    "suspicious_lines": (lambda c: T.suspicious_lines(_texts(c)), f"""WITH l AS (SELECT doc_id, regexp_replace(regexp_replace(unnest(string_split(text, chr(10))), '\\r$', ''), '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g') line, generate_subscripts(string_split(text, chr(10)), 1) line_no FROM documents WHERE text IS NOT NULL)
      SELECT doc_id, line_no::INT AS line_no FROM l WHERE line <> '' AND (contains(line, chr(65533)) OR length(line) - length(regexp_replace(line, '[^A-Za-z0-9\\s\\x0b.,;:''"!?()\\[\\]{{}}-]', '', 'g')) >= 3 OR regexp_matches(line, '{T.SPACED}') OR regexp_matches(line, '[A-Za-z]{{2,}}\\|[A-Za-z]{{2,}}'))"""),
    "token_counts": (lambda c: T.token_counts(_texts(c)), f"WITH t AS (SELECT doc_id, unnest({WORDS.format('text')}) token FROM documents WHERE text IS NOT NULL), p AS (SELECT doc_id, token, count(*) n FROM t GROUP BY 1, 2) SELECT token, count(*) AS documents, sum(n)::BIGINT AS total FROM p GROUP BY 1"),
    "keyword_category": (lambda c: T.keyword_category(_about(c), c.read("categories")).select("doc_id", F.coalesce("category", F.lit("")).alias("category")), ABOUT + f", {KEYWORDS} SELECT d.doc_id, coalesce(s.name, '') AS category FROM documents d LEFT JOIN static s ON s.doc_id = d.doc_id"),
    "dynamic_category": (lambda c: T.word_category(_about(c)), ABOUT + f", {NAMED} SELECT doc_id, name, keywords FROM made"),
    "categorize": (_categorized, ABOUT + f", {KEYWORDS}, {NAMED} SELECT m.doc_id, coalesce(s.name, m.name) AS category FROM made m LEFT JOIN static s ON s.doc_id = m.doc_id"),
    "valid_category": (lambda c: c.extractions.select("id", T.valid_category(F.col("category")).alias("valid")), f"SELECT id, {VALID} AS valid FROM (SELECT id, {LOW.format('category')} low FROM extractions)"),
    "quality_metrics": (lambda c: _texts(c).select("doc_id", *[v.cast("long").alias(k) for k, v in T.quality_metrics(F.col("text")).items()]), "SELECT doc_id, (length(text) - length(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f-\\x{9f}]', '', 'g')))::BIGINT AS controls, (length(text) - length(replace(text, chr(65533), '')))::BIGINT AS replacements, len(regexp_extract_all(text, '[\\p{L}\\p{N}_]{3,}'))::BIGINT AS wordish, greatest(length(text), 1)::BIGINT AS size FROM documents WHERE text IS NOT NULL"),
    "quality_final": (lambda c: _docs(c).select("doc_id", T.final_quality(F.col("text"), F.when(F.col("doc_id") % 4 == 0, F.struct(F.lit("unusable").alias("status"), F.lit(0.2).alias("score"), F.lit("reader").alias("model")))).alias("q")).select("doc_id", "q.status", "q.score", "q.model"), f"""WITH t AS (SELECT doc_id, coalesce(text, '') text FROM documents), m AS (SELECT doc_id, text, {TRIM.format('text')} bare, length(text) - length(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f-\\x{{9f}}]', '', 'g')) c,
      length(text) - length(replace(text, chr(65533), '')) r, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]{{3,}}')) w, greatest(length(text), 1) n FROM t), v AS (SELECT doc_id, CASE WHEN bare = '' THEN 0.0 WHEN contains(substring(text, 1, 200), chr(0)) OR starts_with(text, chr(31) || chr(65533)) OR starts_with(text, chr(31) || chr(139)) OR starts_with(text, chr(139)) THEN 0.02 WHEN c / n > 0.03 THEN 0.05 WHEN r / n > 0.02 THEN 0.1 WHEN length(bare) < 120 OR w < 12 THEN 0.45 ELSE 0.75 END::DOUBLE AS score FROM m)
      SELECT doc_id, CASE WHEN score < 0.2 THEN 'unusable' WHEN doc_id % 4 = 0 THEN 'unusable' ELSE 'usable' END AS status, CASE WHEN score >= 0.2 AND doc_id % 4 = 0 THEN 0.2 ELSE score END AS score, CASE WHEN score >= 0.2 AND doc_id % 4 = 0 THEN 'reader' ELSE 'local-heuristic' END AS model FROM v"""),
    "corpus_substitute": (lambda c: _texts(c).select("doc_id", T.digest(T.substitute(F.col("text"), PAIRS)).alias("sha")), "SELECT doc_id, sha256(replace(replace(replace(text, 'ﬁ', 'fi'), '“', '\"'), '”', '\"')) AS sha FROM documents WHERE text IS NOT NULL"),
    "strip_boilerplate": (lambda c: _texts(c).select("doc_id", T.digest(T.between_notices(F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Front\n*** START OF THE PROJECT GUTENBERG EBOOK\n"), "text", F.lit("\n*** END OF THE PROJECT GUTENBERG EBOOK\nBack"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("x *** Start of this Project Gutenberg\n"), "text")).otherwise(F.col("text")))).alias("sha")),
      """WITH t AS (SELECT doc_id, text, length(text) n FROM documents WHERE text IS NOT NULL) SELECT doc_id, sha256(CASE doc_id % 3 WHEN 0 THEN substring(text || chr(10) || '*** END OF THE PROJECT GUTENBERG EBOOK' || chr(10) || 'Back', 1, 6 + 41 + n + 1) WHEN 1 THEN text ELSE text END) AS sha FROM t"""),
    "apply_rules": (lambda c: _rules(c), """WITH t AS (SELECT doc_id, string_split(text, 'the ') s FROM documents WHERE text IS NOT NULL), u AS (SELECT doc_id, array_to_string(s[1:4], 'THE ') || CASE WHEN len(s) > 4 THEN 'the ' || array_to_string(s[5:], 'the ') ELSE '' END x, least(3, len(s) - 1) a FROM t)
      SELECT doc_id, sha256(regexp_replace(x, '[0-9]+', '#', 'g')) AS sha, a::INT AS a, len(regexp_extract_all(x, '[0-9]+'))::INT AS b FROM u WHERE len(regexp_extract_all(x, '[0-9]+')) <= 1000"""),
    "first_json": (lambda c: _answers(c).select("event_id", T.first_json(F.col("answer"), "k int")["k"].alias("k")), "SELECT event_id, json_extract(props, '$.k')::INT AS k FROM events"),
    "munge": (lambda c: _docs(c).select("doc_id", T.munged(F.col("text")).alias("m")).select("doc_id", "m.*"), None),
    "munge_summary": (lambda c: _docs(c).select(T.munged(F.col("text"))["text"].alias("t")).select(F.when(F.col("t").isNull(), "skipped").when(F.col("t") == "", "failed").otherwise("processed").alias("outcome")).groupBy("outcome").agg(F.count(F.lit(1)).alias("n")), None),
    "munge_running_lines": (lambda c: _texts(c).select("doc_id", T.without_running_lines(F.col("text"))["removed"].alias("removed")), """WITH l AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[\\n\\x{2028}\\x{2029}]')) line FROM documents WHERE text IS NOT NULL), k AS (SELECT doc_id, regexp_replace(line, '^[\\s\\x0b]+|[\\s\\x0b]+$', '', 'g') bare FROM l), m AS (SELECT *, regexp_replace(lower(bare), '[0-9]+', '#', 'g') AS key FROM k), n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, key) AS cnt FROM m)
      SELECT doc_id, count(*) FILTER (regexp_matches(bare, '^[-–— ]*[0-9]+[-–— ]*$') OR (cnt >= 3 AND length(key) BETWEEN 1 AND 90 AND length(bare) <= 90))::INT AS removed FROM n GROUP BY 1"""),
    "fuzzy_title_match": (lambda c: titles.fuzzy_titles(c, ratio=titles.RATIO), TITLESQL),
    "similar_titles": (lambda c: titles.fuzzy_titles(c, ratio=titles.RATIO), None),
    # --- URLs
    "runnable_all": (lambda c: c.files.withColumnRenamed("id", "file_id").select("file_id", queues.is_runnable().alias("runs")), f"SELECT id AS file_id, {RUNS} AS runs FROM files"),
    "public_url": (lambda c: c.files.select("id", U.public(effective_url()).alias("public")), f"SELECT id, {SCHEME} IN ('http', 'https') AND {HOST} <> '' AS public FROM files"),
    "url_class": (lambda c: c.files.select("id", U.url_class(effective_url(), F.col("format"), F.col("download_source")).alias("class")), f"SELECT id, CASE WHEN {TORRENT} AND regexp_matches(lower({EFF}), '/torrents/managed_by|/torrents/external/|pilimi-|zlib2-|libgen-|libgen_rs_fic') THEN 'bulk' WHEN {TORRENT} THEN 'torrent' WHEN ends_with({HOST}, '.onion') THEN 'onion' WHEN {SCHEME} = 'file' AND {PATH} <> '' THEN 'file' WHEN {SCHEME} IN ('http', 'https') AND {HOST} <> '' THEN 'web' ELSE 'other' END AS class FROM files"),
    "url_extension": (lambda c: c.files.withColumnRenamed("id", "file_id").join(c.downloads.select("file_id", "content_type"), "file_id").select("file_id", U.extension(effective_url(), F.col("content_type"), F.col("format")).alias("ext")), CTE + f""", u AS (SELECT f.id file_id, regexp_extract(lower({PATH}), '\\.([a-z0-9]{{1,8}})$') s, trim(split_part(lower(coalesce(dl.content_type, '')), ';', 1), ' ') t, lower(coalesce(f.format, '')) m FROM files f JOIN dl ON dl.file_id = f.id)
      SELECT file_id, CASE WHEN s <> '' AND s NOT IN ({listed(U.DYNAMIC)}) THEN s {" ".join(f"WHEN t = '{a}' THEN '{b}'" for a, b in U.OF_TYPE)} {" ".join(f"WHEN contains(m, '{n}') THEN '.{n}'" for n in U.NAMED)} ELSE '.bin' END AS ext FROM u"""),
    "extract_dispatch": (lambda c: c.files.withColumnRenamed("id", "file_id").join(c.downloads.select("file_id", "content_type"), "file_id", "left").select("file_id", mode_of(effective_url(), F.col("content_type"), F.col("format")).alias("mode")), CTE + f""", u AS (SELECT f.id file_id, regexp_extract(lower({EFF}), '\\.[a-z0-9]+$') s, lower(concat_ws(' ', coalesce(dl.content_type, ''), coalesce(f.format, ''))) h FROM files f LEFT JOIN dl ON dl.file_id = f.id) SELECT file_id, CASE WHEN contains(h, 'encrypted') OR s = '.lcpdf' THEN 'skip:encrypted' WHEN s IN ('.torrent', '.aria2', '.part', '.resume') THEN 'skip:torrent' WHEN s = '.gz' THEN 'gzip'
      WHEN s IN ('.html', '.htm', '.xml', '.fb2') OR contains(h, 'html') OR contains(h, 'fb2') THEN 'html' WHEN s IN ('.txt', '.text', '.md', '.muse', '.json', '.csv') OR contains(h, 'text') OR contains(h, 'muse') THEN 'text' WHEN s = '.pdf' OR contains(h, 'pdf') THEN 'pdf' WHEN s = '.epub' OR contains(h, 'epub') THEN 'epub' WHEN s IN ('.png', '.jpg', '.jpeg', '.tif', '.tiff', '.bmp') OR contains(h, 'image/') THEN 'image' ELSE 'skip:unsupported' END AS mode FROM u"""),
    "url_site": (lambda c: c.files.select("id", U.site_of(effective_url(), F.col("site")).alias("site")), f"SELECT id, coalesce(nullif({HOST}, ''), site) AS site FROM files"),
    "search_urls": (lambda c: c.works.filter("search_query is not null").select("id", U.search_url("https://s.example.org/search?q={query}&raw={raw_query}", F.col("search_query")).alias("url")), "SELECT id, 'https://s.example.org/search?q=' || replace(url_encode(search_query), '%2F', '/') || '&raw=' || search_query AS url FROM works WHERE search_query IS NOT NULL"),
    "export_urls": (lambda c: c.files.select("id", U.export_url(effective_url(), ".epub", "/get/").alias("url")), f"SELECT id, CASE WHEN starts_with({PATH}, '/get/') THEN {SCHEME} || '://' || {HOST} || regexp_replace(regexp_replace({PATH}, '/+$', ''), '\\.[^./]*$', '') || '.epub' END AS url FROM files"),
    "dedupe_links": (lambda c: c.files.withColumn("key", U.detail_key(F.when(F.col("id") % 3 == 0, F.concat(F.lit("https://m.example.org/md5/"), (F.col("id") % 50).cast("string"), F.lit("/x"))).when(F.col("id") % 3 == 1, F.concat(F.lit("https://n.example.org/edition.php?id="), (F.col("id") % 40).cast("string"))).otherwise(F.col("url")))).groupBy("key").agg(F.min("id").alias("id")), """WITH k AS (SELECT id, CASE id % 3 WHEN 0 THEN 'md5:' || (id % 50)::VARCHAR WHEN 1 THEN 'entry:edition.php:' || (id % 40)::VARCHAR ELSE regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) || CASE WHEN regexp_extract(coalesce(url, ''), '^[^?#]*\\?([^#]*)', 1) <> '' THEN '?' || regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) ELSE '' END END AS key FROM files) SELECT key, min(id) AS id FROM k GROUP BY 1"""),
    "mirror_rank": (lambda c: c.files.select("id", U.mirror_rank(F.concat(F.lit("Slow Partner Server #"), (F.col("id") % 9).cast("string"), F.when(F.col("id") % 4 == 0, " (waitlist)").otherwise("")), F.when(F.col("id") % 5 == 0, "/fast/x").otherwise("/slow_download/x")).alias("rank")), "SELECT id, CASE WHEN id % 4 = 0 THEN 100 WHEN id % 5 = 0 THEN 50 WHEN id % 9 = 5 THEN 0 ELSE 10 + abs(id % 9 - 5) END::INT AS rank FROM files"),
    "redirects": (lambda c: c.files.select("id", U.decode_redirect(F.concat(F.lit("https://r.example.org/l/?uddg="), F.url_encode(F.coalesce("url", F.lit(""))), F.lit("&rut=1"))).alias("link")), "SELECT id, CASE WHEN coalesce(url, '') = '' THEN 'https://r.example.org/l/?uddg=&rut=1' ELSE url END AS link FROM files"),
    "pretty_size": (lambda c: c.downloads.select("id", U.pretty_size(F.when(F.col("id") % 5 == 0, "n/a").otherwise((F.col("bytes") * 100).cast("string"))).alias("size")), CTE + "SELECT id, CASE WHEN id % 5 = 0 THEN 'n/a' WHEN bytes IS NULL THEN 'Unknown' WHEN bytes * 100 > 1048576 THEN format('{:.2f} MB', bytes * 100 / 1048576.0) ELSE format('{:.2f} KB', bytes * 100 / 1024.0) END AS size FROM dl"),
    "term_match": (lambda c: c.works.select("id", U.term_match(F.col("search_query"), F.col("title"), F.col("author")).alias("hit")), "WITH t AS (SELECT id, regexp_extract_all(lower(coalesce(search_query, '')), '[a-z0-9]{4,}') ts, lower(concat_ws(' ', coalesce(title, ''), coalesce(author, ''))) h FROM works) SELECT id, len(ts) = 0 OR len(list_filter(ts, lambda x: contains(h, x))) > 0 AS hit FROM t"),
    "parse_duration": (lambda c: _scalars(c, seconds=state.duration(F.concat(F.lit(" "), (F.col("event_id") % 90).cast("string"), F.when(F.col("event_id") % 3 == 0, ".5").otherwise(""), F.element_at(F.array(*map(F.lit, ("s", "M", "h", "d", "", "x"))), (F.col("event_id") % 6 + 1).cast("int"))))), "SELECT event_id, CASE WHEN event_id % 6 = 5 THEN NULL ELSE floor((event_id % 90 + CASE WHEN event_id % 3 = 0 THEN 0.5 ELSE 0 END) * CASE event_id % 6 WHEN 1 THEN 60 WHEN 2 THEN 3600 WHEN 3 THEN 86400 ELSE 1 END)::BIGINT END AS seconds FROM events"),
    "backoff": (lambda c: _scalars(c, seconds=state.backoff((F.col("event_id") % 15).cast("int"), 300, 3600)), "SELECT event_id, least(3600, 300 * greatest(1, event_id % 15))::INT AS seconds FROM events"),
    "age_label": (lambda c: _scalars(c, age=state.age(F.when(F.col("event_id") % 11 != 0, F.col("event_id") * 37 - 500))), "SELECT event_id, CASE WHEN event_id % 11 = 0 THEN 'unknown' WHEN s < 60 THEN s::VARCHAR || 's' WHEN s < 3600 THEN (s // 60)::VARCHAR || 'm' WHEN s < 172800 THEN (s // 3600)::VARCHAR || 'h' ELSE (s // 86400)::VARCHAR || 'd' END AS age FROM (SELECT event_id, greatest(0, event_id * 37 - 500) s FROM events)"),
    "parse_timestamps": (lambda c: _scalars(c, at=F.date_format(state.timestamp(F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(F.col("event_id") % 4 == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(F.col("event_id") % 4 == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("soon")), "yyyy-MM-dd HH:mm:ss")), "SELECT event_id, CASE WHEN event_id % 4 < 3 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS \"at\" FROM events"),
    # --- pages and feeds
    "page_links": (lambda c: pages.page_links(_pages(c)).select("page_url", "link", "format", "site"), f"""WITH u AS (SELECT work_id, replace({EFF}, ' ', '%20') l FROM files WHERE url IS NOT NULL), v AS (SELECT DISTINCT 'https://pages.example.org/' || work_id::VARCHAR AS page_url, regexp_replace(CASE WHEN l = '' THEN 'https://pages.example.org/' || work_id::VARCHAR ELSE l END, '#.*$', '') AS link FROM u JOIN works w ON w.id = work_id WHERE w.title IS NOT NULL), p AS (SELECT *, lower(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) pa FROM v WHERE regexp_matches(link, '^https?://[^/:?#]+'))
      SELECT page_url, link, format, lower(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS site FROM (SELECT *, CASE {" ".join(f"WHEN ends_with(pa, '{s}') THEN '{n}'" for s, n in U.SUFFIXES)} END AS format FROM p) WHERE format IS NOT NULL AND format <> 'HTML'"""),
    "page_metadata": (lambda c: pages.page_metadata(_pages(c)).select("page_url", "title", "author"), f"SELECT 'https://pages.example.org/' || id::VARCHAR AS page_url, CASE WHEN trim({ANY_SPACE.format('title')}, ' ') = '' THEN 'Site' ELSE trim({ANY_SPACE.format('title')}, ' ') END AS title, nullif(trim({ANY_SPACE.format("coalesce(author, '')")}, ' '), '') AS author FROM works WHERE title IS NOT NULL AND id IN (SELECT work_id FROM files WHERE url IS NOT NULL)"),
    "clean_html": (lambda c: pages.page_text(_pages(c)).select("page_url", (~F.contains("text", F.lit("Home Search")) & ~F.contains("text", F.lit("var x"))).alias("clean"), F.regexp_count("text", F.lit(" file")).alias("links")), f"SELECT 'https://pages.example.org/' || w.id::VARCHAR AS page_url, true AS clean, (count(f.id) + any_value(len(regexp_extract_all(trim({ANY_SPACE.format('w.title')}, ' ') || chr(10) || coalesce(w.search_query, ''), ' file'))))::INT AS links FROM works w JOIN files f ON f.work_id = w.id WHERE w.title IS NOT NULL AND f.url IS NOT NULL GROUP BY 1"),
    "filter_mirror_links": (lambda c: pages.filter_mirrors(_mirrors(c), "x.mirror.example"),
      """WITH m AS (SELECT work_id::VARCHAR AS page_url, CASE id % 4 WHEN 0 THEN 'https://x.mirror.example/slow_download/' || id::VARCHAR WHEN 2 THEN 'https://x.mirror.example/fast_download/' || id::VARCHAR ELSE url END AS link, CASE WHEN id % 8 = 0 THEN 'Waitlist' ELSE 'Server' END AS label, id % 4 <> 3 own, id % 4 = 0 AND id % 8 <> 0 slow FROM files WHERE url IS NOT NULL AND id % 4 <> 1), s AS (SELECT DISTINCT page_url FROM m WHERE slow)
      SELECT page_url, link, label FROM m WHERE slow OR NOT own OR page_url NOT IN (SELECT page_url FROM s WHERE page_url IS NOT NULL)"""),
    "page_format_size": (lambda c: c.files.select("id", pages.format_size(F.when(F.col("id") % 3 == 0, F.concat(F.lit("Title · "), F.element_at(F.array(*map(F.lit, ("pdf", "EPUB"))), (F.col("id") % 2 + 1).cast("int")), F.lit(" · 1.5 MB · 1901"))).when(F.col("id") % 3 == 1, F.lit("Size: 20,5 KB (x) Extension: djvu")).otherwise("a scanned epub of it")).alias("f")).select("id", "f.format", "f.size"), "SELECT id, CASE WHEN id % 3 = 0 THEN CASE WHEN id % 2 = 0 THEN 'PDF' ELSE 'EPUB' END WHEN id % 3 = 1 THEN 'DJVU' ELSE 'EPUB' END AS format, CASE id % 3 WHEN 0 THEN '1.5MB' WHEN 1 THEN '20,5 KB (x)' ELSE 'Unknown' END AS size FROM files"),
    "plugin_results": (lambda c: pages.plugin_results(_pages(c), "stacks catalogue").select("page_url", "place", "link"), f"""WITH u AS (SELECT id, work_id, regexp_replace(replace({EFF}, ' ', '%20'), '#.*$', '') || '#top' l FROM files WHERE url IS NOT NULL AND work_id IN (SELECT id FROM works WHERE title IS NOT NULL)), r AS (SELECT 'https://pages.example.org/' || work_id::VARCHAR AS page_url, CASE WHEN l = '#top' THEN 'https://pages.example.org/' || work_id::VARCHAR || '#top' ELSE l END AS link, min(id) i FROM u GROUP BY 1, 2)
      SELECT page_url, place::INT AS place, link FROM (SELECT page_url, link, row_number() OVER (PARTITION BY page_url ORDER BY i) AS place FROM r WHERE regexp_matches(link, '^https?://[^/:?#]+') AND contains(lower(link), 'stacks')) WHERE place <= 10"""),
    "parse_rss": (lambda c: pages.feed_rows(_feeds(c, "rss")).select("id", "title", "author", "link", "site", "format"), FEEDSQL),
    "parse_atom": (lambda c: pages.feed_rows(_feeds(c, "atom")).select("id", "title", "author", "link", "site", "format"), FEEDSQL),
    "parse_preprints": (lambda c: pages.preprint_rows(_preprints(c)), f"SELECT trim({ANY_SPACE.format('title')}, ' ') AS title, CASE WHEN trim(coalesce(author, ''), ' ') = '' THEN 'B. Second' ELSE trim({ANY_SPACE.format('author')}, ' ') || ', B. Second' END AS author, trim('s ' || {ANY_SPACE.format("coalesce(search_query, '')")}, ' ') AS summary, 'http://p.example.org/abs/' || id::VARCHAR AS detail_url, CASE WHEN id % 2 = 0 THEN 'http://p.example.org/x.pdf' ELSE 'http://p.example.org/pdf/' || id::VARCHAR END AS link FROM works WHERE trim(coalesce(title, ''), ' ') <> ''"),
    "parse_publication": (lambda c: pages.publication_rows(_feeds(c, "rss")).select("feed_url", "title", "link", "site"), FEEDROWS + " SELECT 'https://' || site || '/feed' AS feed_url, t AS title, u AS link, site FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY id) n FROM r WHERE t <> '' AND u <> '') WHERE n <= 10"),
    "feed_summary": (lambda c: pages.feed_summary(c.files.filter("site is not null").select(F.col("site").alias("feed_url"), F.col("id").cast("string").alias("id"), F.col("id").alias("place")), c.files.filter("id % 3 = 0").select(F.col("site").alias("feed_url"), F.col("id").cast("string").alias("id")), limit=30), "WITH f AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY id) n FROM files WHERE site IS NOT NULL) SELECT site AS feed_url, count(*) AS items, count(*) FILTER (id % 3 = 0) AS seen, count(*) FILTER (id % 3 <> 0) AS archived, 0::BIGINT AS skipped FROM f WHERE n <= 30 GROUP BY 1"),
    "parse_post_json": (lambda c: pages.post_rows(_posts(c), "posts.example.org"), f"SELECT id AS answer, CASE WHEN coalesce(title, '') = '' THEN id::VARCHAR ELSE trim({SPACE.format('title')}, ' ') END AS title, author, 'https://a.posts.example.org/p/' || id::VARCHAR AS link FROM works UNION ALL SELECT id, CASE WHEN coalesce(title, '') = '' THEN 's ' || id::VARCHAR ELSE trim({SPACE.format('title')}, ' ') END, author, 'https://letters.posts.example.org/p/s-' || id::VARCHAR FROM works"),
    "item_files": (lambda c: pages.item_files(c.files.filter("work_id is not null").groupBy(F.col("work_id").cast("string").alias("identifier")).agg(F.to_json(F.struct(F.collect_list(F.struct(F.concat(F.lit("f"), F.col("id").cast("string")).alias("name"), "format", (F.col("id") * 1000).cast("string").alias("size"))).alias("files"))).alias("metadata")), "https://a.example.org"), "SELECT work_id::VARCHAR AS identifier, 'f' || id::VARCHAR AS name, format, CASE WHEN id * 1000 > 1048576 THEN format('{:.2f} MB', id * 1000 / 1048576.0) ELSE format('{:.2f} KB', id * 1000 / 1024.0) END AS size, 'https://a.example.org/download/' || work_id::VARCHAR || '/f' || id::VARCHAR AS link FROM files WHERE work_id IS NOT NULL AND regexp_matches(lower(coalesce(format, '')), 'pdf|epub|mobi|kindle|text|daisy|torrent')"),
    # --- full text
    "fts_query": (lambda c: search.match_query(c.documents, 'lantern "of the"'), None),
    "fts_search": (lambda c: search.search(c, ["treaty", "siege"], limit=10, offset=5), _bm25_sql(["treaty", "siege"]).replace("SELECT doc_id, round(0.0", ", sc AS (SELECT doc_id, round(0.0", 1) + f"), hit AS (SELECT doc_id FROM documents WHERE list_contains({TOKENS.format('text')}, 'treaty') AND list_contains({TOKENS.format('text')}, 'siege')) SELECT rank::INT AS rank, doc_id, title, site, score FROM (SELECT row_number() OVER (ORDER BY score, sc.doc_id DESC) AS rank, sc.doc_id, t.title, t.site, score FROM sc JOIN hit ON hit.doc_id = sc.doc_id JOIN texts t ON t.doc_id = sc.doc_id) WHERE rank BETWEEN 6 AND 15"),
    "fts_snippet": (lambda c: search.snippets(c.documents, "treaty"), f"""WITH w AS (SELECT doc_id, string_split(trim(regexp_replace(text, '[\\s\\x0b]+', ' ', 'g'), ' '), ' ') ws FROM documents WHERE text IS NOT NULL), p AS (SELECT *, list_position(list_transform(ws, lambda x: {ACCENTS.format("regexp_replace(x, '^[^\\p{L}\\p{N}]+|[^\\p{L}\\p{N}]+$', '', 'g')")}), 'treaty') i FROM w)
      SELECT doc_id, trim(concat_ws(' ', array_to_string(ws[greatest(1, i - 6):i - 1], ' '), '<mark>' || ws[i] || '</mark>', array_to_string(ws[i + 1:i + 6], ' ')), ' ') AS snippet FROM p WHERE i > 0"""),
    "fts_sync_diff": (lambda c: search.sync_diff(c, _indexed(c)), """WITH i AS (SELECT doc_id, max(text_sha256) digest FROM extractions JOIN documents USING (text_uri) WHERE text_uri IS NOT NULL GROUP BY 1), n AS (SELECT doc_id, sha256(text) now FROM documents WHERE text IS NOT NULL)
      SELECT doc_id, action FROM (SELECT coalesce(n.doc_id, i.doc_id) AS doc_id, CASE WHEN n.now IS NULL THEN 'delete' WHEN i.digest IS NULL THEN 'insert' WHEN i.digest <> n.now THEN 'update' END AS action FROM n FULL JOIN i ON i.doc_id = n.doc_id) WHERE action IS NOT NULL"""),
    "fts_stale_rows": (lambda c: search.stale_rows(c, c.documents.select("doc_id")), CTE + f"SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT d.doc_id FROM documents d JOIN ch ON ch.text_uri = d.text_uri WHERE d.text IS NOT NULL AND {USABLE.replace('text_uri', 'ch.text_uri')})"),
    "fts_index": (lambda c: live.indexed_search(c, ["history", "treaty", "lantern"]), _bm25_sql(["history", "treaty", "lantern"])),
    # --- builds
    "corpus_select_query": (lambda c: corpus.keys(c, query="histor").select("doc_id", "extraction_id"), CTE + f", sel AS (SELECT d.doc_id, ch.extraction_id, concat_ws(chr(10), w.title, w.author, w.search_query, ch.category) h FROM ch JOIN works w ON w.id = ch.work_id JOIN documents d ON d.text_uri = ch.text_uri WHERE d.text IS NOT NULL AND {USABLE.replace('text_uri', 'ch.text_uri')}) SELECT doc_id, extraction_id FROM sel WHERE contains(translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'histor')"),
    "corpus_select_munged": (lambda c: corpus.keys(c, munges=_munges(c).filter("status = 'processed'")).select("doc_id", "extraction_id", "text_sha256"), SELECTED + f", {MUNGES} SELECT doc_id, sel.extraction_id, m.sha256 AS text_sha256 FROM sel JOIN munges m ON m.extraction_id = sel.extraction_id WHERE m.status = 'processed'"),
    "corpus_text": (lambda c: corpus.combined(c, PAIRS).select("item_index", T.digest(F.col("block")).alias("sha")), SELECTED + f""", n AS (SELECT *, {SUBSTITUTED} x, row_number() OVER (ORDER BY lower(coalesce(title, '')), lower(coalesce(author, '')), text_sha256 NULLS FIRST, extraction_id, doc_id) AS item_index FROM sel)
      SELECT item_index, sha256('--- BEGIN DOCUMENT ' || item_index::VARCHAR || ' ---' || chr(10) || 'title: ' || coalesce(title, '') || chr(10) || 'author: ' || coalesce(author, '') || chr(10) || 'source_text_sha256: ' || coalesce(text_sha256, '') || chr(10) || 'transformed_sha256: ' || sha256(x) || chr(10) || x || chr(10) || '--- END DOCUMENT ' || item_index::VARCHAR || ' ---') AS sha FROM n"""),
    "corpus_manifest_items": (lambda c: corpus.manifest_items(corpus.items(c, PAIRS)).select("item_index", T.digest(F.col("json")).alias("sha")), SELECTED.replace("d.text FROM ch", "d.text, d.text_uri, ch.work_id, ch.format FROM ch") + f""", n AS (SELECT *, {SUBSTITUTED} x, row_number() OVER (ORDER BY lower(coalesce(title, '')), lower(coalesce(author, '')), text_sha256 NULLS FIRST, extraction_id, doc_id) AS item_index FROM sel), q AS (SELECT *, '"' || replace(replace(title, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"' jt, '"' || replace(replace(author, chr(92), chr(92) || chr(92)), '"', chr(92) || '"') || '"' ja FROM n)
      SELECT item_index, sha256('{{"author":' || coalesce(ja, 'null') || ',"category":"' || category || '","char_count":' || length(x)::VARCHAR || ',"extraction_id":' || extraction_id::VARCHAR || ',"format":' || coalesce('"' || format || '"', 'null') || ',"item_index":' || item_index::VARCHAR || ',"site":' || coalesce('"' || site || '"', 'null') || ',"text_sha256":' || coalesce('"' || text_sha256 || '"', 'null') || ',"text_uri":"' || text_uri || '","title":' || coalesce(jt, 'null') || ',"transformed_sha256":"' || sha256(x) || '","work_id":' || work_id::VARCHAR || '}}') AS sha FROM q"""),
    "corpus_manifest": (lambda c: corpus.manifest(c, "all"), None),
    "corpus_build_path": (lambda c: c.read("corpus_specs").select("id", F.concat_ws("/", T.safe_segment(F.col("name")), F.substring(T.digest(F.col("name")), 1, 16)).alias("path")), "SELECT id, concat_ws('/', name, substring(sha256(name), 1, 16)) AS path FROM corpus_specs"),
    # --- notes
    "memory_search": (lambda c: notes.search(_notes(c), '"K": 7'), NOTES + " SELECT n, kind, content FROM notes WHERE contains(lower(content), '\"k\": 7') OR contains(lower(metadata), '\"k\": 7') ORDER BY n DESC LIMIT 20"),
    "memory_should_compact": (lambda c: notes.should_compact(_notes(c)), NOTES + " SELECT greatest(1, (sum(length(content) + 1) - 1) // 4)::BIGINT AS tokens, 18022::BIGINT AS threshold, greatest(1, (sum(length(content) + 1) - 1) // 4) > 18022 AS compact FROM notes"),
    "memory_compact": (lambda c: notes.compacted(_notes(c)), NOTES + """, s AS (SELECT 1 p, n, kind, content FROM notes WHERE kind = 'summary' ORDER BY n DESC LIMIT 3), o AS (SELECT * FROM notes WHERE kind <> 'summary' ORDER BY n DESC LIMIT 25), u AS (SELECT * FROM s UNION ALL SELECT 2, 0, 'summary', string_agg('[' || kind || '] ' || content, chr(10) ORDER BY n) FROM o UNION ALL SELECT * FROM (SELECT 3, n, kind, content FROM o ORDER BY n DESC LIMIT 10))
      SELECT row_number() OVER (ORDER BY p, n)::INT AS place, kind, content FROM u"""),
    "context_lengths": (lambda c: notes.context_length(c.works.select(F.col("id").cast("string").alias("id"), F.concat(F.lit("s"), F.col("id").cast("string")).alias("slug"), F.when(F.col("id") % 2 == 0, F.col("id") * 10).alias("provider_length"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("length")), c.files.select(F.concat(F.when(F.col("id") % 2 == 0, "s").otherwise(""), F.col("id").cast("string")).alias("model"))), "SELECT CASE WHEN f.id % 2 = 0 THEN 's' ELSE '' END || f.id::VARCHAR AS model, coalesce(CASE WHEN w.id % 2 = 0 THEN w.id * 10 END, CASE WHEN w.id % 3 = 0 THEN w.id END, 32768) AS context FROM files f LEFT JOIN works w ON w.id = f.id"),
    # --- streams that are started and run until their input is used up
    "live_hourly": (live.hourly_dashboard, "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"),
    "live_status": (live.status_feed, "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1"),
    "live_sliding": (live.sliding, "WITH w AS (SELECT event_type, unnest([date_trunc('hour', ts), date_trunc('hour', ts) - INTERVAL 1 HOUR]) h FROM events) SELECT strftime(h, '%Y-%m-%d %H:00') AS start, event_type, count(*) AS n FROM w GROUP BY 1, 2"),
    "live_joined": (live.clicks_after_views, "SELECT v.user_id, v.event_id AS view_id, c.event_id AS click_id FROM events v JOIN events c ON c.user_id = v.user_id AND v.event_type = 'view' AND c.event_type = 'click' AND c.ts >= v.ts AND c.ts <= v.ts + INTERVAL 30 MINUTE"),
    "live_workers": (live.sequential_workers, "WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) i, event_type = 'error' AS e FROM events), f AS (SELECT user_id, min(i) FILTER (e) k, count(*) n FROM r GROUP BY 1) SELECT user_id, coalesce(k - 1, n) AS done, k IS NOT NULL AS stopped, n - coalesce(k, n) AS queued FROM f"),
}


def _sites(c: Catalog, trust: str | None, template: str, where: str = "true") -> DataFrame:
    base = F.concat(F.lit("https://"), "site", F.lit("/"))
    url = F.when(F.lit(template) != "", F.concat(F.lit("https://"), "site", F.lit(template)))
    return c.files.filter(where).filter("site is not null").select("site").distinct().select(F.col("site").alias("name"), base.alias("base_url"), url.alias("search_url_template"), F.lit(trust).cast("string").alias("trust_level"), F.lit(None).cast("boolean").alias("enabled"))


def _mirrors(c: Catalog) -> DataFrame:
    k, n = F.col("id") % 4, F.col("id").cast("string")
    link = F.when(k == 0, F.concat(F.lit("https://x.mirror.example/slow_download/"), n, F.lit("?t=1"))).when(k == 1, F.concat(F.lit("https://x.mirror.example/md5/"), n)).when(k == 2, F.concat(F.lit("https://x.mirror.example/fast_download/"), n)).otherwise(F.col("url"))
    return c.files.filter("url is not null").select(F.col("work_id").cast("string").alias("page_url"), link.alias("link"), F.when(F.col("id") % 8 == 0, "Waitlist").otherwise("Server").alias("label"))


def _rules(c: Catalog) -> DataFrame:
    text, (a, b) = T.apply_rules(F.col("text"), RULES)
    return _texts(c).select("doc_id", T.digest(text).alias("sha"), a.alias("a"), b.alias("b"), F.regexp_count("text", F.lit("[0-9]+")).alias("m")).filter("m <= 1000").drop("m")


def _indexed(c: Catalog) -> DataFrame:
    return c.extractions.filter("text_uri is not null").join(c.documents.select("doc_id", "text_uri"), "text_uri").groupBy("doc_id").agg(F.max("text_sha256").alias("digest"))
