"""The registered queries of the catalogue, and the SQL that gives the same rows on the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.catalog import Catalog, latest
from quire.functions import text as T
from quire.functions import urls as U
from quire.operators import analytics, corpus, merge, queues, search, titles
from quire.predicates import effective_url, format_rank, size_bytes
from quire.streaming import feeds

#: Names that several queries start from. ``dl`` is the newest download of each file, ``ch`` the left-joined chain.
EFF = "coalesce(nullif(download_url, ''), url, '')"
HOST = f"lower(regexp_extract({EFF}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1))"
PATH = f"regexp_extract({EFF}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
SCHEME = f"lower(regexp_extract({EFF}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"
TORRENT = f"(contains(lower(coalesce(format, '')), 'torrent') OR ends_with(lower({PATH}), '.torrent') OR contains(lower(coalesce(download_source, '')), 'torrent'))"
RUNS = f"(({SCHEME} IN ('http', 'https') AND {HOST} <> '' AND NOT ends_with({HOST}, '.onion') AND NOT {TORRENT}) OR ({SCHEME} = 'file' AND {PATH} <> ''))"
CTE = f"""
WITH dl AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY updated_at DESC NULLS LAST, id DESC) rn FROM downloads) WHERE rn = 1),
ch AS (SELECT f.id file_id, f.work_id, f.site, f.format, f.url, f.file_size, f.download_url, f.trust_level, f.download_disabled_at, d.id download_id, d.status download_status,
  d.bytes, d.attempts, d.error, d.scan_status, e.id extraction_id, e.extractor, e.status extraction_status, e.text_uri, e.text_sha256, e.char_count, e.category, e.quality_status, e.processed_at
  FROM files f LEFT JOIN dl d ON d.file_id = f.id LEFT JOIN extractions e ON e.download_id = d.id),
blocked AS (SELECT DISTINCT work_id FROM ch WHERE download_status IN ('pending','downloading') OR (download_status = 'downloaded' AND (extraction_id IS NULL OR extraction_status IN ('pending','processing')
  OR (extraction_status = 'processed' AND coalesce(quality_status, 'usable') <> 'unusable')))),
untried AS (SELECT f.id file_id, f.* EXCLUDE (id) FROM files f WHERE coalesce(f.download_url, f.url, '') <> '' AND f.id NOT IN (SELECT file_id FROM dl WHERE file_id IS NOT NULL)),
pending AS (SELECT u.*, coalesce(nullif(u.download_url, ''), u.url) eff FROM untried u WHERE u.work_id NOT IN (SELECT work_id FROM blocked WHERE work_id IS NOT NULL)),
runnable AS (SELECT * FROM pending WHERE {RUNS}),
act AS (SELECT DISTINCT ON (download_id) ch.*, d.updated_at AS d_updated FROM ch JOIN dl d ON d.id = ch.download_id WHERE download_status = 'failed' AND download_disabled_at IS NULL AND coalesce(download_url, url, '') <> ''
  AND ch.work_id NOT IN (SELECT work_id FROM blocked WHERE work_id IS NOT NULL) AND ch.work_id NOT IN (SELECT work_id FROM untried WHERE download_disabled_at IS NULL AND work_id IS NOT NULL))
"""
USABLE = "coalesce(extraction_status = 'processed' AND text_uri IS NOT NULL AND coalesce(quality_status, 'usable') <> 'unusable', false)"
RANK = "CASE " + " ".join(f"WHEN contains(lower(coalesce(format, '')), '{n}') THEN {v}" for n, v in (("text", 0), ("txt", 0), ("muse", 0), ("htm", 1), ("epub", 2), ("fb2", 3), ("rtf", 3), ("docx", 4), ("doc", 5), ("pdf", 6), ("mobi", 7), ("kindle", 7), ("azw", 8), ("daisy", 9), ("djvu", 10), ("torrent", 99))) + " ELSE 50 END"
SIZE = "coalesce(try_cast(regexp_extract(lower(coalesce(file_size, '')), '([0-9.]+)\\s*(b|kb|mb|gb)?', 1) AS DOUBLE) * CASE regexp_extract(lower(coalesce(file_size, '')), '([0-9.]+)\\s*(b|kb|mb|gb)?', 2) WHEN 'gb' THEN 1073741824.0 WHEN 'mb' THEN 1048576.0 WHEN 'kb' THEN 1024.0 ELSE 1.0 END, 1e12)"
BEST = f"row_number() OVER (PARTITION BY work_id ORDER BY {RANK}, {SIZE}, {EFF}, file_id::VARCHAR) rn"
BLANK = "[ \\t\\r\\n\\f]+"
TRIM = "regexp_replace({}, '^[ \\t\\r\\n\\f]+|[ \\t\\r\\n\\f]+$', '', 'g')"
NORMAL = TRIM.format("regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")
CORPUS = TRIM.format("regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '[ \\t]+', ' ', 'g'), ' ?\\n ?', chr(10), 'g'), '\\n{3,}', chr(10) || chr(10), 'g')")
ACCENTS = f"translate(lower(coalesce({{}}, '')), '{search.ACCENTED}', '{search.PLAIN}')"
TOKENS = "regexp_extract_all(" + ACCENTS + ", '[\\p{{L}}\\p{{N}}]+')"
BODY = f"tok AS (SELECT doc_id, unnest({TOKENS.format('text')}) token, generate_subscripts({TOKENS.format('text')}, 1) - 1 pos FROM documents)"
SELECTED = CTE + f""", sel AS (SELECT d.doc_id, ch.extraction_id, w.title, w.author, coalesce(ch.category, 'uncategorized') category, ch.site, ch.text_sha256, d.text FROM ch JOIN works w ON w.id = ch.work_id
  JOIN documents d ON d.text_uri = ch.text_uri WHERE d.text IS NOT NULL AND {USABLE.replace('text_uri', 'ch.text_uri')})"""
TEXTS = CTE + """, newest AS (SELECT text_uri, work_id, site, category FROM (SELECT *, row_number() OVER (PARTITION BY text_uri ORDER BY extraction_id DESC, work_id DESC) rn FROM ch WHERE text_uri IS NOT NULL) WHERE rn = 1),
  texts AS (SELECT d.doc_id, w.title, w.author, coalesce(n.category, 'uncategorized') category, n.site, d.text body FROM documents d JOIN newest n ON n.text_uri = d.text_uri LEFT JOIN works w ON w.id = n.work_id WHERE d.text IS NOT NULL)"""
PAIRS = [("ﬁ", "fi"), ("“", '"'), ("”", '"')]
SUBSTITUTED = "replace(replace(replace(" + CORPUS + ", 'ﬁ', 'fi'), '“', '\"'), '”', '\"')"

Entry = tuple[Callable[[Catalog], DataFrame], str | None]


def _docs(c: Catalog) -> DataFrame:
    return c.documents.select("doc_id", "text")


def _texts(c: Catalog) -> DataFrame:
    return _docs(c).filter("text is not null")


def _scalar(name: str, make: Callable) -> Callable[[Catalog], DataFrame]:
    return lambda c: _texts(c).select("doc_id", make(F.col("text")).alias(name))


def _text_sql(name: str, expression: str) -> str:
    return f"SELECT doc_id, {expression} AS {name} FROM documents WHERE text IS NOT NULL"


def _bm25_sql(terms: list[str]) -> str:
    fields = " UNION ALL ".join(f"SELECT doc_id, {w} w, unnest({TOKENS.format(f)}) token FROM texts" for f, w in search.WEIGHTS.items())
    tf = ", ".join(f"sum(CASE WHEN token = '{t}' THEN w ELSE 0 END) tf{k}" for k, t in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (tf{k} > 0) df{k}" for k in range(len(terms)))
    zero = ", ".join(f"coalesce(tf{k}, 0) tf{k}" for k in range(len(terms)))
    idf = "ln((n - df{0} + 0.5) / (df{0} + 0.5))"
    score = " ".join(f"- CASE WHEN {idf.format(k)} > 0 THEN {idf.format(k)} ELSE 1e-6 END * tf{k} * 2.2 / (tf{k} + 1.2 * (0.25 + 0.75 * size / mean))" for k in range(len(terms)))
    some = " OR ".join(f"tf{k} > 0" for k in range(len(terms)))
    return f"""{TEXTS}, words AS ({fields}), counted AS (SELECT doc_id, count(*) size, {tf} FROM words GROUP BY doc_id),
      per AS (SELECT t.doc_id, coalesce(size, 0) size, {zero} FROM texts t LEFT JOIN counted USING (doc_id)), total AS (SELECT count(*) n, avg(size) mean, {df} FROM per)
      SELECT doc_id, round(0.0 {score}, 6) AS score FROM per, total WHERE {some}"""


def _list_sql(where: str = "", extra: str = "") -> str:
    return CTE + f""", page AS (SELECT * FROM works w {where} ORDER BY created_at DESC NULLS LAST, id DESC LIMIT 50 {extra})
      SELECT p.id, p.title, p.author, coalesce(count(DISTINCT file_id), 0) AS files, count(DISTINCT CASE WHEN download_status = 'downloaded' THEN file_id END) AS downloaded,
      count(DISTINCT CASE WHEN {USABLE} THEN extraction_id END) AS usable FROM page p LEFT JOIN ch ON ch.work_id = p.id GROUP BY p.id, p.title, p.author"""


FOLD_SQL = """SELECT file_id, count(*) AS events, arg_max(status, (coalesce(updated_at, TIMESTAMP '1900-01-01'), id)) AS status, arg_max(error, (coalesce(updated_at, TIMESTAMP '1900-01-01'), id)) FILTER (error IS NOT NULL) AS last_error FROM downloads GROUP BY file_id"""
Q_TIME = "SELECT strftime({c}, '{p}') AS bucket, count(*) AS n{t} FROM {f} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 90"


def _fold(c: Catalog) -> DataFrame:
    events = c.read("downloads").withColumn("at", F.coalesce("updated_at", F.lit("1900-01-01").cast("timestamp_ntz")))
    return merge.fold_events(events, "file_id", ["at", "id"])


ENTRIES: dict[str, Entry] = {
    "summary": (analytics.summary, CTE + f"""SELECT count(DISTINCT work_id) AS works, count(DISTINCT file_id) AS files, sum(bytes)::BIGINT AS bytes, sum(CASE WHEN extraction_status = 'processed' THEN char_count END)::BIGINT AS chars,
      count(DISTINCT CASE WHEN download_status = 'downloaded' THEN file_id END) AS downloaded, count(DISTINCT CASE WHEN download_status = 'failed' THEN file_id END) AS failed, count(DISTINCT CASE WHEN download_id IS NULL THEN file_id END) AS untried,
      count(DISTINCT CASE WHEN extraction_status = 'processed' THEN extraction_id END) AS processed, count(DISTINCT CASE WHEN extraction_status = 'failed' THEN extraction_id END) AS extraction_failed,
      count(DISTINCT CASE WHEN extraction_status = 'skipped' THEN extraction_id END) AS skipped, count(DISTINCT CASE WHEN {USABLE} THEN extraction_id END) AS usable_texts FROM ch"""),
    "site_breakdown": (analytics.site_breakdown, CTE + f"""SELECT site, count(DISTINCT work_id) AS works, count(file_id) AS files, count(*) FILTER (download_status = 'downloaded') AS downloaded, count(*) FILTER (download_status = 'failed') AS failed,
      count(*) FILTER (download_status IN ('pending','downloading')) AS active, count(*) FILTER (trust_level <> 'trusted') AS untrusted, count(*) FILTER (extraction_status = 'processed') AS processed, count(*) FILTER ({USABLE}) AS usable,
      coalesce(sum(bytes), 0)::BIGINT AS bytes, coalesce(sum(char_count) FILTER (extraction_status = 'processed'), 0)::BIGINT AS chars FROM ch GROUP BY site
      UNION ALL SELECT 'nowhere.example.org', 0, 0, 0, 0, 0, 0, 0, 0, 0, 0 WHERE NOT EXISTS (SELECT 1 FROM files WHERE site = 'nowhere.example.org')"""),
    "format_breakdown": (analytics.format_breakdown, CTE + f"SELECT coalesce(format, 'unknown') AS format, count(file_id) AS files, count(*) FILTER (download_status = 'downloaded') AS downloaded, count(*) FILTER (download_status = 'failed') AS failed, count(*) FILTER (extraction_status = 'processed') AS processed, count(*) FILTER ({USABLE}) AS usable FROM ch GROUP BY 1"),
    "trust_breakdown": (analytics.trust_breakdown, CTE + f"SELECT coalesce(trust_level, 'trusted') AS trust_level, count(*) AS rows, count(*) FILTER (download_status = 'downloaded') AS downloaded, count(*) FILTER (download_status = 'failed') AS failed, count(*) FILTER (scan_status = 'infected') AS infected, count(*) FILTER (extraction_status = 'processed') AS processed, count(*) FILTER ({USABLE}) AS usable FROM ch GROUP BY 1"),
    "category_breakdown": (analytics.category_breakdown, CTE + "SELECT coalesce(category, 'unprocessed') AS category, count(*) AS rows, coalesce(sum(char_count), 0)::BIGINT AS chars, coalesce(category, 'unprocessed') IN (SELECT name FROM categories) AS known FROM ch WHERE download_status = 'downloaded' GROUP BY 1"),
    "category_counts": (analytics.category_counts, "SELECT c.name, c.dynamic, count(e.id) AS texts, coalesce(sum(e.char_count), 0)::BIGINT AS chars FROM categories c LEFT JOIN extractions e ON e.category = c.name GROUP BY 1, 2"),
    "timeseries_works": (lambda c: analytics.timeseries(c.works, "created_at", "day"), Q_TIME.format(c="created_at", p="%Y-%m-%d", t="", f="works")),
    "timeseries_downloads": (lambda c: analytics.timeseries(c.downloads.filter("status = 'downloaded'"), "downloaded_at", "hour", "bytes"), CTE + Q_TIME.format(c="downloaded_at", p="%Y-%m-%d %H:00", t=", coalesce(sum(bytes), 0)::BIGINT AS total", f="(SELECT * FROM dl WHERE status = 'downloaded')")),
    "timeseries_extractions": (lambda c: analytics.timeseries(c.extractions, "processed_at", "day", "char_count"), Q_TIME.format(c="processed_at", p="%Y-%m-%d", t=", coalesce(sum(char_count), 0)::BIGINT AS total", f="extractions")),
    "list_works": (analytics.list_works, _list_sql()),
    "list_works_page": (lambda c: analytics.list_works(c, offset=50), _list_sql(extra="OFFSET 50")),
    "list_works_q": (lambda c: analytics.list_works(c, query="History"), _list_sql("WHERE contains(translate(title, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'history') OR contains(translate(author, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'history') OR contains(translate(search_query, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), 'history')")),
    "list_works_site": (lambda c: analytics.list_works(c, site="stacks.example.org"), _list_sql("WHERE EXISTS (SELECT 1 FROM files f WHERE f.work_id = w.id AND f.site = 'stacks.example.org')")),
    "get_work": (lambda c: c.works.filter("id = 7").select("id", "title", "author", "search_query"), "SELECT id, title, author, search_query FROM works WHERE id = 7"),
    "list_files": (lambda c: analytics.list_files(c, extraction="processed", site="stacks.example.org"), CTE + "SELECT file_id, extraction_id, work_id, site, format, coalesce(download_status, 'pending') AS download_state, coalesce(extraction_status, 'pending') AS extraction_state FROM ch WHERE coalesce(extraction_status, 'pending') = 'processed' AND site = 'stacks.example.org' ORDER BY file_id DESC, extraction_id DESC NULLS LAST LIMIT 100"),
    "list_texts": (lambda c: analytics.list_texts(c, quality="unvalidated"), CTE + "SELECT extraction_id, file_id, w.title, site, coalesce(quality_status, 'unvalidated') AS quality, coalesce(category, 'uncategorized') AS label, char_count FROM ch JOIN works w ON w.id = ch.work_id WHERE extraction_status = 'processed' AND text_uri IS NOT NULL AND coalesce(quality_status, 'unvalidated') = 'unvalidated' ORDER BY extraction_id DESC, file_id DESC LIMIT 100"),
    "works_with_files": (analytics.works_with_files, "SELECT w.id AS work_id, w.title, count(f.id) AS files, coalesce(array_to_string(list_sort(list(DISTINCT f.format) FILTER (f.format IS NOT NULL)), ','), '') AS formats FROM works w LEFT JOIN files f ON f.work_id = w.id GROUP BY 1, 2"),
    "recent_activity": (analytics.recent_activity, CTE + ", al AS (SELECT 'work' AS kind, id, created_at AS t FROM works UNION ALL SELECT 'download', id, updated_at FROM dl UNION ALL SELECT 'extraction', id, processed_at FROM extractions) SELECT kind, id, strftime(t, '%Y-%m-%d %H:%M:%S') AS \"at\" FROM (SELECT * FROM al WHERE t IS NOT NULL ORDER BY t DESC, kind, id DESC LIMIT 25)"),
    "usable_texts": (lambda c: c.chain.filter(analytics.usable_text()).select("extraction_id", "file_id", "char_count"), CTE + f"SELECT extraction_id, file_id, char_count FROM ch WHERE {USABLE}"),
    "format_rank": (lambda c: c.files.select("id", format_rank(F.col("format")).alias("rank")), f"SELECT id, {RANK} AS rank FROM files"),
    "size_rank": (lambda c: c.files.select("id", size_bytes(F.col("file_size")).alias("size")), f"SELECT id, {SIZE} AS size FROM files"),
    "runnable_candidates": (lambda c: queues.runnable(queues.pending_files(c)).select("file_id", "work_id"), CTE + "SELECT file_id, work_id FROM runnable"),
    "pending_extractions": (queues.pending_extractions, CTE + "SELECT id AS download_id, file_id, bytes FROM dl WHERE status = 'downloaded' AND NOT EXISTS (SELECT 1 FROM extractions e WHERE e.download_id = dl.id AND e.extractor = 'plaintext.v2')"),
    "unusable_texts": (queues.unusable_texts, "SELECT id, download_id, char_count FROM extractions WHERE status = 'processed' AND quality_status = 'unusable'"),
    "work_activity": (queues.work_activity, CTE + "SELECT id AS work_id, id IN (SELECT work_id FROM blocked WHERE work_id IS NOT NULL) AS active FROM works"),
    "text_preview": (lambda c: _texts(c).select("doc_id", F.substring("text", 1, 200).alias("preview"), (F.length("text") > 200).alias("truncated")), "SELECT doc_id, substring(text, 1, 200) AS preview, length(text) > 200 AS truncated FROM documents WHERE text IS NOT NULL"),
    "normalize_text": (_scalar("out", lambda t: T.digest(T.normalize(t))), _text_sql("out", f"sha256({NORMAL})")),
    "corpus_normalize": (_scalar("out", lambda t: T.digest(T.corpus_normalize(t))), _text_sql("out", f"sha256({CORPUS})")),
    "collapse_ws": (_scalar("out", lambda t: T.digest(T.collapse(t))), _text_sql("out", f"sha256(trim(regexp_replace(text, '{BLANK}', ' ', 'g'), ' '))")),
    "status_message": (_scalar("out", lambda t: T.shorten(T.collapse(t), 500)), _text_sql("out", f"CASE WHEN length(trim(regexp_replace(text, '{BLANK}', ' ', 'g'), ' ')) > 500 THEN rtrim(substring(trim(regexp_replace(text, '{BLANK}', ' ', 'g'), ' '), 1, 497), ' ') || '...' ELSE trim(regexp_replace(text, '{BLANK}', ' ', 'g'), ' ') END")),
    "text_sha256": (_scalar("sha", T.digest), _text_sql("sha", "sha256(text)")),
    "dehyphenate": (_scalar("out", lambda t: T.digest(T.dehyphenate(t))), _text_sql("out", "sha256(regexp_replace(text, '([A-Za-z]{2,})-\\n([a-z]{2,})', '\\1\\2', 'g'))")),
    "unwrap_paragraphs": (_scalar("out", lambda t: T.digest(T.unwrap(t))), _text_sql("out", """sha256(array_to_string(list_filter(list_transform(regexp_split_to_array(text, '\\n{2,}'), lambda p: (list_transform([list_filter(list_transform(string_split(p, chr(10)), lambda x: regexp_replace(x, '^[ \\t\\r]+|[ \\t\\r]+$', '', 'g')), lambda x: x <> '')],
      lambda ls: CASE WHEN len(ls) <= 1 OR len(list_filter(ls, lambda x: regexp_matches(x, '^([-*•]|[0-9]+[.)])[ \\t]+'))) > 0 OR (len(list_filter(ls, lambda x: length(x) > 72)) = 0 AND len(ls) <= 8) THEN array_to_string(ls, chr(10)) ELSE array_to_string(ls, ' ') END))[1]), lambda p: p <> ''), chr(10) || chr(10)))""")),
    "running_lines": (lambda c: T.running_lines(_texts(c)), """WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) line_no FROM documents WHERE text IS NOT NULL),
      k AS (SELECT doc_id, line_no, regexp_replace(regexp_replace(line, '\\r$', ''), '^[ \\t]+|[ \\t]+$', '', 'g') bare FROM l), m AS (SELECT *, regexp_replace(lower(bare), '[0-9]+', '#', 'g') AS key FROM k),
      n AS (SELECT *, count(*) OVER (PARTITION BY doc_id, key) AS cnt FROM m) SELECT doc_id, line_no::INT AS line_no FROM n WHERE regexp_matches(bare, '^[-–— ]*[0-9]+[-–— ]*$') OR (cnt >= 3 AND length(key) BETWEEN 1 AND 90)"""),
    "quality_heuristic": (lambda c: _docs(c).select("doc_id", T.quality_heuristic(F.col("text")).alias("q")).select("doc_id", "q.status", "q.score"), f"""WITH t AS (SELECT doc_id, coalesce(text, '') text FROM documents), m AS (SELECT doc_id, text, {TRIM.format('text')} bare, length(text) - length(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f-\\x{{9f}}]', '', 'g')) c,
      length(text) - length(replace(text, chr(65533), '')) r, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]{{3,}}')) w, greatest(length(text), 1) n FROM t), v AS (SELECT doc_id, CASE WHEN bare = '' THEN 0.0 WHEN contains(substring(text, 1, 200), chr(0)) OR starts_with(text, chr(31) || chr(65533)) OR starts_with(text, chr(31) || chr(139)) OR starts_with(text, chr(139)) THEN 0.02 WHEN c / n > 0.03 THEN 0.05 WHEN r / n > 0.02 THEN 0.1 WHEN length(bare) < 120 OR w < 12 THEN 0.45 ELSE 0.75 END::DOUBLE AS score FROM m)
      SELECT doc_id, CASE WHEN score < 0.2 THEN 'unusable' WHEN score < 0.5 THEN 'suspect' ELSE 'usable' END AS status, score FROM v"""),
    "useful_text_gate": (lambda c: _docs(c).select("doc_id", T.useful(F.col("text")).alias("useful")), "SELECT doc_id, length(regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]', '', 'g')) >= 200 AS useful FROM documents"),
    "category_slug": (lambda c: c.extractions.select("id", T.slug(F.col("category")).alias("slug")), "SELECT id, coalesce(nullif(trim(regexp_replace(lower(coalesce(category, '')), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'uncategorized') AS slug FROM extractions"),
    "storage_key": (lambda c: c.files.select("id", F.concat_ws("/", T.safe_segment(F.col("site")), F.col("work_id").cast("string"), F.col("id").cast("string"), F.substring(T.digest(F.coalesce("url", F.lit(""))), 1, 16)).alias("key")),
      "SELECT id, concat_ws('/', coalesce(nullif(substring(regexp_replace(regexp_replace(lower(coalesce(site, '')), '[^a-z0-9._-]+', '-', 'g'), '^[.-]+|[.-]+$', '', 'g'), 1, 96), ''), 'unknown'), work_id::VARCHAR, id::VARCHAR, substring(sha256(coalesce(url, '')), 1, 16)) AS key FROM files"),
    "token_estimate": (_scalar("tokens", lambda t: F.greatest(F.lit(1), F.floor(F.length(t) / 4)).cast("long")), _text_sql("tokens", "greatest(1, length(text) // 4)::BIGINT")),
    "url_parts": (lambda c: c.files.select("id", *[U.part(effective_url(), n).alias(n) for n in ("scheme", "host", "path", "query")]), """WITH u AS (SELECT id, coalesce(nullif(download_url, ''), url, '') u FROM files) SELECT id, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme, lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)) AS host,
      regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(u, '^[^?#]*\\?([^#]*)', 1) AS query FROM u"""),
    "url_format": (lambda c: c.files.select("id", U.link_format(effective_url()).alias("format")), "WITH u AS (SELECT id, lower(regexp_extract(coalesce(nullif(download_url, ''), url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)) p FROM files) SELECT id, CASE " + " ".join(f"WHEN ends_with(p, '{s}') THEN '{n}'" for s, n in U.SUFFIXES) + " END AS format FROM u"),
    "dedupe_queries": (titles.distinct_queries, "WITH q AS (SELECT id, trim(regexp_replace(search_query, '[ \\t\\r\\n\\f]+', ' ', 'g'), ' ') query FROM works) SELECT id, query FROM (SELECT *, row_number() OVER (PARTITION BY lower(query) ORDER BY id) rn FROM q WHERE query <> '') WHERE rn = 1"),
    "freshness": (titles.freshness, CTE + """, a AS (SELECT id, date_diff('second', date_trunc('second', updated_at), TIMESTAMP '2025-01-01 00:00:00') s FROM dl) SELECT id, coalesce(CASE WHEN s < 60 THEN s::VARCHAR || 's' WHEN s < 3600 THEN (s // 60)::VARCHAR || 'm' WHEN s < 172800 THEN (s // 3600)::VARCHAR || 'h' ELSE (s // 86400)::VARCHAR || 'd' END, 'never') AS age, coalesce(s >= 1800, true) AS stale FROM a"""),
    "quality_summary": (lambda c: _docs(c).select(T.quality_heuristic(F.col("text"))["status"].alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n")), f"""WITH t AS (SELECT doc_id, coalesce(text, '') text FROM documents), m AS (SELECT {TRIM.format('text')} bare, text, length(text) - length(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0e-\\x1f\\x7f-\\x{{9f}}]', '', 'g')) c,
      length(text) - length(replace(text, chr(65533), '')) r, len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]{{3,}}')) w, greatest(length(text), 1) n FROM t) SELECT CASE WHEN bare = '' OR contains(substring(text, 1, 200), chr(0)) OR starts_with(text, chr(31) || chr(65533)) OR starts_with(text, chr(31) || chr(139)) OR starts_with(text, chr(139)) OR c / n > 0.03 OR r / n > 0.02 THEN 'unusable' WHEN length(bare) < 120 OR w < 12 THEN 'suspect' ELSE 'usable' END AS status, count(*) AS n FROM m GROUP BY 1"""),
    "fts_tokens": (lambda c: search.body_tokens(c.documents).groupBy("token").agg(F.count_distinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("hits")), f"WITH {BODY} SELECT token, count(DISTINCT doc_id) AS documents, count(*) AS hits FROM tok GROUP BY 1"),
    "fts_postings": (lambda c: search.postings(search.indexed_texts(c)).groupBy("field", "token").agg(F.count_distinct("doc_id").alias("documents"), F.count(F.lit(1)).alias("hits")), TEXTS + ", words AS (" + " UNION ALL ".join(f"SELECT doc_id, '{f}' AS field, unnest({TOKENS.format(f)}) token FROM texts" for f in search.WEIGHTS) + ") SELECT field, token, count(DISTINCT doc_id) AS documents, count(*) AS hits FROM words GROUP BY 1, 2"),
    "fts_all": (lambda c: search.match_all(c.documents, ["lantern", "harbour"]), f"WITH {BODY} SELECT doc_id FROM tok WHERE token IN ('lantern', 'harbour') GROUP BY 1 HAVING count(DISTINCT token) = 2"),
    "fts_any": (lambda c: search.match_any(c.documents, ["sonnet", "tariff"]), f"WITH {BODY} SELECT DISTINCT doc_id FROM tok WHERE token IN ('sonnet', 'tariff')"),
    "fts_not": (lambda c: search.match_not(c.documents, "treaty", "siege"), f"WITH {BODY} SELECT doc_id FROM tok WHERE token IN ('treaty', 'siege') GROUP BY 1 HAVING bool_or(token = 'treaty') AND NOT bool_or(token = 'siege')"),
    "fts_prefix": (lambda c: search.match_prefix(c.documents, "compil"), f"WITH {BODY} SELECT doc_id, count(*) AS hits FROM tok WHERE starts_with(token, 'compil') GROUP BY 1"),
    "fts_phrase": (lambda c: search.match_phrase(c.documents, ["had", "to", "wait"]), f"WITH {BODY} SELECT a.doc_id, count(*) AS hits FROM tok a JOIN tok b ON b.doc_id = a.doc_id AND b.pos = a.pos + 1 AND b.token = 'to' JOIN tok c ON c.doc_id = a.doc_id AND c.pos = a.pos + 2 AND c.token = 'wait' WHERE a.token = 'had' GROUP BY 1"),
    "fts_column": (lambda c: search.postings(search.indexed_texts(c)).filter("field = 'title' and token = 'history'").select("doc_id").distinct(), TEXTS + f", words AS (SELECT doc_id, unnest({TOKENS.format('title')}) token FROM texts) SELECT DISTINCT doc_id FROM words WHERE token = 'history'"),
    "fts_total": (lambda c: search.match_any(c.documents, ["lantern"]).agg(F.count(F.lit(1)).alias("total")), f"WITH {BODY} SELECT count(DISTINCT doc_id) AS total FROM tok WHERE token = 'lantern'"),
    "fts_bm25": (lambda c: search.bm25(search.indexed_texts(c), ["history", "treaty", "lantern"]), _bm25_sql(["history", "treaty", "lantern"])),
    "corpus_select": (lambda c: corpus.select(c, category="history", limit=200).select("doc_id", "extraction_id", "title", "site"), SELECTED + "SELECT doc_id, extraction_id, title, site FROM sel WHERE category = 'history' ORDER BY lower(title) NULLS FIRST, text_sha256 NULLS FIRST, extraction_id LIMIT 200"),
    "corpus_order_title": (lambda c: corpus.ordered(c, "title"), SELECTED + "SELECT row_number() OVER (ORDER BY lower(coalesce(title, '')), lower(coalesce(author, '')), text_sha256 NULLS FIRST, extraction_id, doc_id) AS item_index, extraction_id, doc_id FROM sel"),
    "corpus_order_hash": (lambda c: corpus.ordered(c, "hash"), SELECTED + "SELECT row_number() OVER (ORDER BY text_sha256 NULLS FIRST, extraction_id, doc_id) AS item_index, extraction_id, doc_id FROM sel"),
    "corpus_order_created": (lambda c: corpus.ordered(c, "created"), SELECTED + "SELECT row_number() OVER (ORDER BY extraction_id, doc_id) AS item_index, extraction_id, doc_id FROM sel"),
    "corpus_order_seeded": (lambda c: corpus.ordered(c, "seeded", 42), SELECTED + "SELECT row_number() OVER (ORDER BY sha256('42:' || coalesce(text_sha256, '')), text_sha256 NULLS FIRST, extraction_id, doc_id) AS item_index, extraction_id, doc_id FROM sel"),
    "corpus_items": (lambda c: corpus.items(c, PAIRS).select("item_index", "extraction_id", "doc_id", "sha256", "chars"), SELECTED + f"SELECT row_number() OVER (ORDER BY lower(coalesce(title, '')), lower(coalesce(author, '')), text_sha256 NULLS FIRST, extraction_id, doc_id) AS item_index, extraction_id, doc_id, sha256({SUBSTITUTED}) AS sha256, length({SUBSTITUTED})::BIGINT AS chars FROM sel"),
    "corpus_integrity": (corpus.integrity, "SELECT e.id AS extraction_id, d.doc_id, coalesce(sha256(d.text) = e.text_sha256, false) AS ok FROM extractions e JOIN documents d ON d.text_uri = e.text_uri WHERE e.status = 'processed' AND d.text IS NOT NULL"),
    "corpus_totals": (lambda c: corpus.totals(c, PAIRS), SELECTED + f"SELECT category, count(*) AS items, sum(length({SUBSTITUTED}))::BIGINT AS chars FROM sel GROUP BY 1"),
    "upsert_files": (lambda c: latest(c.files, ["work_id", "format", "url"], [F.desc_nulls_last("created_at"), F.desc("id")]).select("id", "work_id", "site"), "SELECT id, work_id, site FROM (SELECT *, row_number() OVER (PARTITION BY work_id, format, url ORDER BY created_at DESC NULLS LAST, id DESC) rn FROM files) WHERE rn = 1"),
    "upsert_works": (lambda c: merge.add_missing(c.works.filter("id <= 300"), c.works.filter("id > 300"), ["title", "author"], "id").select("id", "title"), "SELECT id, title FROM (SELECT *, row_number() OVER (PARTITION BY title, author ORDER BY id) rn FROM works WHERE id > 300) n WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM works o WHERE o.id <= 300 AND o.title IS NOT DISTINCT FROM n.title AND o.author IS NOT DISTINCT FROM n.author)"),
    "upsert_categories": (lambda c: merge.merge_categories(c.read("categories"), c.extractions.filter("category <> ''").select(F.col("category").alias("name"), F.lit(None).cast("string").alias("description"), F.lit("[]").alias("keywords_json"), F.lit(1).alias("dynamic")).distinct()),
      "WITH n AS (SELECT DISTINCT category AS name FROM extractions WHERE category <> '') SELECT coalesce(c.name, n.name) AS name, c.description, coalesce(c.keywords_json, '[]') AS keywords_json, greatest(coalesce(c.dynamic, 0), CASE WHEN n.name IS NULL THEN 0 ELSE 1 END)::INT AS dynamic FROM categories c FULL JOIN n ON n.name = c.name"),
    "download_fold": (_fold, FOLD_SQL),
    "expire_stale": (lambda c: merge.expire(c.downloads, "2024-06-01 00:00:00"), CTE + "SELECT id, file_id, CASE WHEN status = 'downloading' AND updated_at < TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 2 HOUR THEN 'failed' ELSE status END AS status, coalesce(status = 'downloading' AND updated_at < TIMESTAMP '2024-06-01 00:00:00' - INTERVAL 2 HOUR, false) AS expired FROM dl"),
    "keep_processed": (lambda c: merge.keep_better(c.extractions.filter("extractor = 'plaintext.v1'").select("download_id", "status"), c.extractions.filter("extractor = 'plaintext.v2'").select("download_id", "status"), "download_id", "processed"),
      "WITH a AS (SELECT download_id, status FROM extractions WHERE extractor = 'plaintext.v1'), b AS (SELECT download_id, status FROM extractions WHERE extractor = 'plaintext.v2') SELECT coalesce(a.download_id, b.download_id) AS download_id, CASE WHEN a.status = 'processed' AND coalesce(b.status, '') <> 'processed' THEN a.status ELSE coalesce(b.status, a.status) END AS status FROM a FULL JOIN b ON a.download_id = b.download_id"),
    "batched": (lambda c: merge.batches(c.files.select("id", "site"), "id", 50, "site").select("id", "site", F.col("batch").cast("long").alias("batch")), "SELECT id, site, ((row_number() OVER (PARTITION BY site ORDER BY id) - 1) // 50)::BIGINT AS batch FROM files"),
    "context_pack": (lambda c: merge.budget_prefix(c.read("events").withColumn("cost", (F.col("event_id") % 7 + 1)), "user_id", "event_id", "cost", 60).select("event_id", "user_id", "spent"), "SELECT event_id, user_id, spent::BIGINT AS spent FROM (SELECT *, sum(event_id % 7 + 1) OVER (PARTITION BY user_id ORDER BY event_id DESC ROWS UNBOUNDED PRECEDING) spent FROM events) WHERE spent <= 60"),
    "recent_statuses": (lambda c: feeds.latest_status(c.read("events")), "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1"),
    "stream_hourly": (lambda c: feeds.hourly(c.read("events")), "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:00') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2"),
    "stream_dedupe": (lambda c: feeds.deduplicated(c.read("events").union(c.read("events"))).groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1"),
    "stream_sessions": (lambda c: feeds.sessions(c.read("events")), """WITH g AS (SELECT *, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE OR lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL THEN 1 ELSE 0 END s FROM events),
      r AS (SELECT *, sum(s) OVER (PARTITION BY user_id ORDER BY ts, event_id) k FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM r GROUP BY user_id, k"""),
}


def entries() -> dict[str, Entry]:
    from quire.plans import more

    return ENTRIES | more.ENTRIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda s, d, f=make: f(Catalog(s, d))) for name, (make, _) in entries().items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in entries().items() if sql}
