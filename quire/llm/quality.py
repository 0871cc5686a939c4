"""Per-document text quality statistics and the documents that are not prose (problem 4).

Each document gets its counts and ratios, and the share of its characters that stand in lines of prose, of a list, of a table
and of junk. For each language a mergeable quantile sketch of every statistic is built, and values become percentiles and
robust z-scores against it. Where natural prose ends is read from the sketch of the share of prose itself: its two heaps, texts of
prose and texts of other things, are parted where the spread between them is largest, and what lies below is the tail. A tail of less than a
fortieth of a language, or a language whose sketch has no second heap, is parted as all languages together are; so the
bound moves with the corpus, and it holds where a third of a language or more are tables. A document in the tail is named by the largest of its other shares.

Defined cases: null, empty and blank texts have zero counts, null ratios and no kind; a language with one document has
z-scores against the floor of the spread; repeated rows give repeated results; extra columns are ignored. Garbled texts are
repaired before they are judged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.base import cut, lean

#: Frequent words by language (fixed values).
COMMON = {
    "en": "the of and to in a that it was is for on with as by had not be at said one from which who this than more but they have has may there when what nor some no each other any between most".split(),
    "de": "der die das und in den von zu mit ist nicht auch für im dem des ein eine sich auf als noch weder über dann wieder sowohl wir sie man dass waren keine hatten ohne durch gegen".split(),
    "fr": "le la les de des et en un une du que qui dans au aux pour sur pas par ne ni ont sont plus était étaient après sans avec ses où on à l’ d’ quant selon".split(),
    "es": "el la los las de y en un una que del se por con para al su no ni como más lo también eran sin entre según fue allí donde ya años después así".split(),
    "ru": "и в не на что с по как из у к за от о же но для а то его они про ни через при чем уже никто году лет затем сначала потом".split(),
}
STOP = {word: code for code, words in reversed(COMMON.items()) for word in words}
STATISTICS = ("n_words", "mean_word", "symbol_ratio", "digit_ratio", "line_end_share", "common_share", "prose_share")
#: A robust z-score beyond this is a tail, and no spread is taken to be smaller than its floor.
TAIL = 3.0
#: Steps of the percentiles read from a sketch.
GRID = 200
#: How far apart the means of the two heaps of the share of prose must be, and the bound where no sketch shows two.
APART = 0.5
HALF = 0.5
FLOOR = {"n_words": 20.0, "mean_word": 0.3, "symbol_ratio": 0.01, "digit_ratio": 0.01, "line_end_share": 0.1, "common_share": 0.03, "prose_share": 0.05}

_WORD = "[^\\W\\d_]"
#: Lines of tables: cells between bars, tabs, semicolons, commas or wide gaps.
TABLE = re.compile(
    "^\\s*(?:[|│].*[|│]|[^\t]*\t.*|[^;]{0,40}(?:; ?[^;]{0,30}){2,}|[^,\\s]*(?:,[^,\\s]*){1,}|\\S+(?: \\S+)?(?: {2,}\\S+(?: \\S+)?)+|[-+|=: ]{6,})\\s*$"
)
#: Entries of lists: leaders or numbers at the end, marks or numbers at the start, glosses and bibliographies.
ENTRY = re.compile(
    f"^\\s*(?:.{{1,80}}?\\s?[.·…]{{3,}}\\s*\\d+|.{{1,80}}?(?:, ?\\d{{1,4}}(?:[-–]\\d+)?)+\\.?|(?:[-*+•–—]|\\(?\\w{{1,3}}[.):]|\\d{{1,4}}[.):]?|\\[\\d+\\])\\s+\\S.{{0,70}}|[^=]{{1,60}} = [^=]{{1,60}}"
    f"|{_WORD}[\\w’'-]+, {_WORD}\\. .*\\d{{4}}\\.?|[^.,:]{{1,40}}[,:] [^.,]{{1,40}}(?: \\([^)]*\\))?)\\s*$"
)
#: Lines of junk: logs, dumps, code, runs of one sign, menus and the notices of a site.
LOG = re.compile("^\\s*(?:\\[\\d+\\]|\\d{4}-\\d\\d-\\d\\dT|[0-9a-f]{6,} ).*(?:/|ERR|WARN|OK|GET|INFO|DEBUG)|^\\s*[0-9a-f]{4,8}[: ]\\s+(?:[0-9a-f]{2}\\s){4,}")
CODE = re.compile("[{};]\\s*$|=\\s*function|^\\s*(?:var|let|const|def|class|import|return|if|for|while|#include)\\b.*[({;=]|</?\\w+[^>]*>.*</?\\w+")
RUN = re.compile("^\\s*(\\S)\\1{5,}\\w{0,4}\\s*$")
NOTICE = re.compile(
    "(?i)\\b(?:not found|access .{0,40}(?:restricted|denied)|enable (?:scripts|javascript|cookies)|checking your browser|slow download|will be ready in|log ?in to|sign in|session expired|too many requests|try again later|captcha|subscribe|this page|under maintenance|service unavailable)\\b"
)
MENU = re.compile("(?i)\\b(?:home|login|search|share|next|prev|help|cookies|top|menu|contact|about|privacy|terms|register|sitemap)\\b")
HEADING = re.compile("(?i)^\\s*(?:table of contents|contents|index|inventory|list of entries|glossary|bibliography|inhalt|register|verzeichnis|table des matières|índice|содержание|указатель)\\s*:?\\s*$")
_SPLIT = re.compile("[\r\n\x0b\x0c  ]+")
_MARKED = re.compile("[.·…]{4,}\\s*\\d|, ?\\d{1,4}, ?\\d|(?m:^\\s*(?:\\d+[.):]|[-*+•]) )")
_LONG = re.compile("\\S{45,}")
_DIGITS = re.compile("\\d")
_LETTERS = re.compile("[^\\W\\d_]")
_END = re.compile("[.!?…][»”\"’')\\]]*$")
_PUNCT = "“”‘’«»\"'().,;:!?…–—-„‚[]"


def line_class(line: str) -> str:
    """What one line that is not blank looks like: prose, list, table or junk; '' where it may be anything."""
    bare = line.strip()
    size = len(bare)
    words = bare.split()
    common = len([w for w in bare.lower().split() if w in STOP])
    celled = "|" in bare or "│" in bare or "\t" in bare or "  " in bare or ";" in bare
    if common * 4 >= len(words) >= 5 and not celled and "=" not in bare and "/" not in bare and ".." not in bare:
        return "prose"
    if RUN.match(bare) or LOG.match(bare):
        return "junk"
    letters = sum(map(str.isalpha, bare))
    spaces = len(words) - 1
    dense = letters / max(1, size - spaces)
    if celled or ("," in bare and dense < 0.8):
        if CODE.search(bare) and dense < 0.85:
            return "junk"
        if TABLE.match(bare):
            if len(MENU.findall(bare)) >= 2 and dense > 0.8:
                return "junk"
            return "table"
    if CODE.search(bare) and dense < 0.9:
        return "junk"
    if "»" in bare and bare.count(" » ") >= 3 or "·" in bare and bare.count(" · ") >= 3:
        return "junk"
    if len(words) >= 4 and dense > 0.75 and (common * 8 >= len(words) or (len(words) >= 6 and common and not ENTRY.match(bare))):
        if ENTRY.match(bare) and common * 4 < len(words) and not _END.search(bare):
            return "list"
        return "prose"
    if dense < 0.55 and size >= 20:
        return "junk" if not ENTRY.match(bare) else "list"
    if ENTRY.match(bare):
        return "list"
    if HEADING.match(bare):
        return "list"
    return ""


def shares(text: str) -> tuple[float, float, float, float, float]:
    """Shares of the visible characters in lines of prose, list, table and junk, and of common words among all words."""
    lines = [line for line in _SPLIT.split(text) if line and not line.isspace()]
    size = {"prose": 0, "list": 0, "table": 0, "junk": 0, "": 0}
    kinds = []
    for line in lines:
        kind = line_class(line)
        kinds.append(kind)
        size[kind] += len(line.strip())
    words = text.split()
    n = len(words)
    common = len([w for w in text.lower().split() if w in STOP]) / n if n else 0.0
    total = sum(size.values())
    if not total:
        return 0.0, 0.0, 0.0, 0.0, common
    # lines without a look of their own go with their neighbours, else they are prose where the words are common ones
    if n >= 12 and common < 0.05 and _noise(text):
        return 0.0, 0.0, 0.0, 1.0, common
    open_size = size.pop("")
    if open_size:
        menus = len(MENU.findall(text))
        loose = [line.strip() for line, kind in zip(lines, kinds, strict=True) if not kind]
        short = sum(len(line.split()) <= 4 for line in loose)
        if menus >= 4 and menus * 6 >= n and not size["prose"]:
            size["junk"] += open_size
        elif size["list"] + size["table"] > size["prose"] + size["junk"] and short * 2 > len(loose):
            size["list" if size["list"] >= size["table"] else "table"] += open_size
        elif max(map(len, words)) > 45 and sum(map(len, _LONG.findall(text))) * 2 > len(text):
            size["junk"] += open_size
        elif n >= 12 and common < 0.02 and size["prose"] * 3 < open_size and not _cyrillic(text):
            size["junk"] += open_size
        elif short * 5 > len(loose) * 4 and len(loose) >= 6 and common < 0.08:
            size["list"] += open_size
        else:
            size["prose"] += open_size
    if len(lines) < 3 and size["list"] and not _MARKED.search(text):
        size = {"prose": size["prose"] + size["list"], "list": 0, "table": size["table"], "junk": size["junk"]}
    if n <= 30 and len(lines) <= 4 and NOTICE.search(text) and not any(len(line) > 160 for line in lines):
        size = {"prose": 0, "list": 0, "table": 0, "junk": total}
    return size["prose"] / total, size["list"] / total, size["table"] / total, size["junk"] / total, common


def _noise(text: str) -> bool:
    """Whether the Latin words of a text have too few vowels to be words."""
    letters = re.findall("[a-z]", text.lower())
    return len(letters) * 2 > len(text) - text.count(" ") and sum(c in "aeiou" for c in letters) < 0.29 * len(letters)


def _cyrillic(text: str) -> bool:
    """Whether a text is mostly Cyrillic with the words of Russian (few of its sentences need a common word)."""
    letters = re.findall("[Ѐ-ӿ]", text)
    return len(letters) * 2 > len(_LETTERS.findall(text))


def kind_of(text: str | None) -> str:
    """list, table or junk where more than half of a text is not prose, else ''."""
    if not text or text.isspace():
        return ""
    words = text.lower().split()
    if len(words) > 30 and len([w for w in words if w in STOP]) * 4 >= len(words):
        return ""  # no list, table or junk is a quarter common words
    prose, lists, tables, junk, _ = shares(text)
    if prose >= 0.5:
        return ""
    return max((("list", lists), ("table", tables), ("junk", junk)), key=lambda x: x[1])[0]


def language(text: str) -> str:
    """The archive's language whose frequent words are the most among the first of ties, '' without any."""
    counts: dict[str, int] = {}
    for word in text.lower().split():
        code = STOP.get(word)
        if code:
            counts[code] = counts.get(code, 0) + 1
    return max(sorted(counts), key=counts.get) if counts else ""


def _measure(text: str | None) -> tuple:
    from quire.llm.garbled import repaired

    if not text or text.isspace():
        return ("", 0, None, None, None, None, None, None, None, None, None)
    text = repaired(text)
    words = text.split()
    lines = [line for line in _SPLIT.split(text) if line and not line.isspace()]
    letters = len(_LETTERS.findall(text))
    digits = len(_DIGITS.findall(text))
    visible = sum(map(len, words))
    prose, lists, tables, junk, common = shares(text)
    ends = sum(bool(_END.search(line.rstrip()[-4:])) for line in lines)
    return (
        language(text),
        len(words),
        visible / max(1, len(words)),
        (visible - letters - digits) / max(1, visible),
        digits / max(1, visible),
        ends / max(1, len(lines)),
        common,
        prose,
        lists,
        tables,
        junk,
    )


SCHEMA = (
    "doc_id long, language string, n_words long, mean_word double, symbol_ratio double, digit_ratio double, line_end_share double, "
    "common_share double, prose_share double, list_share double, table_share double, junk_share double"
)


def statistics(docs: DataFrame) -> DataFrame:
    """The statistics of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), *[pa.float64()] * 9]
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        for batch in batches:
            columns = list(zip(*map(_measure, batch.column(1).to_pylist()), strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    return lean(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def parted(levels: list[float] | None) -> float | None:
    """Where the quantiles of a share fall into two heaps: the middle of the gap that leaves the largest spread between the means
    of both sides (for equal spreads the widest gap); None where the means are less than ``APART`` from each other."""
    if not levels:
        return None
    n, total = len(levels), sum(levels)
    best, bound, below = (0.0, 0.0), None, 0.0
    for k in range(1, n):
        below += levels[k - 1]
        low, high = below / k, (total - below) / (n - k)
        spread = (round(k * (n - k) * (high - low) ** 2 / n / n, 6), levels[k] - levels[k - 1])
        if high - low >= APART and spread > best:
            best, bound = spread, (levels[k] + levels[k - 1]) / 2
    return bound


def bounds(levels: DataFrame) -> DataFrame:
    """(language, bound): where prose ends in each language, from its quantiles (language, q_prose_share)."""
    rows = {r["language"]: r["q_prose_share"] for r in levels.select("language", "q_prose_share").collect()}  # at most one for each language of the list, and one
    common = parted(rows.get(""))
    common = HALF if common is None else common
    own = [(name, float(bound if (bound := parted(q)) is not None else common)) for name, q in rows.items()]
    return levels.sparkSession.createDataFrame(own, "language string, bound double")


def sketched(stats: DataFrame) -> DataFrame:
    """(language, q_*): the quantiles of each statistic by language, and of all languages together under ''.

    One sketch for each statistic and language is all that is gathered (a few kilobytes each, at most one per language of the
    fixed list and one for the rest), so it can be sent to every task whatever the number of documents."""
    sketches = stats.filter("n_words > 0").groupBy("language").agg(*[F.expr(f"kll_sketch_agg_double(double({c}))").alias(f"s_{c}") for c in STATISTICS])
    # texts without any frequent word are held against all languages together: the sketches merge
    pooled = sketches.groupBy(F.lit("").alias("language")).agg(*[F.expr(f"kll_merge_agg_double(s_{c})").alias(f"s_{c}") for c in STATISTICS])
    sketches = sketches.filter("language <> ''").unionByName(pooled)
    marks = ", ".join(f"{k / GRID}D" for k in range(1, GRID))
    return cut(sketches.select("language", *[F.expr(f"kll_sketch_get_quantile_double(s_{c}, array({marks}))").alias(f"q_{c}") for c in STATISTICS]))


def scored(stats: DataFrame, levels: DataFrame) -> DataFrame:
    """``stats`` with, for each statistic, its percentile ``p_*`` and robust z-score ``z_*`` within the language, and the
    ``bound`` below which its share of prose is in the tail."""
    joined = stats.join(F.broadcast(levels), "language", "left").join(F.broadcast(bounds(levels)), "language", "left")  # at most len(COMMON) + 1 rows
    out = list(stats.columns)
    for c in STATISTICS:
        low, middle, high = (F.col(f"q_{c}")[GRID * k // 4 - 1] for k in (1, 2, 3))
        joined = joined.withColumn(f"z_{c}", (F.col(c) - middle) / F.greatest((high - low) / 1.349, F.lit(FLOOR[c])))
        joined = joined.withColumn(f"p_{c}", F.when(F.col(c).isNotNull(), F.expr(f"size(filter(q_{c}, q -> q <= {c})) / {GRID}D")))
        out += [f"z_{c}", f"p_{c}"]
    return joined.select(*out, "bound")


def judged(docs: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """The statistics, scores, ``tail`` and ``kind`` of every document, kind null for prose; ``levels`` in place of the sketches of
    the documents themselves. ``outlier`` tells that any other statistic lies more than ``TAIL`` robust deviations off."""
    stats = cut(statistics(docs))
    table = scored(stats, sketched(stats) if levels is None else levels)
    outlier = (F.col("z_common_share") < -TAIL) | (F.col("z_symbol_ratio") > TAIL) | (F.col("z_digit_ratio") > TAIL) | (F.col("z_line_end_share") < -TAIL) | (F.abs("z_mean_word") > TAIL)
    tail = F.col("prose_share") < F.coalesce("bound", F.lit(HALF))
    most = F.greatest("list_share", "table_share", "junk_share")
    kind = F.when(F.col("list_share") == most, "list").when(F.col("table_share") == most, "table").otherwise("junk")
    out = table.withColumn("tail", F.coalesce(tail, F.lit(False))).withColumn("outlier", F.coalesce(outlier, F.lit(False)))
    return out.withColumn("kind", F.when(F.col("tail"), kind))


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, kind) of every document of which more than half is not natural prose."""
    return judged(docs).filter("kind is not null").select("doc_id", "kind").distinct()
