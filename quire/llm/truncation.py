"""Text cut off by field limits or broken transfers (problem 9).

For each source the number of texts of each length, in characters and in bytes, gives a discrete hazard: the share of the
texts that reach a length and end there. Each hazard is tested against the hazard of the neighbouring lengths, with the
false-discovery rate controlled within the source over both units; a significant length is a field limit, and its excess over the neighbours
is the share of its texts that were cut there.

Endings are evidence as well, of a strength that is measured: how texts end where a limit cut them is what the significant
lengths have more than the rest, how complete ones end is what the rest shows once the texts that a broken transfer cut are
taken out. A document of prose is cut where the posterior, from the excess at its length (or the rate of broken transfers of its
source elsewhere) and its ending, is one half or more. So a doubtful ending counts at a limit and not elsewhere, and an open
one counts elsewhere by the rate of its source.

Defined cases: null, empty and blank texts, lists, tables and junk are never cut; a null source is a source of its own;
equal texts of a source count once in the hazards and are each reported; extra columns are ignored; without any significant
length the priors ``CUT`` and ``WHOLE`` stand for the endings.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.base import cut, lean

#: Lengths on either side whose hazards a length is held against, and the tolerated false-discovery rate.
NEIGHBOURS = 60
RATE = 0.001
UNITS = ("chars", "bytes")
#: How cut and complete texts end before any is seen, and how many texts these priors weigh.
CUT = {"open": 0.90, "marked": 0.05, "loose": 0.03, "named": 0.015, "closed": 0.005}
WHOLE = {"open": 0.0005, "marked": 0.0001, "loose": 0.002, "named": 0.01, "closed": 0.9874}
PRIOR = 40.0
#: Texts that the common rate of broken transfers weighs in the rate of a source.
SHRINK = 400.0

_CLOSED = re.compile("[.!?][»”\"’')\\]]*$")
_OMITTED = re.compile("(?i)(?:…|\\.\\.\\.|\\[(?:truncated|cut|more|connection (?:closed|lost|reset)|\\.\\.\\.|…|continued|end of (?:field|file)|incomplete|transfer [^\\]]*)[^\\]]*\\]|\\((?:more|continued|truncated|cut)[^)]*\\)|<(?:truncated|cut|more)>|read more|>>|�+)\\s*$")
_NAME = "[A-ZÀ-ÖØ-ÞЀ-Я][\\w’'-]*"
_CLOSING = re.compile(
    f"(?:\\W+|(?i:finis|the end|end|ende|fin|конец)\\W*|\\[[^\\]]*\\]|\\([^)]*\\)|(?i:signed|printed|transcribed|see also|see|index|note|errata|yours|notes?|plate|fig)\\b.*|[—–-]+ ?{_NAME}.*"
    "|.*\\bp+\\. ?\\d+|.* & Sons|\\W*\\d+\\W*|(?i:page|seite|стр) ?\\d+)$"
)
_NAMED = re.compile(f"(?:{_NAME}(?:,? {_NAME}){{0,3}}|{_NAME}(?: {_NAME})*,? ?\\(?\\d{{4}}\\)?)\\W?$")
_PAGE = re.compile("\\W*(?:(?i:page|seite|стр\\.?) ?)?\\d{1,4}\\W*$")


def ending(text: str | None) -> str:
    """How a text of prose ends: marked (an omission is shown), open, loose (openly, in a short line of its own), named (a name
    or place on its own line), closed."""
    if not text or text.isspace():
        return "closed"
    if text.endswith("\ufffd") and "\ufffd" in text.rstrip("\ufffd"):  # a text with lost characters: its last one may be a quote
        text = text.rstrip("\ufffd")
    if _OMITTED.search(text[-80:]):
        return "marked"
    if text[-1] in "  " and text.rstrip("  ")[-1:] != "\n":
        return "open"
    body = text.rstrip()
    lines = body.split("\n")
    if not body:
        return "closed"
    while len(lines) > 1 and (not lines[-1].strip() or _PAGE.match(lines[-1].strip())):
        lines.pop()
    last = lines[-1].strip()
    if not last:
        return "closed"
    if _CLOSED.search(last[-8:]):
        return "closed"
    from quire.llm.quality import STOP, line_class

    if line_class(last) in ("table", "junk") or len(lines) > 2 and line_class(last) == "list" and line_class(lines[-2]) == "list":
        return "closed"
    alone = len(lines) < 2 or not lines[-2].strip() or len(lines) > 1 and lines[-2].rstrip().endswith((",", ".", "!", "?", "”", '"'))
    if alone and len(last) <= 90:
        if _CLOSING.match(last):
            return "closed"
        if _NAMED.match(last):
            first = last.split()[0]
            if not (last.isupper() and len(last) > 3) and (first.strip(",.").lower() in STOP or (len(last.split()) == 1 and len(last) <= 3)):
                return "open"
            return "named"
        return "loose"
    return "open"


SCHEMA = "doc_id long, source string, chars long, bytes long, digest long, prose boolean, ending string"


def endings(docs: DataFrame) -> DataFrame:
    """(doc_id, source, chars, bytes, digest, prose, ending) of every row of ``docs`` (doc_id, text, source)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quire.llm.garbled import repaired
        from quire.llm.quality import kind_of

        names = [f.split()[0] for f in SCHEMA.split(", ")]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                if not text or text.isspace():
                    rows.append((len(text) if text is not None else None, len(text.encode()) if text is not None else None, 0, False, "closed"))
                    continue
                raw = text.encode("utf-8", "surrogatepass")
                end = ending(text)
                if end != "closed":
                    end = ending(repaired(text))
                prose = not kind_of(repaired(text))
                rows.append((len(text), len(raw), xxhash.xxh3_64_intdigest(raw) - 2**63, prose, end))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names)

    return lean(docs, "doc_id", "text", "source").mapInArrow(run, SCHEMA)


def limits(ends: DataFrame, rate: float = RATE) -> DataFrame:
    """(source, unit, length, n, expected, p_value): the significant lengths of each source.

    The windows run over one row for each length of a source and unit, so they are bounded by the longest text, not by the
    number of documents.
    """
    lengths = ends.filter("prose").select("source", "digest", F.stack(F.lit(2), F.lit("chars"), "chars", F.lit("bytes"), "bytes").alias("unit", "length"))
    counts = lengths.groupBy("source", "unit", "length").agg(F.count_distinct("digest").alias("n"))
    own = Window.partitionBy("source", "unit").orderBy("length")
    risk = F.sum("n").over(own.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    beside = own.rangeBetween(-NEIGHBOURS, NEIGHBOURS)
    # hazards add up over lengths: the neighbours' total, spread over the lengths of the window
    table = counts.withColumn("risk", risk).withColumn("hazard", F.col("n") / F.col("risk"))
    rest = (F.sum("hazard").over(beside) - F.col("hazard") + F.lit(1.0) / F.col("risk")) / (2 * NEIGHBOURS)
    expected = F.greatest(rest, F.lit(1e-9)) * F.col("risk")
    tested = table.withColumn("expected", expected)
    # the Chernoff bound of the Poisson tail: never smaller than the tail itself
    bound = F.exp(F.col("n") - F.col("expected") - F.col("n") * F.log(F.col("n") / F.col("expected")))
    tested = tested.withColumn("p_value", F.when(F.col("n") > F.col("expected"), F.least(bound, F.lit(1.0))).otherwise(1.0))
    ranked = Window.partitionBy("source").orderBy("p_value", "unit", "length")
    everyone = Window.partitionBy("source")
    stepped = tested.withColumn("ok", F.col("p_value") <= F.row_number().over(ranked) * F.lit(rate) / F.count(F.lit(1)).over(everyone))
    last = F.max(F.when(F.col("ok"), F.col("p_value"))).over(everyone)
    return stepped.withColumn("last", last).filter("p_value <= last and n >= 3").select("source", "unit", "length", "n", "expected", "p_value")


def endings_by_evidence(counts: dict[str, tuple[float, float, float]]) -> tuple[dict[str, float], dict[str, float], float, float]:
    """(cut, whole, rate, true): the shares of endings of cut and of complete texts, the rate of broken transfers, and the part of
    the excess at significant lengths that was cut, from the number of each ending at significant lengths, the excess expected
    among them, and its number elsewhere. Closed endings in excess are texts that were made to fill a field, not cut ones."""
    at = {e: counts.get(e, (0.0, 0.0, 0.0))[0] for e in CUT}
    off = {e: counts.get(e, (0.0, 0.0, 0.0))[2] for e in CUT}
    n_off, expected = sum(off.values()), sum(c[1] for c in counts.values())
    chance = sum(at.values()) - expected  # texts that end at these lengths by themselves, as those elsewhere do
    more = {e: max(0.0, at[e] - (chance * off[e] / n_off if n_off else 0.0)) for e in CUT}
    filled = more.pop("closed")
    seen = sum(more.values())
    true = (seen + 1.0) / (seen + filled + 1.0)
    more["closed"] = CUT["closed"] * seen
    seen = sum(more.values())
    cut_share = {e: (more[e] + PRIOR * CUT[e]) / (seen + PRIOR) for e in CUT}
    elsewhere = {e: (off[e] + PRIOR * WHOLE[e]) / (n_off + PRIOR) for e in CUT}
    # complete prose ends openly at the rate of the prior: what is above it was cut by a transfer
    rate = min(0.5, max(1e-4, (elsewhere["open"] - WHOLE["open"]) / max(0.1, cut_share["open"] - WHOLE["open"])))
    whole = {e: max(0.1 * WHOLE[e], elsewhere[e] - rate * cut_share[e]) for e in CUT}
    whole |= {e: WHOLE[e] for e in ("open", "marked")}
    total = sum(whole.values())
    return cut_share, {e: w / total for e, w in whole.items()}, rate, true


def judged(docs: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """(doc_id, source, prose, ending, at_limit, posterior, truncated) of every row; ``marks`` in place of ``limits``."""
    ends = cut(endings(docs))
    marks = (limits(ends) if marks is None else marks).withColumn("excess", 1 - F.col("expected") / F.col("n"))
    at = None
    for unit in UNITS:
        own = marks.filter(F.col("unit") == unit).select(F.col("source").alias("s"), F.col("length").alias(unit), F.col("excess").alias(f"excess_{unit}"))
        at = (at if at is not None else ends).join(own.withColumnRenamed(unit, "len"), F.col("s").eqNullSafe(F.col("source")) & (F.col("len") == F.col(unit)), "left").drop("s", "len")
    at = cut(at.withColumn("excess", F.greatest(F.coalesce("excess_chars", F.lit(0.0)), F.coalesce("excess_bytes", F.lit(0.0)))))
    off = F.col("excess") == 0
    one = F.lit(1.0)
    # at most one row for each ending
    rows = at.filter("prose").groupBy("ending").agg(F.coalesce(F.sum(F.when(~off, one)), F.lit(0.0)), F.sum("excess"), F.coalesce(F.sum(F.when(off, one)), F.lit(0.0))).collect()
    cut_share, whole, rate, true = endings_by_evidence({r[0]: (r[1], r[2], r[3]) for r in rows})
    broken = off & F.col("ending").isin("open", "marked")
    share = (F.count_if(broken) + SHRINK * rate) / (F.count_if(off) + SHRINK)
    rates = at.filter("prose").groupBy("source").agg(F.greatest(F.lit(rate / 10), F.least(F.lit(0.5), share)).alias("rate"))
    joined = at.join(rates.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(F.col("source")), "left").withColumn("rate", F.coalesce("rate", F.lit(rate)))
    of = lambda table: F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[F.col("ending")]
    prior = F.col("excess") * true + (1 - F.col("excess")) * F.col("rate")
    posterior = prior * of(cut_share) / (prior * of(cut_share) + (1 - prior) * of(whole))
    posterior = F.when(F.col("prose"), F.coalesce(posterior, F.lit(0.0))).otherwise(0.0)
    return joined.select("doc_id", "source", "prose", "ending", (~off).alias("at_limit"), posterior.alias("posterior"), (posterior >= 0.5).alias("truncated"))


def found(docs: DataFrame) -> DataFrame:
    """(doc_id) of the cut documents."""
    return judged(docs).filter("truncated").select("doc_id").distinct()


def by_source(docs: DataFrame) -> DataFrame:
    """(source, documents, truncated, share): how often each source cuts, over all its rows."""
    return (
        judged(docs)
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("truncated").cast("long")).alias("truncated"))
        .withColumn("share", F.col("truncated") / F.col("documents"))
    )
