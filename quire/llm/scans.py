"""Noise in text from scanned pages (problem 2).

Lines are labelled by a linear chain over four states (text, heading, furniture, break) whose emission scores come from layout
features: page-number and signature shapes, capitals, numbers at either end, repetition over the document, the run of chapter
numbers, and whether the line breaks into a sentence. The features of a line make its symbol; the chain is a hidden Markov model
over symbols, fitted by expectation and maximisation from scores given beforehand on all documents: a line whose state is plain
parts what lies before it from what comes after, so the few distinct stretches between such lines are counted where the words
are, and the expected counts of each are taken once and weighed by its number. Words divided by the layout and words with letters taken for others that
look alike are decided with the corpus' own vocabulary: a first pass counts in how many documents each word stands, and keeps
those in at least ``SHARE`` of the documents. As a document holds a bounded number of distinct words on average, at most that
number divided by ``SHARE`` words are kept, however large the corpus, so the vocabulary may be sent to every task; the counts of
letter triples of capitalised words, which stand in for names, are taken for ``NAMES`` distinct names, so that their bounds
are shares of the names and a document has the same faults in a larger corpus; no word is exempt for its triples alone.

Defined cases: null, empty and blank texts have no faults and no repaired text; lists, tables and junk have no furniture;
repeated rows give their faults once; extra columns are ignored.
"""

from __future__ import annotations

import re
from ast import literal_eval
from collections import Counter, defaultdict
from collections.abc import Iterator
from math import exp, log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.base import cut, lean

SHARE = 3e-4
LEAST = 4
#: How much rarer than the word it stands for a misread form must be.
RARER = 12
#: What a letter was read as, and what it is (fixed values).
MISREAD = (
    ("c", "e"), ("f", "t"), ("u", "n"), ("0", "o"), ("5", "s"), ("cl", "d"), ("1", "l"), ("e", "c"), ("ii", "u"), ("b", "h"),
    ("rn", "m"), ("q", "g"), ("v", "y"), ("vv", "w"), ("l", "i"), ("6", "б"), ("0", "о"), ("3", "з"), ("н", "и"), ("и", "н"),
    ("п", "и"), ("щ", "ш"), ("ш", "щ"), ("ъ", "ь"), ("с", "е"), ("е", "с"), ("о", "с"), ("1", "i"), ("m", "rn"),
)
#: Rounds of the fit, and the lines of each symbol that the scores before the fit weigh.
ROUNDS = 2
PRIOR = 50.0
#: A form that stands so often in a document is repeated; it is misread where the meant word stands in a share of the
#: documents of ``REPEATED`` for each time, and not where it is always capitalised, as names are.
OFTEN = 4
REPEATED = 1e-4
#: Distinct names that the counts of letter triples are for; a corpus with more has its counts scaled down to them.
NAMES = 28_000
HYPHENS = "-‐¬\xad"
_HYPHENS = frozenset(HYPHENS)
_WORD = re.compile(r"[^\W_]+(?:[’'-][^\W_]+)*")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-ÞА-ЯЁ][a-zß-öø-ÿа-яё]{3,}$")
_SPLIT = re.compile(f"[^\\W\\d_][{HYPHENS}][ \\t\\r]*$")


def _words(text: str) -> set[str]:
    """The distinct words of a text; most pieces between blanks are words as they stand."""
    pieces = set(text.split())
    out = set(filter(str.isalpha, pieces))
    mixed = []
    for piece in pieces - out:
        if (bare := piece.strip(".,;:!?")).isalpha():
            out.add(bare)
        else:
            mixed.append(piece)
    out.update(_WORD.findall("\n".join(mixed)))
    return {w.replace("ﬁ", "fi").replace("ﬂ", "fl") for w in out} if "ﬁ" in text or "ﬂ" in text else out


def counted(docs: DataFrame) -> DataFrame:
    """(word, n): in how many documents each word stands, capitalised words once more after ``^``, and how often each stretch of
    lines of documents that may hold furniture (``stretches``) after ``#``; the empty word for the documents themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quire.llm.quality import kind_of

        for batch in batches:
            counts: Counter[str] = Counter()
            met: Counter[tuple] = Counter()
            for text in batch.column(1).to_pylist():
                counts[""] += 1
                if text:
                    words = _words(text)
                    counts.update({w.lower() for w in words})
                    counts.update({f"^{w.lower()}" for w in words if _CAPITAL.match(w)})
                    if "\n" in text and _may_hold(lines := text.split("\n")) and not kind_of(text):
                        met.update(stretches(symbols(lines)))
            counts.update({f"#{x!r}": n for x, n in met.items()})
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    return cut(lean(docs, "doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))


def vocabulary(docs: DataFrame, counts: DataFrame | None = None) -> tuple[dict[str, int], dict[str, float], int, int]:
    """The words kept with their document counts, the letter triples of capitalised words with the number of distinct words
    that hold them among ``NAMES``, the least count of a kept word, and the number of documents. ``counts`` are those of ``counted``."""
    counts = counted(docs) if counts is None else counts
    total = counts.filter("word = ''").agg(F.sum("n")).first()[0] or 0
    least = max(LEAST, round(total * SHARE))
    words = counts.filter((F.col("n") >= least) & (F.length("word") > 1) & ~F.col("word").startswith("^") & ~F.col("word").startswith("#")).collect()
    names = counts.filter(F.col("word").startswith("^")).select(F.concat("word", F.lit("$")).alias("w"))
    triples = names.select(F.explode(F.expr("array_distinct(transform(sequence(1, length(w) - 2), i -> substring(w, i, 3)))")).alias("t")).groupBy("t").count()
    # NAMES times the triples of a name over three rows at most
    scale = min(1.0, NAMES / max(1, names.count()))
    spelt = triples.select("t", (F.col("count") * scale).alias("count")).filter(F.col("count") >= 3).collect()
    return {r["word"]: r["n"] for r in words}, {r["t"]: r["count"] for r in spelt}, least, total


class Reader:
    """Decides on words with a vocabulary."""

    def __init__(self, words: dict[str, int], triples: dict[str, float], least: int, total: int = 0):
        self.words, self.triples, self.least, self.total = words, triples, least, total
        self.known: dict[str, str | None] = {}
        self.unknown: dict[str, tuple[tuple[str, ...], float, bool, str | None]] = {}
        #: words that no much more frequent word can be read for
        self.sound = {w for w in words if self._of_vocabulary(w) == ""}

    def variants(self, word: str) -> Iterator[str]:
        """The word with one or all occurrences of one misreading turned back."""
        for seen, meant in MISREAD:
            at = word.find(seen)
            many = 0
            while at >= 0:
                yield word[:at] + meant + word[at + len(seen) :]
                at = word.find(seen, at + 1)
                many += 1
            if many > 1:
                yield word.replace(seen, meant)

    def commonness(self, word: str, floor: float = 0) -> float:
        """The count of the rarest triple of a word; 0 where it is below ``floor``."""
        marked, get = f"^{word}$", self.triples.get
        least = None
        for i in range(len(marked) - 2):
            n = get(marked[i : i + 3], 0)
            if n == 0 or n < floor:
                return 0
            if least is None or n < least:
                least = n
        return least or 0

    def meant(self, word: str, beside: set[str]) -> str | None:
        """What a misread word stands for, None for a sound word. ``beside`` holds the lower-case words of its document."""
        low = word.lower()
        if len(low) < 3 or low.isdigit():
            return None
        if low not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[low] = self._of_vocabulary(low)
        found = self.known[low]
        if found is not None:
            return found or None
        if low not in self.unknown:
            if len(self.unknown) > 200_000:
                self.unknown.clear()
            self.unknown[low] = self._of_names(low)
        forms, own, digits, best = self.unknown[low]
        for other in forms:
            if other in beside and len(other) > 4 and (digits or self.commonness(other) > 4 * own):
                return other
        return best if digits or word[0].isupper() else None

    def _of_names(self, low: str) -> tuple[tuple[str, ...], float, bool, str | None]:
        """The variants of a word, its own commonness, whether it has digits, and the variant that a name or a word with digits
        stands for, if any."""
        forms, own, digits = tuple(self.variants(low)), self.commonness(low), any(map(str.isdigit, low))
        # what counts below the floor decides nothing
        floor = 3 if digits else max(40, own * 40)
        best, best_count = None, 0
        for other in forms if digits or len(low) >= 5 else ():
            n = self.commonness(other, max(floor, best_count))
            if n > best_count:
                best, best_count = other, n
        if best is not None and not low.isupper() and len(low) >= 5 and best_count >= 40 and own * 40 <= best_count:
            return forms, own, digits, best
        if digits and re.search("[^\\W\\d_][015][^\\W\\d_]", low) and best_count >= 3:
            return forms, own, digits, best
        return forms, own, digits, None

    def _of_vocabulary(self, low: str) -> str | None:
        """A kept word that is much more frequent; '' for a sound word; None where the vocabulary cannot tell."""
        n = self.words.get(low, 0)
        best, best_n = "", 0
        for other in self.variants(low):
            m = self.words.get(other, 0)
            if m > best_n:
                best, best_n = other, m
        if best_n and best_n >= RARER * max(1, n) and len(low) > 3 - any(map(str.isdigit, low)):
            return best
        if best_n == 0 and n < self.least and len(low) > 5:  # two letters of one word
            for first in self.variants(low):
                for other in self.variants(first):
                    m = self.words.get(other, 0)
                    if m > best_n:
                        best, best_n = other, m
            if best_n >= RARER * self.least:
                return best
        return "" if n >= self.least else None

    def divided(self, left: str, right: str, mark: str) -> bool:
        """Whether a hyphen between two parts of a word at a line's end was put there by the layout."""
        if mark in "¬\xad":
            return True
        joined, spelt = (left + right).lower(), (left + "-" + right).lower()
        a, b = self.words.get(joined, 0), self.words.get(spelt, 0)
        if a or b:
            return a >= b
        if left.lower() in self.words and right.lower() in self.words and len(left) > 2 and len(right) > 2:
            # both halves are words: a compound unless the whole looks like a name
            return self.commonness(joined) > 30
        return True


#: Shapes of page furniture and of headings (fixed values).
_NUMBER = re.compile(r"(?:[-–—~*·.]{1,3}\s*[\dlIO|]{1,4}\s*[-–—~*·.]{1,3}|[\[(]\s*[\dlIO|]{1,4}\s*[\])]|(?i:page|p\.|pag\.|pág\.|seite|s\.|стр\.|с\.)\s*[\dlIO|]{1,4}\.?)$")
_BARE = re.compile(r"[\dlIO]{0,3}\d[\dlIO]{0,3}$")
_MARK = re.compile(r"[A-ZА-Я]{1,2} ?\d{1,2}$")
_WITH_NUMBER = re.compile(r"(?:[\[(]?(?P<a>[\dlIO]*\d[\dlIO]*)[\])]?\s+(?P<x>\S.*)|(?P<y>\S.*?)[\s.]+[\[(]?(?P<b>[\dlIO]*\d[\dlIO]*)[\])]?|CHAP\. ?\S+\] (?P<z>.*))$")
_HEADING = re.compile(r"(?i:chapter|preface|kapitel|vorwort|chapitre|préface|capítulo|prólogo|глава|предисловие|book|part|volume|section|contents|introduction|appendix)\b.{0,40}$|§ ?\d+\.?$|\d{1,3}\.$|[IVXLC]+\.?$")
_CHAPTER = re.compile(r"(?:(?i:chapter|kapitel|chapitre|capítulo|глава) |§ ?)?(\d{1,3})\.?$")
_ENDED = re.compile(r"[.!?…:][»”\"’')\]]*$")
#: A line that may be furniture; documents without one need no labelling.
_MAYBE = re.compile(r"(?m)^[ \t\x0c]*(?=\S)(?:[^a-zß-öø-ÿа-яё\n]{1,90}|[^\n]{0,80}[ \[.]\[?\d{1,4}\]?[.)\]]?|\[?\d{1,4}\]?\s+[A-ZА-Я][^\n]{1,80}|CHAP\.[^\n]*|(?i:page|seite|p\.|s\.) ?[^\n]{1,6}|[-–—][^\n]{1,9})[ \t\r]*$")

TEXT, HEAD, FURNITURE, BREAK = range(4)
#: Log-scores of passing from one state to the next: furniture comes in pairs, headings stand by breaks.
STEP = ((0.0, -1.0, -0.7, -0.2), (-0.3, -1.5, -2.0, 0.0), (-0.2, -2.0, 0.4, -0.2), (-0.2, -0.2, -0.5, -0.1))


_UPPER = re.compile("[A-ZÀ-ÖØ-ÞА-ЯЁ]")
_LOWER = re.compile("[a-zß-öø-ÿа-яё]")


def _capitals(line: str) -> float:
    if line.isupper():
        return 1.0
    upper = len(_UPPER.findall(line))
    return upper / (upper + len(_LOWER.findall(line))) if upper else 0.0


def _title_words(line: str) -> bool:
    """Whether all words of a line are capitalised, as those of a person's name are."""
    words = [w for w in line.split() if w[0].isalpha()]
    return 0 < len(words) <= 4 and all(w[0].isupper() for w in words)


def _may_be(line: str) -> bool:
    """Whether a line has a shape of furniture or a heading."""
    if len(line) > 95:
        return False
    first, last = line[0], line[-1]
    plain = first.isalpha() and last not in "])-–—·*~" and not last.isdigit() and not line.isupper() and not line.startswith(("CHAP", "Page", "Seite", "p. ", "S. "))
    return not plain and _MAYBE.match(line) is not None


def _may_hold(lines: list[str]) -> bool:
    """Whether any line has a shape of furniture or a heading."""
    return any(_may_be(b) for line in lines if (b := line.strip(" \t\r\x0c")))


def symbols(lines: list[str]) -> list[tuple[float, float, float, float] | int]:
    """What each line of a document of prose shows: a state where nothing else is possible, else the symbol of its features, which is
    their score for each state before any fit."""
    bare = [line.strip(" \t\r\x0c") for line in lines]
    filled = [i for i, line in enumerate(bare) if line]
    place = {i: k for k, i in enumerate(filled)}
    maybe = [bool(line) and _may_be(line) for line in bare]
    keys = {i: re.sub(r"\W+", " ", re.sub(r"[\dlIO]*\d[\dlIO]*", " ", bare[i])).strip().lower() for i in filled if maybe[i]}
    often = Counter(k for k in keys.values() if k)
    chapters = 0
    scores: list[tuple[float, float, float, float] | int] = []
    shaped = [ok and bool(line and (_NUMBER.match(line) or _MARK.match(line) or (_BARE.match(line)))) for line, ok in zip(bare, maybe, strict=True)]
    for i, line in enumerate(bare):
        if not line:
            scores.append(BREAK)
            continue
        if not maybe[i] and place[i]:
            scores.append(TEXT)
            continue
        k = place[i]
        before = bare[filled[k - 1]] if k else ""
        after = bare[filled[k + 1]] if k + 1 < len(filled) else ""
        gap_before, gap_after = i > 0 and not bare[i - 1], i + 1 < len(bare) and not bare[i + 1]
        text, head, furn = 0.0, -4.0, -5.0
        beside = (k > 0 and shaped[filled[k - 1]]) or (k + 1 < len(filled) and shaped[filled[k + 1]])
        broken = bool(before) and not _ENDED.search(before) and not shaped[filled[k - 1]] and _capitals(before) < 0.8
        flows = bool(after) and after[0].islower()
        fed = "\x0c" in lines[i]
        short = len(line) <= 90
        capitals = _capitals(line)
        if _HEADING.match(line) and k == 0:
            head += 9.0
        elif _HEADING.match(line):
            head += 7.0
        if _NUMBER.match(line):
            furn += 9.0
        elif _MARK.match(line):
            furn += 8.0
        elif _BARE.match(line):
            value = int(line) if line.isdigit() else -1
            follows = 0 < value <= min(30, chapters + 2) and (gap_before or gap_after) and not broken
            furn += 7.0
            if follows and not beside:
                head += 8.0
            if broken or flows or beside or fed:
                furn += 3.0
        elif short and (m := _WITH_NUMBER.match(line)):
            rest = (m["x"] or m["y"] or m["z"] or "").strip(" .")
            upper = _capitals(rest)
            if rest and (upper > 0.85 or m["z"] is not None) and len(rest) > 3 and not _HEADING.match(line):
                furn += 8.0 + 2.0 * beside
            elif rest and _title_words(rest) and not rest.endswith(",") and ("[" in line or beside or often[keys.get(i, "")] > 1 or fed):
                furn += 7.0
                if not ("[" in line or often[keys.get(i, "")] > 1 or fed) and not (broken or flows):
                    furn -= 1.0
        elif short and capitals > 0.85 and len(line) > 5 and k > 0:
            if often[keys.get(i, "")] > 1 or beside:
                furn += 8.0
            elif (broken or flows or fed) and not _ENDED.search(line):
                furn += 6.0
            elif not _HEADING.match(line):
                head += 4.5
        if k == 0 and capitals > 0.85 and not shaped[i]:
            head += 8.0
        if (m := _CHAPTER.match(line)) and int(m[1]) == chapters + 1 and not (beside and line.isdigit()):
            chapters += 1
        scores.append((text, head, furn, -9.0))
    return scores


class Chain:
    """A hidden Markov model of lines: log-scores of symbols by state, and of steps between states."""

    def __init__(self, seen: dict | None = None, step=STEP):
        self.seen, self.step = seen or {}, step

    def own(self, symbol) -> dict[int, float]:
        """The scores of a line by state; a line without any shape of its own has its state already."""
        return {symbol: 0.0} if isinstance(symbol, int) else dict(enumerate(self.seen.get(symbol, symbol)))

    def best(self, line_symbols: list) -> list[int]:
        """The likeliest states of the lines of a document."""
        best: list[dict[int, float]] = []
        back: list[dict[int, int]] = []
        for symbol in line_symbols:
            own = self.own(symbol)
            if not best:
                best.append(own)
                continue
            last, now, came = best[-1], {}, {}
            for t, value in own.items():
                s = max(last, key=lambda s: last[s] + self.step[s][t]) if len(last) > 1 else next(iter(last))  # noqa: B023
                came[t] = s
                now[t] = last[s] + self.step[s][t] + value
            best.append(now)
            back.append(came)
        state = max(best[-1], key=best[-1].get)
        states = [state]
        for came in reversed(back):
            state = came[state]
            states.append(state)
        return states[::-1]

    def expected(self, line_symbols: list) -> tuple[Counter, Counter]:
        """The expected number of each (symbol, state) and of each step of a document, by the forward and backward sums."""
        own = [{t: exp(v) for t, v in self.own(x).items()} for x in line_symbols]
        step = [[exp(v) for v in row] for row in self.step]
        ahead = []
        for k, now in enumerate(own):
            sums = {t: v * (sum(ahead[-1][s] * step[s][t] for s in ahead[-1]) if k else 1.0) for t, v in now.items()}
            total = sum(sums.values())
            ahead.append({t: v / total for t, v in sums.items()})
        seen, steps = Counter(), Counter()
        behind = dict.fromkeys(own[-1], 1.0)
        for k in range(len(own) - 1, -1, -1):
            both = {t: ahead[k][t] * behind[t] for t in own[k]}
            total = sum(both.values())
            for t, v in both.items():
                seen[line_symbols[k], t] += v / total
            if k:
                flow = {(s, t): ahead[k - 1][s] * step[s][t] * own[k][t] * behind[t] for s in own[k - 1] for t in own[k]}
                total = sum(flow.values())
                for pair, v in flow.items():
                    steps[pair] += v / total
                behind = {s: sum(step[s][t] * own[k][t] * behind[t] for t in own[k]) for s in own[k - 1]}
                top = max(behind.values())
                behind = {s: v / top for s, v in behind.items()}
        return seen, steps


def maximised(seen: dict, steps: dict) -> Chain:
    """The chain of expected counts, with ``PRIOR`` lines of each symbol split as its scores before any fit split them. Scores of a
    symbol are logarithms of how much likelier it is in a state than lines are at large."""
    total = defaultdict(float)
    for (_, state), n in seen.items():
        total[state] += n
    lines = sum(total.values())
    fitted = {}
    for symbol in {x for x, _ in seen if not isinstance(x, int)}:
        weight = [exp(v) for v in symbol]
        share = [w / sum(weight) for w in weight]
        n = [seen.get((symbol, t), 0.0) + PRIOR * share[t] for t in range(4)]
        fitted[symbol] = tuple(log(max(n[t], 1e-9) / sum(n)) - log((total[t] + PRIOR) / (lines + 4 * PRIOR)) for t in range(4))
    step = []
    for s in range(4):
        row = [steps.get((s, t), 0.0) + PRIOR * exp(STEP[s][t]) / sum(map(exp, STEP[s])) for t in range(4)]
        step.append(tuple(log(v / sum(row)) for v in row))
    return Chain(fitted, tuple(step))


def stretches(line_symbols: list) -> Iterator[tuple]:
    """The lines of a document from one whose state is plain to the next, both included, after whether they are its first: given
    the state of a line, those before and after it are independent."""
    start, last = 0, len(line_symbols) - 1
    for k, symbol in enumerate(line_symbols):
        if k and (k == last or isinstance(symbol, int)):
            yield (start == 0, *line_symbols[start : k + 1])
            start = k
    if last == 0:
        yield (True, line_symbols[0])


def fit(docs: DataFrame, counts: DataFrame | None = None) -> Chain:
    """The chain fitted on all documents: ``ROUNDS`` rounds of expected counts, one row for each symbol and state of a partition.
    ``counts`` are those of ``counted``."""
    parts = cut((counted(docs) if counts is None else counts).filter(F.col("word").startswith("#")))
    chain = Chain()
    for _ in range(ROUNDS):
        shared = parts.sparkSession.sparkContext.broadcast(chain)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chain, all_seen, all_steps = shared.value, Counter(), Counter()  # noqa: B023
            for batch in batches:
                for part, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    first, *line_symbols = literal_eval(part[1:])
                    seen, steps = chain.expected(line_symbols)
                    if not first:  # the line itself belongs to what lies before
                        seen[line_symbols[0], line_symbols[0]] -= 1
                    for pair, v in seen.items():
                        all_seen[pair] += n * v
                    for pair, v in steps.items():
                        all_steps[pair] += n * v
            rows = [("seen", repr(x), t, n) for (x, t), n in all_seen.items()] + [("step", repr(s), t, n) for (s, t), n in all_steps.items()]
            names, kinds = ["what", "symbol", "state", "n"], [pa.string(), pa.string(), pa.int32(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else ([],) * 4, kinds, strict=True)], names)

        # symbols are the few combinations of features
        sums = parts.mapInArrow(run, "what string, symbol string, state int, n double").groupBy("what", "symbol", "state").agg(F.sum("n").alias("n")).collect()
        shared.unpersist()
        read = lambda what: {(literal_eval(r["symbol"]), r["state"]): r["n"] for r in sums if r["what"] == what}
        seen = read("seen")
        if not any(isinstance(x, tuple) for x, _ in seen):
            break
        chain = maximised(seen, read("step"))
    return chain


def furniture(lines: list[str], chain: Chain | None = None) -> list[int]:
    """The state of each line of a document of prose."""
    return (chain or Chain()).best(symbols(lines))


def faults(text: str, reader: Reader, prose: bool = True, rebuild: bool = True, chain: Chain | None = None) -> tuple[list[tuple[int, str]], str | None]:
    """The faults (line number from 1, fault) of a text, and its continuous paragraphs where it has any."""
    lines = text.split("\n")
    states = furniture(lines, chain) if prose and len(lines) > 1 and _may_hold(lines) else [TEXT if line.strip() else BREAK for line in lines]
    out: list[tuple[int, str]] = [(i + 1, "furniture") for i, s in enumerate(states) if s == FURNITURE]
    # the words of the document; parts of divided words are judged as wholes
    kept = [i for i, s in enumerate(states) if s != FURNITURE and lines[i].strip(" \t\r\x0c")]
    follows = dict(zip(kept, kept[1:]))
    body = [line.rstrip("\r") for line in lines]
    divided: dict[int, tuple[str, str]] = {}
    for i in kept:
        if body[i].rstrip(" \t\r")[-1:] not in _HYPHENS or not _SPLIT.search(body[i]) or i not in follows:
            continue
        j = follows[i]
        left = re.search(r"[^\W_]+(?:[-’'][^\W_]+)*(?=[-‐¬\xad]\s*$)", body[i])
        right = re.match(r"[\s\x0c]*([^\W_]+(?:[’'][^\W_]+)*)", body[j])
        if not left or not right:
            continue
        a, b = left[0], right[1]
        if not b[0].islower() and not (b.isupper() and a.isupper()):
            continue
        mark = body[i].rstrip()[-1]
        if "-" in a and not reader.words.get((a.rsplit("-", 1)[1] + b).lower()) and reader.words.get((a + "-" + b).lower()):
            continue
        if reader.divided(a.rsplit("-", 1)[-1] if "-" in a else a, b, mark):
            out.append((i + 1, "split"))
            divided[i] = (a, b)
    # the running text: furniture gone, divided words whole
    pieces: list[str] = []
    for i, line in enumerate(body):
        if states[i] != FURNITURE:
            pieces.append(line.rstrip()[:-1] + "\x00" if i in divided else line + "\n")
    running = "".join(pieces)
    running = (re.sub("\x00[\\s\x0c]*", "", running) if "\x00" in running else running).replace("ﬁ", "fi").replace("ﬂ", "fl")
    own = _words(running)
    if running.rstrip()[-1:].isalnum() and (tail := _WORD.findall(running.rsplit(None, 1)[-1])) and len(re.findall(re.escape(tail[-1]), running)) == 1:
        own.discard(tail[-1])  # a last word may be cut off
    low = {w: w.lower() for w in own - reader.sound}
    odd = [w for w, v in low.items() if v not in reader.sound]
    fixed: dict[str, str] = {}
    if odd:
        beside = own.union(low.values())
        for word in odd:
            for part in {word, *word.split("-")} if "-" in word else (word,):
                if "’" in part or "'" in part:
                    halves = re.split("[’']", part)
                    part = halves[0] if len(halves[0]) > 2 else halves[-1]
                meant = reader.meant(part, beside)
                if meant is not None and meant != part.lower() and not (running.count(part) >= OFTEN and _usual(part, meant, running, reader)):
                    fixed[part] = meant
    if fixed:
        bad = re.compile("(?<![^\\W_])(?:" + "|".join(map(re.escape, fixed)) + ")(?![^\\W_])")
        skip = ""
        for i, line in enumerate(body):
            if states[i] == FURNITURE or not line.strip():
                continue
            line = line.replace("ﬁ", "fi").replace("ﬂ", "fl")
            if skip and line.lstrip().startswith(skip):
                line = line.lstrip()[len(skip) :]
            skip = ""
            if i in divided:
                a, b = divided[i]
                line, skip = line.rstrip()[:-1] + b, b
            if bad.search(line):
                out.append((i + 1, "misread"))
    return out, _paragraphs(body, states, divided, fixed) if out and rebuild else None


def _usual(form: str, meant: str, running: str, reader: Reader) -> bool:
    """Whether a form that may be misread is the document's own: repeated more often than the meant word is common, or a name."""
    times = len(re.findall(rf"(?<![^\W_]){re.escape(form)}(?![^\W_])", running))
    return times >= OFTEN and (form[0].isupper() or reader.words.get(meant, 0) < times * REPEATED * reader.total)


def _cased(word: str, like: str) -> str:
    return word.upper() if like.isupper() and len(like) > 1 else word.capitalize() if like[:1].isupper() else word


def _paragraphs(lines: list[str], states: list[int], divided: dict[int, tuple[str, str]], fixed: dict[str, str]) -> str:
    """Continuous paragraphs: furniture gone, divided words joined, misread words replaced, lines run on.

    A break next to furniture ends a paragraph only after a closed sentence."""
    parts: list[str] = []
    current = ""
    near = False
    for i, line in enumerate(lines):
        state = states[i]
        if state == FURNITURE:
            near = True
            continue
        bare = line.strip(" \t\r\x0c")
        if not bare:
            if current and (not near or _ENDED.search(current)) and not (i and states[i - 1] == TEXT and not _ENDED.search(current)):
                parts.append(current)
                current = ""
            continue
        near = False
        if state == HEAD:
            parts += [current, bare] if current else [bare]
            current = ""
            continue
        if i in divided:
            bare = bare[:-1] + "\x00"
        if current.endswith("\x00"):
            current = current[:-1] + bare
        elif current[-1:] == "-" and current[-2:-1].isalpha():
            current += bare  # a hyphen of the spelling
        else:
            current = f"{current} {bare}" if current else bare
    if current:
        parts.append(current)
    text = "\n\n".join(parts).replace("\x00", "").replace("ﬁ", "fi").replace("ﬂ", "fl")
    return _WORD.sub(lambda m: _cased(fixed[m[0]], m[0]) if m[0] in fixed else m[0], text) if fixed else text


def _each(docs: DataFrame, schema: str, rebuild: bool, rows) -> DataFrame:
    counts = counted(docs)
    chain = fit(docs, counts)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(docs, counts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quire.llm.garbled import repair
        from quire.llm.quality import kind_of

        reader = Reader(*shared.value)
        names = [f.split()[0] for f in schema.split(", ")]
        kinds = [{"long": pa.int64(), "int": pa.int32(), "string": pa.string()}[f.split()[1]] for f in schema.split(", ")]
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if doc_id is not None and text and not text.isspace():
                    restored = repair(text)[1]
                    sound = restored if restored is not None and restored.count("\n") == text.count("\n") else text
                    kind = kind_of(sound)
                    if kind != "junk" and kind != "table":
                        out += rows(doc_id, *faults(sound, reader, not kind, rebuild, chain))
            columns = list(zip(*out, strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return lean(docs, "doc_id", "text").mapInArrow(run, schema)


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, fault): one row for each fault that a line has."""
    return _each(docs, "doc_id long, line_no int, fault string", False, lambda doc_id, found, _: [(doc_id, n, fault) for n, fault in found]).distinct()


def repaired(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the continuous paragraphs of every document with a fault."""
    return _each(docs, "doc_id long, text string", True, lambda doc_id, _, text: [(doc_id, text)] if text is not None else [])
