"""Text decoded with the wrong character encoding (problem 5).

Characters are mapped back to the bytes of a legacy code page, a byte-structure automaton (a regular expression over those
bytes) finds the maximal well-formed multibyte spans of UTF-8, and only those spans are decoded. A span counts only where it
decodes to characters that running text is made of. Damage without such a structure is named by its traces:
replacement characters and question marks inside words, byte-swapped UTF-16, scripts and signs mixed within words, and letters
that one single-byte code page shows in place of another's. Whether unusual letters are such a trace is never told from a list of
letters: a model of the corpus counts in how many documents each pair of letters stands, and a word counts as misread
only where turned back by one pair of code pages it is clearly likelier, so words of any language that the corpus knows nothing of
stay as they are.

Defined cases: null, empty and blank texts are not affected and have no restored text; a replacement character only at the
very end is a cut and does not count; repeated rows give repeated results; extra columns are ignored. ``restored`` is the
repaired text of an affected document, null where the original characters are lost.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.base import lean

#: Code pages as which UTF-8 was read, in the order tried.
READ_AS = ("cp1252", "cp1251", "mac_roman", "cp850", "cp437", "koi8_r", "cp1250")
#: (read as, written in) for single-byte confusions.
SWAPPED = (("cp1252", "cp1251"), ("cp1251", "cp1252"), ("cp850", "cp1252"), ("cp437", "cp1252"), ("mac_roman", "cp1252"), ("cp1252", "mac_roman"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("koi8_r", "cp1251"), ("cp1251", "koi8_r"), ("cp866", "cp1251"), ("cp1251", "cp866"), ("cp1252", "koi8_r"), ("cp1252", "cp866"), ("iso8859_5", "cp1251"), ("cp1251", "iso8859_5"), ("cp1250", "cp1252"))
#: How much likelier (natural logarithm, for each misread word) the words must be once they are turned back.
LIKELIER = 4.0
#: Marks that may stand inside or beside words of sound text (fixed values).
MARKS = "“”‘’«»„‚‹›–—…¿¡°§′″№€£©®™·•†‡½¼¾²³ªº×÷≈√±¶¬│─\u00a0\u00ad\u2010\u2011"


def _page(name: str) -> dict[str, int]:
    """The byte behind each character of a code page; bytes it leaves undefined are the control characters themselves."""
    page = {}
    for b in range(128, 256):
        try:
            page[bytes([b]).decode(name)] = b
        except UnicodeDecodeError:
            page[chr(b)] = b
    if name == "cp1252":  # also read as Latin-1, whose upper controls stand for their own bytes
        page |= {chr(b): b for b in range(128, 160)}
    return page


def _table(name: str) -> dict[int, str]:
    """For ``str.translate``: each character of the page as the character of its byte; others beyond 255 stay."""
    return {ord(c): chr(b) for c, b in _page(name).items()}


#: Well-formed multibyte sequences, one byte a character: the automaton of the encoding's definition.
SPAN = re.compile(
    "(?:[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    "|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2})+"
)
#: What a decoded span may hold: accented Latin letters, Cyrillic, and the punctuation of running text.
PLAUSIBLE = re.compile("[\u00a0-\u00bf\u00c0-\u017f\u0400-\u045f\u2010-\u203a\u20ac\u2116\u2122\u2248\u221a\u2032\u200d\U0001f000-\U0001ffff]+")
_PAGES = {name: _table(name) for name in READ_AS}
_LEADS = {name: re.compile("[" + "".join(re.escape(c) for c, b in _page(name).items() if 0xC2 <= b <= 0xF4) + "][" + "".join(re.escape(c) for c, b in _page(name).items() if 0x80 <= b <= 0xBF) + "]") for name in READ_AS}
_SCRIPT = {"latin": re.compile("[A-Za-z\u00c0-\u024f]"), "cyrillic": re.compile("[\u0400-\u045f]")}


def _script(c: str) -> str:
    return next((name for name, p in _SCRIPT.items() if p.match(c)), "")


def decode_spans(text: str, name: str) -> tuple[str, int]:
    """The text with its well-formed spans under the page decoded, and how many characters they gave."""
    if not _LEADS[name].search(text):
        return text, 0
    byte = text.translate(_PAGES[name])
    out, at, got = [], 0, 0
    for m in SPAN.finditer(byte):
        a, b = m.span()
        raw = text[a:b]
        if any(ord(c) > 255 for c in m[0]):
            continue
        plain = m[0].encode("latin-1").decode("utf-8", "replace")
        again = SPAN.search(plain) is not None  # decoded twice: the next round goes on
        if not again and not PLAUSIBLE.fullmatch(plain):
            continue
        if not again and not _fits(text, a, b, plain, raw):
            continue
        out += [text[at:a], plain]
        at = b
        got += len(plain)
    return ("".join(out) + text[at:], got) if got else (text, 0)


def _fits(text: str, a: int, b: int, plain: str, raw: str) -> bool:
    """A span of sound text may be well-formed by chance: its letters must then go with the letters beside it."""
    letters = {_script(c) for c in plain} - {""}
    if len(letters) > 1:
        return False
    beside = {_script(c) for c in (text[a - 1 : a], text[b : b + 1]) if c} - {""}
    own = {_script(c) for c in raw} - {""}
    if not letters:  # punctuation or signs: only where the characters shown are odd together
        return bool(own) or len(raw) > 2 or (plain in "\u00a0«»¿¡°§·º" and bool(beside))
    if letters == {"cyrillic"} and "latin" in beside and len(plain) < 2:
        return False
    if letters == {"cyrillic"} and "cyrillic" in own and len(plain) < 2 and beside == {"cyrillic"}:
        return bool(re.search("[^\u0410-\u044f\u0401\u0451]", raw))
    return not beside or "latin" not in letters or beside <= {"latin"} or len(plain) > 1


_LETTER = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f\u0400-\u045f"
_LOST = re.compile(f"[{_LETTER}][?][{_LETTER}]|(?:^|[\\s(“«\"])[?][{_LETTER}]|[,.][?](?=\\s)|[{_LETTER}]\ufffd|\ufffd[{_LETTER}]|\ufffd[^\ufffd]")
_MIXED = re.compile("[A-Za-z\u00c0-\u024f][\u0400-\u045f]|[\u0400-\u045f][A-Za-z\u00c0-\u024f]")
_ODD_CASE = re.compile("[\u0430-\u044f\u0451][\u0410-\u042f\u0401]")
_FOREIGN = re.compile(f"(?<=[a-zßäöüéèàáíóúñçêâîôû])[ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞþðýÿ](?=[a-z])|(?<=[A-Za-z])[^\\x00-\\x7f\\w{MARKS}\u0300-\u036f\u2000-\u2064\ufb00-\ufb06\ufeff\ufffd]|(?<=[a-z])[÷±²³½¼¾·ªº°§¶‚„‡†…•™©®£€¿¡](?=[a-z])|[\x80-\x9f]")
_LATIN_RUN = re.compile("(?<![A-Za-z])[\u00c0-\u00ff¸¨]{4,}(?![A-Za-z])")
_SYMBOL_IN_CYRILLIC = re.compile("(?<=[\u0410-\u044f])[^\\x00-\\x7f\u0400-\u045f{M}\u0300-\u036f\u2000-\u2064\ufeff\ufffd](?=[\u0410-\u044f])".replace("{M}", MARKS) + "|[\u2500-\u259f][\u0410-\u044f]|[\u0410-\u044f][\u2500-\u259f]|[\u0402-\u040f\u0452-\u0450\u0452-\u045f][\u0430-\u044f]".replace("\u0452-\u0450", ""))


def _traces(text: str) -> int:
    """How many traces of a single-byte confusion the text bears."""
    return sum(len(p.findall(text)) for p in (_MIXED, _ODD_CASE, _FOREIGN, _LATIN_RUN, _SYMBOL_IN_CYRILLIC))


def _swap(word: str, read: dict[str, int], written: str) -> str:
    return "".join(c if ord(c) < 128 or c not in read else bytes([read[c]]).decode(written, "replace") for c in word)


_READ = {read: _page(read) for read, _ in SWAPPED}
def _common(text: str) -> float:
    """Share of the most frequent letters of Russian and of lower-case accented Latin letters: decides between pages."""
    letters = [c for c in text if ord(c) > 127]
    return sum(c in "оеаинтсрвлäöüßéèàêçáíóúñ’“”" for c in letters) / max(1, len(letters))


#: Words with a Latin letter beyond ASCII, the pairs of letters in them, and where the model's letters end.
_MARKED = re.compile("[A-Za-z\u00c0-\u024f]*[\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f][A-Za-z\u00c0-\u024f]*")
_LAST = "\u024f"


def pairs_of(word: str) -> list[str]:
    """The pairs of neighbouring characters of a word, its ends included, that hold a letter beyond ASCII."""
    marked = f"^{word.lower()}$"
    return [marked[i : i + 2] for i in range(len(marked) - 1) if not marked[i : i + 2].isascii()]


def letter_pairs(docs: DataFrame) -> dict[str, int]:
    """In how many documents each pair of letters stands, for pairs of two documents or more. There are at most as many pairs
    as the Latin letters up to U+024F allow (some 160 000), however large the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                if text and not text.isascii():
                    counts.update({p for w in set(_MARKED.findall(text)) for p in pairs_of(w)})
            yield pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["pair", "n"])

    counted = lean(docs, "text").mapInArrow(run, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return {r["pair"]: r["n"] for r in counted.filter("n >= 2").collect()}


def turned_back(text: str, model: dict[str, int]) -> str | None:
    """The text with the words turned back that the model finds clearly likelier under one pair of code pages, if any."""
    words = [w for w in set(_MARKED.findall(text)) if not _SOUND.issuperset(w)]
    if not words:
        return None
    weigh = lambda w: sum(log(model.get(p, 0) + 0.5) for p in pairs_of(w)) if all(c <= _LAST for c in w) else 0.0
    best, gain = {}, 0.0
    for read, written in SWAPPED:
        page = _READ[read]
        changed = {w: _swap(w, page, written) for w in words}
        changed = {w: v for w, v in changed.items() if v != w and v.isalpha()}
        if changed:
            own = sum(weigh(v) - weigh(w) - log(0.5) * (len(pairs_of(v)) - len(pairs_of(w))) for w, v in changed.items())
            if own > gain and own >= LIKELIER * len(changed) and len(changed) * 2 >= len(words):
                best, gain = changed, own
    return _MARKED.sub(lambda m: best.get(m[0], m[0]), text) if best else None


_LINE = re.compile("[^\n]+")
_TOKEN = re.compile("\\S+")


def _unswap(text: str) -> str | None:
    """The text with its lines or words of foreign look turned back, by the pair of pages that leaves the fewest traces.

    The pair is chosen on the distinct words of the lines that bear traces; the whole text is turned back once."""
    odd_lines = [line for line in text.split("\n") if not line.isascii() and _traces(line)]
    words = sorted({w for line in odd_lines for w in line.split() if not w.isascii()})
    joined = "\n".join(words)
    best, least = None, (_traces(joined), 0.0)
    for read, written in SWAPPED:
        again = "\n".join(_swap(w, _READ[read], written) for w in words)
        if "\ufffd" not in again and (left := (_traces(again), -_common(again))) < least:
            best, least = (_READ[read], written), left
    if best is None:
        odd = [w for w in words if _traces(w)]
        least = (len(odd), 0.0)
        for read, written in SWAPPED:
            again = "\n".join(_swap(w, _READ[read], written) for w in odd)
            if "\ufffd" not in again and (left := (_traces(again), -_common(again))) < least:
                best, least = (_READ[read], written), left
    if best is None:
        return None
    before = _traces(text)
    for piece in (_LINE, _TOKEN):
        again = piece.sub(lambda m: _swap(m[0], *best) if not m[0].isascii() and _traces(m[0]) else m[0], text)
        if _traces(again) * 4 <= before:
            return again
    return None


def unswap_utf16(text: str) -> str | None:
    """The text of UTF-16 read in the wrong byte order, where a good part of its characters have a zero low byte."""
    wide = [c for c in text if ord(c) > 255]
    if len(wide) < 8 or sum(not ord(c) & 255 for c in wide) < 0.6 * len(wide) or len(wide) < 0.2 * len(text):
        return None
    return re.sub("[^\\x00-\\x7f]+", lambda m: m[0].encode("utf-16-le", "surrogatepass").decode("utf-16-be", "replace") if sum(not ord(c) & 255 for c in m[0]) * 4 >= len(m[0]) else m[0], text)


_UPPER = frozenset("ÄÖÜÉÈÊËÀÇÎÏÔÛÙÁÍÓÚÑÒÌ")
_RUSSIAN = frozenset(map(chr, range(0x410, 0x450))) | {"Ё", "ё"}
_ASCII_LETTERS = frozenset(map(chr, [*range(65, 91), *range(97, 123)]))
#: Characters of which none is the first of a well-formed span in any page, or a trace, as long as no other is there.
_SOUND = frozenset(map(chr, range(128))) | _UPPER | _RUSSIAN | frozenset("äöüßéèêëàçîïôûùœæíóúñáãåøìò“”‘’«»–—…¿¡§\u00a0\u00ad¬\u2010\ufffd")


def repair(text: str | None, model: dict[str, int] | None = None) -> tuple[bool, str | None, str]:
    """(affected, restored, kind): whether the text bears traces of a wrong encoding, its repaired form, and which. Unusual
    letters are judged only with a ``model`` of the corpus."""
    if not text or text.isspace():
        return False, None, ""
    body = text.rstrip().rstrip("\ufffd")
    lost = _LOST.search(body) if "?" in body or "\ufffd" in body else None
    if body.isascii():
        return (True, None, "lost") if lost else (False, None, "")
    chars = set(text)
    if chars <= _SOUND:
        if lost:
            return True, None, "lost"
        upper = chars & _UPPER and _FOREIGN.search(text)
        if upper or (chars & _RUSSIAN and (_ODD_CASE.search(text) or (chars & _ASCII_LETTERS and _MIXED.search(text)))):
            return True, _unswap(text), "page"
        return False, None, ""
    if any(c > "\u00ff" and not ord(c) & 255 for c in chars) and (wide := unswap_utf16(text)) is not None:
        return True, wide, "utf16"
    fixed, found = text, 0
    for _ in range(3):
        best, name_got = fixed, 0
        for name in READ_AS:
            again, got = decode_spans(fixed, name)
            if got > name_got:
                best, name_got = again, got
        if not name_got:
            break
        fixed, found = best, found + name_got
    if 0 < found < 4 and not lost and _traces(text) >= 4 and (turned := _unswap(text)) is not None:
        return True, turned, "page"  # well-formed by chance in a text of another page
    if found:
        return True, None if lost else fixed, "utf8"
    if lost:
        return True, None, "lost"
    if any(p.search(text) for p in (_MIXED, _ODD_CASE, _FOREIGN, _LATIN_RUN, _SYMBOL_IN_CYRILLIC)):
        return True, _unswap(text), "page"
    if model and (turned := turned_back(text, model)) is not None:
        return True, turned, "page"
    return False, None, ""


def repaired(text: str | None) -> str | None:
    """The repaired text where there is one, else the text itself."""
    restored = repair(text)[1]
    return text if restored is None else restored


def garbled(docs: DataFrame) -> DataFrame:
    """(doc_id, kind, restored) of the affected rows of ``docs`` (doc_id, text); documents that are junk as a whole are not
    garbled text."""
    shared = docs.sparkSession.sparkContext.broadcast(letter_pairs(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quire.llm.quality import kind_of

        model = shared.value
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                affected, restored, kind = repair(text, model)
                if affected and doc_id is not None and kind_of(restored if restored is not None else text) != "junk":
                    rows.append((doc_id, kind, restored))
            ids, kinds, texts = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(texts, pa.string())], ["doc_id", "kind", "restored"])

    return lean(docs, "doc_id", "text").mapInArrow(run, "doc_id long, kind string, restored string")


def found(docs: DataFrame) -> DataFrame:
    """(doc_id) of every document of which all or some was decoded with a wrong encoding or lost characters."""
    return garbled(docs).select("doc_id").distinct()
