"""Encoding of the whole corpus with a public tokenizer (problem 7).

The library ``tokenizers`` encodes Arrow batches. A byte-level pre-tokenizer's pieces are either free of white space, save
one leading blank, or white space only, so a text may be cut into visible runs (each with its leading blank) and the white
space between them, by the pre-tokenizer's own rule for white space, and equal runs are encoded once per worker: the ids are
those of the whole text. Texts with the few characters that the two regular expression engines class differently are encoded
whole.

Defined cases: a null text and the empty text both have the empty list of ids; the strings of special tokens are ordinary
text; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from quire.llm.base import by_chars, lean

#: Where the vocabulary files lie; the environment may name another folder.
TOKENIZER_DIR = os.environ.get("QUIRE_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE = "byte_bpe_50k.json"
#: Pieces kept per worker before the memory is given back, and characters encoded at a time.
KEPT_PIECES = 200_000
CHARS_AT_ONCE = 4_000_000


@lru_cache(maxsize=2)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


#: The pre-tokenizer's rule for white space; visible characters stay together. UNLIKE are white space to one engine only.
RUNS = re.compile(r" ?\S+|\s+(?!\S)|\s+")
UNLIKE = re.compile(r"[\x1c-\x1f]")


class Pieces(dict):
    """The ids of each run met so far by this worker, as the bytes of 32-bit integers."""

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = load(path)

    def learn(self, runs: set[str]) -> None:
        if len(self) > KEPT_PIECES:
            self.clear()
        new = [run for run in runs if run not in self]
        for run, ids in zip(new, self.codes(new), strict=True):
            self[run] = ids

    def codes(self, texts: list[str]) -> list[bytes]:
        return [array("i", code.ids).tobytes() for code in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def encode_packed(texts: list[str | None], path: str) -> list[bytes]:
    """The ids of each text, as the bytes of 32-bit integers."""
    known = pieces_of(path)
    out: list[bytes] = []
    for a, b in by_chars(texts, CHARS_AT_ONCE):
        runs = [None if text and UNLIKE.search(text) else RUNS.findall(text or "") for text in texts[a:b]]
        whole = [text for text, cut in zip(texts[a:b], runs, strict=True) if cut is None]
        codes = iter(known.codes(whole) if whole else ())
        known.learn(set(chain.from_iterable(cut for cut in runs if cut)))
        get = known.__getitem__
        out += [next(codes) if cut is None else b"".join(map(get, cut)) for cut in runs]
    return out


def encode(texts: list[str | None], path: str) -> list[list[int]]:
    """The ids of each text."""
    return [np.frombuffer(ids, np.int32).tolist() for ids in encode_packed(texts, path)]


def count(texts: list[str | None], path: str) -> list[int]:
    """The number of ids of each text."""
    return [len(ids) // 4 for ids in encode_packed(texts, path)]


@lru_cache(maxsize=2)
def byte_table(path: str) -> tuple[dict[str, int], list[bytes]]:
    """The byte behind each visible character of a byte-level vocabulary, and the bytes of each id.

    The vocabulary writes printable bytes as themselves and the others, in order, as the characters from 256 on.
    """
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    table = {chr(b): b for b in shown}
    table |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocab = load(path).get_vocab(with_added_tokens=True)
    spelled = [b""] * (max(vocab.values()) + 1)
    for token, number in vocab.items():
        spelled[number] = bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()
    return table, spelled


def decode(ids: list[int], path: str) -> str:
    """The text of the ids. A character split over ids is whole again once all its bytes are there; bytes that stay
    without their rest become replacement characters."""
    spelled = byte_table(path)[1]
    return b"".join([spelled[i] for i in ids]).decode("utf-8", "replace")


def offsets(text: str, ids: list[int], path: str) -> tuple[list[int], list[int]]:
    """For each id, the first character it touches and the one after the last. Ids that share a split character both
    cover it."""
    spelled = byte_table(path)[1]
    ends = np.cumsum([len(spelled[i]) for i in ids], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if len(ids) else ends
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    char = np.cumsum((raw & 0xC0) != 0x80) - 1
    return (char[starts].tolist(), (char[ends - 1] + 1).tolist()) if len(ids) else ([], [])


def _lists(packed: list[bytes]) -> pa.ListArray:
    ends = np.cumsum([0, *(len(ids) // 4 for ids in packed)], dtype=np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), np.int32)))


def _path(vocabulary: str, folder: str | None) -> str:
    return os.path.join(folder or TOKENIZER_DIR, vocabulary)


def encode_corpus(docs: DataFrame, vocabulary: str = BYTE_BPE, folder: str | None = None) -> DataFrame:
    """(doc_id, ids) of every row of ``docs`` (doc_id, text)."""
    path = _path(vocabulary, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1).to_pylist()
            for a, b in by_chars(texts, CHARS_AT_ONCE):
                yield pa.RecordBatch.from_arrays([doc_ids.slice(a, b - a), _lists(encode_packed(texts[a:b], path))], ["doc_id", "ids"])

    return lean(docs, "doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def corpus_offsets(docs: DataFrame, vocabulary: str = BYTE_BPE, folder: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, n_split, last_end, restored): the ids' count, how many of them share a character with the id
    before, the character after the last one, and whether decoding gives the text back."""
    path = _path(vocabulary, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            texts = batch.column(1).to_pylist()
            for text, ids in zip(texts, encode(texts, path), strict=True):
                starts, ends = offsets(text or "", ids, path)
                split = sum(s < e for s, e in zip(starts[1:], ends[:-1], strict=True))
                rows.append((len(ids), split, ends[-1] if ends else 0, decode(ids, path) == (text or "")))
            columns = zip(*rows, strict=True)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_tokens", "n_split", "last_end", "restored"],
            )

    return lean(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_tokens int, n_split int, last_end long, restored boolean")


def token_counts(docs: DataFrame, vocabulary: str = BYTE_BPE, folder: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of every row of ``docs`` (doc_id, text)."""
    path = _path(vocabulary, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array(count(batch.column(1).to_pylist(), path), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes], ["doc_id", "n_tokens"])

    return lean(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_tokens int")
