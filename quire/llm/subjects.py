"""Subject areas of each document (problem 6), by averaged word and subword embeddings with independent logistic outputs.

The model is fitted on a bounded sample of labelled documents: the hand labels, and the categories of the extractions where they
name a subject, with less weight, as they are often wrong. ``SAMPLE`` documents at most are taken, in the order of a hash of
their id, hand labels first; everything else covers all documents. In each round every partition of the sample computes the
gradient of its documents, the gradients are summed, and one step is taken with the sum. The fitted model then labels single
sentences, and a second fit on the sentences of the sample that it is sure of (those of no subject included) sharpens it.
Every sentence of every document is scored, and a subject counts where at least a quarter of the sentences, or of the
entries of a list, treat it.

Defined cases: null, empty and blank texts, tables and junk have no subject; labels of unknown documents or subjects are
ignored; without any label nothing is found; repeated rows give repeated results once; extra columns are ignored.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.base import by_chars, cut, lean
from quire.llm.quality import STOP, kind_of

SUBJECTS = ("philosophy", "political_economy", "history", "literature", "law", "natural_science", "medicine", "software", "sport", "music")
SAMPLE = 4_000
BUCKETS = 1 << 14
DIM = 12
PARTS = 4
ROUNDS = (25, 35)
RATE = 0.2
WEAK = 0.5
SHARE = 0.22
_WORD = re.compile(r"[^\W\d_]{3,}")
_SENTENCE = re.compile(r"(?<=[.!?…])[”\"»’)]*\s+")


def buckets(word: str) -> np.ndarray:
    """The buckets of a word: its own and those of its runs of four letters."""
    marked = f"<{word}>"
    grams = {word, *(marked[i : i + 4] for i in range(len(marked) - 3))}
    return np.unique(np.array([zlib.crc32(g.encode()) & (BUCKETS - 1) for g in sorted(grams)]))


def words_of(text: str) -> list[str]:
    return [w for w in _WORD.findall(text.lower()) if w not in STOP]


def units(text: str, kind: str) -> list[str]:
    """The sentences of prose, or the entries of a list."""
    if kind == "list":
        return [line for line in text.splitlines() if line.strip()]
    running = re.sub(r"[-‐¬\xad][ \r]*\n\s*(?=[a-zß-ÿа-я])", "", text)
    return [s for s in _SENTENCE.split(running) if len(s) > 2]


class Batch:
    """Texts as counts of words: enough for the model, in arrays."""

    def __init__(self, texts: list[list[str]]):
        index: dict[str, int] = {}
        flat = [index.setdefault(w, len(index)) for words in texts for w in words]
        self.sizes = np.array([len(w) for w in texts])
        self.flat = np.array(flat, dtype=np.int64)
        self.rows = np.repeat(np.arange(len(texts)), self.sizes)
        each = [buckets(w) for w in index]
        self.words = np.repeat(np.arange(len(each)), [len(b) for b in each]) if each else np.zeros(0, np.int64)
        self.buckets = np.concatenate(each) if each else np.zeros(0, np.int64)
        self.spread = np.array([len(b) for b in each], dtype=np.float32)

    def word_vectors(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.spread), table.shape[1]), np.float32)
        if len(self.spread):
            starts = np.concatenate([[0], np.cumsum(self.spread.astype(np.int64))[:-1]])
            out = np.add.reduceat(table[self.buckets], starts, axis=0) / self.spread[:, None]
        return out

    def means(self, vectors: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.sizes), vectors.shape[1]), np.float32)
        filled = np.flatnonzero(self.sizes)
        if len(filled):
            starts = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])[filled]
            out[filled] = np.add.reduceat(vectors[self.flat], starts, axis=0) / self.sizes[filled, None]
        return out


def gradient(batch: Batch, target: np.ndarray, weight: np.ndarray, table: np.ndarray, top: np.ndarray, bias: np.ndarray):
    """The summed gradients of the logistic losses for the embeddings, the outputs and the biases."""
    hidden = batch.means(batch.word_vectors(table))
    wrong = (1 / (1 + np.exp(-(hidden @ top + bias))) - target) * weight[:, None]
    back = (wrong @ top.T) / np.maximum(1, batch.sizes)[:, None]
    per_word = np.zeros((len(batch.spread), DIM), np.float32)
    for k in range(DIM):
        per_word[:, k] = np.bincount(batch.flat, weights=back[batch.rows, k], minlength=len(batch.spread))
    per_word /= np.maximum(1, batch.spread)[:, None]
    grad = np.zeros_like(table)
    for k in range(DIM):
        grad[:, k] = np.bincount(batch.buckets, weights=per_word[batch.words, k], minlength=BUCKETS)
    return grad, hidden.T @ wrong, wrong.sum(0)


def start(seed: int = 7):
    rng = np.random.default_rng(seed)
    table = (rng.standard_normal((BUCKETS, DIM)) * 0.3).astype(np.float32)
    top = (rng.standard_normal((DIM, len(SUBJECTS))) * 0.3).astype(np.float32)
    return [table, top, np.full(len(SUBJECTS), -2.0, np.float32)]


class Adam:
    """Steps with the running moments of the summed gradients."""

    def __init__(self, model):
        self.m = [np.zeros_like(p) for p in model]
        self.v = [np.zeros_like(p) for p in model]
        self.t = 0

    def step(self, model, grads, rate: float) -> None:
        self.t += 1
        for p, g, m, v in zip(model, grads, self.m, self.v, strict=True):
            m += 0.1 * (g - m)
            v += 0.02 * (g * g - v)
            p -= rate * (m / (1 - 0.9**self.t)) / (np.sqrt(v / (1 - 0.98**self.t)) + 1e-8)


class Scorer:
    """Scores of words, kept per worker, and of sentences."""

    def __init__(self, model):
        self.table, self.top, self.bias = model
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(SUBJECTS)), np.float32)

    def learn(self, words: set[str]) -> None:
        if len(self.index) > 200_000:
            self.forget()
        new = [w for w in words if w not in self.index]
        if new:
            each = [buckets(w) for w in new]
            sizes = np.array([len(b) for b in each])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            means = np.add.reduceat(self.table[np.concatenate(each)], starts, axis=0) / sizes[:, None]
            self.index.update(zip(new, range(len(self.scores), len(self.scores) + len(new)), strict=True))
            self.scores = np.concatenate([self.scores, (means @ self.top).astype(np.float32)])

    def sentences(self, texts: list[str]) -> np.ndarray:
        """A row of scores for each text; a text without words scores low for every subject."""
        words = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        out = np.full((len(texts), len(SUBJECTS)), -9.0, np.float32)
        filled = np.flatnonzero(sizes)
        if len(filled):
            flat = list(chain.from_iterable(words))
            self.learn(set(flat))
            rows = np.fromiter(map(self.index.__getitem__, flat), np.int64, len(flat))
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])[filled]
            out[filled] = np.add.reduceat(self.scores[rows], starts, axis=0) / sizes[filled, None] + self.bias
        return out


#: What a worker keeps of the batches it has met.
_BUILT: dict[tuple, tuple] = {}


def _built(key: tuple, batch: pa.RecordBatch) -> tuple:
    """The arrays of a batch of examples, made once by each worker. A function of the module, so that workers share its
    store over tasks: what a task's own function refers to is copied with it."""
    if key not in _BUILT:
        if len(_BUILT) > 4 * PARTS:
            _BUILT.clear()
        words = batch.column(0).to_pylist()
        _BUILT[key] = (Batch(words), np.array(batch.column(1).to_pylist(), np.float32), batch.column(2).to_numpy(), len(words))
    return _BUILT[key]


def labels(spark_tables: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, text, marks): the labelled sample; marks holds a weight for each subject named."""
    docs = lean(spark_tables["documents"], "doc_id", "text", "text_uri").filter("doc_id is not null and length(text) > 0")
    hand = lean(spark_tables["subject_labels"], "doc_id", "subject").filter(F.col("subject").isin(*SUBJECTS)).groupBy("doc_id", "subject").agg(F.lit(1.0).alias("w"))
    named = F.regexp_replace(F.lower(F.trim("category")), "[ -]+", "_")
    weak = lean(spark_tables["extractions"], "text_uri", "category").withColumn("subject", named).filter(F.col("subject").isin(*SUBJECTS)).select("text_uri", "subject").distinct()
    weak = weak.join(docs.select("doc_id", "text_uri"), "text_uri").select("doc_id", "subject").distinct().withColumn("w", F.lit(WEAK))
    marks = hand.unionByName(weak).groupBy("doc_id", "subject").agg(F.max("w").alias("w")).groupBy("doc_id").agg(F.collect_list(F.struct("subject", "w")).alias("marks"), F.max("w").alias("best"))
    sample = marks.orderBy(F.desc("best"), F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    return docs.select("doc_id", "text").dropDuplicates(["doc_id"]).join(sample.select("doc_id", "marks"), "doc_id")


def _examples(sample: DataFrame, teacher=None) -> DataFrame:
    """(words, target, weight) of the sample (doc_id, text, marks): its documents or, with a teacher, the sentences it is
    sure of."""
    shared = sample.sparkSession.sparkContext.broadcast(teacher)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, target, weight = examples(batch, shared.value)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.list_(pa.string())), pa.array(list(target), pa.list_(pa.float32())), pa.array(weight, pa.float32())], ["words", "target", "weight"])

    return cut(sample.mapInArrow(run, "words array<string>, target array<float>, weight float"))


def _fit(rows: DataFrame, rounds: int, model):
    """Rounds of summed gradients over the examples (words, target, weight) in PARTS partitions. A worker keeps the arrays that it built of a batch for the next round, and builds them again where
    the batch has moved to another one."""
    sc = rows.sparkSession.sparkContext
    run_id = uuid.uuid4().hex
    adam = Adam(model)
    count = None
    for k in range(rounds):
        shared = sc.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = shared.value  # noqa: B023
            total, n = None, 0.0
            for k, batch in enumerate(batches):
                key = (run_id, TaskContext.get().partitionId(), k)
                built, target, weight, size = _built(key, batch)
                if not size:
                    continue
                grads = gradient(built, target, weight, *model)
                total = grads if total is None else [a + b for a, b in zip(total, grads, strict=True)]
                n += float(weight.sum())
            if total is not None:
                packed = [g.astype(np.float32).tobytes() for g in total]
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.float64()), *[pa.array([p], pa.binary()) for p in packed]], ["n", "table", "top", "bias"])

        # PARTS rows of a fixed size (about one megabyte each), whatever the data
        sums = rows.mapInArrow(run, "n double, table binary, top binary, bias binary").collect()
        shared.unpersist()
        count = sum(r["n"] for r in sums)
        if not count:
            return model
        grads = [sum(np.frombuffer(r[name], np.float32) for r in sums).reshape(p.shape) / count for name, p in zip(("table", "top", "bias"), model, strict=True)]
        adam.step(model, grads, RATE * (1 - k / (rounds + 5)))
    return model


def examples(batch: pa.RecordBatch, teacher) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """The words, targets and weights that a batch of the sample gives: whole documents, or sentences a teacher is sure of."""
    words, targets, weights = [], [], []
    scorer = Scorer(teacher) if teacher is not None else None
    for text, marks in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
        kind = kind_of(text)
        if kind in ("table", "junk"):
            continue
        target = np.zeros(len(SUBJECTS), np.float32)
        for mark in marks:
            target[SUBJECTS.index(mark["subject"])] = 1.0
        if scorer is None:
            words.append(words_of(text))
            targets.append(target)
            weights.append(max(m["w"] for m in marks))
            continue
        parts = units(text, kind)
        scores = scorer.sentences(parts)
        best = scores.argmax(1)
        for part, score, k in zip(parts, scores, best, strict=True):
            sure = score[k] > 0.0
            none = score[k] < -1.5
            if sure or none:
                own = np.zeros(len(SUBJECTS), np.float32)
                if sure:
                    own[k] = 1.0
                words.append(words_of(part))
                targets.append(own)
                weights.append(1.0)
    if scorer is not None and words:
        # the subjects weigh alike, and sentences of none as much as all of them together
        t = np.array(targets)
        each = np.maximum(1.0, t.sum(0))
        scale = np.where(t.any(1), (1 / each)[t.argmax(1)], 1 / max(1.0, (~t.any(1)).sum()) * len(SUBJECTS))
        weights = list(scale / scale.mean())
    return words, np.array(targets, np.float32).reshape(len(words), len(SUBJECTS)), np.array(weights, np.float32)


def train(tables: dict[str, DataFrame]):
    """The model fitted on the labelled sample."""
    sample = cut(labels(tables).repartition(PARTS, "doc_id"))
    model = _fit(_examples(sample), ROUNDS[0], start())
    return _fit(_examples(sample, model), ROUNDS[1], start(11))


def shares(docs: DataFrame, model) -> DataFrame:
    """(doc_id, n_chars, subject, share): for each document and subject that any of its sentences treats, their share."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quire.llm.garbled import repaired

        scorer = Scorer(shared.value)
        for batch in batches:
            ids, sizes, names, values = [], [], [], []
            texts = batch.column(1).to_pylist()
            for a, b in by_chars(texts, 2_000_000):
                whole, parts = [], []
                for doc_id, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts[a:b], strict=True):
                    if doc_id is None or not text or text.isspace():
                        continue
                    sound = repaired(text)
                    kind = kind_of(sound)
                    if kind not in ("table", "junk") and (own := units(sound, kind)):
                        whole.append((doc_id, len(text), len(parts), len(own)))
                        parts += own
                treated = scorer.sentences(parts) > 0
                for doc_id, size, at, n in whole:
                    share = treated[at : at + n].mean(0)
                    for k in np.flatnonzero(share):
                        ids.append(doc_id)
                        sizes.append(size)
                        names.append(SUBJECTS[k])
                        values.append(float(share[k]))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(names, pa.string()), pa.array(values, pa.float64())], ["doc_id", "n_chars", "subject", "share"])

    return lean(docs, "doc_id", "text").mapInArrow(run, "doc_id long, n_chars long, subject string, share double")


def found(tables: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, subject): one row for each subject that a document treats."""
    return shares(tables["documents"], train(tables)).filter(F.col("share") >= SHARE).select("doc_id", "subject").distinct()


def composition(tables: dict[str, DataFrame]) -> DataFrame:
    """(subject, documents, chars): the corpus by subject; a document of several subjects counts for each."""
    return shares(tables["documents"], train(tables)).filter(F.col("share") >= SHARE).groupBy("subject").agg(F.count_distinct("doc_id").alias("documents"), F.sum("n_chars").alias("chars"))
