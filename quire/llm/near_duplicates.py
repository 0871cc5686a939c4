"""Near-duplicate documents with small edits (problem 3), by covering locality-sensitive hashing.

Each document becomes ``GROUPS`` vectors of seven min-hash coordinates over its distinct runs of three words. A table is one
bit mask over the seven coordinates of a group, and two documents collide in it when they agree on all the coordinates that
the mask keeps. Coordinates are numbered by the vectors other than zero of three bits, and the mask of such a vector v keeps
the three coordinates orthogonal to it: for any two coordinates some v is orthogonal to neither, so every pair of vectors that
differ in at most two coordinates collides in some table, and so do 28 of 35 of those that differ in three.

The search is certain for vectors, not for texts: a coordinate agrees with the probability of the similarity, so a pair is
found with the probability 0.992 at a similarity of 0.50, 0.996 at 0.52, 0.998 at 0.55 and 0.9997 at 0.60.

Equal word sequences are one class with one representative; only representatives are hashed. The rows of a key are counted
with partial sums before any shuffle, so no key is hot there. Only the rows of keys that stand twice go on, picked by a bitmap
before the shuffle, and those above ``BLOCK`` rows are dealt by a salt and joined block by block, so that no bucket is ever
held by one task and none is cut short. Rows carry the last six bits of each coordinate, and pairs that agree on fewer than ``AGREE``
of 49 are dropped in the join itself, for a pair of that kind has a similarity of 0.5 with a probability below 0.0003; the same is asked
of the full coordinates before the texts are fetched. What is left is checked exactly on whole texts.

Defined cases: null, empty and short texts (fewer than ``MIN_WORDS`` words) belong to no class and have no pair; repeated
rows of one doc_id count once; ties do not arise, as ids order the pairs; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.base import by_chars, cut, lean

RUN = 3
MIN_WORDS = 30
THRESHOLD = 0.5
GROUPS = 7
WIDTH = 7
#: Rows of a bucket joined by one task, the parts that larger buckets are read in, and the copies of one text that are still spelled out pair by pair.
BLOCK = 512
SALTS = 64
COPIES = 256
#: Coordinates that two texts must agree on to be compared, at a similarity of one half (24.5 of 49 on average, spread 3.5).
AGREE = 13
#: The sketch that goes with a key: the last bits of each coordinate, so many to a long.
LANE = 6
LANES = 10
SKETCH = ("l0", "l1", "l2", "l3", "l4")
#: Most bits of a bitmap sent to all tasks (64 MB); a smaller one has eight bits for each value.
FILTER_BITS = 29
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def masks() -> list[tuple[int, ...]]:
    """The coordinates that each table of a group keeps."""
    names = range(1, WIDTH + 1)
    return [tuple(m - 1 for m in names if not (m & v).bit_count() % 2) for v in names]


def words_of(text: str) -> list[bytes]:
    """Lower-cased pieces between blanks, tabs, line and page breaks."""
    return text.lower().encode("utf-8", "surrogatepass").split()


def runs_of(text: str) -> set[tuple[bytes, ...]]:
    words = words_of(text)
    return set(zip(words, words[1:], words[2:]))


def similarity(a: str, b: str) -> float:
    """Share of the distinct runs found in either text that both hold."""
    left, right = runs_of(a), runs_of(b)
    both = len(left & right)
    return both / max(1, len(left) + len(right) - both)


def _seeds(n: int) -> np.ndarray:
    state = np.arange(1, n + 1, dtype=np.uint64) * _MIX[0]
    state = (state ^ (state >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (state ^ (state >> np.uint64(27))) | np.uint64(1)


def _coordinates(text_words: list[list[bytes]]) -> np.ndarray:
    """A row of min-hash coordinates for each list of words, 16 bits each."""
    hashed: dict[bytes, int] = {}
    digest = xxhash.xxh3_64_intdigest
    flat: list[int] = []
    for words in text_words:
        for w in words:
            h = hashed.get(w)
            if h is None:
                h = hashed[w] = digest(w)
            flat.append(h)
    sizes = np.array([len(w) for w in text_words])
    h = np.array(flat, dtype=np.uint64)
    runs = (h[:-2] * _MIX[0]) ^ ((h[1:-1] * _MIX[1]) << np.uint64(1)) ^ (h[2:] * _MIX[2])
    runs ^= runs >> np.uint64(29)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    # the two runs that cross into the next text must never be a minimum
    keep = np.ones(len(runs), dtype=bool)
    for back in (1, 2):
        at = starts[1:] - back
        keep[at] = False
    kept = runs[keep]
    ends = np.cumsum(sizes - (RUN - 1))
    begin = np.concatenate([[0], ends[:-1]])
    signature = np.empty((len(sizes), GROUPS * WIDTH), dtype=np.uint64)
    for k, seed in enumerate(_seeds(GROUPS * WIDTH)):
        v = kept * seed
        v ^= v >> np.uint64(32)
        v *= _MIX[1]
        signature[:, k] = np.minimum.reduceat(v, begin)
    # a minimum is small, the more so the longer the text: its leading bits say little, so it is mixed before it is shortened
    return ((signature ^ (signature >> np.uint64(31))) * _MIX[2] >> np.uint64(48)).astype(np.uint16)


def sketch(signature: np.ndarray) -> list[np.ndarray]:
    """The last ``LANE`` bits of the coordinates of each row, ``LANES`` to a long."""
    out = [np.zeros(len(signature), np.int64) for _ in SKETCH]
    for k in range(signature.shape[1]):
        out[k // LANES] |= (signature[:, k] & np.uint16(2**LANE - 1)).astype(np.int64) << (LANE * (k % LANES))
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, low, high, sig, l0 to l4): the digest of the word sequence, the coordinates and their sketch of each document that counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in by_chars(texts, 4_000_000):
                ids, low, high, words = [], [], [], []
                for doc_id, text in zip(batch.column(0).slice(a, b - a).to_pylist(), texts[a:b], strict=True):
                    pieces = words_of(text) if text and doc_id is not None else ()
                    if len(pieces) >= MIN_WORDS:
                        digest = xxhash.xxh3_128_digest(b" ".join(pieces))
                        ids.append(doc_id)
                        low.append(int.from_bytes(digest[:8], "big", signed=True))
                        high.append(int.from_bytes(digest[8:], "big", signed=True))
                        words.append(pieces)
                if ids:
                    sig = _coordinates(words)
                    lists = pa.array([row.tobytes() for row in sig], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(low, pa.int64()), pa.array(high, pa.int64()), lists, *map(pa.array, sketch(sig))], ["doc_id", "low", "high", "sig", *SKETCH])

    return lean(docs, "doc_id", "text").mapInArrow(run, "doc_id long, low long, high long, sig binary, " + ", ".join(f"{c} long" for c in SKETCH))


def table_keys(column: str) -> list[Column]:
    """The key of a document in each table, from its coordinates of two bytes each."""
    return [F.xxhash64(F.lit(g * 64 + m), *[F.substring(column, 2 * (g * WIDTH + i) + 1, 2) for i in mask]) for g in range(GROUPS) for m, mask in enumerate(masks())]


def differing() -> Column:
    """How many of the lanes of x and y differ: a lane that is not zero after the exclusive or carries into its highest bit."""
    low, high = (sum(bit << LANE * i for i in range(LANES)) for bit in (2 ** (LANE - 1) - 1, 2 ** (LANE - 1)))

    def longs(c: str) -> Column:
        v = F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))
        return F.bit_count((v.bitwiseAND(F.lit(low)) + F.lit(low)).bitwiseOR(v).bitwiseAND(F.lit(high)))

    return sum((longs(c) for c in SKETCH[1:]), longs(SKETCH[0]))


def candidates(rows: DataFrame, block: int = BLOCK, agree: int = 0) -> DataFrame:
    """(a, b) with a < b: the pairs of ids that share a key in ``rows`` (id, key), each once. With ``agree``, ``rows`` have the columns
    ``SKETCH`` too, and pairs that agree on fewer coordinates are left out where they meet: texts that are alike in a
    few phrases share keys in a number that is quadratic in the corpus, and none of these pairs is written anywhere."""
    lanes = [c for c in SKETCH if agree]
    apart = F.lit(True) if not agree else differing() <= GROUPS * WIDTH - agree
    sizes = cut(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"))
    middle = sizes.filter(F.col("n") <= block).select("key")
    own = among(rows, middle, "key").join(middle, "key")  # the same exchange serves both sides
    met = lambda x, y, on: x.alias("x").join(y.alias("y"), on).filter(F.col("x.id") < F.col("y.id")).filter(apart).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    pairs = met(own, own, "key")
    large = sizes.filter(F.col("n") > block).select("key", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks"))
    if large.isEmpty():
        return pairs.distinct()
    # each row of a large bucket meets every block once: as the left side in (own, j) and as the right side in (i, own)
    salt = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(SALTS)).cast("int")
    dealt = large.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    placed = cut(among(rows, large, "key").withColumn("salt", salt).join(dealt, ["key", "salt"]).select("id", "key", *lanes, "blocks", F.pmod(F.xxhash64("id"), F.col("blocks").cast("long")).cast("int").alias("own")))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = placed.select("id", "key", *lanes, "own", every.alias("other"))
    right = placed.select("id", "key", *lanes, F.col("own").alias("other"), every.alias("own"))
    return pairs.union(met(left, right, ["key", "own", "other"])).distinct()


def among(rows: DataFrame, wanted: DataFrame, column: str, most_bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not in ``wanted``: a filter before a shuffle, which a join must
    follow; it never takes out a wanted row.

    The wanted values, which should lie in a checkpoint, are counted, and set bits of one bitmap of eight bits for each, but of ``2 ** most_bits`` bits at most,
    which is sent to all tasks in rows of 4 KB. Beyond that size the bitmap is fuller and takes out fewer rows.
    """
    bits = min(most_bits, max(15, (8 * wanted.count()).bit_length()))
    spot = F.pmod(F.xxhash64(column), F.lit(2**bits)).cast("long")
    maps = wanted.select(spot.alias("spot")).groupBy(F.bitmap_bucket_number("spot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("spot")).alias("map"))
    byte = F.conv(F.hex(F.substring("map", F.floor(F.bitmap_bit_position(spot) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    kept = rows.withColumn("spot", spot).withColumn("bucket", F.bitmap_bucket_number("spot")).join(F.broadcast(maps), "bucket")
    return kept.filter(F.getbit(byte, F.pmod(F.bitmap_bit_position("spot"), F.lit(8)).cast("int")) == 1).select(*rows.columns)


def _paired(pairs: DataFrame, side: DataFrame, value: str) -> DataFrame:
    """``pairs`` (a, b) with the ``value`` of both ends in ``side`` (id, value) as left and right."""
    left, right = side.select(F.col("id").alias("a"), F.col(value).alias("left")), side.select(F.col("id").alias("b"), F.col(value).alias("right"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")


def likely(pairs: DataFrame, signed: DataFrame, agree: int = AGREE) -> DataFrame:
    """The pairs (a, b) whose signatures in ``signed`` (id, sig) agree on enough coordinates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for k in (2, 3))
                keep = pa.array((left == right).sum(1) >= agree)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(keep)

    return _paired(pairs, signed, "sig").mapInArrow(run, "a long, b long")


def _checked(pairs: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose texts reach the threshold, computed on the whole texts."""
    ends = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b"))
    texts = among(lean(docs, "doc_id", "text"), ends, "doc_id").dropDuplicates(["doc_id"]).withColumnRenamed("doc_id", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = [similarity(x, y) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            keep = pa.array([s >= threshold for s in score], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score, pa.float64())], ["a", "b", "similarity"]).filter(keep)

    return _paired(pairs, texts, "text").mapInArrow(run, "a long, b long, similarity double")


def link(docs: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """The pairs (a, b, similarity) of class representatives, and the classes (doc_id, rep)."""
    signed = cut(signatures(docs))
    chosen = cut(signed.groupBy("low", "high").agg(F.min("doc_id").alias("id"), F.first(F.struct("sig", *SKETCH)).alias("s")).select("low", "high", "id", "s.*"))
    members = signed.select("doc_id", "low", "high").join(chosen.select("low", "high", F.col("id").alias("rep")), ["low", "high"]).select("doc_id", "rep").distinct()
    rows = chosen.select("id", *SKETCH, F.explode(F.array(*table_keys("sig"))).alias("key"))
    close = cut(likely(candidates(rows, block, AGREE), chosen))
    pairs = cut(_checked(close, docs, threshold))
    return pairs, members


def found(docs: DataFrame, threshold: float = THRESHOLD, copies: int = COPIES) -> DataFrame:
    """(doc_id_a, doc_id_b) of every pair at or above the threshold, copies included.

    A class of more than ``copies`` equal texts is given by its representative: each copy is paired with the representative,
    and pairs with other texts name the representative; spelling it out would take a number of rows that is quadratic in
    the class.
    """
    pairs, members = link(docs, threshold)
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    small = sizes.filter(F.col("n") <= copies).select("rep")
    large = sizes.filter(F.col("n") > copies).select("rep")
    copied = members.join(small, "rep", "left_semi")
    within = copied.alias("x").join(copied.alias("y"), "rep").filter("x.doc_id < y.doc_id").select(F.col("x.doc_id").alias("doc_id_a"), F.col("y.doc_id").alias("doc_id_b"))
    star = members.join(large, "rep", "left_semi").filter("doc_id > rep").select(F.col("rep").alias("doc_id_a"), F.col("doc_id").alias("doc_id_b"))

    def spelled(side: str, other: str, df: DataFrame) -> DataFrame:
        own = copied.select(F.col("rep").alias(side), F.col("doc_id").alias("copy"))
        return df.join(own, side, "left").select(F.coalesce("copy", side).alias(side), other)

    across = spelled("b", "a", spelled("a", "b", pairs.select("a", "b")))
    across = across.select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b"))
    return within.union(star).union(across).distinct()


def grouped(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, copies, links): each document that counts, the smallest id with its words, how many documents
    have them, and with how many other texts it is linked."""
    pairs, members = link(docs, threshold)
    ends = pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).groupBy("rep").agg(F.count(F.lit(1)).alias("links"))
    sizes = members.groupBy("rep").agg(F.count(F.lit(1)).alias("copies"))
    return (
        members.join(sizes, "rep")
        .join(ends, "rep", "left")
        .select("doc_id", F.col("rep").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
    )
