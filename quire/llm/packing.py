"""Documents packed into containers of fixed capacity (problem 8), by swap-based local search.

The documents that a specification selects are measured in tokens of a public tokenizer. A document longer than the capacity
is the only one that is divided: into full containers and one rest, which is packed like a document. Items are dealt by a hash
of their id into groups of a bounded number of items (the order of a specification is that of its texts, not of its containers), and each group is packed by itself: first each item into the
fullest container it fits, then exchanges one for one and two for one and moves between underfull containers, each raising the sum
of squared fills, until containers run empty and no exchange helps. What the group's search leaves in its underfull containers is pooled
and packed again in the next round with half as many groups at most, so that the unused space of the groups' last
containers does not add up; the rounds end when one group is left.

Defined cases: null, empty and blank texts have no tokens to place and are left out; a specification without documents has
no container; ties are broken by id; repeated rows of a doc_id count once; extra columns are ignored.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.base import cut, lean
from quire.llm.tokens import BYTE_BPE, token_counts

#: Items of a group, and how full a container must be to be left alone.
GROUP = 4_000
FULL = 0.995
#: Passes of the exchanges over a group's underfull containers.
PASSES = 6
SCHEMA = "spec_id long, container string, doc_id long, part int, tokens int, position int"


def selected(docs: DataFrame, extractions: DataFrame, selection: str | None) -> DataFrame:
    """The documents that a specification's selection names; no or unreadable JSON selects all, unknown names select none."""
    try:
        wanted = json.loads(selection) if selection else {}
    except ValueError:
        wanted = {}
    out = docs
    for name, value in (wanted or {}).items():
        values = value if isinstance(value, list) else [value]
        if name in ("lang", "source"):
            out = out.filter(F.col(name).isin(*values))
        elif name in ("quality_status", "category", "extractor", "status"):
            named = extractions.filter(F.col(name).isin(*values)).select("text_uri").distinct()
            out = out.join(named, "text_uri", "left_semi")
        else:
            out = out.filter(F.lit(False))
    return out


def best_fit(items: list[tuple[int, int]], capacity: int) -> list[list[int]]:
    """Containers (lists of indices into ``items``, which are (size, key)): each item, longest first, goes where it leaves
    the least space."""
    bins: list[list[int]] = []
    space: list[tuple[int, int]] = []  # (space left, container), sorted
    for k in sorted(range(len(items)), key=lambda i: (-items[i][0], items[i][1])):
        size = items[k][0]
        at = bisect_left(space, (size, -1))
        if at < len(space):
            left, b = space.pop(at)
            bins[b].append(k)
        else:
            left, b = capacity, len(bins)
            bins.append([k])
        if left > size:
            insort(space, (left - size, b))
    return bins


def exchange(items: list[tuple[int, int]], bins: list[list[int]], capacity: int, passes: int = PASSES) -> list[list[int]]:
    """The containers after moves and exchanges (one for one, two for one) between underfull ones.

    A step is taken where it raises the sum of squared fills, that is where it fills the fuller of two containers further: the
    emptier one drains. Containers are worked on from the fullest down, each with the items of all that are less full in one
    sorted list, so the best partner of every item and of every pair of a container is found by bisection, and none is left
    untried. Items of one size stand for one another."""
    size = [s for s, _ in items]
    fill = [sum(size[i] for i in b) for b in bins]
    for _ in range(passes):
        open_bins = sorted((b for b in range(len(bins)) if bins[b] and fill[b] < capacity), key=lambda b: (-fill[b], b))
        if len(open_bins) < 2:
            break
        pool = sorted((size[i], i) for b in open_bins for i in bins[b])
        home = {i: b for b in open_bins for i in bins[b]}
        steps = 0
        for b in open_bins:
            for i in bins[b]:
                del pool[bisect_left(pool, (size[i], i))]
            gap = capacity - fill[b]
            while gap > 0 and bins[b] and pool:
                step = _best_step(pool, gap, {size[i]: i for i in bins[b]}, size, bins[b])
                if step is None:
                    break
                gain, at, leaving = step
                come = pool.pop(at)[1]
                c = home[come]
                bins[c].remove(come)
                bins[b].append(come)
                home[come] = b
                for i in leaving:
                    bins[b].remove(i)
                    bins[c].append(i)
                    home[i] = c
                    insort(pool, (size[i], i))
                fill[b] += gain
                fill[c] -= gain
                gap -= gain
                steps += 1
        if not steps:
            break
    return [b for b in bins if b]


def _best_step(pool: list[tuple[int, int]], gap: int, own: dict[int, int], size: list[int], members: list[int]) -> tuple[int, int, tuple[int, ...]] | None:
    """(gain, place of the item that comes, items that go back): the step that fills the gap most, if any gains. ``own`` has one
    item for each size of the container."""
    best: tuple[int, int, tuple[int, ...]] | None = None

    def tried(back: int, leaving: tuple[int, ...]) -> bool:
        nonlocal best
        at = bisect_left(pool, (gap + back + 1, -1)) - 1
        if at >= 0 and pool[at][0] - back > (best[0] if best else 0):
            best = (pool[at][0] - back, at, leaving)
        return best is not None and best[0] == gap

    if tried(0, ()):
        return best
    for s, i in own.items():
        if tried(s, (i,)):
            return best
    sizes = sorted(own)
    twice = {size[i]: i for i in members if own[size[i]] != i}
    for k, x in enumerate(sizes):
        if x in twice and tried(2 * x, (own[x], twice[x])):
            return best
        for y in sizes[k + 1 :]:
            if tried(x + y, (own[x], own[y])):
                return best
    return best


def pack(items: list[tuple[int, int]], capacity: int) -> list[list[int]]:
    """Containers of indices into ``items`` (size, key), none of which is longer than the capacity."""
    return exchange(items, best_fit(items, capacity), capacity)


def pieces(sized: DataFrame, capacity: int) -> DataFrame:
    """(doc_id, part, tokens) of each item: a document, or the full parts and the rest of one beyond the capacity."""
    parts = F.explode(F.sequence(F.lit(0), F.floor((F.col("n_tokens") - 1) / capacity).cast("int")))
    return sized.filter("n_tokens > 0").withColumn("part", parts).select("doc_id", "part", F.least(F.lit(capacity), F.col("n_tokens") - F.col("part") * capacity).cast("int").alias("tokens"))


def containers(sized: DataFrame, spec_id: int, capacity: int, group: int = GROUP) -> DataFrame:
    """(spec_id, container, doc_id, part, tokens, position) for the documents of ``sized`` (doc_id, n_tokens)."""
    items = cut(pieces(sized.dropDuplicates(["doc_id"]), capacity))
    whole = items.filter(F.col("tokens") == capacity).select(
        F.lit(spec_id).cast("long").alias("spec_id"), F.concat_ws("-", F.lit(spec_id), F.lit("w"), "doc_id", "part").alias("container"), "doc_id", "part", "tokens", F.lit(0).alias("position")
    )
    rest = items.filter(F.col("tokens") < capacity).withColumn("ready", F.lit(False))
    n = rest.count()
    done = whole
    rounds = 0
    while n:
        groups = max(1, -(-n // group))
        last = groups == 1

        def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            rows = frame.sort_values(["doc_id", "part"])
            items = list(zip(rows["tokens"].tolist(), range(len(rows)), strict=True))
            out = []
            ids, parts = rows["doc_id"].tolist(), rows["part"].tolist()
            for number, bin_ in enumerate(pack(items, capacity)):
                fill = sum(items[i][0] for i in bin_)
                name = f"{spec_id}-{rounds}-{key[0]}-{number}" if last or fill >= FULL * capacity else None  # noqa: B023
                out += [(spec_id, name, ids[i], parts[i], items[i][0], position) for position, i in enumerate(sorted(bin_))]
            return pd.DataFrame(out, columns=["spec_id", "container", "doc_id", "part", "tokens", "position"])

        slot = F.pmod(F.xxhash64("doc_id", "part", F.lit(rounds)), F.lit(groups))
        # packing costs far more than its few bytes tell: the tasks are set by the number of groups, not by their size
        tasks = max(1, min(groups, max(4 * rest.sparkSession.sparkContext.defaultParallelism, groups // 25)))
        packed = cut(rest.withColumn("slot", slot).repartition(tasks, "slot").groupBy("slot").applyInPandas(run, SCHEMA))
        done = done.unionByName(packed.filter("container is not null"))
        if last:
            break
        rest = packed.filter("container is null").select("doc_id", "part", "tokens")
        left = rest.count()
        # groups that cannot fill their containers any better are given twice the items each
        group, n, rounds = group if left < 0.7 * n else group * 2, left, rounds + 1
        if rounds > 12 or group > 8 * GROUP:
            last_round = packed.filter("container is null")
            done = done.unionByName(_as_packed(last_round, spec_id, capacity, groups))
            break
    return done


def _as_packed(rows: DataFrame, spec_id: int, capacity: int, groups: int) -> DataFrame:
    """The containers of items that no further round improves: each group's own packing."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        rows = frame.sort_values(["doc_id", "part"])
        items = list(zip(rows["tokens"].tolist(), range(len(rows)), strict=True))
        ids, parts = rows["doc_id"].tolist(), rows["part"].tolist()
        out = [
            (spec_id, f"{spec_id}-l-{key[0]}-{number}", ids[i], parts[i], items[i][0], position)
            for number, bin_ in enumerate(pack(items, capacity))
            for position, i in enumerate(sorted(bin_))
        ]
        return pd.DataFrame(out, columns=["spec_id", "container", "doc_id", "part", "tokens", "position"])

    return rows.withColumn("slot", F.pmod(F.xxhash64("doc_id", "part"), F.lit(groups))).groupBy("slot").applyInPandas(run, SCHEMA)


def packed(tables: dict[str, DataFrame], vocabulary: str = BYTE_BPE) -> DataFrame:
    """The containers of every specification. Documents are measured once, whatever the number of specifications."""
    docs = lean(tables["documents"], "doc_id", "text", "lang", "source", "text_uri").filter("doc_id is not null")
    sizes = cut(token_counts(docs.filter(F.length(F.trim("text")) > 0), vocabulary))
    extractions = tables["extractions"]
    out = None
    # a handful of rows: the table of specifications does not grow
    for spec in tables["corpus_specs"].select("id", "selection_json", "capacity_tokens").orderBy("id").collect():
        if spec["capacity_tokens"] is None or spec["capacity_tokens"] <= 0:
            continue
        named = selected(docs.drop("text"), extractions, spec["selection_json"]).select("doc_id")
        one = containers(sizes.join(named, "doc_id", "left_semi"), spec["id"], spec["capacity_tokens"])
        out = one if out is None else out.unionByName(one)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def usage(tables: dict[str, DataFrame]) -> DataFrame:
    """(spec_id, containers, tokens, capacity, fill): how full the containers of each specification are."""
    full = packed(tables).groupBy("spec_id").agg(F.count_distinct("container").alias("containers"), F.sum("tokens").alias("tokens"))
    return full.join(tables["corpus_specs"].select(F.col("id").alias("spec_id"), F.col("capacity_tokens").cast("long").alias("capacity")), "spec_id").withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity")), 6))
