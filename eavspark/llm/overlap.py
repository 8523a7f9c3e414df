"""N-gram Jaccard join by T-occurrence search.

Two sets of like size that overlap by ``percent`` of their union share at least T of
their shingles, so a set's partners are the sets found on T of its inverted lists.
DivideSkip finds them: the longest lists are set aside, the short ones are merged by a
heap that skips what cannot reach the count, and only what is left is probed for in the
long lists by binary search.

Spread over a cluster:

- Texts with equal sets form a class, and one member stands for it.
- Shingle hashes are dealt by range, packed, and each range tells how many of a class's
  shingles occur in another class. Below T the class has no partner and is done.
- The classes left order their shared shingles by rarity. Two partners must share one
  of the first (shared - T + 1); the least class that holds such a shingle names the
  block where they meet, so a family of copies meets in a few blocks, not once per
  shingle.
- In every block, first the class that names it searches for its partners. What that
  links is one component. Only members of other components search again, among all the
  block's members. Blocks of any size are cut in cells (members x searchers) of bounded
  size, and a cell returns the links that join components, not all pairs.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavspark.llm.cells import Roots, grouped
from eavspark.llm.common import shingle_set, small_slices
from eavspark.llm.neardup import digest
from eavspark.session import materialize, small_batches

RANGE = 1 << 21  # shingles of a hash range
MU = 0.0085  # weighs a probe against a step of the merge


# ---- T-occurrence search in one cell ----------------------------------------------


def merge_skip(lists: list[list[int]], need: int) -> Iterator[tuple[int, int]]:
    """(record, lists that hold it) of every record on ``need`` of the sorted lists or more."""
    heap = [(a[0], i, 0) for i, a in enumerate(lists)]
    heapify(heap)
    while len(heap) >= need:
        top, out = heap[0][0], []
        while heap and heap[0][0] == top:
            out.append(heappop(heap))
        if len(out) >= need:
            yield top, len(out)
            target = top + 1
        else:  # nothing before the need-th smallest head can be on ``need`` lists
            while heap and len(out) < need - 1:
                out.append(heappop(heap))
            if not heap:
                return
            target = heap[0][0]
        for _, i, at in out:
            at = bisect_left(lists[i], target, at)
            if at < len(lists[i]):
                heappush(heap, (lists[i][at], i, at))


def divide_skip(lists: list[list[int]], need: int) -> Iterator[tuple[int, int, list[list[int]]]]:
    """(record, count on the short lists, the long lists) of what may be on ``need`` of the lists."""
    if len(lists) < need:
        return
    lists = sorted(lists, key=len)
    aside = min(need - 1, int(need / (MU * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    for record, count in merge_skip(short, need - aside):
        yield record, count, long


def holds(a: list[int], record: int) -> bool:
    at = bisect_left(a, record)
    return at < len(a) and a[at] == record


def cell_links(members: list[dict], searchers: list[dict], percent: int) -> list[tuple[bytes, bytes]]:
    """Components that links of one cell join, by their roots; both sides have n, root and tokens."""
    asked = np.unique(np.concatenate([s["tokens"] for s in searchers]))
    owner = np.repeat(np.arange(len(members)), [len(m["tokens"]) for m in members])
    tokens = np.concatenate([m["tokens"] for m in members])
    some = np.isin(tokens, asked)
    owner, tokens = owner[some], tokens[some]
    order = np.argsort(tokens, kind="stable")
    owner = owner[order]
    heads, starts = np.unique(tokens[order], return_index=True)
    ends = [*starts[1:].tolist(), len(owner)]
    inverted = {t: owner[a:b].tolist() for t, a, b in zip(heads.tolist(), starts.tolist(), ends, strict=True)}
    roots, out = Roots(), []
    for s in searchers:
        size = s["n"]
        lists = [a for t in s["tokens"].tolist() if (a := inverted.get(t))]
        for record, count, long in divide_skip(lists, -(-percent * size // 100)):
            n = members[record]["n"]
            own, its = roots.find(s["root"]), roots.find(members[record]["root"])
            if own == its or 100 * min(n, size) < percent * max(n, size):
                continue
            need = -(-percent * (n + size) // (100 + percent))
            for left, a in zip(range(len(long), 0, -1), long, strict=True):
                if count >= need or count + left < need:
                    break
                count += holds(a, record)
            if count >= need:
                roots.join(own, its)
                out.append((s["root"], members[record]["root"]))
    return out


# ---- sets, classes and who may have a partner -------------------------------------


def classes_of(df: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, class) of every row of (doc_id, text); empty sets have no class."""

    def run(batches: Iterator[pa.RecordBatch]):
        for part in small_slices(batches, "text"):
            sets = [shingle_set(t or b"", words) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "n_shingles", "class"],
            )

    return df.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, class binary")


def ranges(df: DataFrame, words: int, count: int) -> DataFrame:
    """(range, tokens, classes, sizes): each task's shingles dealt to ``count`` ranges of their
    hash, low 32 bits packed, beside the classes they come from (first 8 bytes) and how many each."""

    def deal(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        names, each = np.array(list(held), np.int64), [len(s) for s in held.values()]
        tokens = np.concatenate(list(held.values()))
        held.clear()
        where = tokens >> np.uint64(32)
        where *= np.uint64(count)
        where >>= np.uint64(32)
        tokens, where = tokens.astype(np.uint32), where.astype(np.uint32)
        order = np.argsort(where, kind="stable")
        owner = np.repeat(np.arange(len(names), dtype=np.int32), each)[order]
        tokens, where = tokens[order], where[order]
        starts = np.flatnonzero(np.diff(where, prepend=~where[:1]))
        some, rows = where[starts], []
        for a, b in zip(starts, [*starts[1:], len(where)], strict=True):
            runs = np.flatnonzero(np.diff(owner[a:b], prepend=~owner[a]))
            rows.append((tokens[a:b].tobytes(), names[owner[a:b][runs]].tobytes(), np.diff(runs, append=b - a).astype(np.uint32).tobytes()))
        columns = [pa.array(some, pa.int64()), *(pa.array(c, pa.binary()) for c in zip(*rows, strict=True))]
        return pa.RecordBatch.from_arrays(columns, names=["range", "tokens", "classes", "sizes"])

    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[int, np.ndarray] = {}  # deal() empties it
        size = 0
        for part in small_slices(batches, "text"):
            for t in part.column(0).to_pylist():
                s = shingle_set(t or b"", words)
                if len(s):
                    name = int.from_bytes(digest(s)[:8], "big", signed=True)
                    size += len(s) if name not in held else 0
                    held[name] = s
            if size > RANGE:
                yield deal(held)
                size = 0
        if held:
            yield deal(held)

    return df.select("text").mapInArrow(run, "range long, tokens binary, classes binary, sizes binary")


def shared_counts(packed: DataFrame, parts: int) -> DataFrame:
    """(name, shared): how many shingles of a class occur in another class, for those that have any.

    Every range packs what it finds for ``parts`` parts of the classes, and every part adds up."""

    def count(table: pa.Table) -> pa.Table:
        tokens, classes, sizes = (
            np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("tokens", np.uint32), ("classes", np.int64), ("sizes", np.uint32))
        )
        classes, which = np.unique(classes, return_inverse=True)
        met = tokens.astype(np.uint64)  # a token above, the place of its class below
        met <<= np.uint64(32)
        met |= np.repeat(which.astype(np.uint32), sizes)
        met.sort()
        met = met[np.append(True, met[1:] != met[:-1])]  # a class met in several tasks counts once
        owner, tokens = met.astype(np.uint32), (met >> np.uint64(32)).astype(np.uint32)
        same = tokens[1:] == tokens[:-1]
        n = np.bincount(owner[np.append(same, False) | np.append(False, same)], minlength=len(classes))
        names, n = classes[n > 0], n[n > 0]
        where = names % parts
        order = np.argsort(where, kind="stable")
        split = np.split(order, np.flatnonzero(np.diff(where[order])) + 1) if len(order) else []
        return pa.table({
            "part": pa.array([where[s[0]] for s in split], pa.int64()), "names": pa.array([names[s].tobytes() for s in split], pa.binary()),
            "shared": pa.array([n[s].astype(np.uint32).tobytes() for s in split], pa.binary()),
        })

    def total(table: pa.Table) -> pa.Table:
        names, n = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("names", np.int64), ("shared", np.uint32)))
        names, which = np.unique(names, return_inverse=True)
        return pa.table({"name": pa.array(names), "shared": pa.array(np.bincount(which, n).astype(np.int64))})

    found = packed.groupBy("range").applyInArrow(count, "part long, names binary, shared binary")
    return found.groupBy("part").applyInArrow(total, "name long, shared long")


def sets_of(df: DataFrame, words: int) -> DataFrame:
    """(class, tokens) of every text that has words."""

    def run(batches: Iterator[pa.RecordBatch]):
        for part in small_slices(batches, "text"):
            sets = [s for t in part.column(0).to_pylist() if len(s := shingle_set(t or b"", words))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["class", "tokens"],
            )

    return df.select("text").mapInArrow(run, "class binary, tokens array<long>")


def least_overlap(size: Column, percent: int) -> Column:
    return F.call_function("div", F.lit(percent) * size + 99, F.lit(100).cast("long"))


def name_of(digests: Column) -> Column:
    """The first 8 bytes of a class as a long, as ``ranges`` names it."""
    return F.conv(F.hex(F.substring(digests, 1, 8)), 16, -10).cast("long")


# ---- the whole join ---------------------------------------------------------------


def jaccard_groups(
    df: DataFrame, words: int = 3, percent: int = 90, id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``df``.

    Shingles are runs of ``words`` words, A-Z lower-cased; a shorter text is one
    shingle; a null text or one without words has none and is linked with nothing.
    Texts whose sets overlap by ``percent`` of their union are linked, and
    ``component_id`` is the smallest id reachable. Rows that share an id keep their own
    text's component; a text that only rows without an id carry is linked with its
    equals alone and has no component id. Other columns are not read; an empty table
    gives no rows. Equal hashes (64 bits, classes 160) stand for equal shingles; the
    links are exact otherwise, whatever the sizes of texts and groups.
    """
    small_batches(df.sparkSession)
    docs = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = materialize(classes_of(docs, words), "classes")
    some = found.where(F.col("class").isNotNull())
    classes = some.groupBy("class").agg(F.min("doc_id").alias("id"), F.min("n_shingles").alias("n"))
    total = some.agg(F.sum("n_shingles")).first()[0] or 0
    count = max(1, -(-total // RANGE))
    shared = shared_counts(ranges(docs, words, count), -(-count // 4))
    named = classes.where(F.col("id").isNotNull()).withColumn("name", name_of(F.col("class")))
    may = materialize(named.join(shared, "name").where(F.col("shared") >= least_overlap(F.col("n"), percent)).select("class", "id", "n"), "may")

    texts = docs.join(may.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    sets = materialize(
        sets_of(texts, words).groupBy("class").agg(F.first("tokens").alias("tokens")).join(may, "class").select("class", "id", "n", "tokens"), "sets"
    )
    entries = sets.select("class", "id", F.explode("tokens").alias("token"))
    lists = entries.groupBy("token").agg(F.count("*").alias("df"), F.min(F.struct("id", "class")).alias("least")).where("df > 1")
    keyed = lists.select("token", "df", F.xxhash64("least.class").alias("block"))
    rare = entries.select("class", "token").join(keyed, "token").groupBy("class").agg(F.sort_array(F.collect_list(F.struct("df", "token", "block"))).alias("t"))
    need = least_overlap(F.col("n"), percent)
    members = materialize(
        rare.join(sets.select("class", "n"), "class").where(F.size("t") >= need)
        .select("class", "n", F.col("t.token").alias("tokens"),
                F.array_distinct(F.slice(F.col("t.block"), F.lit(1), (F.size("t") - need + 1).cast("int"))).alias("blocks")), "members",
    )
    tokens = members.select("class", "tokens")
    meet = materialize(members.select(F.explode("blocks").alias("block"), "class", "n"), "meet")

    heads = meet.select("block").distinct().join(members.select(F.xxhash64("class").alias("block"), "class", "n"), "block")
    groups = grouped(meet, heads, tokens, lambda own, asks: cell_links(own, asks, percent))
    placed = classes.join(groups, classes["class"] == groups["node"], "left").select("class", "id", F.coalesce("root", "class").alias("root"))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    answer = placed.join(least, "root").select("class", "component_id")
    return (
        found.join(answer, "class", "left")
        .select("doc_id", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    )
