"""Best-fit packing of documents into sequences, by bin completion branch-and-bound.

What a packing needs to know is how many pieces there are of each length, at most
``capacity`` numbers whatever the size of the corpus. Those counts go to the driver,
which plans *patterns* (the lengths that share a sequence, and how many sequences are
filled that way). The n-th piece of a length then finds its sequence and place by
arithmetic, where it stands.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eavspark.llm.common import arrow_schema
from eavspark.llm.encoding import WITH_SPACE, encoder_for, gathered
from eavspark.session import materialize

Pattern = tuple[tuple[int, ...], int]  # lengths in falling order, number of sequences


# ---- planning ---------------------------------------------------------------------


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing over counted lengths: the first incumbent.

    Equal bins are handled together, so the work depends on the lengths, not the counts.
    """
    open_: dict[int, dict[tuple[int, ...], int]] = {capacity: {}}
    rooms = np.zeros(capacity + 1, np.int64)  # bins by room left
    for size in range(capacity, 0, -1):
        left = int(counts[size])
        while left:
            fits = np.flatnonzero(rooms[size:])
            if len(fits):
                room = size + int(fits[0])
                pattern, n = next(iter(open_[room].items()))
            else:
                room, pattern, n = capacity, (), left  # new bins, as many as there are pieces
                per = capacity // size
                n = -(-left // per)
            used = min(n, left)
            if pattern:
                rest = n - used
                if rest:
                    open_[room][pattern] = rest
                else:
                    del open_[room][pattern]
                rooms[room] -= used
            new = (*pattern, size)
            held = open_.setdefault(room - size, {})
            held[new] = held.get(new, 0) + used
            rooms[room - size] += used
            left -= used
    return [(p, n) for held in open_.values() for p, n in held.items() if p]


def _dominates(f: tuple[int, ...], g: tuple[int, ...]) -> bool:
    """Whether g's pieces fit into bins of f's sizes (Martello and Toth).

    Decided for fillings of at most three pieces, in a handful of comparisons; longer
    ones are not said to dominate, so that the time of a step does not grow with them."""
    if f == g or max(len(f), len(g)) > 3:
        return False
    return any(
        all(sum(x for x, bin_ in zip(g, bins, strict=True) if bin_ == i) <= size for i, size in enumerate(f))
        for bins in product(range(len(f)), repeat=len(g))
    )


def fillings(counts: np.ndarray, room: int, width: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room`` from the pieces counted, least waste first.

    Candidates are the largest piece that fits, the best partner of every first piece,
    the best pair behind every first piece, and, where more pieces fit, the run of
    largest pieces. Of equal waste, the one with larger pieces comes first.
    """
    sizes = np.flatnonzero(counts[: room + 1])
    if not len(sizes):
        return [()]
    below = np.zeros(room + 1, np.int64)  # the largest piece of at most this size
    below[sizes] = sizes
    below = np.maximum.accumulate(below)
    found: set[tuple[int, ...]] = {(int(sizes[-1]),)}
    if sizes[-1] < room:
        a = sizes[::-1]
        b = below[np.minimum(room - a, a)]
        twin = (b == a) & (counts[a] < 2)
        b = np.where(twin, below[np.maximum(b - 1, 0)], b)
        sums = a + b
        order = np.argsort(-sums, kind="stable")[:width]
        found |= {tuple(int(x) for x in (a[i], b[i]) if x) for i in order}
        if sums[order[0]] < room:
            for i in order:  # a third piece, and then the largest that still fit
                for second in {int(b[i]), int(below[min((room - int(a[i])) // 2, int(a[i]))])} - {0}:
                    filling, left, used = [int(a[i]), second], room - int(a[i]) - second, {int(a[i]): 1}
                    used[second] = used.get(second, 0) + 1
                    if left < 0 or used[second] > counts[second]:
                        continue
                    while left > 0 and (x := int(below[left])):
                        while x and used.get(x, 0) >= counts[x]:
                            x = int(below[x - 1])
                        if not x:
                            break
                        filling.append(x)
                        used[x] = used.get(x, 0) + 1
                        left -= x
                    found.add(tuple(sorted(filling, reverse=True)))
    ranked = sorted(found, key=lambda f: (room - sum(f), tuple(-x for x in f)))[: 2 * width]
    kept: list[tuple[int, ...]] = []
    for f in ranked:
        if len(kept) < width and not any(_dominates(k, f) for k in kept):
            kept.append(f)
    return kept


def _patterns(chain: tuple | None) -> list[Pattern]:
    out = []
    while chain is not None:
        pattern, n, chain = chain
        out.append((pattern, n))
    return out


def plan(counts: dict[int, int], capacity: int, width: int = 6, nodes: int = 6000) -> list[Pattern]:
    """Patterns that hold every counted piece, in as few sequences as the search finds.

    Bin completion: take the largest piece left, try its undominated fillings in order
    of waste, use each for as many sequences as its pieces last, and go on. A branch
    ends once its waste exceeds what a plan with one sequence less than the incumbent
    may waste. The incumbent starts as best-fit decreasing. The search ends at the
    lower bound (all tokens over the capacity), when nothing is left to try, or after
    ``nodes`` steps, with the incumbent; the steps bound the search, never the data.
    """
    start = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        start[size] = n
    total = int((start * np.arange(capacity + 1)).sum())
    least = -(-total // capacity)
    best = best_fit(start, capacity)
    bins = sum(n for _, n in best)
    stack: list[tuple[np.ndarray, tuple | None, int, int]] = [(start, None, 0, 0)]
    # a step: counts left, its chain of patterns, sequences and waste so far
    while stack and bins > least and nodes:
        nodes -= 1
        left, chain, used, waste = stack.pop()
        if waste > (bins - 1) * capacity - total:
            continue
        some = np.flatnonzero(left)
        if not len(some):
            if used < bins:
                bins, best = used, _patterns(chain)
            continue
        size = int(some[-1])
        left[size] -= 1
        ways = fillings(left, capacity - size, width)
        left[size] += 1
        for filling in reversed(ways):
            need: dict[int, int] = {}
            for x in (size, *filling):
                need[x] = need.get(x, 0) + 1
            n = min(int(left[x]) // k for x, k in need.items())
            rest = left.copy()
            for x, k in need.items():
                rest[x] -= n * k
            stack.append((rest, ((size, *filling), n, chain), used + n, waste + n * (capacity - size - sum(filling))))
    return sorted(((tuple(sorted(p, reverse=True)), n) for p, n in best), reverse=True)


def slots(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: where each pattern's run of pieces starts (by rank), how many of the
    length one sequence takes, the pattern's first sequence, and the place in it."""
    at: dict[int, int] = {}
    out: dict[int, list] = {}
    first = 0
    for pattern, n in patterns:
        place = 0
        for size in sorted(set(pattern), reverse=True):
            k = pattern.count(size)
            out.setdefault(size, []).append((at.get(size, 0), k, first, place))
            at[size] = at.get(size, 0) + n * k
            place += k * size
        first += n
    return {s: tuple(np.array(c, np.int64) for c in zip(*v, strict=True)) for s, v in out.items()}


# ---- the corpus -------------------------------------------------------------------

PIECES = "piece int, start long, length long, ids_crc32 long, task int, nth long"


def pieces(df: DataFrame, tokenizer: str, capacity: int, end_id: int, id_column: str, text: str) -> DataFrame:
    """Every document's pieces, with the task that cut them and a count per length there."""
    kind = df.schema[id_column].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]):
        encoder, end = encoder_for(tokenizer, WITH_SPACE), np.array([end_id], "<u4").tobytes()
        task, seen, schema = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), arrow_schema(PIECES)
        for batch in gathered(batches, text):
            row, out = [], []
            for i, ids in enumerate(encoder(batch.column(1))):
                ids += end
                n = len(ids) // 4
                begin = 0
                stops = range(n % capacity or capacity, n + 1, capacity) if n > capacity else (n,)
                for j, stop in enumerate(stops):
                    size = stop - begin
                    row.append(i)
                    out.append((j, begin, size, zlib.crc32(ids[4 * begin : 4 * stop]), task, int(seen[size])))
                    seen[size] += 1
                    begin = stop
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *columns], names=["doc_id", *schema.names])

    return df.select(id_column, text).mapInArrow(cut, f"doc_id {kind}, {PIECES}")


def pack(
    df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id",
    text: str = "text", nodes: int = 6000,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    Every document ends with ``end_id``, so a null or empty text is one piece of one id.
    Documents longer than ``capacity`` are cut in pieces of that length; only their
    first piece may be shorter. Rows with equal or null ids are packed each for itself.
    An empty table gives no rows. A text of any length is encoded whole; other columns
    are not read, whatever their names.
    """
    cut = materialize(pieces(df, tokenizer, capacity, end_id, id_column, text), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # <= capacity rows
    places = slots(plan(counts, capacity, nodes=nodes))
    ranked = (
        cut.join(per_task.select("length", "task", before.alias("before")), ["length", "task"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("rank"))
    )

    def place(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            sequence, offset = np.zeros((2, len(rank)), np.int64)
            for size in np.unique(length):
                rows_ = np.flatnonzero(length == size)
                start, k, first, at = places[int(size)]
                p = np.searchsorted(start, rank[rows_], side="right") - 1
                nth = rank[rows_] - start[p]
                sequence[rows_] = first[p] + nth // k[p]
                offset[rows_] = at[p] + nth % k[p] * size
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:5], "sequence_id", "offset"],
            )

    kind = cut.schema["doc_id"].dataType.simpleString()
    return ranked.mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
