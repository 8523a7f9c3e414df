"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are sparse rows of whole weights. Candidates are cut into blocks, each block
turned into postings (term -> rows and weights). A query walks its terms one after
the other and adds weight times weight into the block's dense score array; the k best
of the array are picked by partition selection, and the blocks' picks are merged.

Queries come in blocks as well: each cell (candidate block, query block) is one row of
a join on its own key, so cells spread over tasks and no task holds more than a few pairs
of blocks at a time. All pairs of the stated query set and all rows are scored. Every
block is copied once per block of the other kind, so both kinds are of one size, and
their weights are held on as few bytes as they need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavspark.session import small_batches

SAFE = 1 << 62
MOST_TASKS = 4096  # for cells, however many there are
WIDTHS = (np.int16, np.int32)  # else doubles


def quantized(df: DataFrame, id_column: str, vector: str, scale: float) -> DataFrame:
    """(vec_id, weights): floor(scale * x) of every component, as doubles holding whole numbers.

    Rows with a null id, a null vector, or a null or non-finite component take no part.
    Rows that share an id count once, with the vector that sorts first.
    """
    x = F.col(vector)
    whole = F.transform(x, lambda v: _floor(v.cast("double") * F.lit(float(scale))))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (
        df.where(F.col(id_column).isNotNull() & x.isNotNull()).where(fine)
        .select(F.col(id_column).cast("long").alias("vec_id"), whole.alias("weights"))
        .groupBy("vec_id").agg(F.min("weights").alias("weights"))
    )


def _floor(v: Column) -> Column:
    """Floor of a double as a double, beyond the range of long too."""
    return F.when(F.abs(v) >= 2.0**52, v).otherwise(F.floor(v).cast("double"))


def blocks(df: DataFrame, count: int, name: str) -> DataFrame:
    """(name, ids, ends, weights): ``count`` blocks of vectors, packed as bytes."""

    def pack(batches: Iterator[pa.RecordBatch]):
        held: dict[int, list] = {}
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            where = batch.column(2).to_numpy(zero_copy_only=False)
            vectors = batch.column(1).to_pylist()
            for i, w, v in zip(ids.tolist(), where.tolist(), vectors, strict=True):
                held.setdefault(w, []).append((i, np.array(v, np.float64)))
        for w in sorted(held):
            got = sorted(held.pop(w), key=lambda p: p[0])
            yield pa.RecordBatch.from_arrays([
                pa.array([w], pa.int64()),
                pa.array([np.array([i for i, _ in got], np.int64).tobytes()]),
                pa.array([np.cumsum([len(v) for _, v in got]).astype(np.int64).tobytes()]),
                pa.array([_packed(np.concatenate([v for _, v in got])).tobytes()]),
            ], names=[name, "ids", "ends", "weights"])

    # hash partitions keep a block's rows in one task; blocks have a fixed expected size
    return (
        df.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(count)))
        .repartition(max(1, count), "block")
        .mapInArrow(pack, f"{name} long, ids binary, ends binary, weights binary")
    )


def _packed(weights: np.ndarray) -> np.ndarray:
    """Whole weights in the narrowest type that holds them all."""
    low, high = weights.min(initial=0), weights.max(initial=0)
    fits = (t for t in WIDTHS if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return weights.astype(next(fits, np.float64))


def _weights(ends: bytes, raw: bytes) -> np.ndarray:
    """The packed weights as doubles; their number tells how wide they are."""
    count = int(np.frombuffer(ends, np.int64).max(initial=0))
    width = len(raw) // max(count, 1)
    return np.frombuffer(raw, next((t for t in WIDTHS if np.dtype(t).itemsize == width), np.float64)).astype(np.float64)


def _rows(ids: bytes, ends: bytes, weights: bytes, dtype):
    """Row ids, row ends, terms and weights of the components that are not zero."""
    w = _weights(ends, weights)
    ids, ends = np.frombuffer(ids, np.int64), np.frombuffer(ends, np.int64)
    sizes = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(len(ids)), sizes)
    term = np.arange(len(w)) - np.repeat(ends - sizes, sizes)
    some = w != 0
    if dtype is object:
        w = np.array([int(x) for x in w[some]], object)
    else:
        w = w[some].astype(np.int64)
    return ids, row[some], term[some], w


def score_cell(cand: tuple, quer: tuple, k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of each query's k best in one pair of blocks."""
    big = [np.abs(_weights(*x[1:])).max(initial=0) for x in (cand, quer)]
    longest = max(np.diff(np.frombuffer(x[1], np.int64), prepend=0).max(initial=0) for x in (cand, quer))
    exact = np.int64 if big[0] * big[1] * longest < SAFE else object  # else Python's whole numbers
    ids, rows, terms, weights = _rows(*cand, exact)
    order = np.argsort(terms, kind="stable")
    rows, weights = rows[order], weights[order]
    starts = np.searchsorted(terms[order], np.arange(int(terms.max(initial=-1)) + 2))
    q_ids, q_row, q_terms, q_weights = _rows(*quer, exact)
    q_ends = np.searchsorted(q_row, np.arange(len(q_ids) + 1))
    out = []
    for q in range(len(q_ids)):
        scores = np.zeros(len(ids), exact)
        for at in range(q_ends[q], q_ends[q + 1]):
            t = q_terms[at]
            if t + 1 < len(starts):
                own = slice(starts[t], starts[t + 1])
                scores[rows[own]] += q_weights[at] * weights[own]
        others = np.flatnonzero(ids != q_ids[q])
        found = scores[others]
        if len(found) > k:
            least = np.partition(found, len(found) - k)[len(found) - k]
            above = others[found > least]
            level = others[found == least][: k - len(above)]  # ids ascend in a block
            others = np.concatenate((above, level))
        out += [(int(q_ids[q]), int(ids[o]), min(max(int(scores[o]), -(1 << 63)), (1 << 63) - 1)) for o in others]
    return out


def top_k(
    df: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, id_column: str = "vec_id",
    vector: str = "embedding", candidates_per_block: int = 4096, queries_per_block: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product per query.

    ``queries`` is a condition on ``vec_id``. Equal scores go to the smaller id. A
    query's own id is no candidate; with fewer other rows all are returned. Vectors of
    unequal length are compared over the components that both have. Scores are exact
    whole numbers, held to the range of long. No rows, or no queries, give no result.
    """
    small_batches(df.sparkSession)
    weights = quantized(df, id_column, vector, scale)
    asked = weights.where(queries)
    n, m = weights.count(), asked.count()
    cands = max(1, -(-n // candidates_per_block))
    askers = max(1, -(-m // queries_per_block))
    left = blocks(weights, cands, "c").withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(askers - 1)))).withColumn("q", F.col("q").cast("long"))
    right = blocks(asked, askers, "q").withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(cands - 1)))).withColumn("c", F.col("c").cast("long"))
    # by number: few bytes make much work here, and by their bytes Spark would put cells in few tasks
    tasks = min(2 * cands * askers, MOST_TASKS)
    right = right.select("c", "q", F.col("ids").alias("q_ids"), F.col("ends").alias("q_ends"), F.col("weights").alias("q_weights"))

    def score(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                x = {f: batch.column(j)[i].as_py() for j, f in enumerate(batch.schema.names)}
                got = score_cell((x["ids"], x["ends"], x["weights"]), (x["q_ids"], x["q_ends"], x["q_weights"]), k)
                columns = list(zip(*got, strict=True)) or [()] * 3
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return (
        left.repartition(tasks, "c", "q").join(right.repartition(tasks, "c", "q"), ["c", "q"])
        .mapInArrow(score, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
