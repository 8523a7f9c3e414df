"""Ranked lexical search by presence masks.

One pass over the texts keeps what a block of items needs: each document's length and
its counts of the items' terms. Corpus counts come from these rows. Each task then
walks its documents in blocks. Per item, a bitmap of the block's documents is set for
every term, the bitmaps together give each document its mask of matched terms, and
documents with equal masks form a group. A mask's score is bounded by the best impact
of its terms in the block; masks are evaluated by falling bound, and the block ends
once no mask left can reach the item's k-th score so far.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eavspark.llm.common import counted_terms, small_slices
from eavspark.session import materialize

TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")  # of UTF-8, so any character beyond ASCII
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")
DOCUMENTS = 8192  # documents of a block
POSTINGS = 1 << 22  # postings of a block, but for one document
ITEM_BYTES = 1 << 23  # text of the items searched for in one go
SLICES = 256  # partial merges per item


@dataclass
class Item:
    """Its place in the result, and its terms: number in the vocabulary and occurrences."""

    item: int
    item_id: int | None
    terms: np.ndarray
    repeats: np.ndarray


@dataclass
class Scale:
    """Corpus counts and the terms' weights."""

    n: int
    length: int
    weights: np.ndarray

    def impacts(self, tf: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """What an occurrence of a query term adds, but for its weight."""
        m = 100 - 75 + (75 * sizes * self.n) // self.length
        return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[tuple[list[bytes], list[Item]]]:
    """The vocabulary and the items of each block of items, of bounded size."""
    words: dict[bytes, int] = {}
    block: list[Item] = []
    held = 0
    for i, row in enumerate(items.select(F.col(item_id).cast("long"), text).toLocalIterator()):
        data = (row[1] or "").encode()
        found = counted_terms(data, TERM, GAP)
        at = np.array([words.setdefault(t, len(words)) for t in found], np.int64)
        block.append(Item(i, row[0], at, np.array(list(found.values()), np.int64)))
        held += len(data)
        if held > ITEM_BYTES:
            yield list(words), block
            words, block, held = {}, [], 0
    if block:
        yield list(words), block


def postings(docs: DataFrame, words: list[bytes], id_column: str, text: str) -> DataFrame:
    """(doc_id, size, terms, tfs) of every document with a term; the terms are the words' numbers."""
    numbers = {w: i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in small_slices(batches, "_text"):
            keep, sizes, terms, tfs = [], [], [], []
            for i, data in enumerate(batch.column(1).to_pylist()):
                found = counted_terms(data or b"", TERM, GAP)
                if found:
                    some = sorted((numbers[t], n) for t, n in found.items() if t in numbers)
                    keep.append(i)
                    sizes.append(found.total())
                    terms.append(np.array([t for t, _ in some], np.int32).tobytes())
                    tfs.append(np.array([n for _, n in some], np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                names=["doc_id", "size", "terms", "tfs"],
            )

    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return source.mapInArrow(run, "doc_id long, size long, terms binary, tfs binary")


def scale(found: DataFrame, vocabulary: int) -> Scale:
    """Counts over all documents: one row per task and term is shuffled, one per term collected."""

    def run(batches: Iterator[pa.RecordBatch]):
        holding = np.zeros(vocabulary + 2, np.int64)
        for batch in batches:
            holding[vocabulary] += batch.num_rows
            holding[vocabulary + 1] += int(batch.column(0).to_numpy().sum())
            at = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32)
            holding[:vocabulary] += np.bincount(at, minlength=vocabulary)
        some = np.flatnonzero(holding)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(holding[some])], names=["term", "n"])

    got = found.select("size", "terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(vocabulary + 2, object)
    for r in got:
        counts[r["term"]] = r["n"]
    n = counts[vocabulary]
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for df in counts[:vocabulary]]
    return Scale(n, counts[vocabulary + 1], np.array(weights, np.int64))


class Block:
    """The postings of some documents, by term."""

    def __init__(self, doc_ids: list, sizes: np.ndarray, terms: list[bytes], tfs: list[bytes], corpus: Scale) -> None:
        self.doc_ids = doc_ids
        row = np.repeat(np.arange(len(sizes)), [len(t) // 4 for t in terms])
        term, tf = (np.frombuffer(b"".join(x), np.int32).astype(np.int64) for x in (terms, tfs))
        order = np.argsort(term, kind="stable")
        self.row, self.impact = row[order], corpus.impacts(tf, sizes[row])[order]
        self.ends = np.searchsorted(term[order], np.arange(len(corpus.weights) + 1))
        filled = np.flatnonzero(np.diff(self.ends))
        self.best = np.zeros(len(corpus.weights), np.int64)
        if len(filled):
            self.best[filled] = np.maximum.reduceat(self.impact, self.ends[:-1][filled])

    def search(self, item: Item, weights: np.ndarray, k: int, top: list[tuple[int, int | None]]) -> list[tuple[int, int | None]]:
        """``top`` (score, doc_id) after this block's documents."""
        worth = weights[item.terms] * item.repeats
        some = np.flatnonzero((worth > 0) & (self.best[item.terms] > 0))
        if not len(some):
            return top
        terms, worth = item.terms[some], worth[some]
        bits = np.zeros((len(self.doc_ids), -(-len(some) // 8)), np.uint8)
        for j, t in enumerate(terms):
            bits[self.row[self.ends[t] : self.ends[t + 1]], j >> 3] |= 1 << (j & 7)
        # documents by mask: equal rows of bits
        masks, which = np.unique(bits.view(f"V{bits.shape[1]}").ravel(), return_inverse=True)
        held = np.unpackbits(masks.view(np.uint8).reshape(len(masks), -1), axis=1, count=len(some), bitorder="little").astype(bool)
        bound = held @ (worth * self.best[terms])
        order = np.argsort(-bound, kind="stable")
        members = np.argsort(which, kind="stable")
        ends = np.searchsorted(which[members], np.arange(len(masks) + 1))
        at, step = 0, 1
        while at < len(order):
            least = top[-1][0] if len(top) == k else 1
            go = [m for m in order[at : at + step] if bound[m] >= least]
            if not go:
                break
            docs = np.sort(np.concatenate([members[ends[m] : ends[m + 1]] for m in go]))
            scores = np.zeros(len(docs), np.int64)
            for j in np.flatnonzero(held[go].any(axis=0)):
                rows = self.row[self.ends[terms[j]] : self.ends[terms[j] + 1]]
                place = np.searchsorted(rows, docs)
                hit = np.flatnonzero(rows[np.minimum(place, len(rows) - 1)] == docs)
                scores[hit] += worth[j] * self.impact[self.ends[terms[j]] + place[hit]]
            better = np.flatnonzero(scores >= least)
            top = sorted(top + [(int(scores[i]), self.doc_ids[docs[i]]) for i in better], key=_rank)[:k]
            at, step = at + step, step * 2
        return top


def _rank(found: tuple[int, int | None]) -> tuple:
    score, doc_id = found
    return -score, doc_id is None, doc_id or 0


def best_of(found: DataFrame, corpus: Scale, items: list[Item], k: int) -> DataFrame:
    """(item, item_id, doc_id, score): each task's k best documents of each item."""
    shared = found.sparkSession.sparkContext.broadcast((corpus, items))  # bounded by ITEM_BYTES

    def run(batches: Iterator[pa.RecordBatch]):
        corpus, items = shared.value
        top: list[list] = [[] for _ in items]
        held: list[pa.RecordBatch] = []

        def search() -> None:
            doc_ids, sizes, terms, tfs = ([x for b in held for x in b.column(c).to_pylist()] for c in range(4))
            block = Block(doc_ids, np.array(sizes, np.int64), terms, tfs, corpus)
            for i, item in enumerate(items):
                top[i] = block.search(item, corpus.weights, k, top[i])
            held.clear()

        rows = size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                some = part.column(2).nbytes // 4
                if held and (rows + part.num_rows > DOCUMENTS or size + some > POSTINGS):
                    search()
                    rows = size = 0
                held.append(part)
                rows, size = rows + part.num_rows, size + some
        if held:
            search()
        out = [(item.item, item.item_id, doc_id, score) for item, best in zip(items, top, strict=True) for score, doc_id in best]
        columns = list(zip(*out, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "item_id", "doc_id", "score"])

    return found.mapInArrow(run, "item long, item_id long, doc_id long, score long")


def search(
    docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest score above 0 per item.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.
    Every row of ``items`` is an item of its own and every row of ``docs`` a document,
    also where ids repeat or are null; equal scores go by ascending id, null last. Null
    and empty texts have no terms: such an item finds nothing, such a document counts
    for nothing. Texts of any length count whole, a piece at a time. Other columns of
    either table are not read. Items are searched for in blocks of bounded text, each
    with a pass over the documents; no documents or no items give no rows.
    """
    docs = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_body"))
    spark, out = docs.sparkSession, None
    for words, block in item_blocks(items, item_id, item_text):
        found = materialize(postings(docs, words, "_id", "_body"), "postings")
        corpus = scale(found, len(words))
        if not corpus.length:
            break
        part = best_of(found, corpus, block, k)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    some = out.withColumn("slice", F.spark_partition_id() % SLICES)
    few = some.withColumn("r", F.row_number().over(Window.partitionBy("item", "slice").orderBy(*order))).where(F.col("r") <= k)
    return (
        few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
        .select("item_id", "rank", "doc_id", "score")
    )
