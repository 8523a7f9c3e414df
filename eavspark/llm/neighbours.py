"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Labelled texts become weighted counts of hashed byte trigrams, and their leading
singular vectors, found by subspace iteration, span the latent space. Every document is
projected into that space, its cosine to every labelled vector is computed exactly, in
blocks, and the nearest neighbours vote for their labels with their similarity as weight.
Of equally near neighbours at the edge any may vote; a table's rows do not change that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavspark.llm.common import CHUNK, rows

TERMS = 4096  # hashed trigrams


def counts(text: bytes | None) -> np.ndarray:
    """How often each hashed trigram of bytes occurs; texts go in overlapping chunks."""
    out = np.zeros(TERMS, np.float32)
    text = text or b""
    for at in range(0, max(1, len(text) - 2), CHUNK):
        a = np.frombuffer(text[at : at + CHUNK + 2], np.uint8).astype(np.uint32)
        if len(a) > 2:
            gram = (a[:-2] << np.uint32(16)) | (a[1:-1] << np.uint32(8)) | a[2:]
            out += np.bincount((gram * np.uint32(2654435761)) >> np.uint32(20), minlength=TERMS)
    return out


@dataclass
class Model:
    """At most ``limit`` labelled vectors of ``rank`` dimensions, and the way into their space."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int

    def project(self, found: np.ndarray) -> np.ndarray:
        x = np.log1p(found) * self.idf
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
        v = x @ self.axes
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def score(self, found: np.ndarray) -> np.ndarray:
        """Share of the neighbours' similarity that stands for label 1."""
        if not len(self.labels):
            return np.full(len(found), 0.5)
        near = self.project(found) @ self.vectors.T
        k = min(self.k, near.shape[1])
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(near, at, axis=1), 0, 1).astype(np.float64)
        total = weight.sum(axis=1)
        share = (weight * self.labels[at]).sum(axis=1)
        prior = float(self.labels.mean())
        return np.clip((share + 1e-6 * prior) / (total + 1e-6), 0, 1)


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = 8192, rank: int = 64, k: int = 15,
    id_column: str = "doc_id", text: str = "text",
) -> Model:
    """Learn from at most ``limit`` labelled documents (those whose id hashes lowest).

    Rows with a null id or label teach nothing; an id labelled twice counts with its
    larger label, an id with several texts with each of them.
    """
    marked = labels.where(F.col(id_column).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id_column).alias("_id")).agg(F.max(label).cast("int").alias("_y"))
    marked = marked.join(docs.select(F.col(id_column).alias("_id")).distinct(), "_id", "left_semi")
    chosen = marked.orderBy(F.xxhash64("_id"), "_id").limit(limit)  # at most ``limit`` short rows
    have = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(chosen), "_id")

    def vectors(batches):
        for part in rows(batches, "_t"):
            names = part.schema.names
            found = [counts(t) for t in part.column(names.index("_t")).to_pylist()]
            some = [np.flatnonzero(f).astype(np.uint16) for f in found]
            yield pa.RecordBatch.from_arrays(
                [part.column(names.index("_id")), part.column(names.index("_y")), pa.array([i.tobytes() for i in some], pa.binary()),
                 pa.array([f[i].tobytes() for f, i in zip(found, some, strict=True)], pa.binary())],
                names=["_id", "_y", "_at", "_v"],
            )

    kind = have.schema["_id"].dataType.simpleString()
    chosen = have.mapInArrow(vectors, f"_id {kind}, _y int, _at binary, _v binary").orderBy(F.xxhash64("_id"), F.xxhash64("_at", "_v")).limit(limit)
    got = chosen.select("_y", "_at", "_v").toArrow()  # at most ``limit`` sparse rows
    y = got.column("_y").to_numpy().astype(np.float64)
    (terms, ends), (values, _) = joined(got.column("_at"), np.uint16), joined(got.column("_v"), np.float32)
    del got
    spans = list(pairwise(ends.tolist()))
    held = np.bincount(terms, minlength=TERMS)  # a text names each of its terms once
    idf = np.log((1 + len(y)) / (1 + held)).astype(np.float32) + np.float32(0.1)
    for a, b in spans:
        x = np.log1p(values[a:b]) * idf[terms[a:b]]
        values[a:b] = x / max(float(np.sqrt(x @ x)), 1e-12)

    def blocks():
        """The weighted rows, dense, a few at a time."""
        for first in range(0, len(spans), 512):
            w = np.zeros((len(spans[first : first + 512]), TERMS), np.float32)
            for row, (a, b) in zip(w, spans[first:], strict=False):
                row[terms[a:b]] = values[a:b]
            yield w

    axes = leading(blocks, len(y), TERMS, min(rank, len(y)))
    v = np.concatenate([w @ axes for w in blocks()] or [np.zeros((0, axes.shape[1]), np.float32)])
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return Model(idf, axes, v, y, k)


def joined(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """Numbers packed in the values of a binary column, in one array, and where each value begins and the last ends."""
    out = np.empty(sum(pc.sum(pc.binary_length(c)).as_py() or 0 for c in column.chunks) // np.dtype(kind).itemsize, kind)
    ends, at = [np.zeros(1, np.int64)], 0
    for c in column.chunks:
        of = np.frombuffer(c.buffers()[1] or bytes(4), np.int32)[c.offset : c.offset + len(c) + 1].astype(np.int64)
        data = np.frombuffer(c.buffers()[2] or b"", np.uint8)[of[0] : of[-1]].view(kind)
        out[at : at + len(data)] = data
        ends.append(at + (of[1:] - of[0]) // np.dtype(kind).itemsize)
        at += len(data)
    return out, np.concatenate(ends)


def leading(
    blocks: Callable[[], Iterable[np.ndarray]], rows: int, columns: int, rank: int, spare: int = 16, rounds: int = 12,
) -> np.ndarray:
    """The leading right singular vectors of the matrix whose rows ``blocks`` yields, by
    subspace iteration: ``rank + spare`` columns are held beside one block of rows."""
    width = min(rank + spare, rows, columns)
    if not width:
        return np.zeros((columns, 1), np.float32)
    basis = np.random.default_rng(5).standard_normal((columns, width)).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(sum(w.T @ (w @ basis) for w in blocks()))
    small = sum((w @ basis).T @ (w @ basis) for w in blocks())
    values, turn = np.linalg.eigh(small)
    return np.ascontiguousarray(basis @ turn[:, np.argsort(-values)][:, :rank])


def predict(
    df: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
) -> DataFrame:
    """``keep`` beside score (0 to 1, higher: label 1 likelier) and predicted (score >= 0.5).

    A null or empty text is a text without trigrams: its score is the prior, the share
    of label 1 among what was learned (0.5 if nothing was). Rows keep their number.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded: limit * rank numbers
    fields = df.select(*keep).schema
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "score double, predicted int"])

    def run(batches):
        m = shared.value
        for part in rows(batches):
            names = part.schema.names
            texts = part.column(names.index("_text")).cast(pa.large_binary()).to_pylist()
            score = m.score(np.array([counts(t) for t in texts], np.float32).reshape(len(texts), TERMS))
            arrays = [part.column(names.index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=[*keep, "score", "predicted"]
            )

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, ddl)
