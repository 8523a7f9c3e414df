"""Toxicity by a classifier chain of linear models over words.

Categories are predicted one after the other. Each category has a logistic model over
the words that tell it best and the probabilities of the categories before it. While
learning, those probabilities come from models that did not see the document (out of
fold), so a later model does not lean on an earlier one's memory.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavspark.llm.common import rows, word_hashes

BUCKETS = 1 << 18  # hashed words
# letters and digits stay, A-Z lower-cased; other ASCII parts words
_PART = bytes(ord(chr(b).lower()) if chr(b).isalnum() or b > 127 else 32 for b in range(128)) + bytes(range(128, 256))


def words(text: bytes | None) -> np.ndarray:
    """The distinct hashed words of a whole text, ascending."""
    return np.unique((word_hashes((text or b"").translate(_PART)) >> np.uint64(46)).astype(np.uint32))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 25) -> np.ndarray:
    """Weights (last: the constant) of a ridge logistic regression, by Newton steps."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass
class Link:
    """One category's model: its words, their weights, the earlier categories' weights, the constant."""

    terms: np.ndarray
    weights: np.ndarray

    def features(self, docs: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        out = np.zeros((len(docs), len(self.terms)))
        for i, d in enumerate(docs):
            out[i] = np.isin(self.terms, d)
        return np.hstack([out, before])

    def predict(self, docs: list[np.ndarray], before: np.ndarray) -> np.ndarray:
        z = self.features(docs, before) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: list[np.ndarray], y: np.ndarray, before: np.ndarray, terms: int, ridge: float) -> Link:
    """The ``terms`` words by largest signed root of the likelihood gain, and their weights."""
    inside, outside = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for d, label in zip(docs, y, strict=True):
        (inside if label else outside)[d] += 1
    n, k = len(y), y.sum()
    seen = inside + outside
    with np.errstate(divide="ignore", invalid="ignore"):
        expect = seen * k / max(n, 1)
        spread = expect * (1 - seen / max(n, 1)) * (1 - k / max(n, 1))
        gain = np.where((seen >= 3) & (spread > 0), (inside - expect) / np.sqrt(np.maximum(spread, 1e-12)), 0)
    chosen = np.argsort(-np.abs(gain), kind="stable")[:terms]
    link = Link(np.sort(chosen[gain[chosen] != 0]).astype(np.uint32), np.zeros(0))
    link.weights = logistic(link.features(docs, before), y.astype(float), ridge)
    return link


def chain(docs: list[np.ndarray], labels: np.ndarray, folds: np.ndarray, terms: int, ridge: float) -> list[Link]:
    """One link per column of ``labels``, later ones trained on out-of-fold probabilities."""
    links, before = [], np.zeros((len(docs), 0))
    for c in range(labels.shape[1]):
        y = labels[:, c]
        links.append(learn(docs, y, before, terms, ridge))
        out = np.zeros(len(docs))
        for f in np.unique(folds):
            at, rest = np.flatnonzero(folds == f), np.flatnonzero(folds != f)
            part = learn([docs[i] for i in rest], y[rest], before[rest], terms, ridge)
            out[at] = part.predict([docs[i] for i in at], before[at])
        before = np.hstack([before, out[:, None]])
    return links


def fit(
    docs: DataFrame, labels: DataFrame, categories: dict[str, Column], limit: int = 16384, terms: int = 64, ridge: float = 1.0,
    folds: int = 5, id_column: str = "doc_id", text: str = "text",
) -> dict[str, Link]:
    """Learn the chain from at most ``limit`` labelled documents (those whose id hashes lowest).

    ``categories`` are conditions on ``labels``, in the order of the chain. A category
    that is null for a row makes it no example; ids labelled twice count where any of
    their rows says so. Nothing to learn from gives models that answer one half.
    """
    marks = [F.max(c.cast("int")).alias(f"c{i}") for i, c in enumerate(categories.values())]
    every = F.array(*[F.col(f"c{i}") for i in range(len(marks))])
    marked = labels.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("_id")).agg(*marks)
    marked = marked.select("_id", every.alias("_y")).where(F.forall("_y", lambda v: v.isNotNull()))
    marked = marked.join(docs.select(F.col(id_column).alias("_id")).distinct(), "_id", "left_semi")
    chosen = marked.orderBy(F.xxhash64("_id"), "_id").limit(limit)  # at most ``limit`` short rows
    have = docs.select(F.col(id_column).alias("_id"), F.col(text).alias("_t")).join(F.broadcast(chosen), "_id")
    kind = have.schema["_id"].dataType.simpleString()

    def cut(batches):
        for part in rows(batches, "_t"):
            names = part.schema.names
            found = [words(t).tobytes() for t in part.column(names.index("_t")).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(names.index("_id")), part.column(names.index("_y")), pa.array(found, pa.binary())], names=["_id", "_y", "_w"])

    got = have.mapInArrow(cut, f"_id {kind}, _y array<int>, _w binary").orderBy(F.xxhash64("_id"), F.xxhash64("_w")).limit(limit).collect()
    y = np.array([r["_y"] for r in got], int).reshape(len(got), len(categories))
    links = chain([np.frombuffer(r["_w"], np.uint32) for r in got], y, np.arange(len(got)) % folds, terms, ridge)
    return dict(zip(categories, links, strict=True))


def predict(df: DataFrame, model: dict[str, Link], keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` beside ``p_<category>``, the probability of every category, for each row.

    A null or empty text has no words and gets what the constants say.
    """
    shared = df.sparkSession.sparkContext.broadcast(list(model.values()))  # bounded: terms per category
    names = [f"p_{c}" for c in model]
    fields = df.select(*keep).schema
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"`{n}` double" for n in names)])

    def run(batches):
        for part in rows(batches):
            cols = part.schema.names
            docs = [words(t) for t in part.column(cols.index("_text")).cast(pa.large_binary()).to_pylist()]
            p = np.zeros((len(docs), 0))
            for link in shared.value:
                p = np.hstack([p, link.predict(docs, p)[:, None]])
            yield pa.RecordBatch.from_arrays(
                [*[part.column(cols.index(c)) for c in keep], *[pa.array(np.ascontiguousarray(p[:, i])) for i in range(len(names))]],
                names=[*keep, *names],
            )

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, ddl)
