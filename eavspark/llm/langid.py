"""Language identification by rank-order profiles.

A profile is the list of a text's (or a language's) most frequent letter n-grams in
order of frequency. A document goes to the language whose profile is nearest by the
out-of-place distance: the sum, over the document's n-grams, of how far their ranks
lie apart, with a fixed penalty for n-grams that the language's profile lacks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eavspark.llm.common import arrow_schema, rows

UNKNOWN = "und"
HOLD = 1 << 20  # distinct n-grams a task holds before it passes its counts on


class _Letters:
    """Which code points are letters; filled in as they are met."""

    def __init__(self) -> None:
        self.kind = np.full(0x110000, 2, np.uint8)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        kind = self.kind[codes]
        if (kind == 2).any():
            for c in np.unique(codes[kind == 2]):
                self.kind[c] = chr(c).isalpha()
            kind = self.kind[codes]
        return kind == 1


def grams(text: bytes | None, letters: _Letters) -> np.ndarray:
    """All n-grams of one to three letters as integers, words padded by one blank.

    Three code points fit in 63 bits, so nothing is hashed; runs of other
    characters count as one blank, and a lone blank is no n-gram.
    """
    if not text:
        return np.empty(0, np.int64)
    codes = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le", "replace"), np.uint32)
    is_letter = letters(codes)
    if not is_letter.any():
        return np.empty(0, np.int64)
    flags = np.concatenate(([False], is_letter, [False]))
    padded = np.concatenate(([0], np.where(is_letter, codes, 0), [0])).astype(np.int64)
    keep = flags.copy()
    keep[0] = True
    keep[1:] |= flags[:-1]
    c = padded[keep]
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    return np.concatenate((c[c > 0], two + (1 << 42), three[c[1:-1] > 0] | (1 << 62)))


def _profile(found: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams and their ranks; equal counts share the mean rank."""
    keys, counts = np.unique(found, return_counts=True)
    order = np.argsort(-counts, kind="stable")[:size]
    _, first, same = np.unique(-counts[order], return_index=True, return_counts=True)
    return keys[order], np.repeat(first + (same - 1) / 2, same)


def gram_counts(df: DataFrame, text: str, label: str, shards: int = 16) -> DataFrame:
    """How often each n-gram occurs in each label's texts, over all rows of ``df``."""

    def count(batches: Iterator[pa.RecordBatch]):
        letters, held, schema = _Letters(), {}, arrow_schema("label string, gram long, n long")

        def merged(parts):
            keys = np.concatenate([k for k, _ in parts])
            counts = np.concatenate([n for _, n in parts])
            out, where = np.unique(keys, return_inverse=True)
            return out, np.bincount(where, weights=counts).astype(np.int64)

        def give():
            for name, parts in held.items():
                keys, n = merged(parts)
                for at in range(0, len(keys), 65536):
                    k, v = keys[at : at + 65536], n[at : at + 65536]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(k)), pa.array(k), pa.array(v)], schema=schema)
            held.clear()

        for part in rows(batches, text):
            by: dict[str, list] = {}
            for t, name in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                by.setdefault(name, []).append(grams(t, letters))
            for name, found in by.items():
                held.setdefault(name, []).append(np.unique(np.concatenate(found), return_counts=True))
                if len(held[name]) > 16:
                    held[name] = [merged(held[name])]
            if sum(len(k) for parts in held.values() for k, _ in parts) > HOLD:
                held.update({name: [merged(parts)] for name, parts in held.items()})
                if sum(len(k) for parts in held.values() for k, _ in parts) > HOLD // 2:
                    yield from give()
        yield from give()

    counted = df.select(F.col(text), F.col(label)).where(F.col(label).isNotNull())
    return (
        counted.mapInArrow(count, "label string, gram long, n long")
        .groupBy("label", "gram").agg(F.sum("n").alias("n"))
        .withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards)))
    )


def learn(df: DataFrame, text: str = "text", label: str = "lang", size: int = 400, max_labels: int = 1000) -> dict:
    """Profiles of all labels from every labelled row: label -> n-grams by rank.

    Counts cover all rows; the top ``size`` are taken per shard first, then per label,
    so no task gathers one label's n-grams. The driver gets ``size`` numbers a label,
    and raises ValueError beyond ``max_labels`` labels.
    """
    by = [F.desc("n"), F.asc("gram")]
    first = Window.partitionBy("label", "shard").orderBy(*by)
    last = Window.partitionBy("label").orderBy(*by)
    top = (
        gram_counts(df, text, label)
        .withColumn("r", F.row_number().over(first)).where(F.col("r") <= size)
        .withColumn("r", F.row_number().over(last)).where(F.col("r") <= size)
        .select("label", "gram", "r")
    )
    got = top.limit(size * max_labels + 1).toArrow()
    if got.num_rows > size * max_labels:
        raise ValueError(f"more than {max_labels} labels")
    labels = np.array(got.column("label").to_pylist(), object)
    gram, rank = got.column("gram").to_numpy(), got.column("r").to_numpy()
    return {
        name: gram[at][np.argsort(rank[at])]
        for name in sorted(set(labels)) for at in [labels == name]
    }


def predict(df: DataFrame, profiles: dict, id_column: str = "doc_id", text: str = "text", size: int = 400) -> DataFrame:
    """(id, lang_pred, score) for every row.

    score is 1 minus the distance over the largest one possible. A text that is null or
    has no letter, or an empty set of profiles, gives ``und`` and 0. Equal distances go
    to the label that sorts first. Repeated ids keep their rows; other columns are not
    read, whatever their names. A text of any length is read whole, as one row; a table
    without rows gives none.
    """
    names = sorted(profiles)
    known = np.unique(np.concatenate([profiles[n] for n in names])) if names else np.empty(0, np.int64)
    ranks = np.full((len(known) + 1, max(len(names), 1)), np.nan, np.float32)
    for j, n in enumerate(names):
        ranks[np.searchsorted(known, profiles[n]), j] = np.arange(len(profiles[n]))
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        letters = _Letters()
        for part in rows(batches, text):
            preds, scores = [], []
            for t in part.column(1).to_pylist():
                found = grams(t, letters)
                if not len(found) or not names:
                    preds.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                keys, own = _profile(found, size)
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                at[known[at] != keys] = len(known)
                apart = np.abs(ranks[at] - own[:, None])
                distance = np.where(np.isnan(apart), size, np.minimum(apart, size)).sum(axis=0)
                best = int(np.argmin(distance))
                preds.append(names[best])
                scores.append(float(1 - distance[best] / (size * len(keys))))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                names=[id_column, "lang_pred", "score"],
            )

    return df.select(id_column, text).mapInArrow(run, f"`{id_column}` {kind}, lang_pred string, score double")
