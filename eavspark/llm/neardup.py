"""Near-duplicate groups by min-max hashing.

Texts with equal shingle sets form a class; one member stands for it. A class's
signature keeps both the least and the greatest value of its set under each
permutation, so ``permutations`` hash evaluations give twice as many signature values.
Bands of the signature are buckets. Links are confirmed on the full sets.

A bucket is never expanded into its pairs: its members meet in the block that its least
class names, where that class is compared with all of them, and only what still lies in
other components is compared again (:mod:`eavspark.llm.cells`). A group of thousands of
copies costs thousands of comparisons, not millions.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavspark.llm.cells import Roots, components, grouped  # noqa: F401 - components is offered here too
from eavspark.llm.common import arrow_schema, mix, rows, shingle_set
from eavspark.session import materialize, small_batches

_DRAW = np.random.PCG64(13).random_raw(512)


def signature(found: np.ndarray, permutations: int) -> np.ndarray:
    """Least and greatest value of the set under each permutation (upper 32 bits)."""
    out = np.empty((permutations, 2), np.uint32)
    for p in range(permutations):
        x = (found ^ _DRAW[2 * p]) * (_DRAW[2 * p + 1] | np.uint64(1))
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x9E3779B97F4A7C15)
        out[p] = int(x.min()) >> 32, int(x.max()) >> 32
    return out


def digest(found: np.ndarray) -> bytes:
    """The class of a set: equal for equal sets only, but for a chance of 2**-160."""
    sums = (mix(found ^ d).sum(dtype=np.uint64) for d in _DRAW[-2:])
    return b"".join(int(v).to_bytes(8, "little") for v in sums) + zlib.crc32(found.tobytes()).to_bytes(4, "little")


def bands_of(values: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit key per band: ``width`` values of different permutations each."""
    flat = values.T.reshape(-1).astype(np.uint64)  # all minima, then all maxima
    groups = flat[: len(flat) // width * width].reshape(-1, width)
    key = np.arange(len(groups), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(width):
        key = mix(key ^ groups[:, j]) + np.uint64(j)
    return mix(key)


def sketches(df: DataFrame, words: int, permutations: int, width: int, id_column: str, text: str) -> DataFrame:
    """(doc_id, n_shingles, class, sig, bands) of every document; empty sets have no class."""
    made = "n_shingles long, class binary, sig binary, bands array<long>"

    def run(batches):
        schema = arrow_schema(made)
        for part in rows(batches, "_text"):
            out = []
            for t in part.column(1).to_pylist():
                s = shingle_set(t or b"", words)
                if not len(s):
                    out.append((0, None, None, None))
                    continue
                sig = signature(s, permutations)
                out.append((len(s), digest(s), sig.tobytes(), bands_of(sig, width).view(np.int64)))
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", *schema.names])

    source = df.select(F.col(id_column).alias("doc_id"), F.col(text).alias("_text"))
    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {made}")


def shingle_sets(df: DataFrame, words: int, text: str) -> DataFrame:
    """(class, items): the class and the whole set of every text that has words."""

    def run(batches):
        for part in rows(batches, text):
            sets = [s for t in part.column(0).to_pylist() if len(s := shingle_set(t or b"", words))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([digest(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                names=["class", "items"],
            )

    return df.select(text).mapInArrow(run, "class binary, items array<long>")


def cell_links(members: list[dict], searchers: list[dict], percent: int, screen: int) -> list[tuple[bytes, bytes]]:
    """Components that links of one cell join, by their roots; both sides have n, root, sig and items.

    Signatures that agree in ``screen`` places are compared on the full sets."""
    sigs = np.array([np.frombuffer(m["sig"], np.uint32) for m in members])
    sizes = np.array([m["n"] for m in members])
    roots, out = Roots(), []
    for s in searchers:
        alike = (sigs == np.frombuffer(s["sig"], np.uint32)).sum(axis=1) >= screen
        alike &= 100 * np.minimum(sizes, s["n"]) >= percent * np.maximum(sizes, s["n"])
        for i in np.flatnonzero(alike):
            m = members[i]
            own, its = roots.find(s["root"]), roots.find(m["root"])
            if own == its:
                continue
            shared = len(np.intersect1d(s["items"], m["items"], assume_unique=True))
            if 100 * shared >= percent * (s["n"] + m["n"] - shared):
                roots.join(own, its)
                out.append((s["root"], m["root"]))
    return out


def near_duplicates(
    df: DataFrame, words: int = 5, percent: int = 80, permutations: int = 56, width: int = 4,
    id_column: str = "doc_id", text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``df``.

    Shingles are runs of ``words`` words, A-Z lower-cased; a shorter text is one
    shingle, a null text or one without words has none and is linked with nothing.
    ``component_id`` is the smallest id reachable over links, ``kept`` marks the row
    that bears it (all rows, if several share that id; none for a null id). A text that only rows
    without an id carry is linked with its equals alone.
    112 signature values in 28 bands of four find a pair at similarity 0.8 with
    probability 1 - 4e-7, more alike ones more surely; what is found is then exact.
    """
    small_batches(df.sparkSession)
    found = materialize(sketches(df, words, permutations, width, id_column, text), "sketches")
    some = found.where(F.col("class").isNotNull())
    classes = some.groupBy("class").agg(F.min("n_shingles").alias("n"), F.min(F.struct("sig", "bands")).alias("s"))
    bands = materialize(classes.select("class", "n", F.posexplode("s.bands").alias("band", "key")), "bands")
    # one key may be met by many: partial counts come first, and single ones go
    busy = bands.groupBy("band", "key").agg(F.count("*").alias("members"), F.min("class").alias("least")).where("members > 1")
    # a bucket is named by its least class, so copies that meet in many buckets meet in one block
    meet = materialize(bands.join(busy, ["band", "key"]).select(F.xxhash64("least").alias("block"), "class", "n").distinct(), "meet")
    heads = meet.select("block").distinct().join(meet.select(F.xxhash64("class").alias("block"), "class", "n").distinct(), "block")
    sig = some.join(meet.select("class").distinct(), "class", "left_semi").groupBy("class").agg(F.min("sig").alias("sig"))
    payload = materialize(sig.join(_sets(df, found, meet, words, id_column, text), "class"), "payload")
    screen = int(2 * permutations * max(0.0, percent / 100 - 0.24))  # over six deviations below
    groups = grouped(meet, heads, payload, lambda own, asks: cell_links(own, asks, percent, screen))
    # the smallest id of a class, then of its component
    ids = some.groupBy("class").agg(F.min("doc_id").alias("id"), F.count("*").alias("c"))
    known = ids.join(groups, ids["class"] == groups["node"], "left").select("class", "id", F.coalesce("root", "class").alias("root"), ((F.col("c") > 1) | F.col("root").isNotNull()).alias("shared"))
    least = known.groupBy("root").agg(F.min("id").alias("component"))
    answer = materialize(known.where("shared").join(least, "root").select("class", "component"), "answer")
    return (
        found.join(answer, "class", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))
    )


def _sets(df: DataFrame, found: DataFrame, near: DataFrame, words: int, id_column: str, text: str) -> DataFrame:
    """The full sets of the classes that meet another in a bucket, one text per class read."""
    member = (
        found.join(near.select("class").distinct(), "class", "left_semi")
        .groupBy("class").agg(F.min("doc_id").alias("_id")).where(F.col("_id").isNotNull()).select("_id").distinct()
    )
    # rows that share an id may differ in text, so the class is taken from the text itself
    texts = df.select(F.col(id_column).alias("_id"), F.col(text).alias("_text")).join(member, "_id", "left_semi").select("_text")
    return shingle_sets(texts, words, "_text").groupBy("class").agg(F.first("items").alias("items"))
