"""What several operators share: tables, held-out folds, hashes of words and shingles."""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS = 256  # rows turned into Python objects at a time, so that long texts stay few
WORD = r"[^\x20\x09-\x0D]+"  # a word: anything but ASCII white space
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def rows(batches: Iterator[pa.RecordBatch], text: str | None = None) -> Iterator[pa.RecordBatch]:
    """The batches in small slices, the text column as bytes."""
    for batch in batches:
        if text is not None:
            at = batch.schema.get_field_index(text)
            batch = batch.set_column(at, text, batch.column(at).cast(pa.large_binary()))
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def per_text(
    df: DataFrame, keys: list[str], text: str, made: str, make: Callable[[], Callable[[bytes | None], tuple]],
    flush: int = 4096,
) -> DataFrame:
    """``keys`` of every row beside what a function makes of its text.

    ``make`` runs once per task and returns the function; ``made`` is the DDL of the
    columns it fills. Rows keep their number and order.
    """
    fields = df.select(*keys).schema
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), made])
    names = [c.strip().split()[0] for c in made.split(",")]

    def run(batches):
        fn = make()
        schema = None
        for part in rows(batches, text):
            out = [fn(t.as_py()) for t in part.column(part.schema.get_field_index(text))]
            columns = list(zip(*out, strict=True)) or [()] * len(names)
            schema = schema or arrow_schema(made)
            arrays = [part.column(part.schema.get_field_index(k)) for k in keys]
            arrays += [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, *names])

    return df.select(*keys, text).mapInArrow(run, ddl)


ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
    "boolean": pa.bool_(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
    "float": pa.float32(), "array<float>": pa.list_(pa.float32()), "array<int>": pa.list_(pa.int32()),
}


def arrow_schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, ARROW[t]) for n, t in (c.strip().split() for c in ddl.split(","))])


# ---- hashes -----------------------------------------------------------------------

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_TABLE = np.random.PCG64(11).random_raw(256)
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_STEP = np.random.PCG64(12).random_raw(64) | np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64 (a fixed bijection)."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _raise(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _BACK)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def word_spans(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a UTF-8 text start and end (in bytes)."""
    edges = np.flatnonzero(np.diff(_SPACE[a], prepend=True, append=True))
    return edges[::2], edges[1::2]


def _hash_chunk(a: np.ndarray) -> np.ndarray:
    starts, ends = word_spans(a)
    up, down = _raise(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_TABLE[a] * up[: len(a)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order. Long texts go in chunks cut at white space."""
    a = np.frombuffer(data, np.uint8)
    if len(a) <= CHUNK:
        return _hash_chunk(a)
    parts, at = [], 0
    while at < len(a):
        end = min(at + CHUNK, len(a))
        while end < len(a) and not _SPACE[a[end]]:
            ahead = np.flatnonzero(_SPACE[a[end : end + CHUNK]])
            end = end + int(ahead[0]) if len(ahead) else min(end + CHUNK, len(a))
        parts.append(_hash_chunk(a[at:end]))
        at = end
    return np.concatenate(parts)


def shingle_set(data: bytes, k: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``k`` words, A-Z lower-cased.

    Fewer words than ``k`` make one run of them all; no words, an empty set.
    """
    words = word_hashes(data.lower())
    n = len(words)
    if n == 0:
        return words
    width = min(n, k)
    total = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        total += words[j : n - width + 1 + j] * _STEP[j]
    return np.unique(mix(total))


# ---- terms ------------------------------------------------------------------------


def counted_terms(data: bytes, term: re.Pattern, gap: re.Pattern) -> Counter:
    """How often each term occurs, A-Z lower-cased. Long texts go in pieces cut where ``gap`` matches."""
    data = data.lower()  # bytes: ASCII alone
    found: Counter = Counter()
    at = 0
    while at < len(data):
        cut = gap.search(data, at + CHUNK) if at + CHUNK < len(data) else None
        end = cut.start() if cut else len(data)
        found.update(term.findall(data[at:end]))
        at = end
    return found


def small_slices(batches: Iterator[pa.RecordBatch], text: str, most: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``ROWS`` rows and about ``most`` bytes of text, the text as bytes."""
    for batch in rows(batches, text):
        column = batch.column(batch.schema.get_field_index(text))
        if column.nbytes <= most:
            yield batch
            continue
        ends = np.cumsum(np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False))) // most
        starts = np.flatnonzero(np.diff(ends, prepend=-1))
        for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, stop - start)
