"""Blocks inside pages: fixed, delimited and run-length coded."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    IntegerType,
    StructField,
    StructType,
)

from eavspark.functions import decode as D
from eavspark.operators.ordered import Ordered, match

DELIMITER = 0x05  # fixed value: ends a caption block
REPEAT, LENGTH = 0x80, 0x7F  # fixed values: masks of the run-length control byte


def block_array(b: Column, header: int, length: int | Column) -> Column:
    """The fixed-length blocks of a page, as many as fit."""
    width = F.lit(length).cast("int")
    n = F.floor((F.length(b) - header) / width).cast("int")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.substr(b, i * width + header + 1, width))


def take_until(blocks: Column, bad: Callable[[Column], Column]) -> Column:
    """Blocks before the first bad one. A page is one row, so no shuffle."""
    at = F.array_position(F.transform(blocks, bad), True)
    return F.slice(blocks, F.lit(1), F.when(at == 0, F.size(blocks)).otherwise(at - 1).cast("int"))


def fixed_blocks(
    pages: DataFrame,
    header: int,
    length: int | Column,
    *,
    until: Callable[[Column], Column] | None = None,
    keep: Sequence[str] = ("page_id",),
) -> DataFrame:
    """One row per block: ``keep`` columns, zero-based ``pos`` and ``block``."""
    blocks = block_array(F.col("bytes"), header, length)
    if until is not None:
        blocks = take_until(blocks, until)
    return pages.select(*keep, F.posexplode(blocks).alias("pos", "block"))


def delimited_blocks(pages: DataFrame, charset: str = "ascii") -> DataFrame:
    """Caption blocks ``(page_id, pos, x, y, text)``.

    A coordinate may equal the delimiter; the search for it starts at the text.
    """
    valid = F.rtrim(D.latin1(F.col("bytes")), F.lit("\0"))
    found = F.regexp_extract_all(valid, F.lit(f"(?s).(.)(.)([^\\x{DELIMITER:02x}]*)"), F.lit(0))
    # coordinates alone, at the end of the page, are no block
    found = F.when(
        F.length(F.try_element_at(found, F.lit(-1))) > 3, found
    ).otherwise(F.slice(found, F.lit(1), F.greatest(F.size(found) - 1, F.lit(0))))
    pages = pages.select("page_id", found.alias("_found")).where(
        (F.size("_found") > 0) & (F.length(F.col("_found")[0]) > 4)
    )
    block = F.col("_block")
    text = F.rtrim(F.substr(block, F.lit(4)), F.lit("\0"))
    return pages.select("page_id", F.posexplode("_found").alias("pos", "_block")).select(
        "page_id",
        "pos",
        F.ascii(F.substring(block, 2, 1)).alias("x"),
        F.ascii(F.substring(block, 3, 1)).alias("y"),
        (D.as_ascii(text) if charset == "ascii" else text).alias("text"),
    )


def _rle_batch(pages: pa.Array, first: int, no_value: np.ndarray | None):
    """All blocks of a batch of pages, one block of every page per step."""
    n = len(pages)
    _, offset_buffer, data_buffer = pages.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int32)[pages.offset : pages.offset + n + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer else np.empty(0, np.uint8)
    start, stop = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    readable = np.flatnonzero(stop - start >= first + 3)
    start, stop = start[readable], stop[readable]
    free = (data[start + 6].astype(np.int64) << 8) | data[start + 7]
    free = np.where(free >= 1 << 15, free - (1 << 16), free)
    end = np.minimum(stop, stop - free)
    row, ptr, step = readable, start + first, 0
    out: list[tuple[np.ndarray, ...]] = []
    while len(row):
        control = data[ptr + 2].astype(np.int64)
        repeated, length = (control & REPEAT) > 0, control & LENGTH
        size = length - 3 - repeated
        # control 0 ends the page; so does a block that its own bytes overrun
        good = (control > 0) & (size >= 0) & (ptr + length <= stop)
        row, ptr, end, stop = row[good], ptr[good], end[good], stop[good]
        length, repeated, size = length[good], repeated[good], size[good]
        item = (data[ptr].astype(np.int32) << 8) | data[ptr + 1]
        item = np.where(item >= 1 << 15, item - (1 << 16), item)
        count = data[ptr + length - 1].astype(np.int32)
        rep = np.where(repeated, np.where(count == 0, 256, count), 1)
        out.append((row, np.full(len(row), step, np.int32), item, rep, ptr + 3, size))
        ptr = ptr + length
        more = ptr + 3 <= end
        row, ptr, end, stop = row[more], ptr[more], end[more], stop[more]
        step += 1
    if not out:
        return None
    row, pos, item, rep, at, size = (np.concatenate(c) for c in zip(*out, strict=True))
    if no_value is not None:
        size = np.where(np.isin(item, no_value), 0, size)
    ends = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=ends[1:])
    values = data[np.repeat(at - ends[:-1], size) + np.arange(ends[-1])]
    v = pa.Array.from_buffers(
        pa.binary(), len(size), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(values)]
    )
    return row, pos.astype(np.int32), item.astype(np.int32), rep.astype(np.int32), v, (data, at, size)


WORDS = ["w0", "w1", "w2", "w3"]  # the first bytes of a value as big-endian 32-bit integers


def value_words(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> list[pa.Array]:
    """The first sixteen bytes of each value as four signed integers, zeros behind its end."""
    place = np.arange(4 * len(WORDS))
    head = np.zeros((len(at), len(place)), np.uint8)
    inside = place < size[:, None]
    head[inside] = data[(at[:, None] + place)[inside]]
    return [pa.array(w) for w in head.view(">i4").astype(np.int32).T]


Read = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def rle_blocks(
    pages: DataFrame,
    *,
    header: int = 16,
    keep: Sequence[str] = ("entity_id", "chain_pos"),
    without_value: Iterable[int] = (),
    read: Read | None = None,
    words: bool = False,
) -> DataFrame:
    """Run-length blocks: ``keep`` columns, ``pos, item_id, rep, v`` and, with ``words``, ``WORDS``.

    The length of a block is in its own bytes, which no expression can follow
    cheaply, so Arrow batches go through numpy; pages stay where they are.
    ``without_value`` names items whose bytes are not wanted (their blocks stay,
    since they count for the order of items). With ``read`` the pages are rows
    without ``bytes``, which it adds in the same task.
    """
    names = list(keep)
    source = pages.select(*names) if read else pages.select(*names, "bytes")
    schema = StructType(
        [pages.schema[k] for k in keep]
        + [
            StructField("pos", IntegerType()),
            StructField("item_id", IntegerType()),
            StructField("rep", IntegerType()),
            StructField("v", BinaryType()),
        ]
        + [StructField(w, IntegerType()) for w in WORDS if words]
    )
    dropped = np.array(sorted(without_value), dtype=np.int32) if without_value else None

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in read(batches) if read else batches:
            column = batch.column(len(names))
            if column.null_count:
                batch = batch.filter(column.is_valid())
                column = batch.column(len(names))
            column = column.cast(pa.binary())
            found = _rle_batch(column, header, dropped)
            if found is None:
                continue
            row, pos, item, rep, v, place = found
            taken = batch.select(names).take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(pos), pa.array(item), pa.array(rep), v, *(value_words(*place) if words else [])],
                names=[*names, "pos", "item_id", "rep", "v", *(WORDS if words else [])],
            )

    return source.mapInArrow(parse, schema)


BLOCK_ORDER = ["chain_pos", "pos"]


def by_entity(blocks: DataFrame, **options) -> Ordered:
    return Ordered(blocks, ["entity_id"], BLOCK_ORDER, **options)


def guard_ascending(ordered: Ordered, column: str = "item_id") -> Ordered:
    """Flag rows in ``kept``: a row stays if its item is above all earlier ones,
    or equals their maximum and nothing lower came since that maximum was set.
    Everything after an item that is not positive is out.
    """
    def upto(*extra):
        return ordered.window(*extra).rowsBetween(Window.unboundedPreceding, Window.currentRow)

    df = ordered.df.withColumn("_max", F.max(column).over(upto())).withColumn(
        "_min", F.min(column).over(upto())
    )
    # lowest item since the maximum was set, within the slice
    df = df.withColumn("_since", F.min(column).over(upto("_max")))
    kept = (F.col(column) == F.col("_max")) & (F.col("_since") == F.col("_max"))
    if ordered.sliced:
        inner = ordered._keep(df)
        top = F.max(column)
        peaks = inner.slice_totals((), _top=top, _low=F.min(column))
        # lowest item after the maximum of the slice was first reached
        after = (
            df.where(F.col("_slice") > 0)
            .groupBy(*ordered.keys, "_slice", "_max")
            .agg(F.min("_since").alias("_after"))
            .withColumnRenamed("_max", "_top")
        )
        peaks = match(peaks, after, [*ordered.keys, "_slice", "_top"], "left")
        before = (
            Window.partitionBy(*ordered.keys).orderBy("_slice")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        peaks = peaks.withColumn("_in", F.max("_top").over(before)).withColumn(
            "_in_low", F.min("_low").over(before)
        )
        # the maximum after this slice, and the lowest item since it was set
        peaks = peaks.withColumn("_out", F.greatest("_in", "_top")).withColumn(
            "_out_low",
            F.when(F.col("_in").isNull() | (F.col("_top") > F.col("_in")), F.col("_after"))
            .otherwise(F.col("_low")),
        )
        same = (
            Window.partitionBy(*ordered.keys, "_out").orderBy("_slice")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        peaks = peaks.withColumn("_out_since", F.min("_out_low").over(same))
        lagged = Window.partitionBy(*ordered.keys).orderBy("_slice")
        peaks = peaks.select(
            *ordered.keys, "_slice", "_in", "_in_low",
            F.lag("_out_since").over(lagged).alias("_in_since"),
        )
        df = match(df, peaks, [*ordered.keys, "_slice"], "left")
        fresh = F.col("_in").isNull() | (F.col("_max") > F.col("_in"))
        # a maximum carried in: nothing lower may stand before it or in the slice so far
        level = (F.col(column) == F.col("_in")) & (F.col("_in_since") == F.col("_in"))
        kept = F.when(fresh, kept).otherwise(level & (F.col("_min") == F.col("_in")))
        low = F.least(F.col("_min"), F.col("_in_low"))
    else:
        low = F.col("_min")
    df = df.withColumn("kept", F.coalesce(kept, F.lit(False)) & (low > 0))
    return ordered._keep(df.drop("_max", "_min", "_since", "_in", "_in_low", "_in_since"))


def number_rows(ordered: Ordered) -> Ordered:
    """``seq_end``: the inferred row number of the last row of each block.

    Row numbers are not stored; they come from counting, blanks included.
    """
    return ordered.running_sum(F.col("rep"), "seq_end", extra=["item_id"])


def expand_rows(blocks: DataFrame) -> DataFrame:
    """One row per value: blanks are fillers and give none."""
    filled = blocks.where(F.length("v") > 0)
    last = F.col("seq_end")
    return filled.select(
        *[c for c in blocks.columns if c not in ("rep", "seq_end", "_slice", "kept")],
        F.explode(F.sequence(last - F.col("rep") + 1, last)).alias("seq"),
    )
