"""The inverse of :mod:`eavspark.functions.decode`: typed columns to field bytes.

Used to derive page tables from ordinary tables (round trips, migration tests).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from eavspark.functions.decode import BASE_DATE


def int_bytes(value: Column, n: int, *, signed: bool = True) -> Column:
    """``n`` big-endian bytes; negative values as two's complement. A value that would
    read back as another from a field of this sign raises: the page format has no wider field."""
    v = value.cast("bigint")
    inside = v.between(-(1 << (8 * n - 1)), (1 << (8 * n - 1)) - 1) if signed else v.between(0, (1 << (8 * n)) - 1)
    v = F.when(inside, v).when(~inside, F.raise_error(F.concat(v, F.lit(f" does not fit in {n} bytes"))))
    return F.unhex(F.lpad(F.hex(F.when(v < 0, v + (1 << (8 * n))).otherwise(v)), 2 * n, "0"))


def text_bytes(value: Column, charset: str = "latin-1") -> Column:
    """Single-byte text; characters the charset lacks become ``?``."""
    top = {"latin-1": "ÿ", "ascii": "\u007f"}[charset]
    known = F.regexp_replace(value, f"[^\\x00-{top}]", "?")
    return F.encode(known, "ISO-8859-1")


def fixed_text(value: Column, n: int, charset: str = "latin-1") -> Column:
    """Text on ``n`` bytes, zeros behind it. Text that does not fit raises."""
    return pad(text_bytes(value, charset), n)


def pad(raw: Column, n: int | Column) -> Column:
    """Zero bytes on the right up to ``n``. Bytes that do not fit raise."""
    width = F.lit(n) if isinstance(n, int) else n.cast("int")
    fits = F.when(F.length(raw) <= width, raw).when(
        F.length(raw) > width, F.raise_error(F.concat(F.length(raw), F.lit(" bytes do not fit in "), width)))
    zeros = F.lit(bytes(n)) if isinstance(n, int) else F.unhex(F.repeat(F.lit("00"), width))
    return F.substr(F.concat(fits, zeros), F.lit(1), width)


def trim_zeros(raw: Column) -> Column:
    """Drop trailing zero bytes, as the source does to save space."""
    return F.unhex(F.regexp_replace(F.hex(raw), "(00)+$", ""))


def date_bytes(value: Column) -> Column:
    return int_bytes(F.datediff(value, F.lit(BASE_DATE).cast("date")), 2, signed=False)


def _big_endian(numbers: pa.Array, kind: str) -> pa.Array:
    """IEEE-754 bytes of an Arrow array; Spark has no expression for them."""
    x = numbers.to_numpy(zero_copy_only=False)
    width = np.dtype(kind).itemsize
    data = pa.py_buffer(x.astype(kind).tobytes())
    raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(x), [None, data])
    raw = raw.cast(pa.binary())
    return pc.if_else(numbers.is_valid(), raw, None) if numbers.null_count else raw


def _single_bytes(numbers: pa.Array) -> pa.Array:
    return _big_endian(numbers, ">f4")


def _double_bytes(numbers: pa.Array) -> pa.Array:
    return _big_endian(numbers, ">f8")


def f32_bytes(value: Column) -> Column:
    return F.arrow_udf(_single_bytes, BinaryType())(value.cast("double"))


def f64_bytes(value: Column) -> Column:
    return F.arrow_udf(_double_bytes, BinaryType())(value.cast("double"))


def time_bytes(seconds: Column) -> Column:
    return int_bytes(seconds.cast("bigint") * 1000, 4, signed=False)


def fields(length: int, *placed: tuple[int, int, Column]) -> Column:
    """Lay ``(offset, width, bytes)`` fields, given in order, on ``length`` bytes."""
    parts, at = [], 0
    for offset, width, raw in placed:
        if offset > at:
            parts.append(F.lit(bytes(offset - at)))
        parts.append(pad(raw, width))
        at = offset + width
    if at < length:
        parts.append(F.lit(bytes(length - at)))
    return F.concat(*parts)


def join_blocks(blocks: Column) -> Column:
    """Concatenate an array of binary blocks, in time linear in their length."""
    return F.unhex(F.array_join(F.transform(blocks, F.hex), ""))


def rle_block(item: Column, value: Column, rep: Column) -> Column:
    """One run-length block: item, control byte, value, count where repeated (0 means 256)."""
    repeated = rep > 1
    size = F.length(value) + 3 + repeated.cast("int")
    control = size + F.when(repeated, 128).otherwise(0)
    count = F.when(repeated, int_bytes(F.when(rep != 256, rep).otherwise(0), 1, signed=False)).otherwise(F.lit(b""))
    return F.concat(int_bytes(item, 2), int_bytes(control, 1, signed=False), value, count)


def bits(*flags: tuple[int, Column]) -> Column:
    """Byte value with bit ``index`` (1 = lowest) set where its flag holds."""
    return reduce(
        lambda a, b: a + b,
        [F.when(flag, 1 << (index - 1)).otherwise(0) for index, flag in flags],
    )
