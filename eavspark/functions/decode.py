"""Field decoders as native expressions: ``bytes`` columns in, typed columns out.

Offsets are zero-based, as page layouts count them. Nothing here needs Python
workers; every function returns a Column that stays inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE_DATE = "1860-01-01"  # fixed value: day 0 of the legacy calendar

# fixed values: times of day that are codes, not milliseconds
TIME_PRE, TIME_POST, TIME_MIDNIGHT = 0x20000000, 0x40000000, 0x80000000

DAY_MINUTES = 24 * 60


def part(b: Column, off: int | Column, n: int | Column) -> Column:
    """``n`` bytes from zero-based ``off``."""
    if isinstance(off, int) and isinstance(n, int):
        return F.substring(b, off + 1, n)
    return F.substr(b, (F.lit(off) + 1).cast("int"), F.lit(n).cast("int"))


def _ordered(raw: Column, endian: str) -> Column:
    if endian == "big":
        return raw
    if endian == "little":
        # one character per byte, so reversing text reverses bytes
        return F.encode(F.reverse(F.decode(raw, "ISO-8859-1")), "ISO-8859-1")
    raise ValueError(f"endian must be 'big' or 'little', not {endian!r}")


def uint(raw: Column, endian: str = "big") -> Column:
    """Unsigned integer of up to seven bytes."""
    return F.conv(F.hex(_ordered(raw, endian)), 16, 10).cast("bigint")


def sint(raw: Column, n: int, endian: str = "big") -> Column:
    """Two's complement integer of ``n`` bytes."""
    u = uint(raw, endian)
    return F.when(u >= 1 << (8 * n - 1), u - (1 << (8 * n))).otherwise(u)


def u8(b: Column, off: int | Column) -> Column:
    return uint(part(b, off, 1))


def i8(b: Column, off: int | Column) -> Column:
    return sint(part(b, off, 1), 1)


def u16(b: Column, off: int | Column, endian: str = "big") -> Column:
    return uint(part(b, off, 2), endian)


def i16(b: Column, off: int | Column, endian: str = "big") -> Column:
    return sint(part(b, off, 2), 2, endian)


def u32(b: Column, off: int | Column, endian: str = "big") -> Column:
    return uint(part(b, off, 4), endian)


def i32(b: Column, off: int | Column, endian: str = "big") -> Column:
    return sint(part(b, off, 4), 4, endian)


def _ieee(sign: Column, exponent: Column, mantissa: Column, ebits: int, mbits: int) -> Column:
    bias, top = (1 << (ebits - 1)) - 1, (1 << ebits) - 1
    m = mantissa.cast("double")
    size = (
        # not-a-number reads as 0, infinity is kept for the finite check
        F.when((exponent == top) & (mantissa > 0), F.lit(0.0))
        .when(exponent == top, F.lit(float("inf")))
        .when(exponent == 0, m * F.lit(2.0 ** (1 - bias - mbits)))
        .otherwise((m + float(1 << mbits)) * F.pow(F.lit(2.0), exponent - (bias + mbits)))
    )
    # adding 0.0 turns a negative zero into zero
    return size * F.when(sign == 1, -1.0).otherwise(1.0) + 0.0


def f32_of(bits: Column) -> Column:
    """IEEE-754 single, given as its 32 bits, as DOUBLE; NaN gives 0."""
    return _ieee(
        F.shiftrightunsigned(bits, 31),
        F.shiftrightunsigned(bits, 23).bitwiseAND(0xFF),
        bits.bitwiseAND(0x7FFFFF),
        8, 23,
    )


def f64_of(high: Column, low: Column) -> Column:
    """IEEE-754 double, given as two halves of 32 bits; NaN gives 0."""
    return _ieee(
        F.shiftrightunsigned(high, 31),
        F.shiftrightunsigned(high, 20).bitwiseAND(0x7FF),
        high.bitwiseAND(0xFFFFF) * F.lit(1 << 32) + low,
        11, 52,
    )


def f32(raw: Column, endian: str = "big") -> Column:
    return f32_of(uint(raw, endian))


def f64(raw: Column, endian: str = "big", *, single: bool = False) -> Column:
    """``single`` narrows the result to 32 bits."""
    raw = _ordered(raw, endian)
    value = f64_of(uint(F.substring(raw, 1, 4)), uint(F.substring(raw, 5, 4)))
    return value.cast("float").cast("double") if single else value


def signed(bits: Column, n: int) -> Column:
    """Two's complement reading of an unsigned value of ``n`` bytes."""
    return F.when(bits >= 1 << (8 * n - 1), bits - (1 << (8 * n))).otherwise(bits)


def bit(b: Column, off: int, index: int) -> Column:
    """Bit ``index`` (1 = lowest) of the byte at ``off``."""
    return F.getbit(u8(b, off), F.lit(index - 1)) == 1


def latin1(raw: Column) -> Column:
    """One character per byte, code point equal to the byte."""
    return F.decode(raw, "ISO-8859-1")


def text(raw: Column, charset: str = "ascii") -> Column:
    """Text without trailing NULs. ``ascii`` reads bytes above 0x7F as ``?``."""
    trimmed = F.rtrim(latin1(raw), F.lit("\0"))
    if charset == "ascii":
        return as_ascii(trimmed)
    if charset == "latin-1":
        return trimmed
    raise ValueError(f"charset must be 'ascii' or 'latin-1', not {charset!r}")


def as_ascii(chars: Column) -> Column:
    return F.regexp_replace(chars, "[\u0080-ÿ]", "?")


def ascii_trim(b: Column, off: int | Column, n: int | Column, charset: str = "ascii") -> Column:
    return text(part(b, off, n), charset)


def has_data(b: Column) -> Column:
    """A page or value exists iff some byte is not zero."""
    return F.length(F.rtrim(latin1(b), F.lit("\0"))) > 0


def rpad_bytes(v: Column, n: int) -> Column:
    """Restore trimmed trailing zero bytes; cut what is longer."""
    return F.substring(F.concat(v, F.lit(bytes(n))), 1, n)


def legacy_date(days: Column) -> Column:
    return F.date_add(F.lit(BASE_DATE).cast("date"), days.cast("int"))


def legacy_timestamp(days: Column, millis: Column) -> Column:
    """Zone-free, so that offsets of the 19th century do not shift it."""
    seconds = millis.cast("decimal(18,6)") / F.lit(1000)
    return F.lit(BASE_DATE).cast("timestamp_ntz") + F.make_dt_interval(
        days.cast("int"), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)")
    )


def time_text(code: Column) -> Column:
    """PRE or POST where the time is one of these codes, else NULL."""
    return F.when(code == TIME_PRE, "PRE").when(code == TIME_POST, "POST")


def time_seconds(code: Column) -> Column:
    """Seconds of the day, whole minutes; NULL for PRE and POST."""
    minutes = F.pmod(F.floor(code / 60000), F.lit(DAY_MINUTES))
    return F.when(code == TIME_MIDNIGHT, F.lit(0)).when(
        time_text(code).isNull(), (minutes * 60).cast("int")
    )


def round_half_even(x: Column, digits: Column | int) -> Column:
    scale = F.pow(F.lit(10.0), F.lit(digits).cast("double"))
    return F.rint(x * scale) / scale


def is_finite(x: Column) -> Column:
    return F.abs(x) < F.lit(float("inf"))


def key_length(n: Column) -> Column:
    """Block length of an index from the length its definition states."""
    return (F.floor((n + 11) / 4) * 4).cast("int")


def date_format_for(length: Column) -> Column:
    return F.when(length < 10, "dd.MM.yy").otherwise("dd.MM.yyyy")


def time_format_for(length: Column) -> Column:
    return F.when(length < 5, "hhmm").otherwise("hh:mm")


def clean_comment(comment: Column) -> Column:
    without = F.regexp_replace(comment, "(?i)date of ", "")
    return F.trim(F.regexp_replace(without, "(?i)date", ""))


def fold(key: Column) -> Column:
    """Form in which keys compare without regard to case."""
    return F.lower(key)


def page_text(b: Column, line_count: Column, charset: str = "ascii", start: int = 32) -> Column:
    """Text of one long-text page with its closing line feeds."""
    body = F.rtrim(latin1(F.substring(b, start + 1, 1 << 30)), F.lit("\0"))
    body = F.when(
        F.endswith(body, F.lit("\x7f")), F.substr(body, F.lit(1), F.length(body) - 1)
    ).otherwise(body)
    lines = F.translate(body, "\0\x7f", "\n\n")
    if charset == "ascii":
        lines = as_ascii(lines)
    return F.concat(lines, F.repeat(F.lit("\n"), line_count.cast("int") + 1))
