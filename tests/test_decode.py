"""Field decoders against hand-made vectors and struct."""

import datetime as dt
import struct

import pytest
from pyspark.sql import functions as F

from eavspark.functions import decode as D
from eavspark.functions import encode as E


def lit(h):
    return F.lit(bytes.fromhex(h))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def vectors():
    return [
        (D.i16(lit("fffb"), 0), -5),
        (D.u16(lit("fffb"), 0), 65531),
        (D.i8(lit("fb"), 0), -5),
        (D.i32(lit("00fffffffe"), 1), -2),
        (D.u32(lit("fffffffe"), 0), 4294967294),
        (D.u16(lit("0100"), 0, "little"), 1),
        (D.uint(D.rpad_bytes(lit("01"), 2)), 256),
        (D.f32(D.rpad_bytes(lit("40e8"), 4)), 7.25),
        (D.f64(D.rpad_bytes(lit("401d"), 8)), 7.25),
        (D.f32(lit("0000e840"), "little"), 7.25),
        (D.f32(lit("7fc00000")), 0.0),
        (D.f32(lit("7f800000")), float("inf")),
        (D.f64(lit("fff0000000000000")), float("-inf")),
        (D.f64(lit("3ff199999999999a"), single=True), struct.unpack(">f", struct.pack(">f", 1.1))[0]),
        (D.legacy_date(D.uint(lit("ea60"))), dt.date(2024, 4, 10)),
        (D.legacy_timestamp(F.lit(60000), F.lit(1234)), dt.datetime(2024, 4, 10, 0, 0, 1, 234000)),
        (D.time_text(D.uint(D.rpad_bytes(lit("20"), 4))), "PRE"),
        (D.time_text(D.uint(D.rpad_bytes(lit("40"), 4))), "POST"),
        (D.time_seconds(D.uint(D.rpad_bytes(lit("80"), 4))), 0),
        (D.time_seconds(D.uint(D.rpad_bytes(lit("20"), 4))), None),
        (D.time_seconds(D.uint(lit("0240c840"))), 37800),
        (D.text(lit("41c3420000")), "A?B"),
        (D.text(lit("41c30000"), "latin-1"), "AÃ"),
        (D.round_half_even(F.lit(0.125), 2), 0.12),
        (D.round_half_even(F.lit(0.375), 2), 0.38),
        (D.key_length(F.lit(10)), 20),
        (D.bit(lit("0080"), 1, 8), True),
        (D.bit(lit("0040"), 1, 8), False),
        (D.has_data(lit("000000")), False),
        (D.has_data(lit("000100")), True),
        (D.clean_comment(F.lit("Date of Birth date")), "Birth"),
        (D.date_format_for(F.lit(9)), "dd.MM.yy"),
        (D.time_format_for(F.lit(4)), "hhmm"),
        (
            D.page_text(F.concat(F.lit(bytes(32)), F.lit(b"line1\0line2\x7f\0\0")), F.lit(0)),
            "line1\nline2\n",
        ),
    ]


def test_vectors(spark):
    cases = vectors()
    row = spark.range(1).select(*[c.alias(f"c{i}") for i, (c, _) in enumerate(cases)]).first()
    for i, (_, expected) in enumerate(cases):
        assert row[i] == expected, i


def test_float_bytes_match_struct(spark):
    values = [1.0, 0.1, -2.5, 112946.26, 3e-300, 1e300, 2.0**-1022, -0.3, 0.0, 1.9999999999999998]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for r in df.select("v", E.f64_bytes(F.col("v")).alias("b"),
                       D.f64(E.f64_bytes(F.col("v"))).alias("back")).collect():
        assert struct.unpack(">d", bytes(r.b))[0] == r.v == r.back


def test_subnormal_and_all_exponents(spark):
    raw = [struct.pack(">d", 2.0**e) for e in range(-1074, 1024, 37)]
    raw += [struct.pack(">d", 5e-324), struct.pack(">d", 1.7976931348623157e308)]
    df = spark.createDataFrame([(b,) for b in raw], "b binary")
    for r in df.select("b", D.f64(F.col("b")).alias("x")).collect():
        assert r.x == struct.unpack(">d", bytes(r.b))[0]
    raw = [struct.pack(">f", 2.0**e) for e in range(-149, 128, 11)]
    df = spark.createDataFrame([(b,) for b in raw], "b binary")
    for r in df.select("b", D.f32(F.col("b")).alias("x")).collect():
        assert r.x == struct.unpack(">f", bytes(r.b))[0]


def test_int_that_does_not_fit_raises(spark):
    with pytest.raises(Exception, match="does not fit"):
        one(spark, E.int_bytes(F.lit(70000), 2))
