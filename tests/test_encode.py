"""Encoders raise where a value has no room; they never cut or wrap."""

import pytest
from pyspark.sql import functions as F

from eavspark.functions import encode as E


def test_what_fits_is_laid_out(spark):
    row = spark.range(1).select(
        E.int_bytes(F.lit(65535), 2, signed=False).alias("a"), E.int_bytes(F.lit(-32768), 2).alias("b"),
        E.pad(F.lit(b"ab"), 4).alias("c"), E.pad(F.lit(b"ab"), F.lit(3)).alias("d"),
        E.int_bytes(F.lit(None), 2).alias("e"), E.pad(F.lit(None).cast("binary"), 2).alias("f"),
    ).first()
    assert [v if v is None else bytes(v) for v in row] == [b"\xff\xff", b"\x80\x00", b"ab\0\0", b"ab\0", None, None]


@pytest.mark.parametrize("made", [
    lambda i: E.int_bytes(i + 32768, 2), lambda i: E.int_bytes(i + (1 << 31), 4),
    lambda i: E.int_bytes(i - 1, 2, signed=False), lambda i: E.int_bytes(i + 65536, 2, signed=False),
    lambda i: E.fixed_text(F.concat(i, F.lit("abc")), 3), lambda i: E.int_bytes(i - 32769, 2), lambda i: E.int_bytes(i - 3_000_000_000, 4),
    lambda i: E.pad(E.text_bytes(F.concat(i, F.lit("abc"))), 3),
    lambda i: E.pad(E.text_bytes(F.concat(i, F.lit("abc"))), F.lit(3)),
    lambda i: E.fields(8, (0, 2, E.text_bytes(F.concat(i, F.lit("abc"))))),
])
def test_what_does_not_fit_raises(spark, made):
    with pytest.raises(Exception, match="fit in"):
        spark.range(1).select(made(F.col("id"))).collect()
