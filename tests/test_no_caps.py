"""Ids and numbers of any size go through whole."""

import math
import random

from pyspark.sql import functions as F

from eavspark.operators import grid, quality, routing


def test_numbers_keep_all_their_digits(spark):
    rng = random.Random(2)
    numbers = [0.0, -0.0, 1.0, -1.5, 1e-9, 1.25e-7, 5e-324, 1.7976931348623157e308, 1e7, 12345678.0, 1.5e10, 123456789.125, -1e22, 1e23, 0.001, 1e-3]
    numbers += [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    for x, text in df.select("x", grid.number_text(F.col("x"))).collect():
        assert "E" not in text and float(text) == x, (x, text)
        assert "." not in text or not text.endswith("0"), text
    odd = spark.createDataFrame([(math.inf,), (math.nan,), (None,)], "x double")
    assert [r[0] for r in odd.select(grid.number_text(F.col("x"))).collect()] == ["Infinity", "NaN", None]


def test_large_attribute_ids_are_kept(spark):
    fields = spark.createDataFrame([(70_000, 1, 0, False), (-70_000, 1, 0, False)], "attribute_id int, data_type int, sub_type int, qualified boolean")
    values = spark.createDataFrame([(1, 70_000, 1, b"a"), (2, -70_000, 1, b"b")], "entity_id long, attribute_id int, seq long, v binary")
    typed = routing.with_fields(values, fields)
    assert sorted((r.entity_id, r.value) for r in routing.route(typed)["value_texts"].collect()) == [(1, "a"), (2, "b")]
    ranges = spark.createDataFrame([(70_000, 0.0, 1.0)], "id int, min double, max double")
    numbers = spark.createDataFrame([(1, 70_000, 1, 2.0)], "entity_id long, attribute_id int, seq long, value double")
    assert quality.out_of_range(numbers, ranges).select("detail").collect() == [("above",)]
