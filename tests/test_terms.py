"""Search terms stored by their folded form: a prefix is a range that reaches the scan."""

import os

import pytest
from pyspark.sql import functions as F

from eavspark.operators import grid
from eavspark.plans.entities import term_store
from eavspark.schemas import SCHEMAS
from eavspark.store import Store, write_table

TERMS = [(1, "Smith", 1), (1, "SMITHERS", 2), (2, "smith", 3), (1, "Smit", 4), (1, "smi\U0010ffff", 5), (1, "Ärger", 6),
         (1, "ÄRGERNIS", 7), (1, "z", 8), (1, "", 9), (1, "smiti", 10), (1, "smi퟿", 11), (1, "smi", 12)]


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("terms") / "t")
    indexes = spark.createDataFrame(TERMS, "index_type_id int, term string, entity_id long")
    write_table(term_store(indexes), path, "terms")
    return [Store(spark, {"terms": spark.read.schema(SCHEMAS["terms"]).parquet(path)}), Store(spark, {"indexes": indexes})]


@pytest.mark.parametrize("wanted", ["sMi", "smith", "ärger", "smi퟿", "smi\U0010ffff", "\U0010ffff", "", "smith's"])
def test_prefix_and_whole(stores, wanted):
    for store in stores:
        for prefix in (True, False):
            for kind in (None, 1):
                got = sorted(r.entity_id for r in grid.find_entities(store, wanted, prefix=prefix, index_type_id=kind).collect())
                folded = wanted.lower()
                assert got == sorted(
                    e for i, t, e in TERMS
                    if kind in (None, i) and (t.lower().startswith(folded) if prefix else t.lower() == folded)
                )


def test_the_range_is_pushed_and_skips_files(spark, tmp_path):
    path = str(tmp_path / "t")
    many = spark.range(20_000).select(
        F.lit(1).alias("index_type_id"), F.concat(F.lit("Name#"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("term"),
        F.col("id").alias("entity_id"))
    term_store(many).repartitionByRange(16, "folded").sortWithinPartitions("folded").write.parquet(path)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == 16
    found = grid.find_entities(Store(spark, {"terms": spark.read.schema(SCHEMAS["terms"]).parquet(path)}), "NAME#000001", prefix=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(folded,name#000001)" in plan and "LessThan(folded,name#000002)" in plan
    assert found.count() == 100
