"""Steps whose time or memory must not grow in one task."""

import re

import duckdb
from pyspark.sql import functions as F

from eavspark import buckets
from eavspark.operators.ordered import Ordered
from eavspark.plans import catalog_kinds, star, values
from eavspark.plans.catalog import ORACLES, QUERIES
from eavspark.plans.catalog_pages import value_system
from eavspark.sources import layouts as L
from eavspark.sources import paged


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def parts(spark, path, keys):
    spark.createDataFrame(
        [(k, f"part {k}", "Brand#1", "type", 5, 1.0) for k in keys],
        "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    ).coalesce(1).write.parquet(f"{path}/part.parquet")


def test_menus_lead_beyond_the_ids_there_can_be(spark, tmp_path):
    keys = [*range(40), *range(16_380, 16_400), 32_766]
    spark.createDataFrame([(k, f"supplier {k}", k % 25) for k in keys], "s_suppkey long, s_name string, s_nationkey int").write.parquet(
        f"{tmp_path}/supplier.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW supplier AS SELECT * FROM '{tmp_path}/supplier.parquet/*.parquet'")
    found = QUERIES["menus_owned"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted(con.execute(ORACLES["menus_owned"]).fetchall())


def test_buckets_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(64).select(
        (F.col("id") * (1 << buckets.BUCKET_BITS)).alias("entity_id"), F.lit(1).cast("smallint").alias("attribute_id"),
        F.lit(1).cast("long").alias("seq"), F.lit("x").alias("value"))
    assert buckets.write_buckets(rows, f"{tmp_path}/t", "value_texts") == 64
    tasks = {re.search(r"part-(\d+)", f)[1] for f in map(str, (tmp_path / "t").rglob("*.parquet"))}
    assert len(tasks) > 4
    long = spark.range(200_000).select(
        F.lit(1).cast("long").alias("entity_id"), F.lit(1).cast("smallint").alias("attribute_id"), F.col("id").alias("seq"), F.lit("x").alias("value"))
    buckets.write_buckets(long, f"{tmp_path}/long", "value_texts")
    assert len(list((tmp_path / "long").rglob("*.parquet"))) > 1  # one series, several tasks
    assert buckets.read_buckets(spark, f"{tmp_path}/long", "value_texts").count() == 200_000


def test_codes_are_cut_from_stored_pages(spark, sf_dir):
    assert "unhex" not in plan(QUERIES["dict_codes"](spark, sf_dir))


def test_kinds_are_encoded_by_many_tasks(spark, tmp_path, sf_dir):
    parts(spark, tmp_path, [*range(60), 7, 7, None])
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name")
    customer.unionByName(customer.where("c_custkey = 7")).write.parquet(f"{tmp_path}/customer.parquet")
    assert catalog_kinds._note_pages(spark, str(tmp_path)).rdd.getNumPartitions() > 1
    counted = catalog_kinds._raw(spark, str(tmp_path)).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    assert sorted(map(str, map(tuple, counted.collect()))) == sorted(
        map(str, map(tuple, catalog_kinds._raw_counts(spark, str(tmp_path)).collect())))


def test_pages_are_numbered_without_ordering_their_bytes(spark, monkeypatch):
    seen = []

    class Watched(Ordered):
        def __init__(self, df, *args, **options):
            seen.extend(df.columns)
            super().__init__(df, *args, **options)

    monkeypatch.setattr(star, "Ordered", Watched)
    pages = spark.createDataFrame(
        [(5, 0, b"e"), (5, 1, b"f"), (2, 0, b"c"), (None, 1, b"b"), (None, 0, b"a"), (9, 0, b"g"), (2, 1, b"d")],
        "entity_id long, page_no int, body binary")
    found = star.number_pages(pages, ["entity_id"]).orderBy("page_id").select("page_id", "entity_id", "next_id", "body").collect()
    assert "body" not in seen
    assert [(r.page_id, r.next_id, bytes(r.body)) for r in found] == [
        (1, 0, b"a"), (2, 0, b"b"), (3, 4, b"c"), (4, 0, b"d"), (5, 6, b"e"), (6, 0, b"f"), (7, 0, b"g")]


def test_window_tasks_follow_the_pages(spark):
    assert values._window_tasks(spark.range(100)) == 1
    assert values._window_tasks(spark.range(1_000_000)) == 62


def test_status_is_read_from_stored_pages(spark, sf_dir):
    system = value_system(spark, sf_dir)
    assert "unhex" not in plan(L.entity_status(system.pages("PATSTS")))
    assert "unhex" not in plan(values.existing_entities(system))


def test_parts_of_short_pages_are_bounded_in_pages():
    assert paged.pages_per_part(32) <= 1 << 20
    assert paged.pages_per_part(1024) * 1024 <= 64 << 20
