"""Registered queries: sync of snapshots and incremental selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark.buckets import read_buckets, sync_buckets, write_buckets
from eavspark.operators import routing
from eavspark.operators import sync as Y
from eavspark.plans import star
from eavspark.plans.catalog_grid import NUMBERED
from eavspark.plans.registry import query
from eavspark.schemas import VALUE_KEY
from eavspark.session import scratch_path
from eavspark.store import conform

# one tenth of the customers was processed; of their rows every fifth vanished, the
# others gained 1 where the row number is odd, and a new row came in
_STAGED = f"""WITH {NUMBERED},
t AS (SELECT entity_id, seq, o_totalprice AS value FROM numbered),
s AS (SELECT entity_id, seq, CASE WHEN seq % 2 = 1 THEN value + 1 ELSE value END AS value
      FROM t WHERE entity_id % 10 = 0 AND seq % 5 <> 0
      UNION ALL SELECT entity_id, 100000, 5.0 FROM t WHERE entity_id % 10 = 0 AND seq = 1),
merged AS (
  SELECT coalesce(t.entity_id, s.entity_id) AS entity_id, coalesce(t.seq, s.seq) AS seq,
         CASE WHEN t.entity_id IS NULL THEN 'insert'
              WHEN s.entity_id IS NULL AND t.entity_id % 10 = 0 THEN 'delete'
              WHEN s.entity_id IS NULL THEN 'keep'
              WHEN s.value IS DISTINCT FROM t.value THEN 'update' ELSE 'keep' END AS action,
         coalesce(s.value, t.value) AS value
  FROM t FULL OUTER JOIN s ON t.entity_id = s.entity_id AND t.seq = s.seq)"""


def _scoped(spark: SparkSession, sf_dir: str):
    """Stored order totals, what was staged, and the entities processed."""
    orders = star.numbered_orders(spark, sf_dir)
    target = conform(
        orders.select("entity_id", F.lit(star.TOTAL).alias("attribute_id"), "seq",
                      F.col("o_totalprice").alias("value")), "value_numbers")
    scope = star.table(spark, sf_dir, "customer").select(star.entity("c_custkey").alias("entity_id"))
    scope = scope.where("entity_id % 10 = 0")
    processed = routing.only_entities(target, scope)
    changed = processed.where("seq % 5 <> 0").withColumn(
        "value", F.when(F.col("seq") % 2 == 1, F.col("value") + 1).otherwise(F.col("value")))
    added = processed.where("seq = 1").withColumn("seq", F.lit(100000).cast("bigint")).withColumn(
        "value", F.lit(5.0))
    return target, changed.unionByName(added), scope


@query(_STAGED + """
SELECT entity_id, CAST(102 AS SMALLINT) AS attribute_id, seq, value FROM merged
WHERE action <> 'delete'""")
def sync_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored order totals after a tenth of the customers changed, bucket by bucket."""
    target, staged, scope = _scoped(spark, sf_dir)
    path = scratch_path(spark, "totals")
    write_buckets(target, path, "value_numbers")
    sync_buckets(spark, path, "value_numbers", staged, scope)
    return read_buckets(spark, path, "value_numbers")


@query(_STAGED + """
SELECT action, entity_id, CAST(102 AS SMALLINT) AS attribute_id, seq FROM merged
WHERE action <> 'keep'""")
def sync_change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, staged, scope = _scoped(spark, sf_dir)
    return Y.sync(target, staged, VALUE_KEY, scope).change_log


@query("""WITH t AS (SELECT c_custkey + 1 AS id, c_name AS name,
                CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS code
         FROM customer),
s AS (SELECT c_custkey + 1 AS id,
             CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS name,
             CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS code
      FROM customer WHERE c_custkey % 7 <> 0
      UNION ALL SELECT -(s_suppkey + 1), s_name, NULL FROM supplier)
SELECT coalesce(t.id, s.id) AS id,
       CASE WHEN t.id IS NULL THEN 'insert' WHEN s.id IS NULL THEN 'delete'
            WHEN s.name IS DISTINCT FROM t.name OR s.code IS DISTINCT FROM t.code THEN 'update'
            ELSE 'keep' END AS action,
       CASE WHEN s.id IS NULL THEN t.name ELSE s.name END AS name,
       CASE WHEN s.id IS NULL THEN t.code ELSE s.code END AS code
FROM t FULL OUTER JOIN s ON t.id = s.id""")
def sync_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unscoped sync: rows absent from staging go. NULLs count as values."""
    merged = _metadata(spark, sf_dir, null_safe=True).merged
    gone = F.col("action") == "delete"
    return merged.select(
        "id", "action", F.when(gone, F.col("old_name")).otherwise(F.col("new_name")).alias("name"),
        F.when(gone, F.col("old_code")).otherwise(F.col("new_code")).alias("code"))


@query("""WITH t AS (SELECT c_custkey + 1 AS id, c_name AS name,
                CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS code FROM customer),
s AS (SELECT c_custkey + 1 AS id,
             CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS name,
             CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS code
      FROM customer WHERE c_custkey % 7 <> 0
      UNION ALL SELECT -(s_suppkey + 1), s_name, NULL FROM supplier)
SELECT CASE WHEN t.id IS NULL THEN 'insert' WHEN s.id IS NULL THEN 'delete'
            WHEN coalesce(coalesce(t.name, '') <> s.name, false)
              OR coalesce(coalesce(t.code, '') <> s.code, false) THEN 'update'
            ELSE 'keep' END AS action, count(*) AS n
FROM t FULL OUTER JOIN s ON t.id = s.id GROUP BY 1""")
def sync_compatible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by action where a new NULL never overwrites."""
    return _metadata(spark, sf_dir, null_safe=False).counts()


def _metadata(spark: SparkSession, sf_dir: str, null_safe: bool) -> Y.Synced:
    customers = star.table(spark, sf_dir, "customer")
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    target = customers.select(
        star.entity("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.when(key % 4 != 0, segment).alias("code"))
    kept = customers.where(key % 7 != 0).select(
        star.entity("c_custkey").alias("id"),
        F.when(key % 3 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("name"),
        F.when(key % 5 != 0, segment).alias("code"))
    added = star.table(spark, sf_dir, "supplier").select(
        (-(F.col("s_suppkey") + 1)).alias("id"), F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("code"))
    return Y.sync(target, kept.unionByName(added), ["id"], null_safe=null_safe)


def _status(spark: SparkSession, sf_dir: str, which, name: str) -> DataFrame:
    return star.table(spark, sf_dir, "events").groupBy(
        star.entity("user_id").alias("entity_id")).agg(which("ts").alias(name))


@query("""WITH u AS (SELECT user_id, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1)
SELECT user_id + 1 AS entity_id, last AS updated FROM u
WHERE last > (SELECT max(first) FROM u)""")
def incremental_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with an event after the newest time known; known is the first of each."""
    known = _status(spark, sf_dir, F.min, "last_updated")
    return Y.updated_since(_status(spark, sf_dir, F.max, "updated"), known)


@query("""WITH u AS (SELECT user_id, min(ts) AS first, max(ts) AS last FROM events GROUP BY 1),
k AS (SELECT * FROM u WHERE user_id % 3 <> 0)
SELECT CASE WHEN k.user_id IS NULL THEN 'loaded'
            WHEN u.last > (SELECT max(first) FROM k) THEN 'updated' ELSE 'skipped' END AS status,
       count(*) AS n
FROM u LEFT JOIN k USING (user_id) GROUP BY 1""")
def load_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = _status(spark, sf_dir, F.min, "last_updated").where("(entity_id - 1) % 3 <> 0")
    return Y.load_statistics(
        _status(spark, sf_dir, F.max, "updated"), known.withColumnRenamed("entity_id", "id"))


@query("""SELECT max(o_orderdate) AS latest, max(o_custkey + 1) AS max_id,
       count(DISTINCT o_custkey) AS n_entities FROM orders""")
def high_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    entities = star.table(spark, sf_dir, "orders").groupBy(
        star.entity("o_custkey").alias("id")).agg(F.max("o_orderdate").alias("last_updated"))
    return Y.high_water(entities)
