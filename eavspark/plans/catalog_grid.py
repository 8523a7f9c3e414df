"""Registered queries: grids, views, terms and cohort reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark.operators import grid, routing
from eavspark.plans import entities as P
from eavspark.plans import star
from eavspark.plans.entities import term_store
from eavspark.plans.registry import query
from eavspark.schemas import SCHEMAS
from eavspark.session import scratch_path
from eavspark.store import Store, conform, write_table

# orders with entity and row number, newest first
NUMBERED = """numbered AS (
  SELECT o_custkey + 1 AS entity_id,
         row_number() OVER (PARTITION BY o_custkey
              ORDER BY o_orderdate DESC, o_orderkey DESC) AS seq, o.*
  FROM orders o)"""


def plain(x: str) -> str:
    """SQL for a number as plain digits."""
    return rf"regexp_replace(CAST(CAST({x} AS DECIMAL(28,6)) AS VARCHAR), '\.?0+$', '')"


@query(f"""WITH {NUMBERED}
SELECT entity_id, seq, strftime(o_orderdate, '%d.%m.%Y') AS order_date,
       {plain('o_totalprice')} AS total, o_orderstatus AS status,
       o_orderpriority AS priority, CAST(o_orderkey AS VARCHAR) AS order_key
FROM numbered""")
def table_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the order table of every customer as a grid."""
    return grid.table_values_crosstab(star.store(spark, sf_dir, static=False), star.ORDERS)


@query(f"""WITH {NUMBERED}
SELECT entity_id, seq, o_orderpriority AS priority,
       strftime(o_orderdate, '%d.%m.%Y') AS order_date, {plain('o_totalprice')} AS total
FROM numbered WHERE seq BETWEEN 2 AND 6""")
def view_crosstab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five rows from the second on, columns as on the view."""
    return grid.view_values_crosstab(
        star.store(spark, sf_dir, static=False), star.ORDER_VIEW, start_row=2, rows=5)


@query(f"""SELECT c_custkey + 1 AS entity_id, c_name AS name, n_name AS nation,
       c_mktsegment AS segment, {plain('c_acctbal')} AS balance
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def cohort_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.cohort_grid(
        star.store(spark, sf_dir, orders=False), [star.NAME, star.NATION, star.SEGMENT, star.BALANCE])


_LONG = f"""WITH {NUMBERED}, cells AS (
  SELECT entity_id, seq, CAST(o_orderdate AS DATE) AS key_date,
         unnest([101, 102, 103, 104, 105]) AS attribute_id,
         unnest(['order_date', 'total', 'status', 'priority', 'order_key']) AS name,
         unnest([strftime(o_orderdate, '%d.%m.%Y'), {plain('o_totalprice')}, o_orderstatus,
                 o_orderpriority, CAST(o_orderkey AS VARCHAR)]) AS display_value
  FROM numbered)"""


@query(_LONG + """
SELECT entity_id, seq, key_date, CAST(attribute_id AS SMALLINT) AS attribute_id, name,
       display_value FROM cells""")
def table_values_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.table_values(star.store(spark, sf_dir, static=False), star.ORDERS)


@query(_LONG + """
SELECT entity_id, seq, key_date,
       CAST(CASE attribute_id WHEN 104 THEN 0 WHEN 101 THEN 1 ELSE 2 END AS SMALLINT) AS view_seq,
       CAST(CASE attribute_id WHEN 104 THEN 1 WHEN 101 THEN 20 ELSE 40 END AS SMALLINT) AS x,
       CAST(3 AS SMALLINT) AS y, CAST(attribute_id AS SMALLINT) AS attribute_id, name,
       display_value
FROM cells WHERE attribute_id IN (101, 102, 104) AND seq BETWEEN 4 AND 6""")
def view_values_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second page of a view that shows three rows."""
    return grid.view_values(star.store(spark, sf_dir, static=False), star.ORDER_VIEW, page=2)


@query(f"""SELECT c_custkey + 1 AS entity_id,
       c_name || ' ' || n_name || ' ' || {plain('c_acctbal')} AS id_line
FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def id_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.id_line(star.store(spark, sf_dir, orders=False), star.CUSTOMER)


@query(f"""WITH {NUMBERED}
SELECT entity_id, seq, CAST(o_orderdate AS DATE) AS key_date, o_totalprice AS value
FROM numbered""")
def keydate_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.key_date_series(star.store(spark, sf_dir, static=False), star.TOTAL, star.ORDER_DATE)


def url_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = star.table(spark, sf_dir, "customer").select(
        F.lit(1).alias("index_type_id"), F.col("c_name").alias("term"),
        star.entity("c_custkey").alias("entity_id"))
    urls = star.table(spark, sf_dir, "pages").select(
        F.lit(2).alias("index_type_id"), F.col("url").alias("term"),
        star.entity("page_id").alias("entity_id"))
    return conform(names.unionByName(urls), "indexes")


_TERMS = """terms AS (
  SELECT CAST(1 AS SMALLINT) AS index_type_id, c_name AS term,
         c_custkey + 1 AS entity_id FROM customer
  UNION ALL SELECT CAST(2 AS SMALLINT), url, page_id + 1 FROM pages)"""


@query(f"""WITH {_TERMS}
SELECT DISTINCT * FROM terms WHERE starts_with(lower(term), 'http://th')""")
def term_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search by prefix over names and addresses, without regard to case."""
    return grid.find_entities(_term_store(spark, sf_dir), "HTTP://Th", prefix=True)


def _term_store(spark: SparkSession, sf_dir: str) -> Store:
    """The terms, stored in the order they are searched by."""
    path = scratch_path(spark, "terms")
    write_table(term_store(url_terms(spark, sf_dir)), path, "terms")
    return Store(spark, {"terms": spark.read.schema(SCHEMAS["terms"]).parquet(path)})


@query(f"""WITH {_TERMS}
SELECT DISTINCT * FROM terms WHERE lower(term) = 'customer#000000042' AND index_type_id = 1""")
def term_search_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.find_entities(_term_store(spark, sf_dir), "CUSTOMER#000000042", index_type_id=1)


@query("""SELECT c_custkey + 1 AS id, CAST(1 AS SMALLINT) AS entity_type_id,
       min(t) AS name, max(o_orderdate) AS last_updated
FROM (SELECT c_custkey, unnest([c_name, c_mktsegment || ' ' || c_name]) AS t FROM customer)
LEFT JOIN (SELECT o_custkey, max(o_orderdate) AS o_orderdate FROM orders GROUP BY 1)
  ON o_custkey = c_custkey
WHERE o_orderdate IS NOT NULL GROUP BY c_custkey""")
def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with orders, named by the least of their two index terms."""
    customers = star.table(spark, sf_dir, "customer")
    terms = customers.select(
        F.lit(1).cast("smallint").alias("index_type_id"), star.entity("c_custkey").alias("entity_id"),
        F.explode(F.array("c_name", F.concat_ws(" ", "c_mktsegment", "c_name"))).alias("term"))
    updated = star.table(spark, sf_dir, "orders").groupBy(
        star.entity("o_custkey").alias("entity_id")
    ).agg(F.max("o_orderdate").alias("updated"))
    existing = updated.join(
        customers.select(star.entity("c_custkey").alias("entity_id")), "entity_id", "left_semi")
    meta = Store(spark, star.metadata(spark))
    return P.name_entities(existing, terms, meta["entity_types"], meta["attributes"])


@query("""WITH terms AS (
  SELECT lower(c_name) AS k, min(c_custkey + 1) AS id FROM customer GROUP BY 1)
SELECT o_orderkey AS order_key, upper(c) AS term, id AS linked_entity_id
FROM (SELECT o_orderkey, 'Customer#' || lpad(CAST(o_custkey * 2 AS VARCHAR), 9, '0') AS c
      FROM orders) LEFT JOIN terms ON k = lower(c)""")
def resolve_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys in another case to entities; about half of them name none."""
    keys = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.lit(star.CUSTOMER).alias("linked_type"),
        F.upper(F.concat(F.lit("Customer#"), F.lpad((F.col("o_custkey") * 2).cast("string"), 9, "0")))
        .alias("term"))
    terms = routing.first_terms(
        star.table(spark, sf_dir, "customer").select(
            F.lit(star.CUSTOMER).alias("linked_type"), F.col("c_name").alias("term"),
            star.entity("c_custkey").alias("entity_id"), F.col("c_custkey").alias("at")))
    return routing.resolve_keys(keys, terms).drop("linked_type")


@query("""SELECT CAST(1 AS SMALLINT) AS index_type_id,
       event_type AS term, user_id + 1 AS entity_id
FROM (SELECT *, lag(user_id) OVER (ORDER BY ts, event_id) AS before FROM events)
WHERE before IS DISTINCT FROM user_id GROUP BY 1, 2, 3""")
def index_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in time order as one index chain: runs of a user keep their first."""
    events = star.table(spark, sf_dir, "events").select(
        F.lit(1).alias("index_type_id"), F.col("ts").alias("chain_pos"), F.col("event_id").alias("pos"),
        F.col("event_type").alias("term"), star.entity("user_id").alias("entity_id"))
    return P.indexes(events)
