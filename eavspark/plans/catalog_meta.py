"""Registered queries: metadata rules, on metadata-shaped frames of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark.functions import encode as E
from eavspark.operators import quality
from eavspark.plans import metadata as M
from eavspark.plans import star
from eavspark.plans.menus import propagate
from eavspark.plans.registry import query
from eavspark.session import materialize
from eavspark.sources import layouts as L

# parts as items: group by brand number, every fifth static; type by size
_ITEMS = """items AS (
  SELECT p_partkey + 1 AS page_id, p_name AS name, p_size % 12 + 1 AS data_type,
         p_size % 4 AS sub_type, p_size % 13 AS display_length,
         CASE WHEN p_partkey % 5 = 0 THEN 0
              ELSE CAST(substr(p_brand, 7) AS INTEGER) END AS group_id,
         CAST(p_partkey % 100 AS INTEGER) AS date_item, p_size % 3 AS entity_type,
         'Date of ' || p_type || ' ' || p_name AS comment, p_size % 7 <> 0 AS installed,
         p_size % 11 = 0 AS calculated
  FROM part)"""


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return star.table(spark, sf_dir, "part").select(
        (key + 1).alias("page_id"), F.col("p_name").alias("name"),
        (size % 12 + 1).alias("data_type"), (size % 4).alias("sub_type"),
        (size % 13).alias("display_length"),
        F.when(key % 5 == 0, 0).otherwise(F.substring("p_brand", 7, 9).cast("int")).alias("group_id"),
        (key % 100).cast("int").alias("date_item"), (size % 3).alias("entity_type"),
        F.concat(F.lit("Date of "), "p_type", F.lit(" "), "p_name").alias("comment"),
        (size % 7 != 0).alias("installed"), (size % 11 == 0).alias("calculated"))


@query(f"""WITH {_ITEMS},
f AS (SELECT CASE WHEN group_id = 0 THEN -entity_type ELSE group_id END AS table_id,
             arg_min(name, page_id) AS name, arg_min(entity_type, page_id) AS entity_type,
             arg_min(date_item, page_id) AS date_item, arg_min(comment, page_id) AS comment
      FROM items WHERE installed AND data_type > 0 AND entity_type > 0 GROUP BY 1),
n AS (SELECT f.*, n_name AS screen, r_name AS owner, s_name AS grp,
             trim(regexp_replace(regexp_replace(comment, 'date of ', '', 'gi'), 'date', '', 'gi'))
               AS cleaned
      FROM f LEFT JOIN nation ON n_nationkey = table_id
      LEFT JOIN region ON r_regionkey = entity_type
      LEFT JOIN supplier ON s_suppkey = table_id AND s_suppkey % 2 = 0),
a AS (SELECT *, coalesce(screen, name) AS n0 FROM n),
b AS (SELECT *, CASE WHEN length(n0) < length(grp) THEN grp ELSE n0 END AS n1 FROM a),
c AS (SELECT *, CASE WHEN length(n1) < length(cleaned) THEN cleaned ELSE n1 END AS n2 FROM b)
SELECT CAST(table_id AS SMALLINT) AS id, CAST(entity_type AS SMALLINT) AS entity_type_id,
       CASE WHEN table_id > 0 THEN n2 ELSE coalesce(owner, name) END AS name,
       CAST(date_item AS SMALLINT) AS date_attribute_id FROM c""")
def tables_from_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = star.table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("page_id"), F.col("n_name").alias("name"))
    groups = star.table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(
        F.col("s_suppkey").alias("page_id"), F.col("s_name").alias("name"))
    region = star.table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("page_id"), F.col("r_name").alias("name"))
    return M.tables(items(spark, sf_dir), nation, groups, region)


@query(f"""WITH {_ITEMS},
valid AS (SELECT p_partkey + 1 AS page_id,
                 CASE WHEN p_size % 5 = 0 THEN 3 ELSE 0 END AS qualifier_type,
                 CASE WHEN p_size % 9 = 0 THEN 4 ELSE 0 END AS modifier_type,
                 p_size % 21 AS calc_quark, p_size % 6 AS code_type,
                 CAST(p_size AS DOUBLE) AS low, p_retailprice AS high
          FROM part WHERE p_partkey % 3 <> 0),
j AS (SELECT i.*, v.* EXCLUDE (page_id), v.page_id IS NOT NULL AS checked
      FROM items i LEFT JOIN valid v USING (page_id)),
k AS (SELECT *, checked AND NOT calculated AS used,
             checked AND NOT calculated AND data_type IN (5, 6)
               AND (qualifier_type > 0 OR modifier_type > 0) AS qualified FROM j)
SELECT page_id,
       CASE WHEN qualified THEN 7 WHEN data_type = 1 THEN 1 WHEN data_type BETWEEN 2 AND 6 THEN 2
            WHEN data_type IN (7, 12) THEN 3 WHEN data_type = 8 THEN 4 WHEN data_type = 9 THEN 8
            WHEN data_type = 10 THEN 6 ELSE 5 END AS data_type_id,
       CASE WHEN data_type = 8 THEN CASE WHEN display_length < 10 THEN 'dd.MM.yy'
                                         ELSE 'dd.MM.yyyy' END
            WHEN data_type = 9 THEN CASE WHEN display_length < 5 THEN 'hhmm' ELSE 'hh:mm' END
       END AS format,
       CASE WHEN calculated AND checked THEN calc_quark END AS quark,
       CASE WHEN used AND data_type BETWEEN 2 AND 6 THEN high
            WHEN used AND data_type = 7 THEN -low END AS max,
       CASE WHEN used AND data_type BETWEEN 2 AND 6 THEN low
            WHEN used AND data_type = 7 THEN -high END AS min,
       CASE WHEN qualified THEN greatest(qualifier_type, modifier_type)
            WHEN data_type = 7 THEN -1 WHEN used AND data_type = 12 THEN code_type
       END AS lookup_type_id
FROM k""")
def attributes_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    valid = star.table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").select(
        (F.col("p_partkey") + 1).alias("page_id"),
        F.when(size % 5 == 0, 3).otherwise(0).alias("qualifier_type"),
        F.when(size % 9 == 0, 4).otherwise(0).alias("modifier_type"),
        (size % 21).alias("calc_quark"), (size % 6).alias("code_type"),
        size.cast("double").alias("low"), F.col("p_retailprice").alias("high"))
    return M.typed_attributes(items(spark, sf_dir), valid).select(
        "page_id", "data_type_id", "format", "quark", "max", "min", "lookup_type_id")


@query("""SELECT s_nationkey AS index_def, min(s_suppkey) AS page_id,
       arg_min(s_name, s_suppkey) AS name FROM supplier GROUP BY 1""")
def first_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = star.table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("index_def"), F.col("s_suppkey").alias("page_id"),
        F.col("s_name").alias("name"))
    return M.first_keys(keys, "index_def", "page_id")


@query(f"""WITH {_ITEMS},
owner AS (SELECT page_id AS item_id, entity_type,
                 CASE WHEN group_id = 0 THEN -entity_type ELSE group_id END AS table_id
          FROM items),
shown AS (SELECT l_orderkey AS page_id, min_by(o, (l_linenumber, l_partkey)) AS o
          FROM (SELECT l_orderkey, l_linenumber, l_partkey, {{'t': table_id, 'e': entity_type}} AS o
                FROM lineitem JOIN owner ON item_id = l_partkey * 2 + 1) GROUP BY 1),
dated AS (SELECT o_orderkey AS page_id, {{'t': table_id, 'e': entity_type}} AS o
          FROM orders JOIN owner ON item_id = o_custkey * 3 + 1)
SELECT s.o_orderkey AS page_id, coalesce(d.o, h.o).t AS table_id, coalesce(d.o, h.o).e AS entity_type
FROM orders s LEFT JOIN dated d ON d.page_id = o_orderkey
LEFT JOIN shown h ON h.page_id = o_orderkey""")
def view_owner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as screens with line items as their items; many items do not exist."""
    orders = star.table(spark, sf_dir, "orders")
    screen_items = star.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("page_id"), F.struct("l_linenumber", "l_partkey").alias("pos"),
        (F.col("l_partkey") * 2 + 1).alias("item_id"))
    groups = orders.select(
        F.col("o_orderkey").alias("page_id"), (F.col("o_custkey") * 3 + 1).alias("date_item"))
    return M.view_owners(
        orders.select(F.col("o_orderkey").alias("page_id")), screen_items, groups,
        items(spark, sf_dir))


@query("""WITH p AS (SELECT l_orderkey AS view_id, l_partkey + 1 AS attribute_id,
                (l_linenumber, l_suppkey, l_extendedprice) AS pos, l_linenumber % 5 AS x,
                CAST(l_quantity AS INTEGER) % 9 AS y FROM lineitem),
f AS (SELECT view_id, attribute_id, min(pos) AS pos, arg_min(x, pos) AS x, arg_min(y, pos) AS y
      FROM p WHERE x > 0 AND y > 0 GROUP BY 1, 2)
SELECT view_id, attribute_id, x, y,
       row_number() OVER (PARTITION BY view_id ORDER BY pos) - 1 AS seq FROM f""")
def view_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as places on screens: the first of each item stays."""
    placed = star.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("view_id"), (F.col("l_partkey") + 1).alias("attribute_id"),
        F.struct("l_linenumber", "l_suppkey", "l_extendedprice").alias("pos"),
        (F.col("l_linenumber") % 5).alias("x"), (F.col("l_quantity").cast("int") % 9).alias("y"))
    return M.first_occurrences(placed)


@query("""WITH RECURSIVE m AS (
  SELECT p_partkey + 1 AS id, (p_partkey + 1) // 8 AS parent,
         CASE WHEN p_size % 10 = 0 OR p_partkey = 0 THEN p_size ELSE 0 END AS own,
         p_size % 10 = 5 AS changes FROM part),
r AS (SELECT id, own AS t FROM m WHERE own > 0
      UNION ALL SELECT m.id, r.t FROM r JOIN m ON m.parent = r.id
      WHERE m.own = 0 AND NOT m.changes)
SELECT m.id, CAST(coalesce(r.t, 0) AS INTEGER) AS entity_type_id FROM m LEFT JOIN r ON r.id = m.id""")
def menu_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as a tree of menus; some own a type, some links change the entity."""
    parts = star.table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("id"), F.floor((F.col("p_partkey") + 1) / 8).alias("parent"),
        F.when((F.col("p_size") % 10 == 0) | (F.col("p_partkey") == 0), F.col("p_size"))
        .otherwise(0).alias("entity_type_id"),
        (F.col("p_size") % 10 == 5).alias("changes"))
    edges = parts.where(~F.col("changes")).select(
        F.col("parent").alias("parent_id"), F.col("id").alias("child_id"))
    return propagate(parts.select("id", "entity_type_id"), edges)


@query("""SELECT l_orderkey + 1 AS entity_id, CAST(l_linenumber AS BIGINT) AS attribute_id,
       l_partkey + 1 AS seq, CAST(NULL AS BIGINT) AS page_id,
       'out_of_range' AS rule, CASE WHEN l_quantity < lo THEN 'below' ELSE 'above' END AS detail
FROM lineitem JOIN (SELECT l_linenumber AS n, floor(avg(l_quantity)) - 20 AS lo,
                           floor(avg(l_quantity)) + 20 AS hi FROM lineitem GROUP BY 1)
  ON n = l_linenumber WHERE l_quantity < lo OR l_quantity > hi""")
def range_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities outside a range that depends on the line number."""
    lines = star.table(spark, sf_dir, "lineitem")
    middle = F.floor(F.avg("l_quantity")).cast("double")
    ranges = lines.groupBy(F.col("l_linenumber").alias("id")).agg(
        (middle - 20).alias("min"), (middle + 20).alias("max"))
    numbers = lines.select(
        (F.col("l_orderkey") + 1).alias("entity_id"), F.col("l_linenumber").alias("attribute_id"),
        (F.col("l_partkey") + 1).alias("seq"), F.col("l_quantity").alias("value"))
    return quality.out_of_range(numbers, ranges)


@query("""SELECT -(s_suppkey + 1) AS id, CAST(-1 AS SMALLINT) AS lookup_type_id,
       s_name AS name, '' AS code FROM supplier
UNION ALL SELECT c_custkey + 1, CAST(c_nationkey AS SMALLINT), c_name,
       lpad(c_nationkey::VARCHAR, 5, '0') FROM customer""")
def dict_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as dictionary pages and customers as code pages, decoded and united."""
    dictionary = star.spread(star.table(spark, sf_dir, "supplier"), "s_suppkey").select(
        (F.col("s_suppkey") + 1).alias("page_id"),
        E.fields(64, (0, 64, E.fixed_text(F.col("s_name"), 64))).alias("bytes"))
    codes = star.spread(star.table(spark, sf_dir, "customer"), "c_custkey").select(
        (F.col("c_custkey") + 1).alias("page_id"),
        E.fields(
            96, (0, 80, E.fixed_text(F.col("c_name"), 80)),
            (80, 2, E.int_bytes(F.col("c_nationkey"), 2)),
            (84, 5, E.fixed_text(F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), 5)),
        ).alias("bytes"))
    # stored, so that fields are cut from bytes and not from the expressions that made them
    dictionary, codes = materialize(dictionary, "dict"), materialize(codes, "codes")
    return M.lookups(L.project(dictionary, "DICT"), L.project(codes, "CODES"))


@query("""SELECT p_partkey + 1 AS menu_id, b AS seq,
       CASE WHEN (p_size + b) % 3 = 0 THEN '' ELSE p_name END AS name, 'SCRN' AS function,
       p_size AS next_menu_id, b AS start_menu_id, p_size AS parameter1, -p_size AS parameter2,
       0 AS parameter3, 7 AS parameter4
FROM (SELECT *, unnest([0, 1, 2]) AS b FROM part) WHERE (p_size + b) % 3 <> 0""")
def menu_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as menu pages of three items; empty items count but do not show."""
    size = F.col("p_size")

    def block(b: int):
        name = F.when((size + b) % 3 == 0, "").otherwise(F.col("p_name"))
        return E.fields(
            32, (0, 12, E.fixed_text(name, 12)), (16, 4, E.fixed_text(F.lit("SCRN"), 4)),
            (20, 2, E.int_bytes(size, 2)), (22, 2, E.int_bytes(-size, 2)),
            (26, 2, E.int_bytes(F.lit(7), 2)), (28, 2, E.int_bytes(F.lit(b), 2)),
            (30, 2, E.int_bytes(size, 2)))

    pages = star.table(spark, sf_dir, "part").select(
        (F.col("p_partkey") + 1).alias("page_id"),
        F.concat(E.fixed_text(F.col("p_name"), 20), block(0), block(1), block(2)).alias("bytes"))
    return M.filled_items(L.project_blocks(pages, "MENU"))
