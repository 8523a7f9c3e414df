"""The star-schema tables in entity-attribute-value form, and as page bytes.

Entity type 1 is the customer (entity id = customer key + 1, as id 0 means none):
static attributes in table -1, orders as key-dated rows, newest first, in table 100.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark import schemas as S
from eavspark.functions import encode as E
from eavspark.operators import routing as R
from eavspark.operators.ordered import Ordered, match, row_number
from eavspark.session import literal, materialize
from eavspark.store import Store, conform

CUSTOMER, STATIC, ORDERS = 1, -1, 100
NAME, BALANCE, SEGMENT, NATION = 1, 2, 3, 4
ORDER_DATE, TOTAL, STATUS, PRIORITY, ORDER_KEY = 101, 102, 103, 104, 105

BANNER_VIEW, ORDER_VIEW = 1, 2

# id, logical type, table, name, format
ATTRIBUTES = [
    (NAME, S.TEXT, STATIC, "name", None),
    (BALANCE, S.NUMERIC, STATIC, "balance", None),
    (SEGMENT, S.LOOKUP, STATIC, "segment", None),
    (NATION, S.LOOKUP, STATIC, "nation", None),
    (ORDER_DATE, S.DATE, ORDERS, "order_date", "dd.MM.yyyy"),
    (TOTAL, S.NUMERIC, ORDERS, "total", None),
    (STATUS, S.LOOKUP, ORDERS, "status", None),
    (PRIORITY, S.TEXT, ORDERS, "priority", None),
    (ORDER_KEY, S.TEXT, ORDERS, "order_key", None),
]

# view, attribute, x, y in view order
VIEW_ATTRIBUTES = [
    (BANNER_VIEW, NAME, 1, 1), (BANNER_VIEW, NATION, 30, 1), (BANNER_VIEW, BALANCE, 50, 1),
    (ORDER_VIEW, PRIORITY, 1, 3), (ORDER_VIEW, ORDER_DATE, 20, 3), (ORDER_VIEW, TOTAL, 40, 3),
]

# source types for the byte form: attribute, source type, sub type, qualified
FIELDS = [
    (NAME, R.STRING, 0, False), (BALANCE, R.FLOAT64, 2, False), (SEGMENT, R.DICT, 0, False),
    (NATION, R.CODE, 0, False), (ORDER_DATE, R.DATE, 0, False), (TOTAL, R.FLOAT64, 2, True),
    (STATUS, R.DICT, 0, False), (PRIORITY, R.STRING, 0, False), (ORDER_KEY, R.INT32, 0, False),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt over the cluster, before much is computed of each: a table in one file
    of one row group is read by one task, whatever its size."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key)


def entity(key: str) -> Column:
    return F.col(key) + 1


def numbered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with ``entity_id`` and ``seq``, newest first; stored, as all value
    tables of the group read it."""
    orders = table(spark, sf_dir, "orders")
    numbered = row_number(
        orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "seq", descending=True
    )
    return materialize(numbered.withColumn("entity_id", entity("o_custkey")), "orders")


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(kind, name, code)``: dictionary codes of segments and order states."""
    segments = table(spark, sf_dir, "customer").select(
        F.lit("segment").alias("kind"), F.col("c_mktsegment").alias("name"))
    states = table(spark, sf_dir, "orders").select(
        F.lit("status").alias("kind"), F.col("o_orderstatus").alias("name"))
    names = segments.distinct().unionByName(states.distinct())
    return materialize(row_number(names, [], ["kind", "name"], "code"), "dictionary")


def coded(df: DataFrame, codes: DataFrame, kind: str, column: str) -> DataFrame:
    names = codes.where(F.col("kind") == kind).select(F.col("name").alias(column), "code")
    return df.join(names, column)


def metadata(spark: SparkSession) -> dict[str, Callable[[], DataFrame]]:
    """Metadata tables, each made when first used."""
    places, counts = [], {}
    for view, attribute, x, y in VIEW_ATTRIBUTES:
        places.append((view, counts.setdefault(view, 0), attribute, x, y))
        counts[view] += 1
    none = [F.lit(None).alias(c) for c in
            ("comment", "quark", "display_length", "max", "min", "lookup_type_id")]
    relations = {
        "attributes": (
            [(i, t, CUSTOMER, g, n, f) for i, t, g, n, f in ATTRIBUTES],
            "id int, data_type_id int, entity_type_id int, table_id int, name string, "
            "format string", none),
        "tables": (
            [(STATIC, CUSTOMER, "Customer", 0), (ORDERS, CUSTOMER, "Orders", ORDER_DATE)],
            "id int, entity_type_id int, name string, date_attribute_id int", []),
        "views": (
            [(BANNER_VIEW, "Banner", 1, 3, STATIC, CUSTOMER),
             (ORDER_VIEW, "Orders", 3, 3, ORDERS, CUSTOMER)],
            "id int, name string, n_rows int, n_items int, table_id int, entity_type_id int", []),
        "view_attributes": (
            places, "view_id int, seq int, attribute_id int, x int, y int", []),
        "entity_types": (
            [(CUSTOMER, 1, 1, "Customer", BANNER_VIEW, NAME)],
            "id int, key_index_type_id int, default_index_type_id int, name string, "
            "id_line_view_id int, id_attribute_id int", []),
    }

    def make(name: str) -> Callable[[], DataFrame]:
        rows, schema, more = relations[name]
        return lambda: conform(literal(spark, rows, schema).select("*", *more), name)

    return {name: make(name) for name in relations}


def lookups(spark: SparkSession, sf_dir: str, codes: DataFrame) -> DataFrame:
    codes = codes.select(
        (-F.col("code")).alias("id"), F.lit(-1).alias("lookup_type_id"), "name",
        F.lit("").alias("code"))
    nations = table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).alias("id"), F.lit(1).alias("lookup_type_id"),
        F.col("n_name").alias("name"), F.lit("").alias("code"))
    return conform(codes.unionByName(nations), "lookups")


def _rows(df: DataFrame, seq: Column, value: str, *attributes: tuple[int, Column]) -> DataFrame:
    """One output row per attribute, from a single pass over ``df``."""
    if len(attributes) == 1:
        number, cell = attributes[0]
        return df.select(
            "entity_id", F.lit(number).cast("smallint").alias("attribute_id"), seq.alias("seq"),
            cell.alias(value))
    cells = F.array(*[
        F.struct(F.lit(i).cast("smallint").alias("attribute_id"), c.alias(value))
        for i, c in attributes
    ])
    return df.select("entity_id", seq.alias("seq"), F.explode(cells).alias("c")).select(
        "entity_id", "c.attribute_id", "seq", f"c.{value}"
    )


def store(
    spark: SparkSession, sf_dir: str, *, static: bool = True, orders: bool = True
) -> Store:
    """Value tables and metadata of customers (``static``) and their ``orders``."""
    customers = table(spark, sf_dir, "customer").withColumn("entity_id", entity("c_custkey"))
    one, seq = F.lit(1), F.col("seq")

    @cache
    def codes() -> DataFrame:
        return dictionary(spark, sf_dir)

    @cache
    def rows() -> DataFrame:
        return numbered_orders(spark, sf_dir)

    def both(name: str, fixed: Callable, dated: Callable) -> Callable[[], DataFrame]:
        parts = [fixed] * static + [dated] * orders
        return lambda: reduce(DataFrame.unionByName, [conform(p(), name) for p in parts])

    tables = {
        "value_texts": both(
            "value_texts",
            lambda: _rows(customers, one, "value", (NAME, F.col("c_name"))),
            lambda: _rows(rows(), seq, "value", (PRIORITY, F.col("o_orderpriority")),
                          (ORDER_KEY, F.col("o_orderkey").cast("string"))),
        ),
        "value_numbers": both(
            "value_numbers",
            lambda: _rows(customers, one, "value", (BALANCE, F.col("c_acctbal"))),
            lambda: _rows(rows(), seq, "value", (TOTAL, F.col("o_totalprice"))),
        ),
        "value_lookups": both(
            "value_lookups",
            lambda: _rows(
                coded(customers, codes(), "segment", "c_mktsegment"), one, "lookup_id",
                (SEGMENT, -F.col("code")), (NATION, F.col("c_nationkey") + 1)),
            lambda: _rows(coded(rows(), codes(), "status", "o_orderstatus"), seq, "lookup_id",
                          (STATUS, -F.col("code"))),
        ),
        "lookups": lambda: lookups(spark, sf_dir, codes()),
        "indexes": lambda: conform(
            customers.select(F.lit(1).alias("index_type_id"), F.col("c_name").alias("term"),
                             "entity_id"), "indexes"),
    }
    if orders:
        tables["value_dates"] = lambda: conform(
            _rows(rows(), seq, "value", (ORDER_DATE, F.to_date("o_orderdate"))), "value_dates")
    return Store(spark, {**metadata(spark), **tables})


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(entity_id, _n)``: values per customer, from the orders alone."""
    return table(spark, sf_dir, "orders").groupBy(entity("o_custkey").alias("entity_id")).agg(
        (F.count(F.lit(1)) * 5 + 4).alias("_n"))


def order_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(entity_id, item_id, seq, v)``: customers and orders as raw value bytes.

    A total of a closed order (status F) carries a code behind the number."""
    customers = spread(table(spark, sf_dir, "customer"), "c_custkey").withColumn("entity_id", entity("c_custkey"))
    orders = numbered_orders(spark, sf_dir)
    codes = dictionary(spark, sf_dir)
    segments = coded(customers, codes, "segment", "c_mktsegment")
    states = coded(orders, codes, "status", "o_orderstatus")
    total = E.f64_bytes(F.col("o_totalprice"))
    total = F.when(
        F.col("o_orderstatus") == "F",
        F.concat(total, E.int_bytes(F.lit(2), 2), F.lit(bytes(2)), E.int_bytes(F.lit(9), 4)),
    ).otherwise(total)
    static = _rows(
        segments, F.lit(1), "v", (NAME, E.text_bytes(F.col("c_name"))),
        (BALANCE, E.f64_bytes(F.col("c_acctbal"))), (SEGMENT, E.int_bytes(F.col("code"), 2, signed=False)),
        (NATION, E.int_bytes(F.col("c_nationkey") + 1, 4)),
    )
    dated = _rows(
        states, F.col("seq"), "v",
        (ORDER_DATE, E.date_bytes(F.col("o_orderdate"))), (TOTAL, total),
        (STATUS, E.int_bytes(F.col("code"), 2, signed=False)),
        (PRIORITY, E.text_bytes(F.col("o_orderpriority"))),
        (ORDER_KEY, E.int_bytes(F.col("o_orderkey"), 4)),
    )
    numeric = F.col("attribute_id").isin(BALANCE, TOTAL, ORDER_KEY)
    # trailing zeros are not stored; a first byte always is
    short = E.trim_zeros(F.col("v"))
    v = F.when(numeric & (F.length(short) == 0), F.lit(b"\0")).when(numeric, short).otherwise(
        F.col("v"))
    return static.unionByName(dated).select(
        "entity_id", F.col("attribute_id").cast("int").alias("item_id"), "seq", v.alias("v")
    )


def fields(spark: SparkSession) -> DataFrame:
    return literal(
        spark, FIELDS, "attribute_id int, data_type int, sub_type int, qualified boolean"
    )


def pack(
    rows: DataFrame, keys: list[str], order: list[str], block: Column, per_page: int,
    sizes: DataFrame | None = None, **aggs: Column,
) -> DataFrame:
    """Blocks of each group on pages of ``per_page``: ``keys, page_no, body, aggs``.

    The page number comes from a row number, so a group on a page is bounded.
    ``sizes`` may say cheaply how many rows (``_n``) each group has."""
    numbered = row_number(rows, keys, order, "_at", sizes=sizes)
    return numbered.withColumn("_at", F.col("_at") - 1).withColumn("_block", block).groupBy(
        *keys, F.floor(F.col("_at") / per_page).cast("int").alias("page_no")
    ).agg(
        F.array_sort(F.collect_list(F.struct("_at", "_block"))).alias("_b"),
        *[c.alias(n) for n, c in aggs.items()],
    ).withColumn("body", E.join_blocks(F.col("_b._block"))).drop("_b")


def number_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Give pages dense ids in key order; ``next_id`` is the next page of the group.

    The numbers ``page_no`` of a group are dense, so its count of pages places all of
    them: only counts are put in order, never pages."""
    pages = materialize(pages, "pages")
    counts = pages.groupBy(*keys).agg(F.count(F.lit(1)).alias("_pages"))
    placed = Ordered(counts, [], keys).running_sum(F.col("_pages"), "_upto").rows()
    numbered = match(pages, materialize(placed, "placed-groups"), keys, "left").withColumn(
        "page_id", (F.col("_upto") - F.col("_pages") + F.col("page_no") + 1).cast("bigint"))
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    more = known & (F.col("page_no") + 1 < F.col("_pages"))
    return numbered.withColumn("next_id", F.when(more, F.col("page_id") + 1).otherwise(0)).drop("_pages", "_upto")


def data_pages(blocks: DataFrame, page_length: int = 1024) -> DataFrame:
    """``(page_id, bytes, entity_id, page_no)``: value pages of packed blocks.

    ``blocks`` is the output of :func:`number_pages` with entity_id, high, body."""
    used = F.length("body") + 16
    return blocks.select(
        "page_id",
        E.fields(
            page_length, (0, 4, E.int_bytes(F.col("next_id"), 4)),
            (6, 2, E.int_bytes(page_length - used, 2)),
            (8, 4, E.int_bytes(F.col("entity_id"), 4)), (12, 2, E.int_bytes(F.col("high"), 2)),
            (16, page_length - 16, F.col("body")),
        ).alias("bytes"),
        "entity_id", "page_no",
    )
