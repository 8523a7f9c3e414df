"""Registered queries: bytes, blocks, chains, long texts and whole loads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark.functions import decode as D
from eavspark.functions import encode as E
from eavspark.operators import blocks as B
from eavspark.operators import chains as C
from eavspark.operators import quality, routing
from eavspark.operators.ordered import Ordered, match
from eavspark.plans import entities as P
from eavspark.plans import metadata as M
from eavspark.plans import star, values
from eavspark.plans.catalog_grid import NUMBERED
from eavspark.plans.registry import query
from eavspark.session import materialize, scratch_path
from eavspark.sources import layouts as L
from eavspark.sources import paged

# ---------------------------------------------------------------- fields


@query("""SELECT o_orderkey AS order_key, o_orderkey % 200 AS u8,
       o_orderkey % 200 - 100 AS i8, o_custkey % 65536 AS u16, o_custkey % 65536 - 32768 AS i16,
       o_orderkey AS u32, -o_orderkey AS i32, o_orderkey AS little
FROM orders""")
def decode_ints(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey") % 65536
    raw = star.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.concat(
            E.int_bytes(key % 200, 1, signed=False), E.int_bytes(key % 200 - 100, 1),
            E.int_bytes(cust, 2, signed=False), E.int_bytes(cust - 32768, 2),
            E.int_bytes(key, 4, signed=False), E.int_bytes(-key, 4),
            F.unhex(F.concat(*[
                F.substring(F.hex(E.int_bytes(key, 4, signed=False)), i, 2) for i in (7, 5, 3, 1)])),
        ).alias("b"))
    b = F.col("b")
    return raw.select(
        F.col("o_orderkey").alias("order_key"), D.u8(b, 0).alias("u8"), D.i8(b, 1).alias("i8"),
        D.u16(b, 2).alias("u16"), D.i16(b, 4).alias("i16"), D.u32(b, 6).alias("u32"),
        D.i32(b, 10).alias("i32"), D.u32(b, 14, "little").alias("little"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_extendedprice AS double,
       CAST(CAST(l_extendedprice AS FLOAT) AS DOUBLE) AS single,
       CAST(CAST(-l_extendedprice AS FLOAT) AS DOUBLE) AS narrowed, l_quantity AS short
FROM lineitem""")
def decode_floats(spark: SparkSession, sf_dir: str) -> DataFrame:
    price, quantity = F.col("l_extendedprice"), F.col("l_quantity")
    lines = star.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        E.f64_bytes(price).alias("b64"), E.f32_bytes(price).alias("b32"),
        E.f64_bytes(-price).alias("n64"), E.trim_zeros(E.f64_bytes(quantity)).alias("short"))
    return lines.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        D.f64(F.col("b64")).alias("double"), D.f32(F.col("b32")).alias("single"),
        D.f64(F.col("n64"), single=True).alias("narrowed"),
        D.f64(D.rpad_bytes(F.col("short"), 8)).alias("short"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, CAST(l_shipdate AS DATE) AS ship_date,
       l_shipdate + to_milliseconds(l_partkey * 1001) AS updated
FROM lineitem""")
def decode_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = E.date_bytes(F.col("l_shipdate"))
    millis = E.int_bytes(F.col("l_partkey") * 1001 % 86_400_000, 4, signed=False)
    extra = F.floor(F.col("l_partkey") * 1001 / 86_400_000)
    rows = star.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", days.alias("d"),
        E.date_bytes(F.date_add(F.to_date("l_shipdate"), extra.cast("int"))).alias("du"),
        millis.alias("m"))
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_suppkey",
        D.legacy_date(D.uint(F.col("d"))).alias("ship_date"),
        D.legacy_timestamp(D.uint(F.col("du")), D.uint(F.col("m"))).alias("updated"))


@query("""SELECT event_id, CASE WHEN event_id % 10 < 3 THEN NULL
              ELSE CAST(hour(ts) * 3600 + minute(ts) * 60 AS INTEGER) END AS seconds,
       CASE event_id % 10 WHEN 0 THEN 'PRE' WHEN 1 THEN 'POST' END AS word,
       event_id % 10 = 2 AS midnight
FROM events""")
def decode_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times of events; some are codes. A coded midnight counts as its own column."""
    millis = (F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")) * 1000
    code = (
        F.when(F.col("event_id") % 10 == 0, D.TIME_PRE)
        .when(F.col("event_id") % 10 == 1, D.TIME_POST)
        .when(F.col("event_id") % 10 == 2, D.TIME_MIDNIGHT).otherwise(millis))
    raw = star.table(spark, sf_dir, "events").select(
        "event_id", E.trim_zeros(E.int_bytes(code, 4, signed=False)).alias("v"))
    clock = D.uint(D.rpad_bytes(F.col("v"), 4))
    midnight = clock == D.TIME_MIDNIGHT
    return raw.select(
        "event_id", F.when(~midnight, D.time_seconds(clock)).alias("seconds"),
        D.time_text(clock).alias("word"), midnight.alias("midnight"))


@query(r"""SELECT p_partkey AS part_key, p_name AS name,
       regexp_replace('é' || p_type || 'ü', '[^\x00-\x7f]', '?', 'g') AS type,
       'é' || p_type || 'ü' AS latin
FROM part""")
def decode_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    accented = F.concat(F.lit("é"), "p_type", F.lit("ü"))
    raw = star.table(spark, sf_dir, "part").select(
        "p_partkey", F.concat(E.fixed_text(F.col("p_name"), 60), E.fixed_text(accented, 30)).alias("b"))
    b = F.col("b")
    return raw.select(
        F.col("p_partkey").alias("part_key"), D.ascii_trim(b, 0, 60).alias("name"),
        D.ascii_trim(b, 60, 30).alias("type"), D.ascii_trim(b, 60, 30, "latin-1").alias("latin"))


@query("""SELECT doc_id, regexp_replace(text, '[^\\x00-\\x7f]', '?', 'g') AS text FROM documents""")
def decode_long_ascii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents through single-byte text and back: what is no ASCII reads ?."""
    return star.table(spark, sf_dir, "documents").select(
        "doc_id", D.text(E.text_bytes(F.col("text"))).alias("text"))


# line items as raw numbers with a code behind some: kind 1 replaces the number
_QUALIFIED = """q AS (SELECT l_orderkey + 1 AS entity_id, l_partkey + 1 AS attribute_id,
         l_suppkey * 10 + l_linenumber AS seq, l_extendedprice AS price, l_returnflag AS f
  FROM lineitem)"""


def _qualified(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    price = E.f64_bytes(F.col("l_extendedprice"))
    kind = F.when(flag == "A", 1).otherwise(2)
    v = (
        F.when(flag == "N", price)
        .otherwise(F.concat(price, E.int_bytes(kind, 2), F.lit(bytes(2)), E.int_bytes(F.lit(9), 4))))
    return star.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + 1).alias("entity_id"), (F.col("l_partkey") + 1).alias("attribute_id"),
        (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("seq"), v.alias("v"),
        F.lit(routing.FLOAT64).alias("data_type"), F.lit(2).alias("sub_type"),
        F.lit(True).alias("qualified"))


@query(f"""WITH {_QUALIFIED}
SELECT 'number' AS kind, entity_id, attribute_id, seq, round(price * 100) AS value FROM q
WHERE f <> 'A'
UNION ALL SELECT 'code', entity_id, attribute_id, seq, 9 FROM q WHERE f <> 'N'""")
def qualified_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices in cents and the codes behind them."""
    tables = routing.route(_qualified(spark, sf_dir))
    numbers = tables["value_numbers"].withColumn("value", F.rint(F.col("value") * 100))
    codes = tables["value_lookups"].withColumn("value", F.col("lookup_id").cast("double"))
    key = ["entity_id", "attribute_id", "seq", "value"]
    return numbers.select(F.lit("number").alias("kind"), *key).unionByName(
        codes.select(F.lit("code").alias("kind"), *key))


# ---------------------------------------------------------------- blocks

_LINE_ORDER = "l_linenumber, l_partkey, l_suppkey, l_extendedprice"
_LINES = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@query(f"""WITH n AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) - 1 AS i
  FROM lineitem),
p AS (SELECT *, i // 8 AS page_no, i % 8 AS pos FROM n),
s AS (SELECT *, min(CASE WHEN q > 45 THEN pos END) OVER (PARTITION BY l_orderkey, page_no) AS bad
  FROM p)
SELECT l_orderkey AS order_key, CAST(page_no AS INTEGER) AS page_no, CAST(pos AS INTEGER) AS pos,
       l_linenumber AS line, q AS quantity
FROM s WHERE bad IS NULL OR pos < bad""")
def fixed_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items in fixed blocks, eight to a page; a page ends at a large quantity."""
    lines = star.table(spark, sf_dir, "lineitem")
    block = F.concat(E.int_bytes(F.col("l_linenumber"), 2), E.int_bytes(F.col("l_quantity"), 2))
    pages = star.pack(lines, ["l_orderkey"], _LINES, block, 8).select(
        F.col("l_orderkey").alias("order_key"), "page_no",
        F.concat(F.lit(bytes(6)), "body").alias("bytes"))
    rows = B.fixed_blocks(
        pages, 6, 4, until=lambda b: D.u16(b, 2) > 45, keep=("order_key", "page_no"))
    return rows.select(
        "order_key", "page_no", "pos", D.u16(F.col("block"), 0).cast("int").alias("line"),
        D.u16(F.col("block"), 2).alias("quantity"))


# documents as caption pages: every line is a caption, places count up by line
_CAPTIONS = r"""lines AS (
  SELECT doc_id, string_split(regexp_replace(text, '[\x00\x05]', ' ', 'g'), chr(10)) AS l
  FROM documents),
cap AS (SELECT doc_id AS page_id, unnest(range(len(l))) AS pos, len(l) AS n, l[1] AS head,
               unnest(l) AS line FROM lines),
captions AS (SELECT page_id, CAST(pos AS INTEGER) AS pos, CAST(1 + pos % 250 AS INTEGER) AS x,
               CAST(1 + pos // 250 % 250 AS INTEGER) AS y,
               regexp_replace(line, '[^\x00-\x7f]', '?', 'g') AS text
  FROM cap WHERE length(head) > 1 AND NOT (pos = n - 1 AND line = ''))"""


def _captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = F.split(F.regexp_replace("text", "[\\x00\\x05]", " "), "\n")
    page = F.transform(
        lines,
        lambda line, i: F.concat(
            F.lit(bytes([B.DELIMITER])), E.int_bytes(i % 250 + 1, 1, signed=False),
            E.int_bytes(F.floor(i / 250) % 250 + 1, 1, signed=False), E.text_bytes(line)))
    pages = star.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.concat(E.join_blocks(page), F.lit(bytes(9))).alias("bytes"))
    return B.delimited_blocks(pages)


@query(f"WITH {_CAPTIONS} SELECT * FROM captions")
def delimited_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _captions(spark, sf_dir)


@query(f"""WITH {_CAPTIONS}
SELECT page_id, x, y, text, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS seq, pos
FROM captions WHERE text <> ''""")
def view_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.number_captions(_captions(spark, sf_dir))


@query(f"""WITH {_CAPTIONS},
top AS (SELECT page_id, min(y) AS y FROM captions WHERE y > 0 GROUP BY 1)
SELECT page_id, coalesce(trim(string_agg(text, ' ' ORDER BY x, pos)
         FILTER (NOT starts_with(text, '['))), '') AS title
FROM captions JOIN top USING (page_id, y) GROUP BY 1""")
def caption_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top row of captions of each page as its title."""
    return M.top_captions(_captions(spark, sf_dir))


def _status_blocks(spark: SparkSession, sf_dir: str, value) -> DataFrame:
    """Order states per customer as run-length pages, and back to blocks."""
    orders = star.numbered_orders(spark, sf_dir).withColumn("value", value)
    seen = Ordered(orders, ["entity_id"], ["seq"]).previous("value", "before")
    starts = seen.running_sum(
        F.when(F.col("before").eqNullSafe(F.col("value")), 0).otherwise(1), "run").rows()
    runs = starts.groupBy("entity_id", "run").agg(
        F.first("value").alias("value"), F.count(F.lit(1)).alias("n"))
    # a count is one byte: longer runs take several blocks
    pieces = runs.select(
        "entity_id", "run", "value", "n",
        F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / 255))).alias("piece")
    ).withColumn("rep", F.least(F.lit(255), F.col("n") - F.col("piece") * 255))
    block = E.rle_block(F.lit(star.STATUS), E.text_bytes(F.col("value")), F.col("rep"))
    packed = star.pack(
        pieces, ["entity_id"], ["run", "piece"], block, 16, high=F.lit(star.STATUS).cast("int"))
    pages = packed.select(
        "entity_id", F.col("page_no").cast("bigint").alias("chain_pos"),
        E.fields(
            # sixteen blocks of at most 31 bytes, control bytes included
            512, (6, 2, E.int_bytes(496 - F.length("body"), 2)), (16, 496, F.col("body")),
        ).alias("bytes"))
    return B.rle_blocks(pages)


def _decoded(blocks: DataFrame) -> DataFrame:
    kept = B.guard_ascending(B.by_entity(materialize(blocks, "blocks")))
    return B.expand_rows(B.number_rows(kept._keep(kept.df.where("kept"))).df)


@query(f"""WITH {NUMBERED} SELECT entity_id, seq, o_orderstatus AS value FROM numbered""")
def rle_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order states, run-coded on pages and expanded to one row per order."""
    rows = _decoded(_status_blocks(spark, sf_dir, F.col("o_orderstatus")))
    return rows.select("entity_id", "seq", D.text(F.col("v")).alias("value"))


@query(f"""WITH {NUMBERED}
SELECT entity_id, seq, o_orderpriority AS value FROM numbered WHERE o_totalprice >= 250000""")
def fill_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priorities of large orders; the others are blank fillers that keep the count."""
    value = F.when(F.col("o_totalprice") >= 250000, F.col("o_orderpriority")).otherwise("")
    rows = _decoded(_status_blocks(spark, sf_dir, value))
    return rows.select("entity_id", "seq", D.text(F.col("v")).alias("value"))


_GUARD = f"""g AS (SELECT l_suppkey + 1 AS entity_id, l_partkey + 1 AS item, l_orderkey, {_LINE_ORDER},
         max(l_partkey + 1) OVER w AS m
  FROM lineitem WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey, {_LINE_ORDER}
       ROWS UNBOUNDED PRECEDING)),
h AS (SELECT *, min(item) OVER (PARTITION BY entity_id, m ORDER BY l_orderkey, {_LINE_ORDER}
       ROWS UNBOUNDED PRECEDING) AS low FROM g)"""


@query(f"""WITH {_GUARD}
SELECT entity_id, item AS item_id, l_orderkey, l_linenumber, item = m AND low = m AS kept
FROM h""")
def ascending_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items of a supplier in order; parts that do not ascend are flagged."""
    lines = star.table(spark, sf_dir, "lineitem").withColumns({
        "entity_id": F.col("l_suppkey") + 1, "item_id": F.col("l_partkey") + 1})
    flagged = B.guard_ascending(Ordered(lines, ["entity_id"], ["l_orderkey", *_LINES]))
    return flagged.rows().select("entity_id", "item_id", "l_orderkey", "l_linenumber", "kept")


# ---------------------------------------------------------------- chains


@query("""SELECT conv_id AS chain_id, turn AS chain_pos,
       conv_id * 1000000 + turn + 1 AS page_id,
       CASE WHEN turn = max(turn) OVER (PARTITION BY conv_id) THEN 'end' END AS stop
FROM conversations""")
def chain_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as linked pages, put in order by their links."""
    page = F.col("conv_id") * 1_000_000 + F.col("turn") + 1
    turns = star.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("owner"), page.alias("page_id"), "turn")
    after = turns.select("owner", (F.col("turn") - 1).alias("turn"), F.col("page_id").alias("next_id"))
    links = turns.join(after, ["owner", "turn"], "left").select(
        "owner", "page_id", F.coalesce("next_id", F.lit(0)).alias("next_id"))
    starts = turns.where("turn = 0").select(F.col("owner").alias("chain_id"), "owner", "page_id")
    return C.chain_order(starts, links).select("chain_id", "chain_pos", "page_id", "stop")


@query("""SELECT o_orderkey + 1 AS page_id,
       row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS chain_pos,
       count(*) OVER () - row_number() OVER (ORDER BY o_custkey, o_orderkey) AS back_pos
FROM orders""")
def chain_doubling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One chain over all orders, forwards and backwards."""
    orders = star.table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("page_id"), "o_custkey", "o_orderkey")
    linked = materialize(
        Ordered(orders, [], ["o_custkey", "o_orderkey"]).previous("page_id", "prev_id").rows()
        .select("page_id", "prev_id"), "links")
    after = linked.select(F.col("prev_id").alias("page_id"), F.col("page_id").alias("next_id"))
    links = linked.select("page_id").join(after, "page_id", "left").select(
        F.lit(1).alias("owner"), "page_id", F.coalesce("next_id", F.lit(0)).alias("next_id"))
    starts = linked.where("prev_id is null").select(
        F.lit(1).alias("chain_id"), F.lit(1).alias("owner"), "page_id")
    # eight times the pages that are put in order at once: the list is contracted first
    few = min(C.MAX_GROUP, linked.count() // 8 + 1)
    order = materialize(C.rank_large(starts, links, max_group=few), "order")
    return C.backward(order).select("page_id", "chain_pos", "back_pos")


# every order of a customer is a page of items 10 seq + 1 to 10 seq + 5; where a third of
# the customers is broken, the first page leads to the very first order of all, and the
# second page, which holds one item only, is passed over
_REPAIR = f"""WITH {NUMBERED},
z AS (SELECT min(o_orderkey) AS k, arg_min(o_custkey + 1, o_orderkey) AS e FROM orders),
p AS (SELECT *, count(*) OVER (PARTITION BY entity_id) AS n FROM numbered),
b AS (SELECT p.*, entity_id % 3 = 0 AND n > 1 AND entity_id <> z.e AS broken FROM p, z)"""


@query(_REPAIR + """
SELECT entity_id, o_orderkey + 1 AS page_id,
       seq - CASE WHEN broken AND seq > 1 THEN 2 ELSE 1 END AS chain_pos
FROM b WHERE NOT (broken AND seq = 2)""")
def chain_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in order across broken links."""
    order, _ = _repaired(spark, sf_dir)
    return order.where("chain_pos >= 0").select(
        F.col("owner").alias("entity_id"), "page_id", "chain_pos")


@query(_REPAIR + """
SELECT entity_id, 15::BIGINT AS attribute_id, NULL::BIGINT AS seq, o_orderkey + 1 AS page_id,
       'broken_chain' AS rule,
       CASE WHEN n > 2 THEN 'resumed at page ' ||
         (SELECT o_orderkey + 1 FROM b c WHERE c.entity_id = b.entity_id AND c.seq = 3)
         || ', passed over items 21' ELSE 'no further page' END AS detail
FROM b WHERE broken AND seq = 1""")
def chain_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One finding per broken link, with the page where the chain went on."""
    _, breaks = _repaired(spark, sf_dir)
    return quality.broken_chains(breaks)


def _repaired(spark: SparkSession, sf_dir: str):
    orders = star.numbered_orders(spark, sf_dir)
    first = orders.agg(F.min(F.struct("o_orderkey", "entity_id")).alias("z")).first().z
    target = first.o_orderkey + 1
    n = orders.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
    broken = (F.col("entity_id") % 3 == 0) & (F.col("n") > 1) & (
        F.col("entity_id") != first.entity_id)
    after = orders.select(
        "entity_id", (F.col("seq") - 1).alias("seq"), (F.col("o_orderkey") + 1).alias("after"))
    single = F.col("broken") & (F.col("seq") == 2)
    pages = (
        orders.join(n, "entity_id").withColumn("broken", broken)
        .join(after, ["entity_id", "seq"], "left")
        .select(
            F.col("entity_id").alias("owner"), (F.col("o_orderkey") + 1).alias("page_id"),
            F.when(F.col("broken") & (F.col("seq") == 1), target)
            .otherwise(F.coalesce("after", F.lit(0))).alias("next_id"),
            (F.col("seq") * 10 + F.when(single, 1).otherwise(5)).alias("high"),
            (F.col("seq") * 10 + 1).alias("low"), "seq"))
    pages = materialize(pages, "repair-pages")
    starts = pages.where("seq = 1").select(F.col("owner").alias("chain_id"), "owner", "page_id")

    def last_items(of: DataFrame) -> DataFrame:
        return pages.join(of, "page_id", "left_semi").select("page_id", F.col("high").alias("last"))

    return C.repair_links(
        starts, pages.select("owner", "page_id", "next_id"),
        pages.select("owner", "page_id", "high", "low"), last_items)


TEXT_BYTES = 480  # text on a page of 512 bytes


def _text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut in long-text pages: ``(page_id, bytes, doc_id, page_no)``."""
    documents = star.table(spark, sf_dir, "documents").select(
        "doc_id", E.text_bytes(F.col("text")).alias("raw"))
    documents = documents.withColumn("n", F.ceil(F.length("raw") / TEXT_BYTES))
    # the first page of a text follows the last page of the text before
    placed = Ordered(documents.select("doc_id", "n"), [], ["doc_id"]).running_sum(
        F.col("n"), "upto").rows()
    chunks = F.transform(
        F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1),
        lambda i: D.part(F.col("raw"), i * TEXT_BYTES, TEXT_BYTES))
    cut = documents.select("doc_id", "n", F.posexplode(chunks).alias("page_no", "chunk")).join(
        placed.select("doc_id", (F.col("upto") - F.col("n")).alias("base")), "doc_id")
    page = F.col("base") + F.col("page_no") + 1
    following = F.when(F.col("page_no") + 1 < F.col("n"), page + 1).otherwise(0)
    return cut.select(
        page.alias("page_id"),
        E.fields(
            512, (0, 4, E.int_bytes(following, 4)), (8, 4, E.int_bytes(F.col("doc_id") + 1, 4)),
            (16, 2, E.int_bytes(F.col("page_no"), 2)),
            (32, TEXT_BYTES, F.col("chunk")),
        ).alias("bytes"), "doc_id", "page_no")


@query(r"""WITH t AS (SELECT doc_id, regexp_replace(translate(text, chr(127), chr(10)),
                '[^\x00-\x7f]', '?', 'g') AS text FROM documents),
c AS (SELECT doc_id, unnest(range(CAST(ceil(length(text) / 480.0) AS BIGINT))) AS k, text FROM t)
SELECT doc_id + 1 AS entity_id,
       string_agg(substr(text, k * 480 + 1, 480) || chr(10), '' ORDER BY k) AS value
FROM c GROUP BY 1""")
def long_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut in pages, chained, and put together again. Every page ends in
    a line feed."""
    pages = materialize(_text_pages(spark, sf_dir), "text-pages")
    pointers = pages.where("page_no = 0").select(
        F.col("page_id").alias("pointer"), (F.col("doc_id") + 1).alias("entity_id"))
    texts, _ = values.text_table(pointers, pages.select("page_id", "bytes"))
    return texts.select("entity_id", "value")


# ---------------------------------------------------------------- whole loads


def value_system(spark: SparkSession, sf_dir: str):
    """Customers and orders as one system: a file of value pages, and tables of the others."""
    raw = star.order_bytes(spark, sf_dir)
    block = E.rle_block(F.col("item_id"), F.col("v"), F.lit(1))
    packed = star.pack(
        raw, ["entity_id"], ["item_id", "seq"], block, 24,
        sizes=star.value_counts(spark, sf_dir), high=F.max("item_id"))
    numbered = star.number_pages(packed, ["entity_id"])
    data = star.data_pages(numbered)
    first = numbered.where("page_no = 0").select("entity_id", "page_id")
    vrx = first.select(
        F.col("entity_id").alias("page_id"),
        E.fields(64, (0, 2, E.int_bytes(F.lit(1), 2)), (4, 4, E.int_bytes(F.col("page_id"), 4)))
        .alias("bytes"))
    status = star.spread(star.table(spark, sf_dir, "customer"), "c_custkey").select(
        star.entity("c_custkey").alias("page_id"),
        E.fields(
            64, (1, 1, E.int_bytes(F.lit(1), 1)),
            (32, 4, E.int_bytes(F.col("c_custkey") % 86400 * 1000, 4)),
            (36, 2, E.int_bytes(F.lit(60000), 2, signed=False)),
        ).alias("bytes"))
    types = star.fields(spark)
    items = types.select(
        F.col("attribute_id").cast("bigint").alias("page_id"),
        E.fields(64, (7, 1, E.int_bytes(F.col("data_type"), 1)),
                 (8, 2, E.int_bytes(F.col("sub_type"), 2))).alias("bytes"))
    valid = types.where("qualified").select(
        F.col("attribute_id").cast("bigint").alias("page_id"),
        E.fields(64, (12, 2, E.int_bytes(F.lit(3), 2))).alias("bytes"))
    empty = data.where("false").select("page_id", "bytes")
    folder = scratch_path(spark, "system")
    paged.write_pages(data, f"{folder}/DATA.DBS", 1024)
    # stored, so that fields are cut from bytes and not from the expressions that made them
    vrx, status = materialize(vrx, "vrx"), materialize(status, "status")
    tables = {"VRX": vrx, "PATSTS": status, "ITEM": items, "VALID": valid, "FRTEXT": empty}
    return paged.PageFolder(spark, folder, lengths={"DATA.DBS": 1024}, tables=tables)


_RAW = f"""WITH {NUMBERED},
d AS (SELECT kind, name, row_number() OVER (ORDER BY kind, name) AS code FROM (
  SELECT DISTINCT 'segment' AS kind, c_mktsegment AS name FROM customer
  UNION ALL SELECT DISTINCT 'status', o_orderstatus FROM orders)),
v AS (
  SELECT 'value_texts' AS t, c_custkey + 1 AS e, 1 AS a, 1 AS s, c_name AS x FROM customer
  UNION ALL SELECT 'value_numbers', c_custkey + 1, 2, 1,
    CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) FROM customer
  UNION ALL SELECT 'value_lookups', c_custkey + 1, 3, 1, CAST(-code AS VARCHAR)
    FROM customer JOIN d ON kind = 'segment' AND name = c_mktsegment
  UNION ALL SELECT 'value_lookups', c_custkey + 1, 4, 1, CAST(c_nationkey + 1 AS VARCHAR)
    FROM customer
  UNION ALL SELECT 'value_dates', entity_id, 101, seq, strftime(o_orderdate, '%Y-%m-%d')
    FROM numbered
  UNION ALL SELECT 'value_numbers', entity_id, 102, seq,
    CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) FROM numbered
  UNION ALL SELECT 'value_lookups', entity_id, 102, seq, '9' FROM numbered
    WHERE o_orderstatus = 'F'
  UNION ALL SELECT 'value_lookups', entity_id, 103, seq, CAST(-code AS VARCHAR)
    FROM numbered JOIN d ON kind = 'status' AND name = o_orderstatus
  UNION ALL SELECT 'value_texts', entity_id, 104, seq, o_orderpriority FROM numbered
  UNION ALL SELECT 'value_numbers', entity_id, 105, seq,
    CAST(o_orderkey * 100 AS VARCHAR) FROM numbered)"""


def _shown(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        value = F.col(df.columns[-1])
        if name == "value_numbers":
            value = F.rint(value * 100).cast("bigint")
        rows = df.select(
            F.lit(name).alias("value_table"), "entity_id",
            F.col("attribute_id").cast("int").alias("attribute_id"), "seq",
            value.cast("string").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(_RAW + """
SELECT t AS value_table, e AS entity_id, a AS attribute_id, s AS seq, x AS value FROM v""")
def load_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page files of all customers and orders, decoded to the value tables."""
    return _shown(values.load_values(value_system(spark, sf_dir)).tables)


@query(_RAW + """
SELECT t AS value_table, e AS entity_id, a AS attribute_id, s AS seq, x AS value FROM v
WHERE (e - 1) % 86400 > 1000 AND a NOT IN (1, 104)""")
def load_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for entities updated after a known time, without two attributes."""
    mark = D.legacy_timestamp(F.lit(60000), F.lit(1_000_000))
    known = star.table(spark, sf_dir, "region").select(mark.alias("last_updated"))
    loaded = values.load_values(
        value_system(spark, sf_dir), known=known, exclude=[star.NAME, star.PRIORITY])
    return _shown(loaded.tables)


@query(_RAW + """
SELECT t AS value_table, a AS attribute_id, count(*) AS n_values FROM v GROUP BY ALL""")
def route_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values per table and attribute, routed straight from their bytes."""
    raw = star.order_bytes(spark, sf_dir).withColumnRenamed("item_id", "attribute_id")
    typed = materialize(
        routing.with_fields(raw, star.fields(spark)), "typed", partition_by=("data_type",))
    return routing.value_counts(routing.route(typed))


@query("""SELECT CAST(c_nationkey + 1 AS SMALLINT) AS index_type_id, c_name AS term,
       c_custkey + 1 AS entity_id
FROM customer""")
def index_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers in one index per nation: pages of keys, chained, back to terms."""
    definitions, pages = _index_pages(spark, sf_dir)
    return P.indexes(P.index_blocks(L.index_definitions(definitions), pages))


def _index_pages(spark: SparkSession, sf_dir: str, wrong: Column | None = None):
    customers = star.table(spark, sf_dir, "customer").withColumn("def", F.col("c_nationkey") + 1)
    block = F.concat(
        E.int_bytes(star.entity("c_custkey"), 4), E.fixed_text(F.col("c_name"), 24))
    packed = star.pack(customers, ["def"], ["c_name", "c_custkey"], block, 16,
                       n=F.count(F.lit(1)))
    numbered = star.number_pages(packed, ["def"])
    before = numbered.select(
        F.col("next_id").alias("page_id"), F.col("page_id").alias("prev_id")).where("page_id > 0")
    back = F.coalesce("prev_id", F.lit(0))
    if wrong is not None:
        back = F.when(wrong, back + 1_000_000).otherwise(back)
    pages = materialize(numbered.join(before, "page_id", "left").select(
        "page_id", "def", "page_no",
        E.fields(
            20 + 16 * 28, (0, 4, E.int_bytes(back, 4)),
            (4, 4, E.int_bytes(F.col("next_id"), 4)), (12, 2, E.int_bytes(F.col("n"), 2)),
            (14, 2, E.int_bytes(F.col("def"), 2)), (20, 16 * 28, F.col("body")),
        ).alias("bytes")), "index-pages")
    # a stated length of 17 to 20 means blocks of 28 bytes
    definitions = pages.where("page_no = 0").select(
        F.col("def").cast("bigint").alias("page_id"),
        E.fields(32, (0, 2, E.int_bytes(F.lit(18), 2)),
                 (4, 4, E.int_bytes(F.col("page_id"), 4))).alias("bytes"))
    return definitions, pages.select("page_id", "bytes")


@query("""WITH n AS (SELECT c_nationkey + 1 AS def,
         (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_name, c_custkey) - 1) // 16 AS k
  FROM customer),
p AS (SELECT def, k, row_number() OVER (ORDER BY def, k) AS id FROM (SELECT DISTINCT def, k FROM n))
SELECT CAST(def AS BIGINT) AS chain_id, id AS page_id,
       CAST(id - 1 + 1000000 AS INTEGER) AS prev_id, id - 1 AS expected
FROM p WHERE k % 3 = 2""")
def index_back_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index pages whose previous page is not the page before: every third is wrong."""
    definitions, pages = _index_pages(spark, sf_dir, wrong=F.col("page_no") % 3 == 2)
    headers = L.project(pages, "INDEX")
    starts = L.index_definitions(definitions).select(
        F.col("page_id").alias("chain_id"), F.col("page_id").alias("owner"),
        F.col("start_page").alias("page_id"))
    links = headers.select(F.col("index_def").alias("owner"), "page_id", "next_id")
    order = materialize(C.chain_order(starts, links), "order")
    return C.broken_back_links(order, headers)


# ---------------------------------------------------------------- page files


@query("""SELECT o_orderkey + 1 AS page_id, o_orderkey AS order_key, o_orderpriority AS priority
FROM orders WHERE o_orderstatus <> 'P'""")
def paged_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as a page file and scanned; pages of open orders are all zero
    and so do not exist."""
    path = scratch_path(spark, "paged")
    there = F.col("o_orderstatus") != "P"
    page = E.fields(
        32, (0, 4, E.int_bytes(F.col("o_orderkey"), 4)),
        (8, 15, E.fixed_text(F.col("o_orderpriority"), 15)))
    pages = star.table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("page_id"),
        F.when(there, page).otherwise(F.lit(bytes(32))).alias("bytes"))
    paged.write_pages(pages, path, 32)
    b = F.col("bytes")
    return paged.read_pages(spark, path, 32).select(
        "page_id", D.u32(b, 0).alias("order_key"), D.ascii_trim(b, 8, 15).alias("priority"))


@query("""SELECT DISTINCT o_custkey + 1 AS page_id, c_name AS name
FROM orders JOIN customer ON c_custkey = o_custkey WHERE o_totalprice > 400000""")
def page_point_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of the customers that have a large order, read by their ids."""
    path = scratch_path(spark, "paged")
    paged.write_pages(
        star.table(spark, sf_dir, "customer").select(
            star.entity("c_custkey").alias("page_id"),
            E.fixed_text(F.col("c_name"), 32).alias("bytes")), path, 32)
    wanted = star.table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(
        star.entity("o_custkey").alias("page_id"))
    found = paged.pick_pages(spark, path, 32, wanted)
    return found.select("page_id", D.ascii_trim(F.col("bytes"), 0, 32).alias("name"))


# ---------------------------------------------------------------- faults

_FAULTS = f"""{_GUARD},
k AS (SELECT o_orderkey, o_custkey * 2 AS c FROM orders)
SELECT entity_id, item AS attribute_id, NULL::BIGINT AS seq, l_orderkey AS page_id,
       'item_order' AS rule, 'items not ascending' AS detail
FROM h WHERE NOT (item = m AND low = m) GROUP BY 1, 2, 4
UNION ALL
SELECT l_orderkey + 1, l_partkey + 1, l_suppkey * 10 + l_linenumber, NULL, 'abnormal_number',
       'Infinity' FROM lineitem WHERE l_quantity = 50
UNION ALL
SELECT o_orderkey + 1, 11, 1, NULL, 'unresolved_key', 'CUSTOMER#' || lpad(c::VARCHAR, 9, '0')
FROM k WHERE c NOT IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT doc_id + 1, 10, 1, CASE WHEN doc_id % 2 = 0 THEN doc_id + 1 ELSE -(doc_id + 1) END,
       'foreign_text', CASE WHEN doc_id % 2 = 0 THEN 'page of entity ' || (doc_id + 2)
                            ELSE 'no such page' END
FROM documents WHERE doc_id % 5 < 2
UNION ALL
SELECT conv_id, NULL, NULL, max(conv_id * 1000000 + turn + 1), 'bad_chain', 'cycle'
FROM conversations GROUP BY conv_id"""


@query(f"WITH {_FAULTS}")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planted faults of several kinds in one report."""
    lines = star.table(spark, sf_dir, "lineitem").withColumns({
        "entity_id": F.col("l_suppkey") + 1, "item_id": F.col("l_partkey") + 1,
        "page_id": F.col("l_orderkey")})
    guarded = B.guard_ascending(Ordered(lines, ["entity_id"], ["l_orderkey", *_LINES])).rows()
    infinite = star.table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") + 1).alias("entity_id"), (F.col("l_partkey") + 1).alias("attribute_id"),
        (F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.when(F.col("l_quantity") == 50, F.lit(bytes.fromhex("7ff0")))
        .otherwise(E.f64_bytes(F.col("l_quantity"))).alias("v"),
        F.lit(routing.FLOAT64).alias("data_type"), F.lit(2).alias("sub_type"),
        F.lit(False).alias("qualified"))
    name = F.concat(F.lit("CUSTOMER#"), F.lpad((F.col("o_custkey") * 2).cast("string"), 9, "0"))
    keys = star.table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + 1).alias("entity_id"), F.lit(11).alias("attribute_id"),
        F.lit(1).alias("seq"), F.lit(star.CUSTOMER).alias("linked_type"), name.alias("term"))
    terms = routing.first_terms(star.table(spark, sf_dir, "customer").select(
        F.lit(star.CUSTOMER).alias("linked_type"), F.col("c_name").alias("term"),
        star.entity("c_custkey").alias("entity_id"), F.col("c_custkey").alias("at")))
    doc = F.col("doc_id")
    documents = star.table(spark, sf_dir, "documents")
    pointers = documents.select(
        (doc + 1).alias("entity_id"), F.lit(10).alias("attribute_id"), F.lit(1).alias("seq"),
        F.when((doc % 5 < 2) & (doc % 2 == 1), -(doc + 1)).otherwise(doc + 1).alias("pointer"))
    headers = documents.select(
        (doc + 1).alias("page_id"),
        F.when(doc % 5 < 2, doc + 2).otherwise(doc + 1).alias("entity_id"))
    turns = star.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("owner"), "turn",
        (F.col("conv_id") * 1_000_000 + F.col("turn") + 1).alias("page_id"))
    after = turns.select("owner", (F.col("turn") - 1).alias("turn"), F.col("page_id").alias("next_id"))
    first = turns.where("turn = 0").select("owner", F.col("page_id").alias("first_id"))
    # the last turn leads back to the first
    links = match(turns, after, ["owner", "turn"], "left").join(first, "owner").select(
        "owner", "page_id", F.coalesce("next_id", "first_id").alias("next_id"))
    starts = first.select(F.col("owner").alias("chain_id"), "owner", F.col("first_id").alias("page_id"))
    return quality.report([
        quality.unordered_items(guarded),
        quality.abnormal(routing.abnormal_numbers(infinite)),
        quality.unresolved(keys, terms),
        quality.foreign_texts(pointers, headers),
        quality.bad_chains(C.chain_order(starts, links)),
    ])
