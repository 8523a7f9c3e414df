"""Metadata tables derived from their page files.

Ids of metadata are 16-bit, so these frames are small in production; nothing below
relies on it. Rules are joins and aggregates; a
"first by id" rule is a ``min_by``, which combines before it shuffles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark import schemas as S
from eavspark.functions import decode as D
from eavspark.operators import routing as R
from eavspark.operators.blocks import delimited_blocks
from eavspark.operators.ordered import Ordered
from eavspark.session import literal
from eavspark.plans.menus import menus, own_menus
from eavspark.sources import layouts as L
from eavspark.store import conform

Pages = Callable[[str], DataFrame]

DICT_LOOKUP_TYPE = -1  # fixed value: the lookup type of dictionary codes

# fixed values: id, name, value table, lookup table, and the same for the second value
DATA_TYPES = [
    (S.TEXT, "Text", "value_texts", None, None, None),
    (S.NUMERIC, "Numeric", "value_numbers", None, None, None),
    (S.LOOKUP, "Lookup", "value_lookups", "lookups", None, None),
    (S.DATE, "Date", "value_dates", None, None, None),
    (S.ENTITY_PTR, "EntityPtr", "value_entities", "entities", "value_texts", None),
    (S.LONG_TEXT, "LongText", "value_long_texts", None, None, None),
    (S.QUALIFIED, "QualifiedNumbers", "value_numbers", None, "value_lookups", "lookups"),
    (S.TIME, "Time", "value_times", None, "value_texts", None),
]


def data_types(spark: SparkSession) -> DataFrame:
    names = S.SCHEMAS["data_types"].fieldNames()
    rows = [(i, n, v, lk, av, al) for i, n, v, lk, av, al in DATA_TYPES]
    frame = literal(
        spark, rows, "id int, name string, value_table string, lookup_table string, "
        "alt_value_table string, alt_lookup_table string"
    )
    return conform(frame.select(names), "data_types")


def entity_types(entity: DataFrame) -> DataFrame:
    return conform(
        entity.select(
            F.col("page_id").alias("id"), F.col("key_index_def").alias("key_index_type_id"),
            F.col("default_index_def").alias("default_index_type_id"), "name",
            F.col("id_group").alias("id_line_view_id"), F.col("id_item").alias("id_attribute_id"),
        ),
        "entity_types",
    )


def table_id(group: str = "group_id", entity_type: str = "entity_type") -> Column:
    """Items without a group belong to the static table of their entity type."""
    return F.when(F.col(group) == 0, -F.col(entity_type)).otherwise(F.col(group))


def first_items(items: DataFrame) -> DataFrame:
    """First item by id of each logical table: it fixes type, key date and name."""
    usable = items.where("installed and data_type > 0 and entity_type > 0")
    first = F.min_by(F.struct("name", "entity_type", "date_item", "comment"), "page_id")
    return (
        usable.groupBy(table_id().alias("table_id")).agg(first.alias("f"))
        .select("table_id", "f.*")
    )


def longer(best: Column, other: Column) -> Column:
    """``other`` where it exists and is strictly longer."""
    return F.when(other.isNotNull() & (F.length(best) < F.length(other)), other).otherwise(best)


def tables(items: DataFrame, screens: DataFrame, groups: DataFrame, entity: DataFrame) -> DataFrame:
    """Logical tables; the longest of the candidate names wins."""
    named = (
        first_items(items)
        .join(screens.select(F.col("page_id").alias("table_id"), F.col("name").alias("screen")),
              "table_id", "left")
        .join(groups.select(F.col("page_id").alias("table_id"), F.col("name").alias("group")),
              "table_id", "left")
        .join(entity.select(F.col("page_id").alias("entity_type"), F.col("name").alias("owner")),
              "entity_type", "left")
    )
    dated = F.coalesce("screen", "name")
    dated = longer(dated, F.col("group"))
    dated = longer(dated, D.clean_comment(F.col("comment")))
    name = F.when(F.col("table_id") > 0, dated).otherwise(F.coalesce("owner", "name"))
    return conform(
        named.select(
            F.col("table_id").alias("id"), F.col("entity_type").alias("entity_type_id"),
            name.alias("name"), F.col("date_item").alias("date_attribute_id"),
        ),
        "tables",
    )


def logical_type(data_type: Column) -> Column:
    """Source type 1 to 12 to logical type; any other raises."""
    kinds = {
        R.STRING: S.TEXT, R.INT8: S.NUMERIC, R.INT16: S.NUMERIC, R.INT32: S.NUMERIC,
        R.FLOAT32: S.NUMERIC, R.FLOAT64: S.NUMERIC, R.DICT: S.LOOKUP, R.DATE: S.DATE,
        R.TIME: S.TIME, R.FREE_TEXT: S.LONG_TEXT, R.ENTITY_KEY: S.ENTITY_PTR, R.CODE: S.LOOKUP,
    }
    out = None
    for source, logical in kinds.items():
        out = (F if out is None else out).when(data_type == source, logical)
    return out.otherwise(
        F.raise_error(F.concat(F.lit("unknown data type "), data_type.cast("string"))).cast("int")
    )


def bound(raw: Column, data_type: Column, sub_type: Column) -> Column:
    """A range limit by the type of its item; 8 raw bytes in, DOUBLE out."""
    def whole(n: int) -> Column:
        field = F.substring(raw, 1, n)
        return F.when(sub_type > 0, D.sint(field, n)).otherwise(D.uint(field)).cast("double")

    return (
        F.when(data_type == R.INT8, whole(1)).when(data_type == R.INT16, whole(2))
        .when(data_type == R.INT32, whole(4))
        .when(data_type == R.FLOAT32, D.f32(F.substring(raw, 1, 4)))
        .when(data_type == R.FLOAT64, D.f64(raw))
        .when(data_type == R.DICT, D.sint(F.substring(raw, 1, 2), 2).cast("double"))
    )


def typed_attributes(items: DataFrame, valid: DataFrame) -> DataFrame:
    """Items with logical type, format, range and lookup type.

    ``items``: page_id, data_type, sub_type, calculated, ...; ``valid``: page_id,
    qualifier_type, modifier_type, calc_quark, code_type, low, high (DOUBLE).
    """
    checks = valid.select(
        "page_id", "qualifier_type", "modifier_type", "calc_quark", "code_type",
        F.col("low").alias("_low"), F.col("high").alias("_high"), F.lit(True).alias("_checked"),
    )
    t = F.col("data_type")
    used = F.coalesce("_checked", F.lit(False)) & ~F.col("calculated")
    qualifier = F.greatest("qualifier_type", "modifier_type")
    qualified = used & t.isin(R.FLOAT32, R.FLOAT64) & (
        (F.col("qualifier_type") > 0) | (F.col("modifier_type") > 0)
    )
    ranged = used & t.between(R.INT8, R.FLOAT64)
    coded = used & (t == R.DICT)
    return (
        items.where("data_type > 0").join(checks, "page_id", "left")
        .withColumn("data_type_id", F.when(qualified, S.QUALIFIED).otherwise(logical_type(t)))
        .withColumn(
            "format",
            F.when(t == R.DATE, D.date_format_for(F.col("display_length")))
            .when(t == R.TIME, D.time_format_for(F.col("display_length"))),
        )
        .withColumn(
            "quark",
            F.when(F.col("calculated") & F.col("_checked").isNotNull(), F.col("calc_quark")),
        )
        # dictionary ids are negated, so their range turns round
        .withColumn("max", F.when(ranged, F.col("_high")).when(coded, -F.col("_low")))
        .withColumn("min", F.when(ranged, F.col("_low")).when(coded, -F.col("_high")))
        .withColumn(
            "lookup_type_id",
            F.when(qualified, qualifier).when(t == R.DICT, DICT_LOOKUP_TYPE)
            .when(used & (t == R.CODE), F.col("code_type")),
        )
        .drop("_low", "_high", "_checked", "qualifier_type", "modifier_type", "calc_quark",
              "code_type")
    )


def attributes(items: DataFrame, valid: DataFrame) -> DataFrame:
    types = items.select("page_id", F.col("data_type").alias("_t"), F.col("sub_type").alias("_s"))
    limits = valid.join(types, "page_id").select(
        *[c for c in valid.columns if c not in ("min_raw", "max_raw")],
        bound(F.col("min_raw"), F.col("_t"), F.col("_s")).alias("low"),
        bound(F.col("max_raw"), F.col("_t"), F.col("_s")).alias("high"),
    )
    typed = typed_attributes(items, limits)
    return conform(
        typed.select(
            F.col("page_id").alias("id"), "data_type_id",
            F.col("entity_type").alias("entity_type_id"), table_id().alias("table_id"), "name",
            "comment", "quark", "display_length", "format", "max", "min", "lookup_type_id",
        ),
        "attributes",
    )


def top_captions(captions: DataFrame) -> DataFrame:
    """``(page_id, title)``: the captions of the top row, left to right.

    Captions of one page are one bounded group, a page's bytes."""
    top = captions.where("y > 0").groupBy("page_id").agg(F.min("y").alias("y"))
    row = captions.where("not startswith(text, '[')").join(top, ["page_id", "y"])
    titles = row.groupBy("page_id").agg(
        F.array_sort(F.collect_list(F.struct("x", "pos", "text"))).alias("c")
    )
    pages = captions.select("page_id").distinct()
    return pages.join(titles, "page_id", "left").select(
        "page_id", F.coalesce(F.trim(F.array_join(F.col("c.text"), " ")), F.lit("")).alias("title")
    )


def view_owners(screens: DataFrame, screen_items: DataFrame, groups: DataFrame,
                items: DataFrame) -> DataFrame:
    """``(page_id, table_id, entity_type)``: by the group's date item, else by the
    first item on the screen that exists."""
    owner = items.select(
        F.col("page_id").alias("item_id"), table_id().alias("table_id"), "entity_type"
    )
    dated = groups.select("page_id", F.col("date_item").alias("item_id")).join(owner, "item_id")
    shown = screen_items.join(owner, "item_id").groupBy("page_id").agg(
        F.min_by(F.struct("table_id", "entity_type"), "pos").alias("s")
    )
    return (
        screens.select("page_id")
        .join(dated.select("page_id", F.struct("table_id", "entity_type").alias("d")),
              "page_id", "left")
        .join(shown, "page_id", "left")
        .select("page_id", F.coalesce("d", "s").alias("o"))
        .select("page_id", "o.*")
    )


def views(screens: DataFrame, screen_items: DataFrame, captions: DataFrame, groups: DataFrame,
          items: DataFrame, caption_pages: DataFrame | None = None) -> DataFrame:
    """Screens with an owner, named by the captions of their top row. ``caption_pages`` are
    the caption pages that exist: one without captions leaves the name empty, while a
    screen without a caption page goes by its own name."""
    owned = view_owners(screens, screen_items, groups, items).where(
        "table_id <> 0 and entity_type <> 0"
    )
    titles = top_captions(captions)
    if caption_pages is not None:
        titles = caption_pages.select("page_id").join(titles, "page_id", "left").select(
            "page_id", F.coalesce("title", F.lit("")).alias("title")
        )
    return conform(
        screens.join(owned, "page_id").join(titles, "page_id", "left").select(
            F.col("page_id").alias("id"), F.coalesce("title", "name").alias("name"),
            F.col("row_count").alias("n_rows"), F.col("item_count").alias("n_items"),
            "table_id", F.col("entity_type").alias("entity_type_id"),
        ),
        "views",
    )


def first_occurrences(placed: DataFrame) -> DataFrame:
    """First place of each ``(view_id, attribute_id)``, renumbered from 0 in the
    order of ``pos``."""
    usable = placed.where("attribute_id > 0 and x > 0 and y > 0")
    first = usable.groupBy("view_id", "attribute_id").agg(
        F.min_by(F.struct("pos", "x", "y"), "pos").alias("p")
    ).select("view_id", "attribute_id", "p.*")
    numbered = Ordered(first, ["view_id"], ["pos"]).row_number("seq").rows()
    return numbered.withColumn("seq", F.col("seq") - 1).drop("pos")


def view_attributes(screen_items: DataFrame) -> DataFrame:
    return conform(
        first_occurrences(
            screen_items.select(
                F.col("page_id").alias("view_id"), "pos", F.col("item_id").alias("attribute_id"),
                "x", "y",
            )
        ),
        "view_attributes",
    )


def number_captions(captions: DataFrame) -> DataFrame:
    """Captions with text and place, numbered from 0."""
    kept = captions.where("length(text) > 0 and x > 0 and y > 0")
    numbered = Ordered(kept, ["page_id"], ["pos"]).row_number("seq").rows()
    return numbered.withColumn("seq", F.col("seq") - 1)


def view_captions(captions: DataFrame) -> DataFrame:
    return conform(
        number_captions(captions).select(
            F.col("page_id").alias("view_id"), "seq", F.col("text").alias("caption"), "x", "y"
        ),
        "view_captions",
    )


def first_keys(keys: DataFrame, by: str, order: str) -> DataFrame:
    """The first row of each group by ``order``, whatever the size of the group."""
    rest = [c for c in keys.columns if c != by]
    return keys.groupBy(by).agg(F.min_by(F.struct(*rest), order).alias("k")).select(by, "k.*")


def index_types(definitions: DataFrame, keys: DataFrame) -> DataFrame:
    """One key per index definition: the first."""
    first = first_keys(keys.select("index_def", "page_id", "name", "entity_type", "prefix"),
                       "index_def", "page_id").withColumnRenamed("page_id", "key_page")
    return conform(
        definitions.join(first, definitions["page_id"] == first["index_def"]).select(
            F.col("index_def").alias("id"), F.col("entity_type").alias("entity_type_id"), "name",
            "prefix", F.col("id_line_screen").alias("id_line_view_id"),
        ),
        "index_types",
    )


def lookup_types(code_types: DataFrame) -> DataFrame:
    spark = code_types.sparkSession
    constant = literal(spark, [(DICT_LOOKUP_TYPE, "Dictionary code")], "id int, name string")
    return conform(
        constant.unionByName(code_types.select(F.col("page_id").cast("int").alias("id"), "name")),
        "lookup_types",
    )


def lookups(dictionary: DataFrame, codes: DataFrame) -> DataFrame:
    """Dictionary entries get negative ids, other codes keep theirs."""
    entries = dictionary.select(
        (-F.col("page_id")).alias("id"), F.lit(DICT_LOOKUP_TYPE).alias("lookup_type_id"),
        "name", F.lit("").alias("code"),
    )
    return conform(
        entries.unionByName(
            codes.select(
                F.col("page_id").alias("id"), F.col("code_type").alias("lookup_type_id"),
                "name", F.col("read_code").alias("code"),
            )
        ),
        "lookups",
    )


def filled_items(blocks: DataFrame) -> DataFrame:
    """Items with a name; ``seq`` counts all blocks, empty ones included."""
    return blocks.where("length(item_name) > 0").select(
        F.col("page_id").alias("menu_id"), F.col("pos").alias("seq"),
        F.col("item_name").alias("name"), "function", F.col("next_menu").alias("next_menu_id"),
        F.col("start_menu").alias("start_menu_id"),
        "parameter1", "parameter2", "parameter3", "parameter4",
    )


def menu_items(blocks: DataFrame) -> DataFrame:
    return conform(filled_items(blocks), "menu_items")


def user_starters(starters: DataFrame, menus: DataFrame) -> DataFrame:
    """Log-in records that open a menu which exists; no secret is carried over."""
    usable = starters.where("code_length > 1 and function_id = 1")
    there = menus.select(F.col("page_id").alias("function_parameter"))
    return conform(
        usable.join(there, "function_parameter", "left_semi").select(
            F.col("page_id").alias("id"), "user_name", F.col("function_parameter").alias("menu_id"),
            F.col("entity_type").alias("entity_type_id"),
            F.col("id_line_screen").alias("id_line_view_id"),
            F.col("index_def").alias("index_type_id"),
        ),
        "user_starters",
    )


def load_metadata(pages: Pages, spark: SparkSession) -> dict[str, DataFrame]:
    """All metadata tables of a page folder."""
    items = L.items(pages("ITEM"))
    valid = L.project(pages("VALID"), "VALID")
    entity = L.project(pages("ENTITY"), "ENTITY")
    screens = L.project(pages("SCREEN"), "SCREEN")
    screen_items = L.project_blocks(pages("SCREEN"), "SCREEN")
    groups = L.project(pages("TRGROUP"), "TRGROUP")
    captions = delimited_blocks(pages("SCRTXT"))
    menu_pages = L.project(pages("MENU"), "MENU")
    out = {
        "data_types": data_types(spark),
        "tables": tables(items, screens, groups, entity),
        "views": views(screens, screen_items, captions, groups, items, pages("SCRTXT")),
        "entity_types": entity_types(entity),
        "index_types": index_types(
            L.index_definitions(pages("IDXDEF")), L.project(pages("KEYDEF"), "KEYDEF")
        ),
        "attributes": attributes(items, valid),
        "view_attributes": view_attributes(screen_items),
        "view_captions": view_captions(captions),
        "lookup_types": lookup_types(L.project(pages("CODEDEF"), "CODEDEF")),
        "menu_items": menu_items(L.project_blocks(pages("MENU"), "MENU")),
        "user_starters": user_starters(L.project(pages("PASSWD"), "PASSWD"), menu_pages),
        "lookups": lookups(
            L.project(pages("DICT"), "DICT"), L.project(pages("CODES"), "CODES")
        ),
    }
    out["menus"] = own_menus(
        menus(menu_pages), out["menu_items"], out["user_starters"], out["views"], out["tables"]
    )
    return out
