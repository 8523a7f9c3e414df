"""The query surface: long and wide views of stored values.

All functions take a :class:`~eavspark.store.Store` and a set of entities (one id,
a list of ids, a DataFrame of ids, or None for all). Attribute lists of one logical
table come from the metadata, whose ids are 16-bit, so they are collected to name
the columns of a grid and to push the ids into the scans.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from eavspark import schemas as S
from eavspark.functions import decode as D
from eavspark.schemas import VALUE_KEY
from eavspark.store import Store

SCREEN_ROWS = 18  # height of a screen, the page size where nothing else is stated

Entities = int | Iterable[int] | DataFrame | None


def restrict(df: DataFrame, entities: Entities, column: str = "entity_id") -> DataFrame:
    if entities is None:
        return df
    if isinstance(entities, DataFrame):
        ids = entities.select(F.col(entities.columns[0]).alias(column)).distinct()
        return df.join(ids, column, "left_semi")
    if isinstance(entities, int):
        return df.where(F.col(column) == entities)
    return df.where(F.col(column).isin(list(entities)))


def number_text(x: Column) -> Column:
    """Decimal text, without exponent, that reads back as the number."""
    short = x.cast("string")
    form = r"^(-?)(\d+)\.(\d+)E(-?\d+)$"
    sign, one, rest = (F.regexp_extract(short, form, i) for i in (1, 2, 3))
    power = F.regexp_extract(short, form, 4).try_cast("int")
    rest = F.regexp_replace(rest, "0+$", "")
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), one, rest)
    more = power - F.length(rest)  # zeros behind the digits
    large = F.when(more >= 0, F.concat(one, rest, F.repeat(F.lit("0"), more))).otherwise(
        F.concat(one, F.substr(rest, F.lit(1), power), F.lit("."), F.substr(rest, power + 1))
    )
    # most numbers have no exponent, and these branches are not taken for them
    return F.when(F.instr(short, "E") > 0, F.concat(sign, F.when(power < 0, small).otherwise(large))).otherwise(
        F.regexp_replace(short, r"\.0$", "")
    )


def date_text(value: Column, fmt: Column) -> Column:
    return F.when(fmt == "dd.MM.yy", F.date_format(value, "dd.MM.yy")).otherwise(
        F.date_format(value, "dd.MM.yyyy")
    )


def time_of_day(seconds: Column, fmt: Column) -> Column:
    clock = F.lpad(F.floor(seconds / 3600).cast("string"), 2, "0")
    minute = F.lpad((F.floor(seconds / 60) % 60).cast("string"), 2, "0")
    return F.concat(clock, F.when(fmt == "hhmm", "").otherwise(":"), minute)


def attributes_of(store: Store, ids: Sequence[int] | None = None) -> DataFrame:
    """Attribute columns needed for display."""
    attributes = store["attributes"].select(
        F.col("id").alias("attribute_id"), "name", "data_type_id", "format"
    )
    if ids is not None:
        attributes = attributes.where(F.col("attribute_id").isin(list(ids)))
    return attributes


def display_values(
    store: Store, attribute_ids: Sequence[int] | None = None, entities: Entities = None,
    seqs: tuple[int, int] | None = None,
) -> DataFrame:
    """``(entity_id, attribute_id, seq, name, data_type_id, display)``.

    Filters on attribute, entity and row range reach every value table; of few listed
    attributes each table is asked for those of its types alone, and what is to be known
    of them stands in the plan. Only types stored in two tables (entity links, qualified
    numbers) are merged, which costs them a shuffle on the key; all others pass straight
    through.
    """
    known = _listed(store, attribute_ids)

    def values(table: str, *wanted: int, but: int | None = None) -> DataFrame:
        """Values of attributes of the wanted types (of all but one), with name, type and format."""
        ok = F.col("data_type_id").isin(*wanted) if wanted else F.col("data_type_id") != but if but else F.lit(True)
        ids, df = attribute_ids, store[table]
        if known is not None:
            ids = [i for i, a in known.items() if (a.data_type_id in wanted if wanted else a.data_type_id != but)]
        if ids is not None:
            df = df.where(F.col("attribute_id").isin(list(ids)))
        if seqs is not None:
            df = df.where(F.col("seq").between(*seqs))
        df = restrict(df, entities)
        if known is None or len(known) > FEW:
            return df.join(attributes_of(store, attribute_ids), "attribute_id").where(ok)
        return df.select("*", *[_of_attribute({i: getattr(known[i], c) for i in ids}, kind).alias(c) for c, kind in ATTRIBUTE])

    carried = [*VALUE_KEY, "name", "data_type_id"]
    kind, fmt = F.col("data_type_id"), F.col("format")

    def shown(df: DataFrame, display: Column) -> DataFrame:
        return df.select(*carried, display.alias("display"))

    held = None if known is None else {a.data_type_id for a in known.values()}

    def any_of(*kinds: int) -> bool:
        """Branches for types that no wanted attribute has are not planned at all."""
        return held is None or bool(held & set(kinds))

    def coded(*wanted: int, but: int | None = None) -> DataFrame:
        # neither side is assumed small: AQE broadcasts or splits by what it measures
        names = store["lookups"].select(
            F.col("id").alias("lookup_id"), F.col("name").alias("lookup_name")
        )
        text = F.coalesce("lookup_name", F.col("lookup_id").cast("string"))
        return values("value_lookups", *wanted, but=but).join(names, "lookup_id", "left").withColumn("text", text)

    value = F.col("value")
    out: list[DataFrame] = []
    if any_of(S.TEXT, S.TIME):
        out.append(shown(values("value_texts", S.TEXT, S.TIME), value))
    if any_of(S.LONG_TEXT):
        out.append(shown(values("value_long_texts"), value))
    if any_of(S.NUMERIC):
        numbers = values("value_numbers", but=S.QUALIFIED)
        out.append(shown(numbers, number_text(value)))
    if any_of(S.DATE):
        out.append(shown(values("value_dates"), date_text(value, fmt)))
    if any_of(S.TIME):
        out.append(shown(values("value_times"), time_of_day(value, fmt)))
    if any_of(S.LOOKUP):
        out.append(shown(coded(but=S.QUALIFIED), F.col("text")))

    # types stored in two tables: the first text stands before the second
    first: list[DataFrame] = []
    second: list[DataFrame] = []
    if any_of(S.ENTITY_PTR):
        names = store["entities"].select(
            F.col("id").alias("linked_entity_id"), F.col("name").alias("entity_name")
        )
        linked = values("value_entities", S.ENTITY_PTR).join(names, "linked_entity_id", "left")
        first.append(shown(linked, F.col("entity_name")))
        second.append(shown(values("value_texts", S.ENTITY_PTR), value))
    if any_of(S.QUALIFIED):
        first.append(shown(coded(S.QUALIFIED), F.col("text")))
        numbers = values("value_numbers", S.QUALIFIED)
        second.append(shown(numbers, number_text(value)))
    if first:
        pieces = reduce(
            DataFrame.unionByName,
            [p.withColumn("rank", F.lit(0)) for p in first]
            + [p.withColumn("rank", F.lit(1)) for p in second],
        )
        a, b = (F.max(F.when(F.col("rank") == r, F.col("display"))) for r in (0, 1))
        merged = pieces.groupBy(*carried).agg(a.alias("_a"), b.alias("_b"))
        both = F.when(kind == S.ENTITY_PTR, F.coalesce("_a", "_b")).otherwise(
            F.concat_ws(" ", "_a", "_b")
        )
        out.append(merged.select(*carried, both.alias("display")))
    if not out:  # no such attributes
        return shown(values("value_texts"), value)
    return reduce(DataFrame.unionByName, out)


FEW = 64  # attributes whose figures stand in the plan instead of being joined

ATTRIBUTE = [("name", "string"), ("data_type_id", "smallint"), ("format", "string")]


def _listed(store: Store, attribute_ids: Sequence[int] | None) -> dict[int, Row] | None:
    """Listed attributes by id: a table or a view has a bounded number."""
    if attribute_ids is None:
        return None
    return {r.attribute_id: r for r in attributes_of(store, attribute_ids).collect()}


def _of_attribute(figures: dict[int, object], kind: str) -> Column:
    """The figure of a row's attribute, as a case over their ids."""
    out = F.lit(None)
    for i, figure in figures.items():
        out = F.when(F.col("attribute_id") == i, F.lit(figure)).otherwise(out)
    return out.cast(kind)


def table_attributes(store: Store, table_id: int) -> list[tuple[int, str]]:
    """``(id, name)`` of a logical table's attributes, by id."""
    rows = store["attributes"].where(F.col("table_id") == table_id).select("id", "name").collect()
    return sorted((r.id, r.name) for r in rows)


def view_attributes(store: Store, view_id: int) -> list[tuple[int, str]]:
    """``(id, name)`` of a view's attributes, in view order."""
    placed = store["view_attributes"].where(F.col("view_id") == view_id)
    named = store["attributes"].select(F.col("id").alias("attribute_id"), "name")
    rows = placed.join(named, "attribute_id").select(
        "seq", "attribute_id", "name"
    )
    return [(r.attribute_id, r.name) for r in sorted(rows.collect(), key=lambda r: r.seq)]


def key_date_attribute(store: Store, table_id: int) -> int | None:
    row = store["tables"].where(F.col("id") == table_id).select("date_attribute_id").first()
    return row.date_attribute_id if row and row.date_attribute_id else None


def page_rows(page: int | None, size: int) -> tuple[int, int] | None:
    """First and last row number of a 1-based page; all rows for None."""
    return None if page is None else ((page - 1) * size + 1, page * size)


def _dated(store: Store, values: DataFrame, table_id: int, entities: Entities, seqs) -> DataFrame:
    """Add the key date of each row of the table (none for static tables)."""
    attribute = key_date_attribute(store, table_id)
    if attribute is None:
        return values.withColumn("key_date", F.lit(None).cast("date"))
    dates = restrict(store["value_dates"].where(F.col("attribute_id") == attribute), entities)
    if seqs is not None:
        dates = dates.where(F.col("seq").between(*seqs))
    dates = dates.select("entity_id", "seq", F.col("value").alias("key_date"))
    # both sides spread over (entity, row), also where one entity holds very many rows
    return values.join(dates, ["entity_id", "seq"], "left")


def table_values(
    store: Store, table_id: int, entities: Entities = None, page: int | None = None,
    page_size: int = SCREEN_ROWS,
) -> DataFrame:
    """``(entity_id, seq, key_date, attribute_id, name, display_value)``."""
    ids = [i for i, _ in table_attributes(store, table_id)]
    seqs = page_rows(page, page_size)
    values = display_values(store, ids, entities, seqs)
    return _dated(store, values, table_id, entities, seqs).select(
        "entity_id", "seq", "key_date", "attribute_id", "name",
        F.col("display").alias("display_value"),
    )


def view_values(
    store: Store, view_id: int, entities: Entities = None, page: int | None = None
) -> DataFrame:
    """:func:`table_values` of a view's attributes with their place on the screen."""
    view = store["views"].where(F.col("id") == view_id).select("table_id", "n_rows").first()
    seqs = page_rows(page, view.n_rows or SCREEN_ROWS)
    ids = [i for i, _ in view_attributes(store, view_id)]
    values = display_values(store, ids, entities, seqs)
    placed = store["view_attributes"].where(F.col("view_id") == view_id).select(
        "attribute_id", F.col("seq").alias("view_seq"), "x", "y"
    )
    return _dated(store, values, view.table_id, entities, seqs).join(
        placed, "attribute_id"
    ).select(
        "entity_id", "seq", "key_date", "view_seq", "x", "y", "attribute_id", "name",
        F.col("display").alias("display_value"),
    )


def pivot(
    values: DataFrame, columns: Sequence[tuple[int, str]], group: Sequence[str]
) -> DataFrame:
    """One row per ``group``, one column per attribute, in the given order.

    The values of a row meet in one aggregation: one shuffle, on the row, with
    partial results before it. A row has at most one value per attribute."""
    cells = F.map_from_entries(F.collect_list(F.struct("attribute_id", "display")))
    rows = values.groupBy(*group).agg(cells.alias("_cells"))
    return rows.select(
        *group,
        *[F.try_element_at("_cells", F.lit(i).cast("smallint")).alias(n) for i, n in columns],
    )


def _crosstab(
    store: Store, columns: Sequence[tuple[int, str]], entities: Entities, start_row: int,
    rows: int | None,
) -> DataFrame:
    last = (1 << 31) - 1 if rows is None else start_row + rows - 1
    seqs = None if rows is None and start_row == 1 else (start_row, last)
    values = display_values(store, [i for i, _ in columns], entities, seqs)
    return pivot(values, columns, ["entity_id", "seq"])


def table_values_crosstab(
    store: Store, table_id: int, entities: Entities = None, start_row: int = 1,
    rows: int | None = None,
) -> DataFrame:
    """One row per entity and row number, one column per attribute of the table."""
    return _crosstab(store, table_attributes(store, table_id), entities, start_row, rows)


def view_values_crosstab(
    store: Store, view_id: int, entities: Entities = None, start_row: int = 1,
    rows: int | None = None,
) -> DataFrame:
    """Columns as placed on the view."""
    return _crosstab(store, view_attributes(store, view_id), entities, start_row, rows)


def cohort_grid(
    store: Store, attribute_ids: Sequence[int], entities: Entities = None
) -> DataFrame:
    """Static attributes of many entities, one row each."""
    named = dict(
        (r.attribute_id, r.name) for r in attributes_of(store, attribute_ids).collect()
    )
    columns = [(i, named[i]) for i in attribute_ids]
    values = display_values(store, attribute_ids, entities, (1, 1))
    return pivot(values, columns, ["entity_id"])


def id_line(store: Store, entity_type_id: int, entities: Entities = None) -> DataFrame:
    """Banner of an entity: the values of its ID-line view in view order."""
    row = (
        store["entity_types"].where(F.col("id") == entity_type_id)
        .select("id_line_view_id").first()
    )
    wide = view_values_crosstab(store, row.id_line_view_id, entities, 1, 1)
    cells = [F.col(f"`{c}`") for c in wide.columns if c not in ("entity_id", "seq")]
    return wide.select("entity_id", F.concat_ws(" ", *cells).alias("id_line"))


def find_entities(
    store: Store, term: str, *, prefix: bool = False, index_type_id: int | None = None
) -> DataFrame:
    """Entities by search term, whole or as a prefix, without regard to case.

    The stored terms are sorted by their folded form. A prefix is a half-open range of
    it, which reaches the scan and skips files and row groups."""
    if store.holds("terms"):
        terms = store["terms"]
    else:
        terms = store["indexes"].withColumn("folded", D.fold(F.col("term")))
    if index_type_id is not None:
        terms = terms.where(F.col("index_type_id") == index_type_id)
    wanted = store.spark.createDataFrame([(term,)], "t string").select(D.fold(F.col("t"))).first()[0]
    folded = F.col("folded")
    if not prefix:
        terms = terms.where(folded == wanted)
    else:
        terms, beyond = terms.where(folded >= wanted), after_prefix(wanted)
        terms = terms if beyond is None else terms.where(folded < beyond)
    return terms.select("index_type_id", "term", "entity_id").distinct()


def after_prefix(prefix: str) -> str | None:
    """The least text above all that start with ``prefix``; none if there is no such text."""
    for at in range(len(prefix) - 1, -1, -1):
        code = ord(prefix[at]) + 1
        if code <= 0x10FFFF:
            return prefix[:at] + chr(0xE000 if 0xD800 <= code <= 0xDFFF else code)  # no surrogates
    return None


def key_date_series(
    store: Store, attribute_id: int, date_attribute_id: int, entities: Entities = None
) -> DataFrame:
    """``(entity_id, seq, key_date, value)`` of one numeric attribute over time."""
    numbers = restrict(store["value_numbers"].where(F.col("attribute_id") == attribute_id), entities)
    dates = restrict(store["value_dates"].where(F.col("attribute_id") == date_attribute_id), entities)
    return numbers.select("entity_id", "seq", "value").join(
        dates.select("entity_id", "seq", F.col("value").alias("key_date")), ["entity_id", "seq"]
    )
