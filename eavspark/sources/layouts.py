"""Field layouts of the page files, as data, and the one projection over them.

Offsets are zero-based from the start of the page (``FIELDS``) or of a block
(``BLOCKS``). All numbers below are fixed values of the file format.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavspark.functions import decode as D
from eavspark.operators.blocks import fixed_blocks

CATALOG = "BASE"
CATALOG_PAGE_LENGTH = 64  # fixed value: the one page length not in the catalog

# field name: (offset, kind) or (offset, "text", length); "rest" is text to the page's end
FIELDS: dict[str, dict[str, tuple]] = {
    "BASE": {"name": (0, "text", 16), "page_length": (24, "i16")},
    "DICT": {"name": (0, "text", 64)},
    "CODES": {"name": (0, "text", 80), "code_type": (80, "i16"), "read_code": (84, "text", 5)},
    "CODEDEF": {"name": (64, "text", 80)},
    "ENTITY": {
        "name": (0, "text", 16), "id_group": (16, "i16"), "id_item": (18, "i16"),
        "key_index_def": (20, "i16"), "default_index_def": (22, "i16"),
    },
    "ITEM": {
        "name_group": (0, "text", 2), "name_item": (2, "text", 4), "data_type": (7, "u8"),
        "sub_type": (8, "i16"), "display_length": (10, "i16"), "installed": (12, "bit", 8),
        "calculated": (12, "bit", 7), "indexed": (13, "bit", 1), "mandatory": (13, "bit", 2),
        "duplicate_index": (13, "bit", 3), "group_id": (14, "i16"), "date_item": (16, "i16"),
        "entity_type": (18, "i16"), "comment": (20, "text", 27),
    },
    "VALID": {
        "qualifier_type": (12, "i16"), "calc_quark": (14, "i16"), "modifier_type": (16, "i16"),
        "code_type": (32, "i16"), "min_raw": (32, "bytes", 8), "max_raw": (40, "bytes", 8),
    },
    "MENU": {"name": (0, "text", 20)},
    # the code itself (0,12) is a secret: only its length is read
    "PASSWD": {
        "code_length": (0, "length", 12), "function_id": (12, "i16"),
        "function_parameter": (14, "i16"), "privilege": (16, "u8"), "entity_type": (18, "i16"),
        "index_def": (20, "i16"), "id_line_screen": (22, "i16"), "user_name": (24, "text", 4),
    },
    "IDXDEF": {
        "stated_length": (0, "u16"), "partial_match": (2, "bit", 1), "start_page": (4, "i32"),
        "middle_page": (8, "i32"), "id_line_screen": (16, "i16"),
    },
    "INDEX": {
        "prev_id": (0, "i32"), "next_id": (4, "i32"), "blocks_on_page": (12, "i16"),
        "index_def": (14, "i16"),
    },
    "SCREEN": {"name": (0, "text", 24), "row_count": (26, "i16"), "item_count": (28, "i16")},
    "SCRTXT": {},
    "TRGROUP": {"name": (0, "text", 30), "date_item": (34, "i16"), "time_item": (36, "i16")},
    "PATSTS": {"status": (1, "u8"), "millis": (32, "u32"), "days": (36, "u16")},
    "KEYDEF": {
        "index_def": (0, "i16"), "match_item1": (2, "i16"), "match_item2": (4, "i16"),
        "priv": (6, "i16"), "key_length": (9, "u8"), "type1": (10, "i8"), "type2": (11, "i8"),
        "prefix": (12, "text", 1), "entity_type": (14, "i16"), "name": (16, "rest"),
    },
    "FRTEXT": {
        "next_id": (0, "i32"), "line_count": (6, "u8"), "entity_id": (8, "i32"),
        "page_sequence": (16, "i16"),
    },
    "VRX": {"first_data_page": (4, "i32")},
    "DATA": {
        "next_id": (0, "i32"), "free_bytes": (6, "i16"), "entity_id": (8, "i32"),
        "high_item": (12, "i16"), "low_item": (16, "i16"),
    },
}

# file: (header length, block length, fields of a block)
BLOCKS: dict[str, tuple[int, int, dict[str, tuple]]] = {
    "MENU": (20, 32, {
        "item_name": (0, "text", 12), "flags": (13, "u8"), "priv1": (14, "u8"), "priv2": (15, "u8"),
        "function": (16, "text", 4), "parameter1": (20, "i16"), "parameter2": (22, "i16"),
        "parameter3": (24, "i16"), "parameter4": (26, "i16"), "start_menu": (28, "i16"),
        "next_menu": (30, "i16"),
    }),
    "SCREEN": (48, 10, {"item_id": (0, "i16"), "x": (3, "u8"), "y": (5, "u8")}),
    "TRGROUP": (64, 2, {"item_id": (0, "i16")}),
    "VRX": (0, 8, {"max_item": (0, "i16"), "data_page_count": (2, "i16"), "data_page": (4, "i32")}),
}

INDEX_HEADER = 20


def field(b: Column, spec: tuple, charset: str = "ascii", endian: str = "big") -> Column:
    off, kind = spec[0], spec[1]
    if kind == "text":
        return D.ascii_trim(b, off, spec[2], charset)
    if kind == "rest":
        return D.ascii_trim(b, off, F.length(b) - off, charset)
    if kind == "length":
        return F.length(F.rtrim(D.latin1(D.part(b, off, spec[2])), F.lit("\0")))
    if kind == "bytes":
        return D.part(b, off, spec[2])
    if kind == "bit":
        return D.bit(b, off, spec[2])
    if kind == "u8":
        return D.u8(b, off).cast("int")
    if kind == "i8":
        return D.i8(b, off).cast("int")
    read = {"u16": D.u16, "i16": D.i16, "u32": D.u32, "i32": D.i32}[kind]
    return read(b, off, endian).cast("bigint" if kind == "u32" else "int")


def project(
    pages: DataFrame, name: str, *, keep_bytes: bool = False, only: tuple[str, ...] = (),
    charset: str = "ascii", endian: str = "big",
) -> DataFrame:
    """Header fields of file ``name``: one select over ``(page_id, bytes)``."""
    specs: Mapping[str, tuple] = FIELDS[name]
    columns = [
        field(F.col("bytes"), spec, charset, endian).alias(column)
        for column, spec in specs.items()
        if not only or column in only
    ]
    if keep_bytes:
        columns.append(F.col("bytes"))
    return pages.select("page_id", *columns)


_WIDTHS = {"u8": 1, "i8": 1, "bit": 1, "u16": 2, "i16": 2, "u32": 4, "i32": 4}


def head_length(name: str) -> int:
    """Bytes from the start of a page that hold all header fields of file ``name``."""
    return max(spec[0] + (_WIDTHS.get(spec[1]) or spec[2]) for spec in FIELDS[name].values())


def project_blocks(
    pages: DataFrame, name: str, *, charset: str = "ascii", endian: str = "big"
) -> DataFrame:
    """Fixed blocks of file ``name`` as ``(page_id, pos, fields...)``."""
    header, length, specs = BLOCKS[name]
    until = None
    if name == "VRX":
        until = lambda block: D.i16(block, 0, endian) <= 0
    rows = fixed_blocks(pages, header, length, until=until)
    return rows.select(
        "page_id", "pos",
        *[
            field(F.col("block"), spec, charset, endian).alias(column)
            for column, spec in specs.items()
        ],
    )


def items(pages: DataFrame) -> DataFrame:
    """Items with their composed name and the key-date flag."""
    return (
        project(pages, "ITEM")
        .withColumn("name", F.concat_ws(".", "name_group", "name_item"))
        .withColumn("is_key_date", F.col("date_item") == F.col("page_id"))
    )


def entity_status(pages: DataFrame) -> DataFrame:
    """``(page_id, status, updated)``."""
    return project(pages, "PATSTS").select(
        "page_id", "status", D.legacy_timestamp(F.col("days"), F.col("millis")).alias("updated")
    )


def index_definitions(pages: DataFrame) -> DataFrame:
    return project(pages, "IDXDEF").withColumn("key_length", D.key_length(F.col("stated_length")))
