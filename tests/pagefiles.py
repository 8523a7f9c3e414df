"""A small system of page files, made by hand for the tests."""

from __future__ import annotations

import os
import struct

LENGTHS = {
    "DICT": 64, "CODES": 96, "CODEDEF": 160, "ENTITY": 32, "ITEM": 64, "VALID": 64, "MENU": 148,
    "PASSWD": 32, "IDXDEF": 32, "INDEX": 104, "SCREEN": 128, "SCRTXT": 128, "TRGROUP": 96,
    "PATSTS": 64, "KEYDEF": 64, "FRTEXT": 64, "VRX": 64, "DATA": 96,
}


def u16(n):
    return (n & 0xFFFF).to_bytes(2, "big")


def u32(n):
    return (n & 0xFFFFFFFF).to_bytes(4, "big")


def lay(length, *fields):
    page = bytearray(length)
    for at, raw in fields:
        page[at:at + len(raw)] = raw
    assert len(page) == length
    return bytes(page)


def item(name, kind, sub=0, length=10, group=0, date=0, entity=1, comment=b"", installed=True,
         calculated=False):
    flags = (0x80 if installed else 0) | (0x40 if calculated else 0)
    return lay(64, (0, name), (7, bytes([kind])), (8, u16(sub)), (10, u16(length)),
               (12, bytes([flags])), (14, u16(group)), (16, u16(date)), (18, u16(entity)),
               (20, comment))


def block(number, value=b"", rep=None):
    size = len(value) + 3 + (rep is not None)
    control = size | (0x80 if rep is not None else 0)
    return u16(number) + bytes([control]) + value + (bytes([rep]) if rep is not None else b"")


def data_page(entity, following, *blocks, high=None):
    body = b"".join(blocks)
    last = struct.unpack(">H", blocks[-1][:2])[0]
    return lay(96, (0, u32(following)), (6, u16(96 - 16 - len(body))), (8, u32(entity)),
               (12, u16(high or last)), (16, body))


def index_page(before, after, definition, keys, size=20):
    body = b"".join(u32(e) + k.ljust(size - 4, b"\0") for e, k in keys)
    return lay(104, (0, u32(before)), (4, u32(after)), (12, u16(len(keys))),
               (14, u16(definition)), (20, body))


def pages():
    blank = lambda name: bytes(LENGTHS[name])
    out = {
        "DICT": [lay(64, (0, b"Main hospital")), blank("DICT"), lay(64, (0, b"Clinic"))],
        "CODES": [lay(96, (0, b"less than"), (80, u16(2)), (84, b"LT...")),
                  lay(96, (0, b"Diabetes"), (80, u16(1)), (84, b"C10..junk"[:5]))],
        "CODEDEF": [lay(160, (64, b"Diagnosis")), lay(160, (64, b"Qualifier"))],
        "ENTITY": [
            lay(32, (0, b"Patient"), (16, u16(1)), (18, u16(1)), (20, u16(1)), (22, u16(2))),
            lay(32, (0, b"GP"), (16, u16(0)), (18, u16(13)), (20, u16(3)), (22, u16(3)))],
        "ITEM": [
            item(b"PANAME", 1),
            item(b"PASIZE", 3, sub=1),
            item(b"PALEVL", 5, sub=1),
            item(b"PAHOSP", 7),
            item(b"HADATE", 8, length=8, group=2, date=5, comment=b"Date of haematology test"),
            item(b"HATIME", 9, length=4, group=2, date=5),
            item(b"PANOTE", 10),
            item(b"PAGP", 11, sub=2),
            item(b"PADIAG", 12),
            item(b"PAOLD", 1, installed=False),
            item(b"HAWBC", 6, sub=2, group=2, date=5),
            item(b"PACALC", 2, calculated=True),
            item(b"GPNAME", 1, entity=2),
        ],
        "VALID": [
            blank("VALID"),
            lay(64, (32, u16(-5)), (40, u16(300))),
            lay(64, (12, u16(2)), (32, struct.pack(">f", 1.0)), (40, struct.pack(">f", 9.5))),
            lay(64, (32, u16(1)), (40, u16(3))),
            *[blank("VALID")] * 4,
            lay(64, (32, u16(1))),
            blank("VALID"),
            lay(64, (32, struct.pack(">d", 0.0)), (40, struct.pack(">d", 10.0))),
            lay(64, (14, u16(77))),
        ],
        "MENU": [
            lay(148, (0, b"Start"),
                (20, lay(32, (0, b"Next"), (16, b"MENU"), (30, u16(2)))),
                (52, lay(32, (16, b"MENU"))),
                (84, lay(32, (0, b"To GP"), (16, b"CHGE"), (20, u16(2)), (30, u16(3)))),
                (116, lay(32, (0, b"Far"), (16, b"MENU"), (30, u16(4))))),
            lay(148, (0, b"Second"), (20, lay(32, (0, b"Last"), (16, b"MENU"), (30, u16(4))))),
            lay(148, (0, b"GP menu"), (20, lay(32, (0, b"On"), (16, b"MENU"), (30, u16(5))))),
            lay(148, (0, b"Screens"), (20, lay(32, (0, b"Show"), (16, b"QUIT")))),
            lay(148, (0, b"Grid"), (20, lay(32, (0, b"Grid"), (16, b"SCRN"), (20, u16(2))))),
        ],
        "PASSWD": [
            lay(32, (0, b"secret"), (12, u16(1)), (14, u16(1)), (18, u16(1)), (20, u16(2)),
                (22, u16(1)), (24, b"ANNA")),
            lay(32, (0, b"x"), (12, u16(1)), (14, u16(1))),
            lay(32, (0, b"secret"), (12, u16(0)), (14, u16(1))),
            lay(32, (0, b"secret"), (12, u16(1)), (14, u16(99))),
        ],
        # stated lengths 10: blocks of 20 bytes
        "IDXDEF": [
            lay(32, (0, u16(10)), (2, b"\1"), (4, u32(1)), (16, u16(1))),
            lay(32, (0, u16(10)), (4, u32(2)), (16, u16(1))),
            lay(32, (0, u16(10)), (4, u32(4)), (16, u16(0)))],
        "KEYDEF": [
            lay(64, (0, u16(2)), (14, u16(1)), (12, b"N"), (16, b"Patient name")),
            lay(64, (0, u16(1)), (14, u16(1)), (16, b"Hospital number")),
            lay(64, (0, u16(2)), (14, u16(1)), (16, b"Second key of the index")),
            lay(64, (0, u16(3)), (14, u16(2)), (16, b"GP code"))],
        "INDEX": [
            index_page(0, 0, 1, [(1, b"H001"), (2, b"H002")]),
            index_page(0, 3, 2, [(2, b"Brown"), (2, b"Brown Bob"), (1, b"Smith")]),
            index_page(2, 0, 2, [(1, b"Smith John"), (2, b"Zed")]),
            index_page(0, 0, 3, [(3, b"GP7")]),
        ],
        "SCREEN": [
            lay(128, (0, b"Banner"), (26, u16(1)), (28, u16(2)),
                (48, u16(1) + bytes([0, 4, 0, 1, 0, 0, 0, 0])),
                (58, u16(4) + bytes([0, 30, 0, 1, 0, 0, 0, 0]))),
            lay(128, (0, b"Blood"), (26, u16(10)), (28, u16(3)),
                (48, u16(5) + bytes([0, 1, 0, 3, 0, 0, 0, 0])),
                (58, u16(11) + bytes([0, 12, 0, 3, 0, 0, 0, 0])),
                (68, u16(11) + bytes([0, 40, 0, 3, 0, 0, 0, 0])),
                (78, u16(6) + bytes([0, 20, 0, 3, 0, 0, 0, 0]))),
            lay(128, (0, b"Lost"), (48, u16(90) + bytes(8)))],
        "SCRTXT": [
            lay(128, (0, b"\0\3\1Name\5\x1e\1Hospital")),
            lay(128, (0, b"\0\x0c\1WBC\5\1\1Date\5\x14\1[x\5\5\5Time")),
        ],
        "TRGROUP": [
            blank("TRGROUP"),
            lay(96, (0, b"Haematology"), (34, u16(5)), (64, u16(5) + u16(6) + u16(11)))],
        "PATSTS": [
            lay(64, (1, b"\1"), (32, u32(60_000)), (36, u16(60000))),
            lay(64, (1, b"\1"), (32, u32(120_000)), (36, u16(60000))),
            lay(64, (1, b"\1"), (32, u32(0)), (36, u16(59999))),
            blank("PATSTS")],
        "VRX": [
            lay(64, (0, u16(6)), (2, u16(1)), (4, u32(1)), (8, u16(11)), (10, u16(1)), (12, u32(3))),
            lay(64, (0, u16(11)), (4, u32(2))),
            lay(64, (0, u16(13)), (4, u32(5))),
            lay(64, (0, u16(1)), (4, u32(1)))],
        "FRTEXT": [
            lay(64, (0, u32(2)), (8, u32(1)), (32, b"line1\0line2\x7f")),
            lay(64, (6, b"\1"), (8, u32(1)), (32, b"more")),
            lay(64, (8, u32(2)), (32, b"other"))],
        "DATA": [
            # entity 1, first page
            data_page(1, 3, block(1, b"Smith J\xe9"), block(2, b"\xff\xfb"),
                      block(3, struct.pack(">f", 5.5) + u16(2) + u16(0) + u32(1)),
                      block(4, u16(3)), block(5, u16(60000)), block(5, u16(59000), rep=2),
                      block(6, b"\x20")),
            # entity 2
            data_page(2, 4, block(1, b"Brown"), block(2, b"\x01"), block(3, b"\0"),
                      block(5, u16(58000)), block(7, u32(1)), block(8, b"gp9")),
            # entity 1, second page: rows of item 6 go on
            data_page(1, 0, block(6, b"", rep=1), block(6, b"\x02\x40\xc8\x40"),
                      block(7, u32(1)), block(8, b"gp7"), block(9, u32(2)),
                      block(11, struct.pack(">d", 11.125)[:4]), block(11, b"\x7f\xf0")),
            # entity 2, second page; items fall back
            data_page(2, 0, block(9, b"\0"), block(5, u16(1)), block(9, u32(1)),
                      block(11, struct.pack(">d", 7.25)[:2]), high=11),
            data_page(3, 0, block(13, b"Doctor Seven")),
            # a page nobody points to
            data_page(1, 1, block(1, b"stale")),
        ],
    }
    out["BASE"] = [
        lay(64, (0, f"{n}.DBS".encode()), (24, u16(length))) for n, length in LENGTHS.items()]
    return out


def write(folder, changes=None):
    """Write all files; ``changes`` maps file name to a list of pages."""
    os.makedirs(folder, exist_ok=True)
    for name, content in {**pages(), **(changes or {})}.items():
        with open(os.path.join(folder, f"{name}.DBS"), "wb") as f:
            f.write(b"".join(content))
            f.write(b"\1")  # a partial page at the end does not count
