"""Blocks, row numbers and the order guard, also where groups are cut in slices."""

import random

import pytest
from pyspark.sql import functions as F

from eavspark.operators import blocks as B
from eavspark.operators.ordered import Ordered, row_number

HEADER = bytes(16)
RUNS = bytes.fromhex("000a06616263" "000a8403" "000a047a" "000b857102" "000b03" "000b0477")


def test_run_length_vector(spark):
    page = bytes(6) + (0).to_bytes(2, "big") + bytes(8) + RUNS
    df = spark.createDataFrame([(1, 0, bytearray(page))], "entity_id long, chain_pos int, bytes binary")
    blocks = B.rle_blocks(df)
    got = [(r.item_id, r.rep, bytes(r.v)) for r in blocks.orderBy("pos").collect()]
    assert got == [(10, 1, b"abc"), (10, 3, b""), (10, 1, b"z"), (11, 2, b"q"), (11, 1, b""), (11, 1, b"w")]
    kept = B.guard_ascending(B.by_entity(blocks))
    rows = B.expand_rows(B.number_rows(kept).df).collect()
    assert sorted((r.item_id, r.seq, bytes(r.v)) for r in rows) == [
        (10, 1, b"abc"), (10, 5, b"z"), (11, 1, b"q"), (11, 2, b"q"), (11, 4, b"w")]


def python_blocks(page, first=16):
    free = int.from_bytes(page[6:8], "big", signed=True)
    end, at, out = min(len(page), len(page) - free), first, []
    while at + 3 <= len(page):
        control = page[at + 2]
        repeated, length = control & 0x80, control & 0x7F
        size = length - 3 - (1 if repeated else 0)
        if control == 0 or size < 0 or at + length > len(page):
            break
        rep = (page[at + length - 1] or 256) if repeated else 1
        out.append((int.from_bytes(page[at:at + 2], "big", signed=True), rep, page[at + 3:at + 3 + size]))
        at += length
        if at + 3 > end:
            break
    return out


def test_run_length_against_a_plain_loop(spark):
    rnd = random.Random(5)
    pages = []
    for i in range(300):
        body = b""
        while len(body) < rnd.randint(0, 200):
            v = bytes(rnd.randrange(256) for _ in range(rnd.randint(0, 12)))
            if rnd.random() < 0.3:
                body += rnd.randrange(1, 400).to_bytes(2, "big") + bytes([0x80 | (len(v) + 4)]) + v + bytes([rnd.randrange(256)])
            else:
                body += rnd.randrange(1, 400).to_bytes(2, "big") + bytes([len(v) + 3]) + v
        page = bytes(6) + bytes(2) + bytes(8) + body
        page = page.ljust(256, b"\0")
        page = page[:6] + (256 - 16 - len(body)).to_bytes(2, "big", signed=True) + page[8:]
        pages.append((i, 0, bytearray(page)))
    df = spark.createDataFrame(pages, "entity_id long, chain_pos int, bytes binary")
    got = {}
    for r in B.rle_blocks(df).orderBy("entity_id", "pos").collect():
        got.setdefault(r.entity_id, []).append((r.item_id, r.rep, bytes(r.v)))
    for i, _, page in pages:
        assert got.get(i, []) == python_blocks(bytes(page))


def test_values_of_excluded_items_are_not_read(spark):
    page = bytes(16) + RUNS
    df = spark.createDataFrame([(1, 0, bytearray(page))], "entity_id long, chain_pos int, bytes binary")
    rows = B.rle_blocks(df, without_value=[10]).collect()
    assert [bytes(r.v) for r in rows if r.item_id == 10] == [b"", b"", b""]
    assert [bytes(r.v) for r in rows if r.item_id == 11] == [b"q", b"", b"w"]


def test_delimited_vector(spark):
    page = bytes.fromhex("000301") + b"HB" + bytes.fromhex("050901") + b"WBC" + bytes.fromhex("050505") + b"Note" + bytes(9)
    df = spark.createDataFrame([(1, bytearray(page)), (2, bytearray(b"\0\1\1A\5"))], "page_id long, bytes binary")
    got = [(r.page_id, r.x, r.y, r.text) for r in B.delimited_blocks(df).orderBy("pos").collect()]
    assert got == [(1, 3, 1, "HB"), (1, 9, 1, "WBC"), (1, 5, 5, "Note")]


def test_fixed_blocks_stop_early(spark):
    page = bytes(2) + bytes([1, 2, 3, 0, 5, 9])
    df = spark.createDataFrame([(1, bytearray(page)), (2, bytearray(b"\0"))], "page_id long, bytes binary")
    rows = B.fixed_blocks(df, 2, 1, until=lambda b: F.hex(b) == "00").orderBy("pos").collect()
    assert [(r.pos, bytes(r.block)) for r in rows] == [(0, b"\1"), (1, b"\2"), (2, b"\3")]


def guard(items):
    """The rule as a plain loop."""
    current, skipping, positive, out = 0, False, True, []
    for item in items:
        positive = positive and item > 0
        if item > current:
            current, skipping = item, False
        elif item < current:
            skipping = True
        out.append(positive and not skipping and item == current)
    return out


def test_guard_vector(spark):
    assert [i for i, k in zip([5, 7, 6, 7, 8], guard([5, 7, 6, 7, 8])) if k] == [5, 7, 8]


@pytest.mark.parametrize("hot_rows", [1_000_000, 40])
def test_guard_matches_loop(spark, hot_rows):
    rnd = random.Random(7)
    rows, expected = [], []
    for entity, n in ((1, 700), (2, 300), (3, 20), (4, 15)):
        items, at = [], 1
        for _ in range(n):
            r = rnd.random()
            at = at + rnd.randint(0, 2) if r < 0.9 else max(1, at - rnd.randint(1, 3))
            items.append(at)
        if entity == 2:
            items[200] = 0
        rows += [(entity, i // 10, i % 10, x) for i, x in enumerate(items)]
        expected += [(entity, i // 10, i % 10, x, k) for i, (x, k) in enumerate(zip(items, guard(items)))]
    df = spark.createDataFrame(rows, "entity_id long, chain_pos int, pos int, item_id int")
    flagged = B.guard_ascending(Ordered(df, ["entity_id"], ["chain_pos", "pos"], hot_rows=hot_rows))
    assert flagged.sliced == (hot_rows == 40)
    got = [tuple(r) for r in flagged.df.select("entity_id", "chain_pos", "pos", "item_id", "kept").collect()]
    assert sorted(got) == sorted(expected)


@pytest.mark.parametrize("hot_rows", [1_000_000, 50])
def test_running_values_match_loop(spark, hot_rows):
    rnd = random.Random(11)
    rows = [(None if k == 3 else k, i, rnd.randint(0, 9)) for k, n in ((1, 900), (2, 60), (3, 200), (4, 5)) for i in range(n)]
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "k int, i int, v int")
    ordered = Ordered(df, ["k"], ["i"], hot_rows=hot_rows)
    assert ordered.sliced == (hot_rows == 50)
    got = ordered.running_sum(F.col("v"), "s").row_number("n").previous("v", "p").rows().collect()
    state = {}
    for r in sorted(got, key=lambda r: r.i):
        total, n, before = state.get(r.k, (0, 0, None))
        assert (r.s, r.n, r.p) == (total + r.v, n + 1, before)
        state[r.k] = (total + r.v, n + 1, r.v)


@pytest.mark.parametrize("hot_rows", [1_000_000, 50])
def test_descending_and_global(spark, hot_rows):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).alias("m"))
    down = row_number(df, ["m"], ["id"], "n", descending=True, hot_rows=hot_rows)
    for m in range(7):
        ids = [r.id for r in down.where(f"m = {m}").orderBy("n").collect()]
        assert ids == sorted(ids, reverse=True)
    everything = row_number(df, [], ["id"], "n", hot_rows=hot_rows).collect()
    assert all(r.n == r.id + 1 for r in everything)
    before = Ordered(df, [], ["id"], hot_rows=hot_rows, descending=True).previous("id", "p").rows()
    assert all(r.p == (r.id + 1 if r.id < 499 else None) for r in before.collect())
