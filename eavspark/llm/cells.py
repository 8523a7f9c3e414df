"""Similar classes within blocks, without a pair per pair of a group.

A block is a set of classes that may be alike. The class that names a block searches for
its partners among the members; what that links is one component, however large. Only
members of other components than the block's largest search again, among all of the
block's members. Blocks of any size are cut in cells (members x searchers) of bounded
size, and a cell returns the roots that its links join, not all pairs. So the second
search leaves a graph of components, not of classes, which is small.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eavspark.session import materialize

CELL = 1 << 17  # shingles on either side of a cell


class Roots:
    """Components of what a cell knows."""

    def __init__(self) -> None:
        self.up: dict[bytes, bytes] = {}

    def find(self, x: bytes) -> bytes:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: bytes, y: bytes) -> None:
        self.up[max(x, y)] = min(x, y)


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node reachable, for every node of an edge.

    Alternating large-star and small-star rounds; each is aggregated before it is
    shuffled and written to the shared folder. Ends when every node has its root beside it.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")).where("u < v").distinct(), "edges")
    while not _stars(edges):
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # no more rows than edges, so equal ones may wait for the end of the round
        large = both.where("v > u").join(least, "u").select(F.col("m").alias("u"), "v").where("u < v")
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = (
            large.join(low, "v").select(F.col("m").alias("u"), F.explode(F.array("u", "v")).alias("v"))
            .where("u < v").distinct()
        )
        edges = materialize(small, "edges")
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether every ``v`` has one ``u`` that is no other's ``v``: that ``u`` is then its root."""
    up = F.lit(1).alias("up"), F.lit(0).alias("down")
    down = F.lit(0).alias("up"), F.lit(1).alias("down")
    nodes = edges.select(F.col("v").alias("node"), *up).unionByName(edges.select(F.col("u").alias("node"), *down))
    ends = nodes.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.agg(F.max((F.col("up") + F.col("down") > 1) & (F.col("up") > 0))).first()[0]


Links = Callable[[list[dict], list[dict]], list[tuple[bytes, bytes]]]


def search(placed: DataFrame, payload: DataFrame, links: Links) -> DataFrame:
    """(a, b): roots that links between the searchers and the members of each block join.

    ``placed`` is (block, class, n, root, searcher), ``payload`` what ``links`` needs to
    know of a class. A block's members and searchers are dealt to as many parts as their
    shingles need, and ``links`` gets the members and the searchers of a pair of parts.
    """
    parts = placed.groupBy("block").agg(*(
        F.greatest(F.lit(1), F.ceil(F.coalesce(F.sum(F.when(F.col("searcher") == side, F.col("n"))), F.lit(0)) / CELL)).cast("long").alias(name)
        for side, name in ((False, "slices"), (True, "queries"))
    ))
    own = lambda c: F.array(F.pmod(F.xxhash64("class", F.lit(7)), F.col(c)))
    every = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    cells = (
        placed.join(parts, "block")
        .withColumn("slice", F.explode(F.when(F.col("searcher"), every("slices")).otherwise(own("slices"))))
        .withColumn("query", F.explode(F.when(F.col("searcher"), own("queries")).otherwise(every("queries"))))
        .select("block", "slice", "query", "class", "n", "root", "searcher").join(payload, "class")
    )

    def find(table: pa.Table) -> pa.Table:
        rows = [dict(zip(table.column_names, r, strict=True)) for r in zip(*(_values(c) for c in table.columns), strict=True)]
        members, searchers = ([r for r in rows if r["searcher"] == side] for side in (False, True))
        got = links(members, searchers) if members and searchers else []
        return pa.table({"a": pa.array([a for a, _ in got], pa.binary()), "b": pa.array([b for _, b in got], pa.binary())})

    return cells.groupBy("block", "slice", "query").applyInArrow(find, "a binary, b binary")


def _values(column: pa.ChunkedArray) -> list:
    """A column's values; lists of numbers as arrays."""
    column = column.combine_chunks()
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    values, ends = column.flatten().to_numpy(), column.value_lengths().to_numpy().cumsum()
    return [values[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def grouped(meet: DataFrame, heads: DataFrame, payload: DataFrame, links: Links) -> DataFrame:
    """(node, root): components of the classes that ``links`` joins.

    ``meet`` is (block, class, n), ``heads`` (block, class, n) the classes that name blocks."""
    member, searcher = F.lit(False).alias("searcher"), F.lit(True).alias("searcher")
    first = meet.select("*", member).unionByName(heads.select("*", searcher)).withColumn("root", F.col("class"))
    found = materialize(search(first, payload, links), "links")
    low = components(found)
    known = materialize(
        meet.join(low.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class")), "known"
    )
    sizes = known.groupBy("block", "root").agg(F.count("*").alias("c"))
    main = sizes.groupBy("block").agg(F.max(F.struct("c", "root")).alias("m"), F.count("*").alias("roots")).where("roots > 1").select("block", F.col("m.root").alias("main"))
    rest = known.join(main, "block")
    again = rest.select("block", "class", "n", "root", member).unionByName(rest.where("root <> main").select("block", "class", "n", "root", searcher))
    over = components(materialize(search(again, payload, links), "links"))
    # a node of ``over`` is a component of the first search, or a class that it linked with none
    top = over.select(F.col("node").alias("root"), F.col("root").alias("top"))
    moved = low.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return moved.unionByName(over.join(low.where("node = root").select("node"), "node", "left_anti"))
