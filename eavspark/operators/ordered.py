"""Running values over ordered groups of any size.

A plain window sorts a whole group in one task. Here groups above ``hot_rows``
are cut, by a range partitioning on the order columns, into slices of about that
many rows; windows run per slice and a small table of slice totals carries the
state from slice to slice. Data without such groups gets the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavspark.session import materialize

HOT_ROWS = 1_000_000
MAX_SLICES = 10_000

_SLICE = "_slice"


def match(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join that also matches NULL keys; keeps the left key columns."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns]
    )
    condition = None
    for c in on:
        same = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        condition = same if condition is None else condition & same
    joined = left.join(renamed, condition, how)
    return joined.drop(*[f"_r_{c}" for c in on])


class Ordered:
    """Rows grouped by ``keys`` and ordered by ``order`` within each group.

    ``order`` holds column names; ``descending`` turns all of them round. The
    order must be total, else equal rows come in any order.
    """

    def __init__(
        self,
        df: DataFrame,
        keys: Sequence[str],
        order: Sequence[str],
        *,
        descending: bool = False,
        hot_rows: int = HOT_ROWS,
        sizes: DataFrame | None = None,
    ):
        self.keys, self.order_names, self.descending = list(keys), list(order), descending
        self.df, self.sliced = self._slice(df, hot_rows, sizes)

    @property
    def order(self) -> list[Column]:
        return [F.col(c).desc() if self.descending else F.col(c).asc() for c in self.order_names]

    def _slice(self, df: DataFrame, hot_rows: int, sizes: DataFrame | None):
        if sizes is None:
            sizes = df.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("_n"))
        hot = sizes.where(F.col("_n") > hot_rows)
        found = hot.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n")).first()
        if not found.k:
            return df.withColumn(_SLICE, F.lit(0)), False
        slices = min(MAX_SLICES, max(2, math.ceil(found.n / hot_rows)))
        if self.keys:
            hot = materialize(hot.select(*self.keys), "hot-keys")
            rows = match(df, hot, self.keys, "left_semi")
        else:
            rows = df
        # both readers of the slices must see the same cut, hence the written table
        rows = materialize(
            rows.repartitionByRange(slices, *[F.col(k).asc() for k in self.keys], *self.order)
            .withColumn(_SLICE, F.spark_partition_id() + 1),
            "slices",
        )
        if self.keys:
            rest = match(df, hot, self.keys, "left_anti").withColumn(_SLICE, F.lit(0))
            rows = rest.unionByName(rows)
        return rows, True

    def window(self, *extra: str):
        return Window.partitionBy(*self.keys, *extra, _SLICE).orderBy(*self.order)

    def slice_totals(self, extra: Sequence[str], **aggs: Column) -> DataFrame:
        """One row per group and slice; only cut groups have any, so at most
        the number of slices plus the number of cut groups (times ``extra``)."""
        return (
            self.df.where(F.col(_SLICE) > 0).groupBy(*self.keys, *extra, _SLICE).agg(
                *[c.alias(n) for n, c in aggs.items()]
            )
        )

    def carried(self, totals: DataFrame, extra: Sequence[str] = (), **carry) -> DataFrame:
        """Join to every row what all earlier slices of its group sum up to.

        ``carry`` maps a new column to a function of the window over slices."""
        earlier = (
            Window.partitionBy(*self.keys, *extra).orderBy(_SLICE)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        on = [*self.keys, *extra, _SLICE]
        state = totals.select(*on, *[f(earlier).alias(n) for n, f in carry.items()])
        return match(self.df, state, on, "left")

    def _keep(self, df: DataFrame) -> Ordered:
        out = object.__new__(Ordered)
        out.__dict__.update(self.__dict__)
        out.df = df
        return out

    def running_sum(self, value: Column, name: str, extra: Sequence[str] = ()) -> Ordered:
        """``sum(value)`` from the start of the group to the row."""
        df = self.df.withColumn("_value", value)
        local = F.sum("_value").over(
            self.window(*extra).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        if self.sliced:
            self_v = self._keep(df)
            totals = self_v.slice_totals(extra, _total=F.sum("_value"))
            df = self_v.carried(totals, extra, _base=lambda w: F.sum("_total").over(w))
            df = df.withColumn(name, local + F.coalesce(F.col("_base"), F.lit(0))).drop("_base")
        else:
            df = df.withColumn(name, local)
        return self._keep(df.drop("_value"))

    def row_number(self, name: str) -> Ordered:
        if not self.sliced:
            number = F.row_number().over(self.window()).cast("bigint")
            return self._keep(self.df.withColumn(name, number))
        return self.running_sum(F.lit(1), name)

    def previous(self, column: str, name: str) -> Ordered:
        """``column`` of the row before; NULL at the start of a group."""
        local = F.lag(column).over(self.window())
        if not self.sliced:
            return self._keep(self.df.withColumn(name, local))
        position = F.struct(*self.order_names)
        last = F.min_by if self.descending else F.max_by
        totals = self.slice_totals((), _last=last(F.struct(column), position))
        df = self.carried(totals, _before=lambda w: F.last("_last", ignorenulls=True).over(w))
        first = F.row_number().over(self.window()) == 1
        df = df.withColumn(name, F.when(first, F.col(f"_before.{column}")).otherwise(local))
        return self._keep(df.drop("_before"))

    def rows(self) -> DataFrame:
        return self.df.drop(_SLICE)


def row_number(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, **options
) -> DataFrame:
    return Ordered(df, keys, order, **options).row_number(name).rows()
