"""A value store: one DataFrame per table, saved as parquet directories."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark.schemas import KEYS, SCHEMAS


class Store(Mapping):
    """Tables by name. A table the store lacks reads as empty; a function in place of
    a table is called when the table is first used."""

    def __init__(
        self, spark: SparkSession,
        tables: Mapping[str, DataFrame | Callable[[], DataFrame]] | None = None,
    ):
        self.spark = spark
        self._tables = dict(tables or {})
        unknown = set(self._tables) - set(SCHEMAS)
        if unknown:
            raise KeyError(f"no such tables: {sorted(unknown)}")

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._tables:
            found = self._tables[name]
            if callable(found):
                found = self._tables[name] = found()
            return found
        # no partitions and no job: an empty relation is folded away
        return self.spark.range(0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]]
        )

    def __iter__(self):
        return iter(SCHEMAS)

    def __len__(self) -> int:
        return len(SCHEMAS)

    def holds(self, name: str) -> bool:
        return name in self._tables

    def with_tables(self, **tables: DataFrame) -> Store:
        return Store(self.spark, {**self._tables, **tables})

    def save(self, path: str, names: Iterable[str] | None = None) -> None:
        """Write tables under ``path``; ``path`` must be new for what is read here."""
        for name in names or self._tables:
            write_table(self[name], f"{path}/{name}", name)

    @classmethod
    def load(cls, spark: SparkSession, path: str, names: Iterable[str]) -> Store:
        return cls(
            spark,
            {n: spark.read.schema(SCHEMAS[n]).parquet(f"{path}/{n}") for n in names},
        )


def conform(df: DataFrame, name: str) -> DataFrame:
    """Select and cast the columns of table ``name``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[name]])


def write_table(df: DataFrame, path: str, name: str, mode: str = "error") -> None:
    """Full write. Value tables are laid out by entity and terms by their folded form,
    so that reads of some entities, or of a prefix, skip files and row groups. The whole
    key bounds the ranges: one entity with very many values spreads over several files."""
    out = conform(df, name)
    if name.startswith("value_") or name == "terms":
        out = out.repartitionByRange(*KEYS[name]).sortWithinPartitions(*KEYS[name])
    out.write.mode(mode).parquet(path)


def append_table(df: DataFrame, path: str, name: str) -> None:
    conform(df, name).write.mode("append").parquet(path)


def replace_table(df: DataFrame, path: str, name: str) -> None:
    """Full refresh: the new rows replace all old ones."""
    write_table(df, path, name, "overwrite")


def append_jdbc(df: DataFrame, name: str, url: str, properties: Mapping[str, str]) -> None:
    """Bulk append to a SQL database, in batches of the driver's ``batchsize``."""
    conform(df, name).write.jdbc(url, name, mode="append", properties=dict(properties))


def read_jdbc(
    spark: SparkSession, name: str, url: str, properties: Mapping[str, str],
    column: str = "entity_id", bounds: tuple[int, int] = (1, 1 << 31), parts: int = 64,
) -> DataFrame:
    """Read a stored table back, split by ranges of ``column``."""
    return spark.read.jdbc(
        url, name, column=column, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=parts, properties=dict(properties),
    )


def scan_only(df: DataFrame) -> None:
    """Run a plan to its end and keep nothing."""
    df.write.format("noop").mode("overwrite").save()
