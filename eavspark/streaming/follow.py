"""Keep a value table in step with staged rows that arrive as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eavspark.buckets import sync_buckets
from eavspark.operators.sync import sync
from eavspark.schemas import BY_ENTITY, KEYS, SCHEMAS
from eavspark.snapshots import Snapshots


def follow(
    spark: SparkSession, incoming: str, root: str, table: str, checkpoint: str,
    *, scoped: bool = True, max_files: int = 1000,
) -> StreamingQuery:
    """Sync what has arrived in ``incoming`` since the last run, then stop.

    Each file holds all rows of the entities it covers, in the columns of the
    table; the entities of a batch are its scope. The checkpoint remembers files,
    and a sync repeated after a failure changes nothing, so every file counts once.
    """
    staged = (
        spark.readStream.schema(SCHEMAS[table]).option("maxFilesPerTrigger", max_files)
        .parquet(incoming)
    )
    snaps = Snapshots(spark, root)
    keys = KEYS[table]

    def apply(batch: DataFrame, _: int) -> None:
        # a key that arrived twice in one batch counts once
        rest = [c for c in batch.columns if c not in keys]
        once = batch.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
        store = snaps.current()
        if scoped and table in BY_ENTITY and store.holds(table):
            # only the buckets of the batch's entities are read and replaced
            sync_buckets(spark, snaps.paths()[table], table, once, batch.select("entity_id"))
            return
        scope = batch.select("entity_id").distinct() if scoped else None
        result = sync(store[table], once, keys, scope)
        snaps.publish({table: snaps.write(table, result.snapshot)})

    return (
        staged.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
