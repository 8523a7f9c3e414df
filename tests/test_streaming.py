"""Staged files are synced once each."""

from eavspark.snapshots import Snapshots
from eavspark.store import Store, conform
from eavspark.streaming.follow import follow


def staged(spark, *rows):
    df = spark.createDataFrame(list(rows), "entity_id long, attribute_id int, seq long, value string")
    return conform(df, "value_texts")


def test_follow(spark, tmp_path):
    incoming, root, checkpoint = (str(tmp_path / n) for n in ("in", "store", "check"))
    snaps = Snapshots(spark, root)
    first = staged(spark, (1, 10, 1, "a"), (1, 10, 2, "b"), (2, 10, 1, "c"))
    snaps.publish({"value_texts": snaps.append("value_texts", first)})
    staged(spark, (1, 10, 1, "x"), (1, 10, 1, "x"), (3, 10, 1, "n")).write.mode("append").parquet(incoming)
    follow(spark, incoming, root, "value_texts", checkpoint).awaitTermination()
    rows = sorted((r.entity_id, r.seq, r.value) for r in snaps.current()["value_texts"].collect())
    assert rows == [(1, 1, "x"), (2, 1, "c"), (3, 1, "n")]
    staged(spark, (2, 10, 1, "d")).write.mode("append").parquet(incoming)
    follow(spark, incoming, root, "value_texts", checkpoint).awaitTermination()
    rows = sorted((r.entity_id, r.seq, r.value) for r in snaps.current()["value_texts"].collect())
    assert rows == [(1, 1, "x"), (2, 1, "d"), (3, 1, "n")]


def test_missing_tables_read_as_empty(spark):
    assert Store(spark)["value_dates"].count() == 0
