"""Shared-folder helpers: where intermediate tables go and how lineage is cut."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_KEY = "spark.checkpoint.dir"
BATCH_KEY, BATCH = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    A path without a scheme is taken on the cluster's default file system, by Spark as by
    the tasks that open files themselves. A folder of our own is made only where the
    session names none and runs on one machine (tests); elsewhere that is an error.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return qualified(spark, named.rstrip("/"))
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all executors see")
    own = tempfile.mkdtemp(prefix="eavspark-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the default file system, where it has none and that is not local."""
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
    if re.match(r"[a-z][a-z0-9+.-]*:", path) or default.startswith("file:"):
        return path
    return default.rstrip("/") + "/" + path.lstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/eavspark-{name}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame, name: str = "stage", partition_by: tuple[str, ...] = ()
) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts lineage like ``checkpoint()``, survives the loss of executors, and,
    being columnar, lets later reads prune columns (and ``partition_by`` values).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python tasks in batches of about 4 MB, however long they are.

    By Spark's default 10,000 rows are one batch, which the JVM and its Python worker both
    hold. A session's own setting stands."""
    if BATCH_KEY not in spark.conf.getAll:
        spark.conf.set(BATCH_KEY, BATCH)


def literal(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small constant relation. It is planned as one, so that filters and joins
    on it fold, and reading it back starts no job."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    fields = StructType.fromDDL(schema)
    arrow = {"string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    arrays = [
        pa.array(c, arrow.get(f.dataType.simpleString(), pa.int32()))
        for c, f in zip(columns, fields, strict=True)
    ]
    return spark.createDataFrame(pa.table(arrays, names=names), schema=fields)
