"""The corpus pipeline: classify, deduplicate, redact, mix, pack.

Each stage reads the table that the one before it wrote. All but the last return the
columns of ``documents``; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eavspark.llm import binpack, mixing, neardup, neighbours, secrets, token_blocks
from eavspark.llm.common import table
from eavspark.session import materialize, small_batches
from eavspark.shipping import ship

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(df: DataFrame) -> DataFrame:
    """The columns of ``documents``, with the number of characters of the text as it is now."""
    return df.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """The rows with a name of their own, ``row``: where they stand in their file, which is
    the same however often they are read. Rows that no file holds are stored first."""
    place = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
    try:
        return docs.select(*COLUMNS, place.alias("row"))
    except AnalysisException:
        return materialize(docs.select(*COLUMNS, F.monotonically_increasing_id().cast("string").alias("row")), "rows")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours vote for. The labels learned from are all there are."""
    small_batches(spark)
    model = neighbours.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return neighbours.predict(docs.select(*COLUMNS), model, keep=COLUMNS).where("predicted = 1").select(*COLUMNS)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five words, 0.8): the smallest id, a null last.

    Rows are told apart by a number of their own, so rows that share an id, or have none,
    are kept or dropped each for itself."""
    rows = _numbered(docs)
    groups = neardup.near_duplicates(rows, id_column="row").select(F.col("doc_id").alias("row"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("f")
    kept = groups.join(rows.select("row", "doc_id"), "row").groupBy("component_id").agg(first).select("f.row")
    return rows.join(kept, "row", "left_semi").select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets (encoded ones too) replaced by a mark."""
    small_batches(spark)
    return _documents(secrets.redacted(docs.select(*COLUMNS)))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix by weights 3, 1, 2 to 150% of the words: a row per time a document is taken."""
    small_batches(spark)
    return _documents(mixing.mix(_numbered(docs), key="row"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens; repeated documents are packed once per row."""
    small_batches(spark)
    return binpack.pack(docs, token_blocks.default_tokenizer("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("deduplicate", deduplicate), ("redact", redact), ("mix", mix), ("pack", pack),
]
ORACLE_SQL = None  # models, hashes and tokenizers are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read by the next.

    Null texts and sources, empty and very long texts and repeated ids go through as the
    stages say. Tables without rows give none; without labels every document scores one
    half and stays. Other columns of ``documents`` are not read, whatever their names.
    """
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
