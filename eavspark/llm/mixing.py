"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated as often as the
mix may repeat them. A document's virtual finish time is the number of words its
source has served up to its end, over the source's target. Time one is reached by
every source when it has served its target, so the mix in order of virtual time,
truncated at the total budget, takes each source to its target.

The shuffle key is a digest of the id, hence even: its leading bits cut a source of
any size in slices of like size, and a small table of slice totals carries the running
sums across. The same holds for virtual time, which serves words at an even pace.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavspark.llm.common import WORD, rows, word_spans
from eavspark.session import materialize

SLICES = 256  # slices of a source's shuffled order: the first byte of the digest


def targets(sizes: Sequence[int], weights: Sequence[int], budget: Fraction, repeats: int) -> list[float]:
    """Every source's share of the budget by weight, none above ``repeats`` times its size.

    What a source cannot take is shared again by weight among the others until none is
    above its bound. If all are at their bound, the budget stays partly unused.
    """
    fixed: set[int] = set()
    while True:
        free = [i for i in range(len(sizes)) if i not in fixed]
        left = budget - sum(repeats * sizes[i] for i in fixed)
        total = sum(weights[i] for i in free)
        over = [i for i in free if weights[i] * left > repeats * sizes[i] * total]
        if not over:
            return [float(repeats * sizes[i]) if i in fixed else float(weights[i] * left / total) for i in range(len(sizes))]
        fixed.update(over)


def _running(size: Column, key: str, totals: DataFrame, df: DataFrame, name: str) -> DataFrame:
    """The words its source serves before each row, in the order of ``key``."""
    slice_ = f"{name}_slice"
    before = Window.partitionBy("rank", slice_).orderBy(key, "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn(slice_, F.substring(key, 1, 2))
        .withColumn(name, F.coalesce(F.sum(size).over(before), F.lit(0)))
        .join(totals, ["rank", slice_])
        .withColumn(name, F.col(name) + F.col(f"{name}_base")).drop(slice_, f"{name}_base")
    )


def shares(
    df: DataFrame, weights: Sequence[int] = (3, 1, 2), percent: int = 150, repeats: int = 2, seed: str = "mix",
    keep: Sequence[str] = (), id_column: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and per
    repeat r ``taken_r`` (words served) and ``finish_r`` (virtual finish time).

    Sources in code point order, null last, weigh ``weights`` in turn. A null text has no
    words; a document without words is never taken. The document in service when its
    source reaches its target is taken in part. Rows that share an id are documents of
    their own. An empty table gives no rows. The driver sees one row per source: a
    mixture is set up per source, so their number does not grow with the documents.
    """
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    keys = [F.md5(F.concat(F.lit(f"{seed}:{r}:"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))).cast("binary")).alias(f"k{r}") for r in range(repeats)]
    docs = materialize(df.select(F.col(id_column).alias("doc_id"), F.col(source).alias("source"), size.alias("size"), *keep, *keys), "sizes")
    found = sorted(
        ((r["source"], int(r["n"])) for r in docs.groupBy("source").agg(F.sum("size").alias("n")).collect()),
        key=lambda s: (s[0] is None, s[0] or ""),
    )
    sizes = [n for _, n in found]
    shared = targets(sizes, [weights[i % len(weights)] for i in range(len(found))], Fraction(sum(sizes) * percent, 100), repeats)
    spark = df.sparkSession
    table = spark.createDataFrame(
        [(i, s, n, t) for i, ((s, n), t) in enumerate(zip(found, shared, strict=True))],
        "rank int, source string, source_size long, target double",
    )
    known = docs.join(table.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s") if len(found) > 1000 else _by_map(docs, found, shared)
    for r in range(repeats):
        name = f"start_{r}"
        at = Window.partitionBy("rank").orderBy(f"{name}_slice").rowsBetween(Window.unboundedPreceding, -1)
        totals = (
            known.groupBy("rank", F.substring(f"k{r}", 1, 2).alias(f"{name}_slice")).agg(F.sum("size").alias("n"))
            .select("rank", f"{name}_slice", F.coalesce(F.sum("n").over(at), F.lit(0)).alias(f"{name}_base"))
        )
        known = _running(F.col("size"), f"k{r}", totals, known, name)
    parts = []
    for r in range(repeats):
        start = F.col(f"start_{r}") + r * F.col("source_size")
        quota = F.floor(F.col("target")) - start
        parts += [
            F.greatest(F.lit(0), F.least(F.col("size"), quota)).cast("long").alias(f"taken_{r}"),
            F.when(F.col("target") > 0, (start + F.col("size")) / F.col("target")).alias(f"finish_{r}"),
        ]
    out = known.select("doc_id", "source", *keep, "size", "source_size", "target", *parts)
    taken = sum((F.col(f"taken_{r}") for r in range(1, repeats)), F.col("taken_0"))
    return out.withColumn("taken", taken)


def _by_map(docs: DataFrame, found: list, shared: list[float]) -> DataFrame:
    """The sources' figures as a literal map (at most a thousand entries), so that the
    documents need no join and no shuffle for them."""
    if not found:
        return docs.select("*", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"))
    entries = []
    for i, ((s, n), t) in enumerate(zip(found, shared, strict=True)):
        key = F.lit("-" if s is None else "+" + s)
        entries += [key, F.struct(F.lit(i).alias("rank"), F.lit(n).cast("long").alias("source_size"), F.lit(t).alias("target"))]
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source")))
    return docs.withColumn("of", F.create_map(*entries)[key]).select(*docs.columns, "of.rank", "of.source_size", "of.target")


def cut_words(df: DataFrame, words: str, text: str = "text") -> DataFrame:
    """Every text up to the end of its first ``words`` words, whole where that is null; nothing
    else changes."""

    def run(batches: Iterator[pa.RecordBatch]):
        import numpy as np

        for batch in batches:
            where, limit = batch.schema.get_field_index(text), batch.schema.get_field_index(words)
            for part in rows([batch]):
                kind = part.column(where).type
                out = []
                limits = part.column(limit).to_pylist()
                if not any(n is not None for n in limits):
                    yield part
                    continue
                for t, n in zip(part.column(where).cast(pa.large_binary()).to_pylist(), limits, strict=True):
                    ends = word_spans(np.frombuffer(t or b"", np.uint8))[1] if n is not None else ()
                    out.append(t if t is None or n is None or n >= len(ends) else t[: ends[n - 1] if n else 0])
                yield part.set_column(where, text, pa.array(out, pa.large_binary()).cast(kind))

    return df.mapInArrow(run, df.schema)


def mix(
    df: DataFrame, seed: str = "mix", id_column: str = "doc_id", source: str = "source", text: str = "text", key: str | None = None, **options,
) -> DataFrame:
    """The mix itself: the rows of ``df``, one per time a document is taken, cut at the
    words taken, in order of virtual finish time (globally range-sorted).

    Shares are worked out on narrow rows; the rows themselves are shuffled to meet their
    shares and to be sorted. ``key`` names a column that tells all rows apart, however often
    they are read, and is not returned; without one the rows are stored and numbered.
    Other columns may have any names."""
    columns, repeats = [c for c in df.columns if c != key], options.get("repeats", 2)
    row = F.struct(*columns).alias("row")
    if key is None:
        rows_ = materialize(df.select(F.monotonically_increasing_id().alias("key"), row), "rows")
    else:
        rows_ = df.select(F.col(key).alias("key"), row)
    narrow = rows_.select("key", *(F.col("row")[c].alias(n) for n, c in (("doc_id", id_column), ("source", source), ("text", text))))
    taken = shares(narrow, seed=seed, keep=["key"], **options)
    each = F.explode(F.array(*[F.struct(F.col(f"taken_{r}").alias("words"), F.col(f"finish_{r}").alias("finish")) for r in range(repeats)]))
    served = taken.select("key", "size", each.alias("e")).select("key", "size", "e.*").where("words > 0").join(rows_, "key")
    cut = cut_words(
        served.select(F.col("row")[text].alias("text"), F.when(F.col("words") < F.col("size"), F.col("words")).alias("words"), "row", "finish"), "words"
    )
    return cut.select(F.col("row").withField(f"`{text}`", F.col("text")).alias("row"), "finish").orderBy("finish").select("row.*")
