"""Host-level quality rules, in DataFrame functions alone.

Every document is measured against rules. Failures are counted per host; a host's rate
of failures is shrunk towards the rate of all hosts by a beta prior that is estimated
from the hosts themselves, so that a host with three documents is not judged by them
alone. The verdict on the host is joined back to its documents.

Computed arrays leave through a generator (``inline``): what is derived from them more
than once then reads a column instead of computing them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eavspark.llm.common import GAP, WORD
from eavspark.session import materialize

SYMBOLS = "#*$%&|<>"  # fixed value: the characters that count as symbols
SALTS = 64  # parts that the documents of one host are dealt to

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _fixed(df: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """``keep`` and the given columns, computed once."""
    made = F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select(*keep, made)


def measures(df: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` beside the measures of every whole text; a null text has no words."""
    t = F.coalesce(F.col("_text"), F.lit(""))
    first = _fixed(
        df.select(*keep, F.col(text).alias("_text")), keep,
        words=F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
        lines=F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD)),
        word_chars=F.length(F.regexp_replace(t, GAP, "")).cast("long"),
        n_symbols=(F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    )
    w = F.col("words")
    windows = F.transform(w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    second = _fixed(
        first, [*keep, "word_chars", "n_symbols"],
        n_words=F.size(w).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        windows=F.sort_array(F.slice(windows, 1, F.greatest(F.size(w) - 2, F.lit(0)))),
    )
    s = F.col("windows")
    again = F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    third = _fixed(
        second, [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines"],
        places=F.sort_array(F.transform(again, lambda x: x["i"])),
    )
    p = F.col("places")
    # a window covers three words, or as many as lie before the next such window
    covered = F.transform(p, lambda x, i: F.least(F.lit(3), F.coalesce(F.get(p, i + 1) - x, F.lit(3))))
    n_repeat = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words")
    return third.select(*keep, *MEASURES[:4], n_repeat)


def rules() -> dict[str, Column]:
    """Rule by name: true where a document fails it."""
    n = F.col("n_words")
    return {
        "base": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n),
        "symbols": 10 * F.col("n_symbols") > n,
        "lines": 10 * F.col("n_dup_lines") > n,
    }


def prior(counts: DataFrame, name: str) -> tuple[float, float]:
    """The beta prior (a, b) of a rule, from the mean and the spread of the hosts' rates.

    Method of moments, hosts weighted by documents. Hosts that do not differ give a
    prior as strong as all their documents; no documents give (1, 1). One row is read.
    """
    n, k = F.sum("n").alias("n"), F.sum(name).alias("k")
    squares = F.sum(F.col(name) * F.col(name) / F.col("n")).alias("s")
    row = counts.agg(n, k, squares).first()
    if not row["n"]:
        return 1.0, 1.0
    mean = row["k"] / row["n"]
    spread = row["s"] / row["n"] - mean * mean
    inside = mean * (1 - mean)
    strength = min(max(inside / spread - 1, 1.0), float(row["n"])) if spread > 0 else float(row["n"])
    return mean * strength + 1e-9, (1 - mean) * strength + 1e-9


def verdicts(counts: DataFrame, names: list[str], limit: float) -> DataFrame:
    """(host, host_rate, host_kept): the largest shrunk rate of a host, and whether it is within the limit."""
    rates = []
    for name in names:
        a, b = prior(counts, name)
        rates.append((F.col(name) + a) / (F.col("n") + (a + b)))
    rate = F.greatest(*rates) if len(rates) > 1 else rates[0]
    return counts.select("host", rate.alias("host_rate")).withColumn("host_kept", F.col("host_rate") <= limit)


def host_rules(
    df: DataFrame, limit: float = 0.5, id_column: str = "doc_id", host: str = "source", text: str = "text",
) -> DataFrame:
    """(doc_id, measures, base_failed, host_rate, kept), one row per row of ``df``.

    A document is kept if it passes the base rules and its host's shrunk rate of
    failures is at most ``limit`` for every rule. Rows without a host form one host.
    Rows that share an id are measured each for itself; an empty table gives no rows.
    """
    named = df.select(F.col(id_column).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"))
    failing = rules()
    docs = materialize(measures(named, ["doc_id", "host"]).select("*", *[c.alias(f"fails_{n}") for n, c in failing.items()]), "measures")
    counts = materialize(
        docs.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col(f"fails_{n}").cast("long")).alias(n) for n in failing]), "hosts"
    )
    judged = verdicts(counts, list(failing), limit).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = docs.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words"), F.lit(SALTS)).cast("int"))
    both = dealt.join(judged.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")) & (dealt["salt"] == judged["salt"]), "left")
    kept = ~F.col("fails_base") & F.coalesce("host_kept", F.lit(True))
    return both.select("doc_id", *MEASURES, F.col("fails_base").alias("base_failed"), "host_rate", kept.alias("kept"))
