"""Each stage of the corpus pipeline on small tables, and all of them in a row."""

import random
import re

import corpus_pipeline as cp
import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n):
    return " ".join(f"w{rng.randrange(500)}" for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA).repartition(3)


def test_stages_are_the_dealt_ones():
    assert [name for name, _ in cp.STAGES] == ["quality", "deduplicate", "redact", "mix", "pack"]


def test_quality_keeps_what_the_classifier_predicts(spark, sf_dir):
    from eavspark.llm import neighbours

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = cp.quality(spark, docs, sf_dir)
    model = neighbours.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    wanted = neighbours.predict(docs, model).where("predicted = 1")
    assert kept.columns == list(cp.COLUMNS)
    assert sorted(r[0] for r in kept.select("doc_id").collect()) == sorted(r[0] for r in wanted.select("doc_id").collect())
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality = 1")
    good = docs.join(labels, "doc_id", "left_semi").count()
    assert kept.join(labels, "doc_id", "left_semi").count() >= 0.95 * good


@pytest.mark.parametrize("stored", [False, True])
def test_deduplicate_keeps_one_row_of_each_group(spark, sf_dir, tmp_path, stored):
    rng = random.Random(4)
    a, b, c, d = (prose(rng, 60) for _ in range(4))
    near = a + " tail"
    rows = [(3, a, "s"), (2, near, "s"), (9, a, "s"), (9, b, "s"), (5, c, "s"), (5, c, "s"), (None, d, "s"), (None, d, "s"),
            (None, a, "s"), (7, None, "s"), (8, "", "s"), (6, None, "s")]
    docs = table(spark, rows)
    if stored:  # as the stages meet them
        docs.write.parquet(str(tmp_path / "docs"))
        docs = spark.read.parquet(str(tmp_path / "docs"))
    got = cp.deduplicate(spark, docs, sf_dir).collect()
    kept = sorted(((r.doc_id, r.text) for r in got), key=str)
    # the unique text b shares its id with a copy of a, and stays
    assert kept == sorted([(2, near), (9, b), (5, c), (None, d), (7, None), (8, ""), (6, None)], key=str)
    assert got[0].__fields__ == list(cp.COLUMNS)


def test_redact_keeps_every_row(spark, sf_dir):
    rows = [(1, "say password=hunter2secret now", "s"), (2, None, "s"), (3, "clean text", "s"), (3, "clean text", "t")]
    got = sorted(cp.redact(spark, table(spark, rows), sf_dir).collect(), key=str)
    assert [r.doc_id for r in got] == [1, 2, 3, 3]
    by = {r.doc_id: r for r in got}
    assert "hunter2secret" not in by[1].text and by[1].text.startswith("say ") and by[1].text.endswith(" now")
    assert by[2].text is None and by[3].text == "clean text" and by[1].n_chars == len(by[1].text)


def test_mix_takes_each_source_near_its_target(spark, sf_dir):
    rng = random.Random(5)
    rows = [(i, prose(rng, 30), f"s{i % 3}") for i in range(90)]
    docs = table(spark, rows)
    got = cp.mix(spark, docs, sf_dir)
    assert got.columns == list(cp.COLUMNS)
    size = F.size(F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1))
    taken = {r.source: r.n for r in got.groupBy("source").agg(F.sum(size).alias("n")).collect()}
    total = 1.5 * 90 * 30
    for source, share in (("s0", 3 / 6), ("s1", 1 / 6), ("s2", 2 / 6)):
        wanted = min(share * total, 2 * 900)
        assert taken[source] == pytest.approx(wanted, rel=0.35)
    assert max(r["count"] for r in got.groupBy("doc_id").count().collect()) <= 2


def test_pack_returns_every_row_in_gapless_sequences(spark, sf_dir):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randint(0, 900)), "s") for i in range(25)] + [(3, "again", "s"), (None, None, "s")]
    got = cp.pack(spark, table(spark, rows), sf_dir).collect()
    assert sorted({r.doc_id for r in got}, key=str) == sorted({i for i, _, _ in rows}, key=str)
    assert sum(r.piece == 0 for r in got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048


def test_empty_tables_go_through_every_stage(spark, sf_dir):
    none = table(spark, [(1, "x", "s")]).where("doc_id < 0")
    for _, stage in cp.STAGES:
        assert stage(spark, none, sf_dir).collect() == []


def test_all_stages(spark, sf_dir):
    got = cp.run(spark, sf_dir)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got.count() > 0 and got.join(docs, "doc_id", "left_anti").isEmpty()


def test_mix_allows_any_column_names(spark):
    from eavspark.llm import mixing

    rng = random.Random(8)
    rows = [(i, prose(rng, 20 + i), f"s{i % 2}", i, "k", 1.5) for i in range(12)] + [(12, None, None, 0, "k", 0.0), (3, prose(rng, 9), "s1", 0, "k", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, key string, finish double")
    got = mixing.mix(docs).collect()
    assert got[0].__fields__ == docs.columns
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(t or "")
    assert all(any(t.startswith(r.text) for t in texts[r.doc_id]) for r in got)
    assert sum(len(r.text.split()) for r in got) == pytest.approx(1.5 * sum(len((t or "").split()) for _, t, *_ in rows), rel=0.05)
    # a column's values stay with their row
    assert all(r["size"] == r.doc_id for r in got if r.key == "k" and r.finish == 1.5)
