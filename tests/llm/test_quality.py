"""Neighbour voting against a plain loop, and its axes against a decomposition."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavspark.llm import neighbours

GOOD = "the river bends slowly past the old stone mill and the meadow".split()
BAD = "click now buy cheap pills win cash prize fast offer deal".split()


def text(rng, words, n=60):
    return " ".join(rng.choice(words) for _ in range(n))


def brute_counts(data):
    found = Counter()
    for i in range(len(data) - 2):
        gram = (data[i] << 16) | (data[i + 1] << 8) | data[i + 2]
        found[(gram * 2654435761 % (1 << 32)) >> 20] += 1
    return found


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(1)
    rows = [(i, text(rng, GOOD if i % 3 else BAD, rng.randint(5, 80)), "x") for i in range(120)]
    rows += [(200, None, "x"), (201, "", "x"), (0, rows[0][1], "x"), (1, text(rng, BAD), "x"), (None, "no id", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(120)] + [(None, 1), (5, None), (7, 0)], "doc_id long, quality int")
    return docs, labels, neighbours.fit(docs, labels, rank=8, k=5)


def test_votes_match_a_plain_loop(spark, learned):
    docs, _, model = learned
    got = neighbours.predict(docs.withColumn("n", F.monotonically_increasing_id()), model, keep=("n", "doc_id", "text")).collect()
    assert len(got) == docs.count()
    prior = model.labels.mean()
    for r in got:
        found = brute_counts((r["text"] or "").encode())
        x = np.zeros(neighbours.TERMS)
        for t, n in found.items():
            x[t] = math.log1p(n) * model.idf[t]
        v = (x / max(np.linalg.norm(x), 1e-12)) @ model.axes
        v /= max(np.linalg.norm(v), 1e-12)
        near = sorted(((float(v @ w), float(y)) for w, y in zip(model.vectors, model.labels)), reverse=True)
        if found and len(near) > model.k and abs(near[model.k - 1][0] - near[model.k][0]) < 1e-5:
            continue  # a tie at the edge: either may vote
        weight = [(min(max(s, 0), 1), y) for s, y in near[: model.k]]
        expected = (sum(s * y for s, y in weight) + 1e-6 * prior) / (sum(s for s, _ in weight) + 1e-6)
        assert r["score"] == pytest.approx(expected, abs=2e-3)
        assert r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1


def test_axes_span_the_leading_singular_vectors():
    rng = np.random.default_rng(3)
    for n in (5, 40, 300):
        w = (rng.standard_normal((n, 30)) * np.geomspace(1, 1e-3, 30)) @ rng.standard_normal((30, 200))
        w = w.astype(np.float32)
        rank = min(6, n)
        axes = neighbours.leading(lambda w=w: [w[:3], w[3:]], n, 200, rank)
        _, _, vt = np.linalg.svd(w, full_matrices=False)
        assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-4)
        assert np.linalg.svd(vt[:rank] @ axes, compute_uv=False).min() > 0.999
    assert neighbours.leading(lambda: [], 0, 9, 0).shape == (9, 1)


def test_held_out_texts_are_told_apart(spark, learned):
    _, _, model = learned
    rng = random.Random(7)
    rows = [(i, text(rng, GOOD if i % 2 else BAD)) for i in range(60)]
    got = neighbours.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert sum(r["predicted"] == r["doc_id"] % 2 for r in got) >= 57


def test_bounded_sample_nothing_learned_and_no_rows(spark, learned):
    docs, labels, model = learned
    assert len(neighbours.fit(docs, labels, limit=10).labels) == 10
    empty = neighbours.fit(docs, labels.where("doc_id < 0"))
    assert {r["score"] for r in neighbours.predict(docs, empty).collect()} == {0.5}
    assert neighbours.predict(docs.where("doc_id < 0"), model).collect() == []
