"""Language profiles and the classifier chain against plain loops."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavspark.llm import langid, toxicity

SIZE = 400


def brute_grams(text):
    padded, last = [0], 0
    for ch in (text or "").lower():
        code = ord(ch) if ch.isalpha() else 0
        if code or last:
            padded.append(code)
        last = code
    if last:
        padded.append(0)
    found = Counter(c for c in padded if c)
    if not found:
        return found
    found.update(((a << 21) | b) + (1 << 42) for a, b in zip(padded, padded[1:]))
    found.update((((a << 21) | b) << 21 | c) | (1 << 62) for a, b, c in zip(padded, padded[1:], padded[2:]) if b)
    return found


def brute_ranks(found):
    """Ranks of the most frequent n-grams; equal counts share the mean of their ranks."""
    top = sorted(found, key=lambda g: (-found[g], g))[:SIZE]
    places = defaultdict(list)
    for i, g in enumerate(top):
        places[found[g]].append(i)
    return {g: sum(places[found[g]]) / len(places[found[g]]) for g in top}


def texts():
    rng = random.Random(2)
    kinds = {"x": "abcde", "y": "cdefg", "z": "üöäßab"}
    rows = []
    for i in range(60):
        lang = rng.choice(list(kinds))
        words = ["".join(rng.choice(kinds[lang]) for _ in range(rng.randint(1, 6))) for _ in range(rng.randint(1, 120))]
        rows.append((i, rng.choice([" ", ", ", "  1 "]).join(words).title(), lang, i, "a"))
    odd = [None, "", "12 -- !", "a", "ABC abc", "Ünï ünï", "x" * 20_000, "ab " * 9000]
    rows += [(100 + i, t, lang, 0, "b") for i, (t, lang) in enumerate(zip(odd, ["x", "y", "z", "x", None, "z", "y", "x"]))]
    return [*rows, rows[3], (5, "another text", "y", 0, "c"), (None, "cdefg cde", None, 0, "d")]


def test_languages_match_a_plain_loop(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score long, lang_pred string").repartition(4)
    counts = defaultdict(Counter)
    for _, t, lang, *_ in rows:
        if lang is not None:
            counts[lang].update(brute_grams(t))
    order = {lang: {g: i for i, g in enumerate(sorted(c, key=lambda g: (-c[g], g))[:SIZE])} for lang, c in counts.items()}
    got = langid.predict(df, langid.learn(df)).collect()
    expected = Counter()
    for doc_id, t, *_ in rows:
        own = brute_ranks(brute_grams(t))
        if not own:
            expected[doc_id, "und", 0.0] += 1
            continue
        distance = {lang: sum(min(abs(r - known[g]), SIZE) if g in known else SIZE for g, r in own.items()) for lang, known in order.items()}
        best = min(sorted(distance), key=distance.get)
        expected[doc_id, best, round(1 - distance[best] / (SIZE * len(own)), 5)] += 1
    assert Counter((r.doc_id, r.lang_pred, round(r.score, 5)) for r in got) == expected


def test_languages_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.learn(none) == {} and langid.predict(none, {}).collect() == []


TOXIC, LOW, PLAIN = ["vile", "hate", "scum"], ["cheap", "click", "win"], "the river bends past an old mill by a meadow and hill".split()


def example(rng, toxic, low):
    words = rng.choices(PLAIN, k=25) + (rng.choices(TOXIC, k=3) if toxic else []) + (rng.choices(LOW, k=3) if low else [])
    rng.shuffle(words)
    return " ".join(words)


@pytest.fixture(scope="module")
def learned(spark):
    rng = random.Random(3)
    marks = [(i, int(rng.random() < 0.3), int(rng.random() < 0.4)) for i in range(240)]
    rows = [(i, example(rng, t, low), 0.5) for i, t, low in marks] + [(900, None, 0.1), (901, "", 0.2), (0, "vile " * 9, 0.3), (None, "hate", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, p_toxic double")
    labels = spark.createDataFrame([(i, t, 1 - low) for i, t, low in marks] + [(None, 1, 1), (3, None, 1), (4, 1, 0)], "doc_id long, toxic int, quality int")
    toxic, low = F.col("toxic") == 1, F.col("quality") == 0
    return docs, labels, toxicity.fit(docs, labels, {"low": low, "toxic": toxic, "both": toxic & low}, terms=12)


def test_chain_matches_a_plain_loop(spark, learned):
    docs, _, model = learned
    got = toxicity.predict(docs.select("doc_id", "text"), model, keep=("doc_id", "text")).collect()
    assert len(got) == docs.count()
    for r in got:
        found = set(toxicity.words((r["text"] or "").encode()).tolist())
        before = []
        for name, link in model.items():
            z = link.weights[-1] + sum(w for t, w in zip(link.terms.tolist(), link.weights) if t in found)
            z += sum(p * w for p, w in zip(before, link.weights[len(link.terms) : -1], strict=True))
            before.append(1 / (1 + math.exp(-z)))
            assert r[f"p_{name}"] == pytest.approx(before[-1], abs=1e-9)


def test_later_links_learn_from_out_of_fold_probabilities():
    rng = np.random.default_rng(4)
    docs = [np.unique(rng.integers(0, 40, 8)).astype(np.uint32) for _ in range(60)]
    labels = rng.integers(0, 2, (60, 2))
    folds = np.arange(60) % 5
    links = toxicity.chain(docs, labels, folds, 6, 1.0)
    before = np.zeros((60, 1))
    for f in range(5):
        rest = [i for i in range(60) if i % 5 != f]
        part = toxicity.learn([docs[i] for i in rest], labels[rest, 0], np.zeros((48, 0)), 6, 1.0)
        for i in range(f, 60, 5):
            z = part.weights[-1] + sum(w for t, w in zip(part.terms, part.weights) if t in docs[i])
            before[i, 0] = 1 / (1 + math.exp(-z))
    second = toxicity.learn(docs, labels[:, 1], before, 6, 1.0)
    assert np.array_equal(links[1].terms, second.terms) and np.allclose(links[1].weights, second.weights)


def test_held_out_toxic_texts_are_found(spark, learned):
    _, _, model = learned
    rng = random.Random(9)
    rows = [(i, example(rng, i % 2, i % 3 == 0)) for i in range(80)]
    got = toxicity.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()
    assert sum((r["p_toxic"] >= 0.5) == bool(r["doc_id"] % 2) for r in got) >= 70


def test_chain_of_nothing(spark, learned):
    docs, labels, model = learned
    assert toxicity.predict(docs.where("doc_id < 0"), model).collect() == []
    toxic = {"toxic": F.col("toxic") == 1}
    empty = toxicity.fit(docs, labels.where("doc_id < 0"), toxic)
    assert {round(r["p_toxic"], 6) for r in toxicity.predict(docs.drop("p_toxic"), empty).collect()} == {0.5}


def test_packed_numbers_join_into_one_array():
    """The rows that ``fit`` gets stand in one array, whatever the chunks they came in."""
    import pyarrow as pa
    from eavspark.llm.neighbours import joined

    rows = [[1, 2], [], [3], [4, 5, 6], [7]]
    packed = pa.array([np.array(r, np.float32).tobytes() for r in rows], pa.binary())
    numbers, ends = joined(pa.chunked_array([packed[:2], packed[2:2], packed[2:]]), np.float32)
    assert numbers.tolist() == [1, 2, 3, 4, 5, 6, 7] and ends.tolist() == [0, 2, 2, 3, 6, 7]
    numbers, ends = joined(pa.chunked_array([], pa.binary()), np.uint16)
    assert len(numbers) == 0 and ends.tolist() == [0]
