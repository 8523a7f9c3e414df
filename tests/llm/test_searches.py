"""Set join, divergence audit and ranked search against brute force, odd cases included."""

import random
import re
from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from eavspark.llm import cells, divergence, lexical, neardup, overlap, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, block long, tokens string, rank int"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, la, so, 0, "x", 1, "y", 2) for i, t, la, so in rows], SCHEMA).repartition(3)


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def prose(rng, n, vocabulary=300):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(3)
    base = [prose(rng, 90) for _ in range(10)]
    near = [" ".join([*b.split()[:-2], "other", "end"]) for b in base]
    far = [" ".join([*b.split()[:60], *prose(rng, 30).split()]) for b in base]
    shared = [prose(rng, 6, 10**6) + " " + base[0] for _ in range(20)]
    texts = [None, "", " \n\t", "one", "One", "one two three", "ONE two  three", prose(rng, 40_000), "Ünï ünï Ünï # $ |",
             " ".join(["same"] * 200), " ".join(["same"] * 201), *base, *near, *base[:3], *far, *shared]
    return texts


# ---- the set join -------------------------------------------------------------------


def brute_groups(rows, words, percent):
    sets = []
    for _, t in rows:
        w = WORD.findall(lower(t))
        sets.append({tuple(w[j : j + words]) for j in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    return sorted((d, len(sets[i]), min(least[find(i)])) for i, (d, _) in enumerate(rows))


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (2, 60)])
def test_join_matches_all_pairs(spark, odd, words, percent):
    rows = [(i * 2, t) for i, t in enumerate(odd)]
    got = overlap.jaccard_groups(documents(spark, [(i, t, "en", "a") for i, t in rows]), words, percent).collect()
    assert sorted(map(tuple, got)) == brute_groups(rows, words, percent)


def test_join_in_cells_of_any_size(spark, odd, monkeypatch):
    """A block cut in many cells gives the same groups; members linked to no head meet again."""
    rng = random.Random(8)
    stem = prose(rng, 100, 10**6).split()
    rows = list(enumerate(odd))
    for i in range(150):  # two of these are alike only if their changes fall together
        w = list(stem)
        for p in rng.sample(range(100), 3):
            w[p] = f"new{rng.randrange(4)}"
        rows.append((len(rows), " ".join(w)))
    monkeypatch.setattr(cells, "CELL", 900)
    monkeypatch.setattr(overlap, "RANGE", 500)
    got = overlap.jaccard_groups(documents(spark, [(i, t, "en", "a") for i, t in rows])).collect()
    assert sorted(map(tuple, got)) == brute_groups(rows, 3, 90)


def test_join_of_nothing_and_of_shared_and_null_ids(spark):
    assert overlap.jaccard_groups(documents(spark, [(1, "a", "", "")]).where("doc_id < 0")).collect() == []
    a, b = prose(random.Random(1), 50), prose(random.Random(2), 50)
    rows = [(5, a), (5, b), (6, a), (7, b + " x"), (None, a), (None, "alone here now"), (None, None), (8, a)]
    got = overlap.jaccard_groups(documents(spark, [(i, t, "", "") for i, t in rows])).collect()
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter(
        {(5, 5): 2, (6, 5): 1, (7, 5): 1, (None, 5): 1, (None, None): 2, (8, 5): 1}
    )


def test_second_search_links_components():
    """A cell names the components that its links join, so what is left to join is small."""
    tokens = np.arange(20)
    sets = [{"class": c, "root": r, "n": 20, "tokens": tokens} for c, r in ((b"b", b"a"), (b"c", b"a"), (b"d", b"d"))]
    assert overlap.cell_links(sets[:2], sets[2:], 90) == [(b"d", b"a")]
    sets = [{**s, "sig": bytes(16), "items": tokens} for s in sets]
    assert neardup.cell_links(sets[:2], sets[2:], 80, 2) == [(b"d", b"a")]


def test_groups_of_both_searches(spark):
    """Classes that only the second search links, and components that it joins, end at their least class."""
    names = [bytes([c]) for c in b"abcdefg"]
    meet = spark.createDataFrame([(1, c, 1) for c in names[:6]] + [(2, names[6], 1)], "block long, class binary, n long")
    heads = spark.createDataFrame([(1, b"b", 1), (2, b"g", 1)], "block long, class binary, n long")
    payload = spark.createDataFrame([(c, 0) for c in names], "class binary, x int")
    first, second = [(b"b", b"c"), (b"b", b"f")], [(b"a", b"b"), (b"d", b"e")]
    for then, wanted in ((second, {b"a": b"a", b"b": b"a", b"c": b"a", b"f": b"a", b"d": b"d", b"e": b"d"}), ([], {b"b": b"b", b"c": b"b", b"f": b"b"})):
        got = cells.grouped(meet, heads, payload, lambda own, asks, then=then: then if len(asks) > 1 else first if len(own) > 1 else [])
        assert sorted((bytes(r.node), bytes(r.root)) for r in got.collect()) == sorted(wanted.items())


def test_divide_skip_finds_what_counting_finds():
    rng = random.Random(4)
    for _ in range(300):
        lists = [sorted(rng.sample(range(40), rng.randint(1, 30))) for _ in range(rng.randint(1, 12))]
        need = rng.randint(1, len(lists))
        count = Counter(x for a in lists for x in a)
        found = {
            r: n + sum(overlap.holds(a, r) for a in long) for r, n, long in overlap.divide_skip(lists, need)
        }
        assert {r: n for r, n in found.items() if n >= need} == {r: n for r, n in count.items() if n >= need}


# ---- the audit ----------------------------------------------------------------------


def brute_audit(rows, least, ranks):
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    groups = set()
    for _, t, la, so in rows:
        la, so = la or "", so or ""
        groups.add((la, so))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
        counts[la, so].update(terms)
        docs[la].update(set(terms))
    out = []
    for la in {g[0] for g in groups}:
        kept = [t for t, n in docs[la].items() if n >= least]
        p = {}
        whole = Counter()
        own = [g for g in groups if g[0] == la]
        for g in own:
            whole.update({t: counts[g][t] for t in kept})
        for key, c in [*((g, counts[g]) for g in own), (None, whole)]:
            n = sum(c[t] for t in kept)
            p[key] = {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}
        for g in own:
            pair = sorted(((-sum(abs(p[g][t] - p[h][t]) for t in kept), h[1].encode()) for h in own if h != g))
            term = sorted((p[None][t] - p[g][t], t.encode()) for t in kept if counts[g][t] and p[g][t] > p[None][t])
            for part, found in (("pair", pair), ("term", term[:ranks])):
                out += [(*g, part, item.decode(), -v, r) for r, (v, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize(("least", "first", "cells"), [(3, 3, 1 << 20), (2, 1, 7), (1000, 3, 1)])
def test_audit_matches_brute_force(spark, odd, monkeypatch, least, first, cells):
    monkeypatch.setattr(divergence, "FIRST_LEVEL", first)
    monkeypatch.setattr(divergence, "CELLS", cells)
    monkeypatch.setattr(divergence, "CHUNK_ENTRIES", 100)
    rng = random.Random(9)
    terms = ["a", "ab", "abc", "abcd", "ABCDE", "abcdef" * 9, "é", "ée", "ß", "日本", "x1y", *(f"{'wxyz'[i % 4]}{'k' * (i % 7)}" for i in range(30))]
    rows = [(i, " ".join(rng.choices(terms, k=25)), rng.choice(["en", "de", None, ""]), rng.choice(["s", "t", "ü", None])) for i in range(60)]
    rows += [(i, t, "en", "s") for i, t in enumerate(odd)] + [(1, None, "xx", "lone"), (1, "", "yy", "a"), (1, "a", "yy", "b"), *rows[:5]]
    got = divergence.audit(documents(spark, rows), least, 4).collect()
    assert sorted(map(tuple, got)) == brute_audit(rows, least, 4)


def test_audit_of_nothing(spark):
    assert divergence.audit(documents(spark, [(1, "a", "", "")]).where("doc_id < 0")).collect() == []


def test_audit_counts_beyond_a_long_product(spark):
    df = spark.createDataFrame([(10**13, 10**14, 10**6)], "c long, n long, v long")
    assert df.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).first()[0] == 1 + 10**9 * (10**13 + 5) // (10**14 + 5 * 10**6)


# ---- the search ---------------------------------------------------------------------


def brute_search(rows, items, k):
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(t))
    docs = [(i, Counter(find(t))) for i, t in rows]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n, length = len(docs), sum(s for _, _, s in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item, text in items:
        asked = Counter(find(text))
        scored = []
        for i, c, size in docs:
            m = 100 - 75 + (75 * size * n) // length
            score = sum(r * floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m)) for t, r in asked.items() if c[t])
            if score > 0:
                scored.append((-score, i is None, i, score))
        out += [(item, r, i, s) for r, (_, _, i, s) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "k"), [(8192, 10), (7, 3)])
def test_search_matches_brute_force(spark, odd, monkeypatch, block, k):
    monkeypatch.setattr(lexical, "DOCUMENTS", block)
    rng = random.Random(12)
    rows = [*enumerate(odd), *((500 + i, prose(rng, rng.randint(1, 60), 40)) for i in range(120))]
    rows += [(None, "w1 w2"), (700, "w1 w2"), (700, "w1 w2"), (701, "W1, w2!")]
    items = [(0, "w1 w2 w3"), (1, None), (2, ""), (3, "one one two"), (4, "nothing here"), (5, prose(rng, 80, 60)), (5, "w7"), (6, "ünï Ünï 7"),
             (7, " ".join(f"w{i}" for i in range(300)))]
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id long, score long")
    got = lexical.search(documents(spark, [(i, t, "en", "a") for i, t in rows]), asked, k).collect()
    assert sorted(map(tuple, got), key=str) == brute_search(rows, items, k)


def test_search_in_several_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 5)
    rows, items = [(1, "a b"), (2, "b c c"), (3, "d")], [(1, "a b"), (2, "c c"), (3, "d e f"), (4, "b")]
    got = lexical.search(documents(spark, [(i, t, "", "") for i, t in rows]), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute_search(rows, items, 10)


def test_search_of_nothing(spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    some = documents(spark, [(1, "a", "", "")])
    assert lexical.search(some.where("doc_id < 0"), items).collect() == []
    assert lexical.search(some, items.where("item_id < 0")).collect() == []
    assert lexical.search(documents(spark, [(1, None, "", ""), (2, "--", "", "")]), items).collect() == []


def test_a_term_in_most_documents_still_counts(spark):
    rows = [(i, "a " + "b " * i) for i in range(9)]
    got = lexical.search(documents(spark, [(i, t, "", "") for i, t in rows]), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute_search(rows, [(1, "a b")], 10)


# ---- the queries against their SQL ----------------------------------------------------


@pytest.mark.parametrize("name", ["op11_ngram_join", "op12_source_divergence", "op13_lexical_search"])
def test_query_equals_sql(spark, sf_dir, name):
    assert oracle.differences(queries.QUERIES[name](spark, sf_dir), oracle.connect(sf_dir), queries.ORACLES[name]) == []


def test_terms_of_long_texts_are_counted_in_pieces(monkeypatch):
    from eavspark.llm import common

    text = ("Ab é" * 500 + " x" * 900).encode()
    whole = common.counted_terms(text, lexical.TERM, lexical.GAP)
    monkeypatch.setattr(common, "CHUNK", 7)
    assert common.counted_terms(text, lexical.TERM, lexical.GAP) == whole and np.sum(list(whole.values())) == whole.total()
