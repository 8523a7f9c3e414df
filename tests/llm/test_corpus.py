"""The corpus operators against brute force, on small tables with the odd cases in."""

import base64
import bz2
import gzip
import hashlib
import lzma
import random
import re
import urllib.parse
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from eavspark.llm import hosts, mixing, neardup, neighbours, queries, secrets, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, class string, host string"


def documents(spark, texts, sources=("a",), first=0):
    rows = [(i, t, "en", sources[i % len(sources)], len(t or ""), "x", "y") for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def prose(rng, n, words=tuple(f"w{i}" for i in range(400))):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(5)
    long = prose(rng, 30_000)
    base = [prose(rng, 80) for _ in range(12)]
    near = [" ".join([*b.split()[:-2], "other", "end"]) for b in base[:6]]
    lines = "one line\nanother line\none line\n\n \none line"
    return [None, "", " \n\t", "one", "one two three", long, long, lines, "Ünï ünï Ünï # $ |", *base, *near, *base[:3],
            " ".join(["same"] * 200), "A b C d e", "a B c D E"]


def test_near_duplicates_match_all_pairs(spark, odd):
    texts = {i: t for i, t in enumerate(odd)}
    got = {r.doc_id: r for r in neardup.near_duplicates(documents(spark, odd), words=4).collect()}
    sets = {}
    for i, t in texts.items():
        w = [re.sub("[A-Z]", lambda m: m.group().lower(), x) for x in WORD.findall(t or "")]
        sets[i] = {tuple(w[j : j + 4]) for j in range(max(1, len(w) - 3))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sets:
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    for i in sets:
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(sets[i]), find(i), find(i) == i)


def test_near_duplicates_in_one_large_group(spark):
    rng = random.Random(6)
    words = prose(rng, 120).split()
    texts = []
    for i in range(300):  # each differs from the first in one word, so from each other in two
        w = list(words)
        w[i % 120] = f"new{i}"
        texts.append(" ".join(w))
    got = neardup.near_duplicates(documents(spark, texts), words=4)
    assert got.select("component_id").distinct().collect() == [(0,)]
    assert got.where("kept").count() == 1


def test_near_duplicates_of_nothing(spark):
    empty = documents(spark, ["x"]).where("doc_id < 0")
    assert neardup.near_duplicates(empty).collect() == []
    assert [(r.component_id, r.kept) for r in neardup.near_duplicates(documents(spark, [None])).collect()] == [(0, True)]


def test_near_duplicates_with_shared_ids(spark):
    rng = random.Random(10)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (None, a)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=4).collect()
    assert {r.component_id for r in got} == {1} and sum(r.kept for r in got) == 2


def test_components_stop_at_stars(spark, monkeypatch):
    """Links that already lead to the least node need no round, and no round is spent on seeing that nothing changes."""
    from eavspark.llm import cells

    stored, store = [], cells.materialize
    monkeypatch.setattr(cells, "materialize", lambda *a: stored.append(1) or store(*a))
    for edges, times in (([(1, 2), (3, 1), (7, 9)], 1), ([(2, 1), (2, 3)], 2), ([], 1)):
        stored.clear()
        got = {r.node: r.root for r in cells.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {n: 7 if n > 6 else 1 for e in edges for n in e} and len(stored) == times


def test_components_end_with_the_least_node(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 200), (200, 300), (100, 300)]
    got = {r.node: r.root for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, 100: 100, 200: 100, 300: 100}


SECRET = "password=hunter2secret"


@pytest.mark.parametrize("carried", [
    base64.b64encode(SECRET.encode()).decode(),
    base64.urlsafe_b64encode(base64.b64encode(SECRET.encode())).decode().rstrip("="),
    urllib.parse.quote(base64.b64encode(gzip.compress(SECRET.encode())).decode(), safe=""),
    "".join(f"\\u{ord(c):04x}" for c in SECRET),
    "".join(f"&#{ord(c)};" for c in SECRET),
    "".join(f"%{ord(c):02X}" for c in SECRET),
])
def test_secrets_in_layers(carried):
    base, found, layers = secrets.find("é " + carried + " end")
    assert not base and SECRET in layers[-1]
    assert (2, 0) in {(a, k) for a, k, _ in found}
    assert all(b <= 2 + len(carried) for _, _, b in found)


@pytest.mark.parametrize("beside", [b"\x00", b"\x1b[31m", b"caf\xe9 ", b"\xff\x80\xc3\xa9 "])
@pytest.mark.parametrize("encode", [
    lambda b: base64.b64encode(b).decode(),
    lambda b: base64.b64encode(gzip.compress(b)).decode(),
    lambda b: "".join(f"%{c:02X}" for c in b),
])
def test_secrets_beside_bytes_that_are_no_text(encode, beside):
    carried = encode(beside + SECRET.encode() + b" " + beside)
    found = secrets.find("see " + carried + " end")[1]
    assert {k for _, k, _ in found} == {0}
    assert all(4 <= a < b <= 4 + len(carried) for a, _, b in found)
    if carried == base64.b64encode(beside + SECRET.encode() + b" " + beside).decode():
        n = len(beside)
        assert found == {(4 + n * 8 // 6, 0, 4 + ((n + len(SECRET)) * 8 - 1) // 6 + 1)}


def wrapped(data, width, end="\n"):
    run = base64.b64encode(data).decode()
    return end.join(run[i : i + width] for i in range(0, len(run), width))


@pytest.mark.parametrize("width", [64, 76, 10, 61])
@pytest.mark.parametrize("end", ["\n", "\r\n", "\n    "])
def test_secrets_in_wrapped_base64(width, end):
    rng = random.Random(7)
    long = " ".join([prose(rng, 90), SECRET, prose(rng, 90)]).encode()
    for data in (long, gzip.compress(long), b"x" * 38 + SECRET.encode()):
        text = "see below" + end + wrapped(data, width, end) + end + "bye\n"
        found = secrets.find(text)[1]
        assert {k for _, k, _ in found} == {0}
        a, _, b = min(found)
        assert len("see below" + end) <= a < b < len(text)
        if data is not long:
            continue
        # the span holds the characters that carry the secret, and no more than a group more
        digits = "".join(text[a:b].split())
        assert any(SECRET.encode() in base64.b64decode(("A" * k + digits + "AAAA")[: (k + len(digits) + 4) // 4 * 4]) for k in range(4))
        assert len(digits) <= len(SECRET) * 8 // 6 + 2


@pytest.mark.parametrize("glue", ["path/", "key_", "a-b-", "x", "xy", "xyz", "/a/b/c/", "-----"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_secrets_in_glued_base64(glue, pack):
    run = base64.b64encode(pack(SECRET.encode())).decode().rstrip("=")
    found = secrets.find(glue + run + "/more_")[1]
    assert {k for _, k, _ in found} == {0}
    a, _, b = min(found)
    if pack is bytes:
        assert found == {(len(glue), 0, len(glue) + len(run))}
    else:
        assert a <= len(glue) and b >= len(glue) + len(run)


def test_secrets_beside_escapes_of_no_character():
    run = "\\ud800" + "".join(f"\\u{ord(c):04x}" for c in SECRET) + "&#9999999;"
    assert secrets.find(run)[1] == {(0, 0, len(run))}


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress])
def test_secrets_in_long_torn_and_joined_streams(pack):
    def kinds(data):
        text = "see " + base64.b64encode(data).decode()
        found = secrets.find(text)[1]
        assert all(4 <= a < b <= len(text) for a, _, b in found)
        return {k for _, k, _ in found}

    secret, key = SECRET.encode(), b"AKIA" + b"A" * 16
    assert kinds(pack(b"no more") + pack(secret) + pack(key)) == {0, 1}
    assert kinds(pack(b"ab " + secret[:10]) + pack(secret[10:])) == {0}  # across members
    rest = bytes(random.Random(8).randbytes(300_000))
    whole = pack(secret + b" " + rest)
    if pack is not bz2.compress:  # its blocks are whole or nothing
        assert kinds(whole[: len(whole) // 2]) == {0}
        broken = whole[:200_000] + b"\xff" * 40 + whole[200_040:]
        assert 0 in kinds(broken)
    blank = b"ab cd " * (11 << 20)  # 66 MB
    assert kinds(pack(blank + secret)) == {0}
    assert kinds(pack(blank[: secrets.PIECE - 8] + secret + blank[: secrets.PIECE])) == {0}


PACKS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress]


@pytest.mark.parametrize("inner", PACKS)
@pytest.mark.parametrize("outer", PACKS)
def test_secrets_in_streams_in_streams(inner, outer):
    def kinds(data):
        text = "see " + base64.b64encode(data).decode() + " end"
        return {k for a, k, b in secrets.find(text)[1] if (a, b) == (4, len(text) - 4)}

    secret, key = SECRET.encode(), b"AKIA" + b"A" * 16
    assert kinds(outer(inner(secret))) == {0}
    assert kinds(outer(outer(inner(b"\x00" + inner(secret))))) == {0}
    assert kinds(outer(b"\xff\x00 a" + inner(secret) + b"\x80 b" + inner(key))) == {0, 1}
    rest = bytes(random.Random(8).randbytes(300_000))
    if inner is not bz2.compress:  # its blocks are whole or nothing
        assert kinds(outer(inner(secret + b" " + rest)[:200_000] + b"\xff" * 40 + key)) >= {0, 1}


def test_secrets_in_long_streams_in_streams():
    rng = random.Random(8)
    long = gzip.compress(rng.randbytes(secrets.PIECE) + b" " + SECRET.encode() + b" " + rng.randbytes(2 * secrets.PIECE), 1)
    data = rng.randbytes(3 * secrets.PIECE // 2) + long + rng.randbytes(secrets.PIECE) + zlib.compress(b"\xff AKIA" + b"A" * 16 + b" ")
    pieces = [data[i : i + 70_000] for i in range(0, len(data), 70_000)]
    found = [b"".join(s) for s in secrets.streams(pieces)]
    assert gzip.decompress(long) in found and any(b"AKIA" in x for x in found)
    windows = list(secrets.contents(secrets.Stream(bz2.compress(data), 0)))
    assert any(SECRET.encode() in x for x in windows) and any(b"AKIA" in x for x in windows)
    assert list(secrets.streams([])) == []


def test_streams_are_opened_however_deep_and_once():
    data = SECRET.encode()
    for _ in range(1500):
        data = zlib.compress(data)
    assert {k for _, k, _ in secrets.find(base64.b64encode(data).decode())[1]} == {0}
    same = gzip.compress(b"plain enough text")
    assert sum(b"enough" in x for x in secrets.contents(secrets.Stream(gzip.compress(same + b"\xff" + same), 0))) == 1


def test_windows_share_what_lies_across():
    nested = base64.b64encode(prose(random.Random(9), 900_000).encode())
    data = b"ab cd " * 200_000 + nested + b" ef gh" * 200_000
    parts = list(secrets.windows(data[i : i + 70_000] for i in range(0, len(data), 70_000)))
    assert len(parts) > 2 and any(nested in p for p in parts)
    assert list(secrets.windows([])) == []


def test_wholly_binary_runs_are_no_layers():
    assert secrets.find(base64.b64encode(b"\x00\xff" * 64).decode())[2] == []


def test_secrets_end_on_cycles_and_match_brute_force(spark):
    texts = [None, "", "token: 'abcdef' PASSWORD=\"x\" api_key=1234567", "AKIA" + "A" * 16 + " AKIAAAA", "f" * 24 + "g" + "0" * 23,
             "%25" * 50, "a%2525252525", "é secret=ééé passwd = qwertz", "%41%4", "Kelvin toKen=abcdefg toKen=abcdefg"]
    patterns = [(secrets.ASSIGN, 2, 6), (re.compile("AKIA[A-Z0-9]+"), 0, 20), (re.compile("[0-9a-f]+"), 0, 24)]
    for r in secrets.secrets(documents(spark, texts)).collect():
        spans = sorted(
            (m.start(), k, m.end()) for k, (p, g, n) in enumerate(patterns) for m in p.finditer(texts[r.doc_id] or "") if len(m.group(g)) >= n
        )
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def test_redaction_keeps_the_rest(spark):
    texts = ["a token=abcdef b", None, "clean"]
    got = {r.doc_id: r.text for r in secrets.redacted(documents(spark, texts)).collect()}
    assert got == {0: "a [secret] b", 1: None, 2: "clean"}


def test_host_measures_match_brute_force(spark, odd):
    got = {r.doc_id: r for r in hosts.host_rules(documents(spark, odd, ("a", None, "b"))).collect()}
    for i, text in enumerate(odd):
        t = text or ""
        w = WORD.findall(t)
        count = Counter(zip(w, w[1:], w[2:]))
        covered = {j + k for j, g in enumerate(zip(w, w[1:], w[2:])) if count[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in hosts.SYMBOLS for c in t), len(lines) - len(set(lines)), len(covered))
        assert tuple(got[i][m] for m in hosts.MEASURES) == want
        assert got[i].base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w))
        assert not (got[i].kept and got[i].base_failed)


def test_a_bad_host_goes_and_a_small_one_is_shrunk(spark):
    rng = random.Random(7)
    rows = [("good", prose(rng, 60))] * 1 + [(h, prose(rng, 60)) for h in ("good", "fine", "calm") for _ in range(40)]
    rows += [("bad", "short")] * 45 + [("bad", prose(rng, 60))] * 3 + [("tiny", prose(rng, 60)), ("tiny", "no")]
    df = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    got = hosts.host_rules(df).join(df, "doc_id").where("not base_failed").groupBy("source").agg(F.min("kept").alias("k")).collect()
    assert dict((r.source, r.k) for r in got) == {"good": True, "fine": True, "calm": True, "tiny": True, "bad": False}


def test_mixing_takes_sources_to_target(spark):
    rng = random.Random(8)
    texts = [prose(rng, rng.randrange(1, 90)) for _ in range(200)] + [None, "", " "]
    df = documents(spark, texts, ("b", None, "a", "é"))
    once, again = (sorted(tuple(r) for r in mixing.shares(df.repartition(n)).collect()) if n else None for n in (2, 5))
    assert once == again
    taken, goal, sizes = defaultdict(int), {}, defaultdict(int)
    for r in mixing.shares(df).collect():
        assert r.size == len(WORD.findall(texts[r.doc_id] or "")) and 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
        sizes[r.source] += r.size
        goal[r.source] = r.target
    assert all(abs(taken[s] - goal[s]) < 1 and goal[s] <= 2 * sizes[s] for s in goal)
    assert abs(sum(goal.values()) - 1.5 * sum(sizes.values())) < 1e-6
    words = mixing.mix(df).select(F.sum(F.regexp_count("text", F.lit(WORD.pattern))).alias("n")).first().n
    assert words == sum(taken.values())


def test_targets_are_shared_again():
    assert mixing.targets([10, 10, 100], [3, 1, 2], 180, 2) == [20.0, 20.0, 140.0]
    assert mixing.targets([0, 0], [3, 1], 0, 2) == [0.0, 0.0]
    assert mixing.targets([], [], 0, 2) == []


def test_quality_on_held_out_documents(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = queries.QUERIES["op10_quality"](spark, sf_dir).join(labels, "doc_id").where("held_out and quality = 1")
    n, right = got.count(), got.where("predicted = 1").count()
    assert right >= 0.9 * n


def test_classifiers_on_odd_texts(spark, odd):
    docs = documents(spark, odd)
    labels = spark.createDataFrame([(9, 1, 0), (10, 0, 1), (None, 1, 1), (11, None, None)], "doc_id long, quality int, toxic int")
    model = neighbours.fit(docs, labels)
    scores = neighbours.predict(docs, model).collect()
    assert len(scores) == len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in scores)
    nothing = neighbours.fit(docs, labels.where("false"))
    assert {r.score for r in neighbours.predict(docs, nothing).collect()} == {0.5}
    chain = toxicity.fit(docs, labels, {"toxic": F.col("toxic") == 1, "low": F.col("quality") == 0})
    assert toxicity.predict(docs, chain).count() == len(odd)
    assert toxicity.predict(docs.where("false"), toxicity.fit(docs, labels.where("false"), {"toxic": F.col("toxic") == 1})).collect() == []


def test_the_chain_finds_toxic_words(spark):
    rng = random.Random(9)
    texts = [prose(rng, 60) + (" moron!" if i % 4 == 0 else "") for i in range(240)]
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(160)], "doc_id long, toxic int")
    chain = toxicity.fit(docs, labels, {"first": F.col("toxic") == 1, "second": F.col("toxic") == 1})
    got = {r.doc_id: r.p_second for r in toxicity.predict(docs, chain).collect()}
    assert all((got[i] >= 0.5) == (i % 4 == 0) for i in range(160, 240))
