"""Language, search, token files and packing against brute force."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from eavspark.llm import binpack, langid, token_blocks, topk

ENCODE = {}


def ids_of(name, text):
    from tokenizers import Tokenizer

    tok = ENCODE.setdefault(name, Tokenizer.from_file(token_blocks.default_tokenizer(name)))
    return tok.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    some = [" ".join(rng.choice(["ab", "the", "Ünï", "12", "zq!", "漢字"]) for _ in range(rng.randrange(1, 900))) for _ in range(30)]
    return [None, "", " \n", "x", " ".join(["long"] * 9000), *some, some[0]]


def documents(spark, texts):
    rows = [(i * 3, t, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)


def test_top_k_matches_brute_force(spark):
    rng = random.Random(1)
    vectors = {i: [rng.choice([-1.0, -0.3, 0.0, 0.01, 0.7]) for _ in range(6)] for i in range(120)}
    vectors |= {50: None, 7: [1.0, None, 0.0, 0.0, 0.0, 0.0], 8: [math.nan] * 6, 9: [math.inf] * 6, 11: vectors[10], 12: vectors[10]}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, candidates_per_block=17, queries_per_block=2).collect()
    whole = {i: [math.floor(256 * x) for x in v] for i, v in vectors.items() if v and all(x is not None and math.isfinite(x) for x in v)}
    want = set()
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)[:5]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want and len(got) == len(want)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize(("big", "width"), [(0.0, 2), (127.0, 2), (-128.0, 2), (128.0, 4), (1e7, 8)])
def test_top_k_holds_weights_on_the_bytes_they_need(spark, big, width):
    vectors = {i: [0.5 * i, -1.0, big] for i in range(12)} | {50: [1.0, 0.25, big], 100: []}
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    block = topk.blocks(topk.quantized(df, "vec_id", "embedding", 256.0), 1, "c").first()
    assert len(block["weights"]) == width * 3 * 13 and len(block["ids"]) == 8 * 14
    whole = {i: [math.floor(256 * x) for x in v] for i, v in vectors.items()}
    want = set()
    for q in (0, 50, 100):
        best = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)[:5]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).select("query_id", "rank", "vec_id", "score").collect()} == want


def test_top_k_copies_blocks_seldom(spark, monkeypatch):
    """The candidates are copied once per block of queries, so those are as large as theirs."""
    counts = []
    monkeypatch.setattr(topk, "blocks", lambda df, count, name, made=topk.blocks: counts.append(count) or made(df, count, name))
    df = spark.range(50 * 600).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"))
    topk.top_k(df, F.col("vec_id") % 50 == 0)
    assert counts == [8, 1]  # candidates, queries


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_ids_are_cut_in_blocks_of_128(n):
    ids = np.array([random.Random(i).choice([3, 9, 70, 2**32 - 1 if i % 50 == 0 else 5]) for i in range(n)], np.uint64)
    assert len(token_blocks.encode_blocks(ids)) == -(-n // 128)


def test_token_files_give_every_text_back(spark, texts):
    got = {r["doc_id"]: r for r in token_blocks.read(token_blocks.write(documents(spark, texts), token_blocks.default_tokenizer("word_bpe_49k.json"))).collect()}
    start = 0
    for i, t in enumerate(texts):
        ids = [*ids_of("word_bpe_49k.json", t), 2]
        r = got[i * 3]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), crc(ids))
        start += len(ids)
    assert len(got) == len(texts)


def test_packing_is_gapless_and_whole(spark, texts):
    got = binpack.pack(documents(spark, texts), token_blocks.default_tokenizer("byte_bpe_50k.json")).collect()
    docs, bins = {}, {}
    for r in got:
        docs.setdefault(r["doc_id"], []).append(r)
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    total = 0
    for i, t in enumerate(texts):
        ids = [*ids_of("byte_bpe_50k.json", t), 0]
        total += len(ids)
        pieces = sorted(docs[i * 3], key=lambda r: r["piece"])
        assert [p["piece"] for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 2048)
        at = 0
        for p in pieces:
            assert p["start"] == at and p["ids_crc32"] == crc(ids[at : at + p["length"]])
            at += p["length"]
        assert at == len(ids) and all(p["length"] == 2048 for p in pieces[1:])
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert -(-total // 2048) <= len(bins) <= -(-total // 2048) + 1


def test_language_of_odd_texts(spark):
    rows = [(1, "aba bab abba", "x"), (2, "cdc dcd cddc", "y"), (3, None, "x"), (4, "12 !?", "y"), (5, "abba", None), (6, "", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r for r in langid.predict(df, langid.learn(df)).collect()}
    assert [got[i]["lang_pred"] for i in range(1, 7)] == ["x", "y", "und", "und", "x", "und"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert {r["lang_pred"] for r in langid.predict(df, {}).collect()} == {"und"}


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_plain_call(vocabulary):
    """Also with added tokens' strings in the texts, and with a table that overflows."""
    import random

    from eavspark.llm import encoding

    pieces = encoding.WITH_SPACE if vocabulary.startswith("byte") else encoding.WITHOUT_SPACE
    rng = random.Random(3)
    words = ["a", "B", "foo", "it's", "12", "x1", "é", "é", "日本", "🙂", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "b<|endoftext|>c",
             "</w>", "!!", "don't", "\x00", "​", "Ω", "ﬁ", *(f"w{i}" for i in range(300))]
    gaps = [" ", "  ", "\n", "\n\n", "\t", " \n ", "\r\n", "\xa0", "　", "", "   "]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    texts += ["", " ", "\n", "a <|endoftext|> b", "<|startoftext|>", "x" * 5000]
    plain = [ids_of(vocabulary, t) for t in texts]
    for kept in (1 << 20, 40):
        encoder = encoding.Encoder(token_blocks.default_tokenizer(vocabulary), pieces, kept)
        for _ in range(2):
            got = [np.frombuffer(b, "<u4").tolist() for at in range(0, len(texts), 50) for b in encoder(texts[at : at + 50])]
            assert got == plain


@pytest.mark.parametrize("vocabulary", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_are_learned_once_with_any_mark_behind_them(vocabulary):
    """The library meets a word once, not once for every mark (and case, where that counts for nothing)."""
    from eavspark.llm import encoding

    spaced = vocabulary.startswith("byte")
    encoder = encoding.Encoder(token_blocks.default_tokenizer(vocabulary), encoding.WITH_SPACE if spaced else encoding.WITHOUT_SPACE)
    met = []
    library = encoder._tokenizer

    class Counting:
        def encode_batch_fast(self, texts, **options):
            met.extend(texts)
            return library.encode_batch_fast(texts, **options)

    encoder._tokenizer = Counting()
    words = ["wandering", "niñera", "crème", "H"]
    texts = [f" {w}{mark}" for w in words for mark in ("", ".", ",", "!!", ";", "###", "\u0331", "×", "\xa0 ", "'s")]
    texts += [] if spaced else [t.upper() for t in texts]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    text = " ".join(met).lower()
    # alone, and before what is no ASCII mark (an accent, a cross, a space, an apostrophe), where capitals stay but before the last
    assert text.count("wandering") == (5 if spaced else 8)


def test_gathered_rows_stay_whole_and_in_order():
    import pyarrow as pa
    from eavspark.llm import encoding

    texts = [None, "", "é" * 3000, *("ab cd" for _ in range(700)), None, "x" * 50]
    table = pa.table({"id": range(len(texts)), "text": texts})
    got = list(encoding.gathered(iter(table.to_batches(max_chunksize=90)), "text", 1000))
    assert [(i, None if t is None else t.decode()) for b in got for i, t in zip(*(c.to_pylist() for c in b.columns), strict=True)] == list(enumerate(texts))
    assert max(b.column(1).nbytes for b in got if b.num_rows > 1) < 2 * 1000 + 8 * 256 + 6000
