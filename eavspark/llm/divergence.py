"""Source divergence audit by iceberg prefix refinement.

The texts are read once into packed chunks: per chunk of documents and language, every
(term, source) with the documents that hold it and its occurrences, in term order.
Level by level the byte prefixes grow. Each chunk tells how many distinct documents
stand behind each of its prefixes; the sums over all chunks, taken range by range of
the prefixes' hashes, decide which prefixes reach the threshold, and every chunk drops
all terms behind the others. A term whose end is reached is complete, and is kept if
its own documents reach the threshold. The levels end when no open prefix survives, so
the long tail of rare terms is never counted, or shuffled, term by term. What a chunk
is told of a level are the numbers of its own prefixes that survive: nothing of the
vocabulary is broadcast.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eavspark.llm.common import arrow_schema, counted_terms, small_slices
from eavspark.session import materialize

TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
GAP = re.compile(rb"[^A-Za-z\x80-\xff]")
CHUNK_ENTRIES = 1 << 20  # (document, term) entries that a task holds before it writes them
RANGE = 1 << 21  # prefixes of a hash range
CELLS = 1 << 20  # sources times terms of a block of the distance sums
FIRST_LEVEL = 4  # bytes of the first prefixes; every level doubles the length

CHUNK = "chunk long, lang string, entries long, sources string, terms binary, sizes binary, source binary, docs binary, held binary, n binary"


def packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 up in the fewest bytes each, behind one byte that tells how many."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"u{data[0]}", offset=1)


class Chunk:
    """The (term, source) entries of one chunk and language, by term."""

    def __init__(self, row: dict) -> None:
        self.chunk, self.lang, self.sources = row["chunk"], row["lang"], row["sources"]
        self.terms = np.frombuffer(row["terms"], np.uint8)
        self.sizes, self.held, self.n = (unpacked(row[c]).astype(np.int64) for c in ("sizes", "held", "n"))
        self.source, self.docs = unpacked(row["source"]), unpacked(row["docs"])
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes

    def groups(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Number of each entry's prefix of ``length`` bytes, and whether the entry's term is complete.

        Complete terms are prefixes of their own."""
        whole = self.sizes <= length
        new = np.ones(len(whole), bool)
        new[1:] = whole[1:] != whole[:-1]
        block = max(2, (1 << 21) // length)
        place = np.arange(length)
        for at in range(0, len(whole), block - 1):  # blocks share an entry
            start, size = self.starts[at : at + block, None], self.sizes[at : at + block, None]
            found = np.where(place < size, self.terms[np.minimum(start + place, len(self.terms) - 1)], 0)
            new[at + 1 : at + block] |= (found[1:] != found[:-1]).any(axis=1)
        return np.cumsum(new) - 1, whole

    def documents(self, group: np.ndarray, length: int) -> np.ndarray:
        """Distinct documents behind each prefix of ``length`` bytes."""
        entries = np.bincount(group)
        # the documents of one term differ from source to source; only other terms share some
        alone = (entries == 1)[group] | (self.sizes <= length)
        out = np.zeros(len(entries), np.int64)
        np.add.at(out, group[alone], self.held[alone])
        mixed = np.repeat(np.where(alone, -1, group), self.held)
        some = mixed >= 0
        pairs = np.unique(mixed[some] << 32 | self.docs[some].astype(np.int64))
        return out + np.bincount(pairs >> 32, minlength=len(entries))

    def beyond(self, length: int) -> Chunk:
        """Without the terms of at most ``length`` bytes."""
        keep = self.sizes > length
        return self if keep.all() else Chunk(dict(zip(arrow_schema(CHUNK).names, self.row(keep), strict=True)))

    def row(self, keep: np.ndarray) -> tuple:
        """As a row, with the entries of ``keep`` alone."""
        take = lambda data, some: data[np.repeat(keep, some)]
        return (
            self.chunk, self.lang, int(keep.sum()), self.sources, take(self.terms, self.sizes).tobytes(), packed(self.sizes[keep]),
            packed(self.source[keep]), packed(take(self.docs, self.held)), packed(self.held[keep]), packed(self.n[keep]),
        )


class Gathered:
    """Documents of one language, gathered before they become a chunk."""

    def __init__(self) -> None:
        self.numbers: dict[bytes, int] = {}  # of terms
        self.sources: dict[str, int] = {}
        self.terms, self.counts, self.sizes, self.of = (array("I") for _ in range(4))

    def add(self, source: str, found: dict[bytes, int]) -> None:
        numbers = self.numbers
        self.terms.extend([numbers.setdefault(t, len(numbers)) for t in found])
        self.counts.extend(found.values())
        self.sizes.append(len(found))
        self.of.append(self.sources.setdefault(source, len(self.sources)))

    def row(self, lang: str) -> tuple:
        terms, counts, sizes, of = (np.frombuffer(a, np.uint32) for a in (self.terms, self.counts, self.sizes, self.of))
        names = sorted(self.numbers)
        rank = np.empty(len(names), np.int64)
        rank[[self.numbers[t] for t in names]] = np.arange(len(names))
        doc = np.repeat(np.arange(len(sizes), dtype=np.uint32), sizes)
        key = rank[terms] * len(self.sources) + of[doc]
        order = np.argsort(key, kind="stable")  # documents ascend within an entry
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        term, source = np.divmod(key[first], len(self.sources))
        lengths = np.array([len(t) for t in names], np.int64)
        starts = np.cumsum(lengths) - lengths
        size = lengths[term]
        ends = np.cumsum(size)
        data = np.frombuffer(b"".join(names), np.uint8)
        at = np.repeat(starts[term] - (ends - size), size) + np.arange(int(ends[-1]))
        return (
            uuid.uuid4().int >> 65, lang, len(first), json.dumps(list(self.sources)), data[at].tobytes(), packed(size),
            packed(source), packed(doc), packed(np.diff(first, append=len(doc))),
            packed(np.add.reduceat(counts[order].astype(np.int64), first)),
        )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def chunks(docs: DataFrame) -> DataFrame:
    """The texts of (lang, source, text) as packed chunks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Gathered] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, some in held.items():
                if some.numbers:
                    yield _batch([some.row(lang)], CHUNK)
            held.clear()

        for part in small_slices(batches, "text"):
            for lang, source, data in zip(*(c.to_pylist() for c in part.columns), strict=True):
                held.setdefault(lang, Gathered()).add(source, counted_terms(data, TERM, GAP))
                if sum(len(g.terms) for g in held.values()) > CHUNK_ENTRIES:
                    yield from flush()
        yield from flush()

    return docs.select("lang", "source", "text").mapInArrow(run, CHUNK)


def dealt(table: DataFrame, length: int, done: int, ranges: int) -> DataFrame:
    """Every chunk's prefixes, dealt by their hash: the hashes (lowest bit: complete), the
    prefixes' numbers in the chunk, and their distinct documents. Terms complete at
    ``done`` bytes are passed over."""
    ddl = "range long, chunk long, hashes binary, numbers binary, docs binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row).beyond(done)
            if not len(c.sizes):
                continue
            group, whole = c.groups(length)
            first = np.flatnonzero(np.diff(group, prepend=-1))
            terms, salt = c.terms.tobytes(), blake2b(c.lang.encode(), digest_size=16).digest()
            ends = np.minimum(c.ends, c.starts + length)
            digests = b"".join([
                blake2b(terms[a:b], digest_size=8, salt=salt).digest() for a, b in zip(c.starts[first].tolist(), ends[first].tolist(), strict=True)
            ])
            hashes = np.frombuffer(digests, np.uint64) & ~np.uint64(1) | whole[first].astype(np.uint64)
            where = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            docs = c.documents(group, length).astype(np.uint32)
            cuts = np.flatnonzero(np.diff(where[order], prepend=-1))
            yield _batch([
                (int(where[some[0]]), c.chunk, hashes[some].tobytes(), some.astype(np.uint32).tobytes(), docs[some].tobytes())
                for some in np.split(order, cuts[1:])
            ], ddl)

    return table.mapInArrow(run, ddl)


def decided(told: DataFrame, least: int) -> DataFrame:
    """(chunk, numbers, open): the numbers of each chunk's prefixes that ``least`` documents stand behind."""

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk").to_pylist()
        hashes, numbers, docs = (
            [np.frombuffer(b, kind) for b in table.column(name).to_pylist()] for name, kind in (("hashes", np.uint64), ("numbers", np.uint32), ("docs", np.uint32))
        )
        names, which = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.zeros(len(names), np.int64)
        np.add.at(total, which, np.concatenate(docs))
        alive = np.split(total[which] >= least, np.cumsum([len(h) for h in hashes])[:-1])
        rows = [(c, n[a].tobytes(), bool((h[a] & np.uint64(1) == 0).any())) for c, n, h, a in zip(chunk, numbers, hashes, alive, strict=True) if a.any()]
        return pa.Table.from_batches([_batch(rows, "chunk long, numbers binary, open boolean")])

    return told.groupBy("range").applyInArrow(run, "chunk long, numbers binary, open boolean")


def surviving(table: DataFrame, told: DataFrame, length: int, done: int) -> DataFrame:
    """The chunks without the entries of discarded prefixes, and without terms complete
    at ``done`` bytes, which earlier levels have told; none that are empty."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([_batch([], CHUNK)])
        c = Chunk(left.to_pylist()[0]).beyond(done)
        group, _ = c.groups(length)
        alive = np.zeros(int(group[-1]) + 1, bool)
        alive[np.frombuffer(b"".join(right.column("numbers").to_pylist()), np.uint32)] = True
        return pa.Table.from_batches([_batch([c.row(alive[group])], CHUNK)])

    return table.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(run, CHUNK)


def complete(table: DataFrame, length: int, ranges: int) -> DataFrame:
    """The entries whose terms are complete at ``length`` bytes, dealt by the terms' hash;
    each term is written once, where ``first`` marks its first entry."""
    ddl = "range long, lang string, sources string, terms binary, sizes binary, first binary, source binary, held binary, n binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            c = Chunk(row)
            done = np.flatnonzero(c.sizes <= length)
            if not len(done):
                continue
            group = c.groups(length)[0][done]
            first = np.diff(group, prepend=-1) != 0
            data, heads = c.terms.tobytes(), done[first]
            where = np.array([zlib.crc32(data[a:b]) * ranges >> 32 for a, b in zip(c.starts[heads].tolist(), c.ends[heads].tolist(), strict=True)])
            where = where[np.cumsum(first) - 1]
            order = np.argsort(where, kind="stable")
            cuts = np.flatnonzero(np.diff(where[order])) + 1
            out = []
            for some in np.split(order, cuts):
                keep, once = done[some], done[some[first[some]]]
                sizes = c.sizes[once]
                at = np.repeat(c.starts[once] - (np.cumsum(sizes) - sizes), sizes)
                out.append((
                    int(where[some[0]]), c.lang, c.sources, c.terms[at + np.arange(len(at))].tobytes(), packed(sizes),
                    packed(first[some].astype(np.uint8)), packed(c.source[keep]), packed(c.held[keep]), packed(c.n[keep]),
                ))
            yield _batch(out, ddl)

    return table.mapInArrow(run, ddl)


def counted(entries: DataFrame, least: int) -> DataFrame:
    """(lang, source, term, n) of the complete terms that ``least`` documents of their language hold."""
    ddl = "lang string, source string, term binary, n long"

    def run(table: pa.Table) -> pa.Table:
        terms: dict[tuple[str, bytes], int] = {}
        groups: dict[tuple[str, str], int] = {}
        parts = []
        for row in _rows(table.to_batches()):
            lang, data = row["lang"], row["terms"]
            own = np.array([groups.setdefault((lang, s), len(groups)) for s in json.loads(row["sources"])], np.int64)
            ends = np.cumsum(unpacked(row["sizes"]).astype(np.int64)).tolist()
            ids = np.array([terms.setdefault((lang, data[a:b]), len(terms)) for a, b in zip([0, *ends], ends, strict=False)], np.int64)
            ids = ids[np.cumsum(unpacked(row["first"]).astype(np.int64)) - 1]
            parts.append((ids, own[unpacked(row["source"])], *(unpacked(row[c]).astype(np.int64) for c in ("held", "n"))))
        ids, group, held, n = (np.concatenate(p) for p in zip(*parts, strict=True))
        docs = np.zeros(len(terms), np.int64)
        np.add.at(docs, ids, held)
        some = docs[ids] >= least
        key, which = np.unique(ids[some] * len(groups) + group[some], return_inverse=True)
        total = np.zeros(len(key), np.int64)
        np.add.at(total, which, n[some])
        names, places = list(terms), list(groups)
        rows = [(*places[k % len(groups)], names[k // len(groups)][1], t) for k, t in zip(key.tolist(), total.tolist(), strict=True)]
        return pa.Table.from_batches([_batch(rows, ddl)])

    return entries.groupBy("range").applyInArrow(run, ddl)


def kept_terms(docs: DataFrame, least: int) -> DataFrame:
    """(lang, source, term, n): occurrences of every term found in ``least`` documents of its language or more."""
    length, done = FIRST_LEVEL, 0
    table = materialize(chunks(docs), "chunks")
    ranges, found = 0, None
    while True:
        now = max(1, -(-(table.agg(F.sum("entries")).first()[0] or 0) // RANGE))
        ranges = ranges or now
        told = materialize(decided(dealt(table, length, done, now), least), "prefixes")
        table = materialize(surviving(table, told, length, done), "chunks")
        terms = complete(table, length, ranges)
        found = terms if found is None else found.unionByName(terms)
        if told.where("open").isEmpty():
            # prefixes are told apart by hashes; here the terms themselves decide
            return counted(found, least)
        length, done = 2 * length, length


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(1000000000 * (count + 5) / (total + 5 * kept)), exact for any long."""
    over = F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 5).cast("decimal(19,0)")
    return F.call_function("div", over, (total + 5 * kept).cast("decimal(19,0)")) + 1


def distances(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): the sum over kept terms of abs(p - q), per ordered pair of sources.

    ``shares`` has the terms that a group holds (lang, source, term, p), ``groups`` the
    share of a term it does not hold, and the language's numbers of sources and terms.
    Terms are cut in blocks; a block is a small dense matrix of sources and terms.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("kept") * F.col("sources") / CELLS)).cast("long")
    sized = groups.withColumn("blocks", blocks)
    filled = shares.join(sized.select("lang", "source", "blocks"), ["lang", "source"]).select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block"), "source", "term", "p"
    )
    bare = sized.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "source", F.lit(None).cast("string").alias("term"), F.col("base").alias("p")
    )

    def sums(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        missing = table.column("term").combine_chunks().is_null().to_numpy(zero_copy_only=False)
        sources = table.column("source").combine_chunks()
        p = table.column("p").to_numpy()
        names = sorted(sources.filter(pa.array(missing)).to_pylist())
        place = {s: i for i, s in enumerate(names)}
        row = np.array([place[s] for s in sources.to_pylist()], np.int64)
        base = np.zeros(len(names), np.int64)
        base[row[missing]] = p[missing]
        column = table.column("term").combine_chunks().filter(pa.array(~missing)).dictionary_encode()
        cells = np.repeat(base[:, None], len(column.dictionary), axis=1)
        cells[row[~missing], column.indices.to_numpy()] = p[~missing]
        out = [np.abs(cells[i + 1 :] - cells[i]).sum(axis=1) for i in range(len(names))]
        left = np.repeat(np.arange(len(names)), [len(o) for o in out])
        right = np.concatenate([np.arange(i + 1, len(names)) for i in range(len(names))]) if names else left
        return pa.table({
            "lang": pa.array([lang] * len(left), pa.string()), "a": pa.array([names[i] for i in left], pa.string()),
            "b": pa.array([names[i] for i in right], pa.string()), "value": pa.array(np.concatenate(out) if out else [], pa.int64()),
        })

    halves = filled.unionByName(bare).groupBy("lang", "block").applyInArrow(sums, "lang string, a string, b string, value long")
    pairs = halves.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ends = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return pairs.select("lang", "value", ends.alias("e")).select("lang", "e.source", "e.item", "value")


def audit(
    df: DataFrame, least: int = 30, ranks: int = 50, text: str = "text", lang: str = "lang", source: str = "source",
) -> DataFrame:
    """(lang, source, part, item, value, rank): how far sources of a language differ, and by which terms.

    Terms are runs of letters and of characters beyond ASCII, A-Z lower-cased. Null
    text, lang and source are read as empty. A language keeps the terms of ``least``
    documents or more; repeated rows are documents of their own. Part ``pair`` has every
    other source of the language with the summed difference of shares (0 without kept
    terms), part ``term`` the ``ranks`` terms whose share exceeds the language's most.
    Equal values rank by the item's bytes. Texts of any length are read whole, a piece
    at a time; other columns are not read; an empty table gives no rows.
    """
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for n, c in (("lang", lang), ("source", source), ("text", text))))
    counts = materialize(kept_terms(docs, least).withColumn("term", F.col("term").cast("string")), "kept")
    pairs = docs.select("lang", "source").distinct()
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"))
    kept = of_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("all").alias("lang_total"))
    held = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        pairs.join(held, ["lang", "source"], "left").join(kept, "lang", "left").na.fill(0, ["total", "kept", "lang_total"])
        .withColumn("base", F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))).otherwise(0))
    )
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    groups = materialize(groups.join(sources, "lang"), "groups")
    shares = materialize(
        counts.join(groups, ["lang", "source"]).join(of_lang, ["lang", "term"]).select(
            "lang", "source", "term", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
            share(F.col("all"), F.col("lang_total"), F.col("kept")).alias("q"),
        ), "shares",
    )
    pair = distances(shares, groups).withColumn("part", F.lit("pair"))
    term = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"), F.lit("term").alias("part"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    few = term.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranks)
    order = ["lang", "source", "part", "item", "value", "rank"]
    return pair.withColumn("rank", F.row_number().over(best)).select(order).unionByName(few.select(order))
