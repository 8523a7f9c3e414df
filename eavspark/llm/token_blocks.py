"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of consecutive documents. Ids are cut in blocks of 128; a block
stores its minimum, the differences to it packed at a width that a chosen percentile
of them fits, and, for the few that do not fit, an exception list of places and high
bits. The starts of all blocks stand in an index at the end, so any id can be reached
without decoding what stands before it.

    file   = "TKB1" | block ... | documents | index | footer
    block  = minimum u32 | width u8 | exceptions u8 | packed 16 * width bytes
             | places u8 ... | high bits u32 ...
    documents = doc_id i64 ... | null flag u8 ... | number of ids i64 ...
    index  = start of every block u64 ...
    footer = ids u64 | documents u64 | blocks u64 | place of documents u64 | "TKB1"
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eavspark.llm.encoding import WITHOUT_SPACE, encoder_for, gathered
from eavspark.session import materialize, shared_dir

BLOCK = 128
MAGIC = b"TKB1"
FOOTER = struct.Struct("<QQQQ4s")


def _bits(x: np.ndarray) -> np.ndarray:
    """How many bits each whole number up to 2**32 needs."""
    return np.frexp(x.astype(np.float64))[1]


def encode_blocks(ids: np.ndarray, percentile: float = 90.0) -> list[bytes]:
    """Blocks of 128 ids; a last block that is not full repeats its first id."""
    count = -(-len(ids) // BLOCK)
    if not count:
        return []
    full = np.empty(count * BLOCK, "<u4")
    full[: len(ids)] = ids
    full[len(ids) :] = ids[(count - 1) * BLOCK]
    v = full.reshape(count, BLOCK)
    low = v.min(axis=1)
    v = v - low[:, None]
    place = min(BLOCK - 1, int(BLOCK * percentile / 100))
    width = _bits(np.partition(v, place, axis=1)[:, place])
    block, at = np.nonzero(v >= np.ldexp(1.0, width)[:, None])
    odd = np.bincount(block, minlength=count)
    ends = np.cumsum(6 + 16 * width + 5 * odd)
    starts = np.append(0, ends[:-1])
    out = np.empty(ends[-1], np.uint8)
    out[starts[:, None] + np.arange(4)] = low.view(np.uint8).reshape(-1, 4)
    out[starts + 4], out[starts + 5] = width, odd
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        bits = np.unpackbits(v[of].view(np.uint8).reshape(-1, BLOCK, 4), axis=2, count=int(w), bitorder="little")
        packed = np.packbits(bits.reshape(len(of), BLOCK * int(w)), axis=1, bitorder="little")
        out[starts[of][:, None] + 6 + np.arange(16 * w)] = packed
    places, high = _exceptions(starts, width, odd, block)
    out[places] = at
    out[high] = (v[block, at].astype(np.uint64) >> width[block].astype(np.uint64)).astype("<u4").view(np.uint8).reshape(-1, 4)
    data = out.tobytes()
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _exceptions(starts: np.ndarray, width: np.ndarray, odd: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the place and the high bits (four bytes) of every exception stand; ``block`` is its block."""
    nth = np.arange(len(block)) - (np.cumsum(odd) - odd)[block]
    places = (starts + 6 + 16 * width)[block]
    return places + nth, (places + odd[block] + 4 * nth)[:, None] + np.arange(4)


def decode_blocks(data: bytes, starts: np.ndarray, total: int) -> np.ndarray:
    """The first ``total`` ids of the blocks that begin at ``starts`` in ``data``."""
    if not len(starts):
        return np.empty(0, np.uint32)
    raw = np.frombuffer(data, np.uint8)
    low = raw[starts[:, None] + np.arange(4)].view("<u4")
    width, odd = raw[starts + 4].astype(int), raw[starts + 5].astype(int)
    out = np.empty((len(starts), BLOCK), "<u4")
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        packed = raw[starts[at][:, None] + 6 + np.arange(16 * w)]
        bits = np.zeros((len(at), BLOCK, 32), np.uint8)
        bits[:, :, :w] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(at), BLOCK, int(w))
        out[at] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
    block = np.repeat(np.arange(len(starts)), odd)
    places, high = _exceptions(starts, width, odd, block)
    out[block, raw[places]] |= raw[high].view("<u4")[:, 0] << width[block].astype(np.uint32)
    return (out + low).reshape(-1)[:total].astype(np.uint32)


class Writer:
    """One file of blocks; holds less than ``hold`` ids at a time."""

    def __init__(self, stream, hold: int = 1 << 17) -> None:
        self.stream, self.hold = stream, hold
        self.pending: list[bytes] = []
        self.waiting = self.total = 0
        self.place, self.starts, self.docs = 4, [], []
        stream.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        self.docs.append((doc_id or 0, doc_id is None, n))
        self.pending.append(ids)
        self.waiting += n
        self.total += n
        if self.waiting >= self.hold:
            self._give(False)

    def _give(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.pending), "<u4")
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for block in encode_blocks(ids[:whole]):
            self.starts.append(self.place)
            self.stream.write(block)
            self.place += len(block)
        self.pending, self.waiting = [ids[whole:].tobytes()], len(ids) - whole

    def close(self) -> None:
        self._give(True)
        ids, null, n = zip(*self.docs, strict=True) if self.docs else ((), (), ())
        for values, kind in ((ids, "<i8"), (null, "u1"), (n, "<i8"), (self.starts, "<u8")):
            self.stream.write(np.array(values, kind).tobytes())
        self.stream.write(FOOTER.pack(self.total, len(self.docs), len(self.starts), self.place, MAGIC))
        self.stream.close()


def read_file(source, step: int = 2048) -> Iterator[tuple[int | None, bytes]]:
    """(doc_id, ids as bytes) of every document, ``step`` blocks decoded at a time."""
    end = source.size()
    total, docs, blocks, place, magic = FOOTER.unpack(source.read_at(FOOTER.size, end - FOOTER.size))
    if magic != MAGIC:
        raise ValueError("not a file of token blocks")
    tail = source.read_at(17 * docs + 8 * blocks, place)
    names = np.frombuffer(tail, "<i8", docs)
    null = np.frombuffer(tail, "u1", docs, 8 * docs)
    counts = np.frombuffer(tail, "<i8", docs, 9 * docs)
    starts = np.append(np.frombuffer(tail, "<u8", blocks, 17 * docs).astype(np.int64), place)
    held, begin, at = b"", 0, 0

    def more() -> bytes:
        nonlocal at
        upto = min(at + step, blocks)
        data = source.read_at(int(starts[upto] - starts[at]), int(starts[at]))
        n = min(upto * BLOCK, total) - at * BLOCK
        got = decode_blocks(data, starts[at:upto] - starts[at], n).astype("<u4").tobytes()
        at = upto
        return got

    for name, missing, n in zip(names.tolist(), null.tolist(), counts.tolist(), strict=True):
        if len(held) - begin < 4 * n:
            parts, have = [held[begin:]], len(held) - begin
            while have < 4 * n:
                parts.append(more())
                have += len(parts[-1])
            held, begin = b"".join(parts), 0
        yield (None if missing else name), held[begin : begin + 4 * n]
        begin += 4 * n


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system that a folder's address names, and the path in it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def write(
    df: DataFrame, tokenizer: str, end_id: int = 2, id_column: str = "doc_id", text: str = "text",
    folder: str | None = None, ids_per_file: int = 1 << 26,
) -> DataFrame:
    """Encode every text, write the files in ascending id order, give their list.

    The list (shard, part, path, n_docs, n_ids, bytes) is stored beside the files. Each
    task writes under names of its own, and only the list of the attempts that ended
    well is kept, so a lost or repeated task leaves nothing that is read. A null text
    is empty; null ids come first; rows with equal ids are ordered by their texts' hash.
    A text of any length is encoded whole, and its ids pass through blocks of bounded
    size. Other columns are not read, whatever their names; an empty table gives no files.
    """
    spark = df.sparkSession
    base = (folder or shared_dir(spark)).rstrip("/") + f"/tokens-{uuid.uuid4().hex}"

    def store(batches: Iterator[pa.RecordBatch]):
        where, root = _place(base)
        where.create_dir(root, recursive=True)
        scheme = base.removesuffix(root)
        encoder = encoder_for(tokenizer, WITHOUT_SPACE)
        end = np.array([end_id], "<u4").tobytes()
        task = TaskContext.get()
        writer, listed = None, []

        def closed():
            writer.close()
            listed.append((task.partitionId(), len(listed), scheme + path, len(writer.docs), writer.total, writer.place))

        for batch in gathered(batches, "text"):
            for name, ids in zip(batch.column(0).to_pylist(), encoder(batch.column(1)), strict=True):
                if writer is not None and writer.total >= ids_per_file:
                    closed()
                    writer = None
                if writer is None:
                    path = f"{root}/{task.partitionId():06d}-{len(listed):04d}-{uuid.uuid4().hex}.tkb"
                    writer = Writer(where.open_output_stream(path))
                writer.add(name, ids + end)
        if writer is not None:
            closed()
        columns = list(zip(*listed, strict=True)) or [()] * 6
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "part", "path", "n_docs", "n_ids", "bytes"])

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        df.select(F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie"))
        .repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    )
    return materialize(
        ordered.mapInArrow(store, "shard int, part int, path string, n_docs long, n_ids long, bytes long"), "tokens"
    )


def read(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files."""
    order = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.select("path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).cast("long").alias("before"))

    def load(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where, inner = _place(path)
                got = []
                with where.open_input_file(inner) as source:
                    for name, ids in read_file(source):
                        got.append((name, before, len(ids) // 4, zlib.crc32(ids)))
                        before += len(ids) // 4
                        if len(got) == 8192:
                            yield _table(got)
                            got = []
                yield _table(got)

    def _table(got):
        columns = list(zip(*got, strict=True)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.repartition(max(1, files.count())).mapInArrow(load, "doc_id long, start long, n_tokens long, ids_crc32 long")


def default_tokenizer(name: str) -> str:
    """Where the public vocabulary files stand on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
