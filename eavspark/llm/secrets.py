"""Secret scans through nested encodings, by a worklist of decoded layers.

A text is the first layer. Each layer is scanned, and whatever in it can be unwrapped
(percent escapes, Unicode escapes, base64, compressed bytes) becomes a layer of its
own, until no new layer appears. Layers met before are not entered again, so
encodings that lead back to themselves end. Every layer keeps, for each of its code
points, the range of the original text it comes from; findings are mapped along it.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import urllib.parse
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame

from eavspark.llm.common import per_text

# The kinds of secrets, in the order that breaks ties
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")  # the maximal runs that are long enough
LEAST = {"assign": 6, "access": 20}

PERCENT = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(r"(?:\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\u\{[0-9A-Fa-f]{1,6}\}|\\x[0-9A-Fa-f]{2}|&\#[0-9]{1,7};|&\#[xX][0-9A-Fa-f]{1,6};)+")
ONE = re.compile(r"\\u\{([0-9A-Fa-f]{1,6})\}|\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&\#[xX]([0-9A-Fa-f]{1,6});|&\#([0-9]{1,7});")
# A run goes on after line breaks (wrapped text), with blanks around them. Its characters
# are counted where it is used: a piece between two breaks may be short.
BREAK = r"[ \t]*+\r?\n[ \t]*+"
DIGIT = "[A-Za-z0-9+/_-]"
BASE64 = re.compile(rf"(?<!{DIGIT})(?:{DIGIT}{{12,}}+|{DIGIT}++(?={BREAK}{DIGIT}))(?:{BREAK}{DIGIT}++)*+={{0,2}}")
SHORTEST = 12
FEED = 1 << 16  # bytes of a compressed stream read at a time
PIECE = 1 << 20  # bytes of its content scanned at a time, at least
OVERLAP = 1 << 16  # bytes that a piece shares with the one before, at least
MARGIN = 1 << 17  # bytes before the end of what is held in which a stream is not yet judged
LARGEST = 1 << 26  # bytes without a gap from which a piece is cut anywhere
# Where content may be cut: bytes of no finding, or blanks that are in no assignment
GAP = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f-\xff]|[^\s:=]\x20+(?=[^\s:=\"'])")

ODD = re.compile("[\udc80-\udcff]")  # what "surrogateescape" makes of bytes that are not UTF-8
CONTROL = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")
# The shortest finding has 12 characters, all printable ASCII, and no text encoding of
# it is shorter or leaves ASCII: bytes without such a stretch carry nothing to find.
STRETCH = re.compile(rb"[\t-\r\x20-\x7e]{12}")

Spans = set[tuple[int, int, int]]  # start, kind, end


def scan(text: str) -> Iterator[tuple[int, int, int]]:
    """The base findings of one layer as (start, kind, end), leftmost first per kind."""
    for m in ASSIGN.finditer(text):
        if m.end(2) - m.start(2) >= LEAST["assign"]:
            yield m.start(), 0, m.end()
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= LEAST["access"]:
                yield m.start(), 1, m.end()
    for m in HEX.finditer(text):
        yield m.start(), 2, m.end()


def _zlib_headers() -> bytes:
    """A pattern for the two bytes that start a zlib stream without a preset dictionary."""
    pairs = [(c, f) for c in range(0x08, 0x88, 16) for f in range(256) if (c << 8 | f) % 31 == 0 and not f & 32]
    return b"|".join(re.escape(bytes(p)) for p in pairs)


STREAM = re.compile(rb"\x1f\x8b\x08|BZh[1-9](?:1AY&SY|\x17rE8P\x90)|\xfd7zXZ\x00|" + _zlib_headers(), re.DOTALL)


class Stream:
    """What a gzip, zlib, bzip2 or xz stream at a place in ``data`` holds, in pieces.

    Members that follow each other are one stream. A torn one gives what it has up to
    there. After the last piece, ``done`` is where its last whole member ends (the start,
    if there is none), and ``end`` where reading ended.
    """

    def __init__(self, data: bytes, start: int) -> None:
        self.data, self.start, self.done, self.end = data, start, start, start

    def __iter__(self) -> Iterator[bytes]:
        at = self.start
        while STREAM.match(self.data, at):
            given, safe = 0, at
            try:
                for out, safe in self._member(at, len(self.data)):
                    given += len(out)
                    yield out
            except _TORN:
                # a call that fails gives nothing: once more, byte by byte where it failed
                skip = given
                try:
                    for out, _ in self._member(at, safe):
                        new, skip = out[skip:], max(0, skip - len(out))
                        given += len(new)
                        yield new
                except _TORN:
                    pass
            if self.done <= at:  # torn
                self.end = self.end if given else self.done
                return
            at = self.done
            while self.data[at : at + 1] == b"\0":  # padding between members
                at += 1

    def _member(self, at: int, single: int) -> Iterator[tuple[bytes, int]]:
        """Pieces beside where the input of each began; from ``single`` on, bytes are read one by one."""
        view, head = memoryview(self.data), self.data[at : at + 3]
        d = bz2.BZ2Decompressor() if head == b"BZh" else lzma.LZMADecompressor() if head[:1] == b"\xfd" else zlib.decompressobj(47)
        begun = at
        while not d.eof:
            feed = getattr(d, "unconsumed_tail", b"")
            if not feed and getattr(d, "needs_input", True):
                begun, feed = at, view[at : at + (FEED if at < single else 1)]
                at += len(feed)
                self.end = at
            out = d.decompress(feed, PIECE)
            if not out and not len(feed) and not d.eof:
                return
            yield out, begun
        self.done = self.end = at - len(d.unused_data)


_TORN = (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError)


def windows(pieces: Iterable[bytes]) -> Iterator[bytes]:
    """The content cut at gaps, so that what can be found is whole in one of the windows."""
    held, enough = bytearray(), PIECE
    for piece in pieces:
        held += piece
        while len(held) >= enough:
            cut = 0
            for low in range(len(held) - 2 * OVERLAP, -OVERLAP, -OVERLAP):
                for m in GAP.finditer(held, max(low, 0), low + OVERLAP):
                    cut = m.end()
                if cut:
                    break
            if not cut and len(held) < LARGEST:
                enough = 2 * len(held)
                break
            yield bytes(held)
            del held[: cut or len(held) - OVERLAP]
            enough = max(PIECE, len(held) + OVERLAP)
    if held:
        yield bytes(held)


def streams(pieces: Iterable[bytes]) -> Iterator[Stream]:
    """The streams in the content, whole or up to where they break.

    What is held grows only while a stream goes on, by its bytes as they are packed.
    """
    held, enough, left, more = b"", PIECE, True, iter(pieces)
    while left:
        got, size = [held], len(held)
        while size < enough and (left := (piece := next(more, None)) is not None):
            got.append(piece)
            size += len(piece)
        held, at = b"".join(got), 0
        stop = len(held) - MARGIN if left else len(held)
        while (m := STREAM.search(held, at)) and m.start() < stop:
            stream = Stream(held, m.start())
            given = sum(map(len, stream))
            if left and stream.end >= stop:  # it may go on
                at = m.start()
                break
            if given:
                yield Stream(held[m.start() : stream.end], 0)
            at = max(stream.done, m.start() + 1)
        else:
            at = max(at, stop)
        held = held[at:]
        enough = max(PIECE, 2 * len(held))


def contents(outer: Stream) -> Iterator[bytes]:
    """The windows of what a stream holds, and of the streams in it, however deep.

    From the first window on, ``outer`` knows where it ends. A stream that holds what
    another one held is not opened again, so streams that hold themselves end. Windows of
    a torn one without a stretch that is long enough are left out.
    """
    seen: set[tuple[bool, bytes]] = set()
    work = [iter([outer])]
    while work:
        if (stream := next(work[-1], None)) is None:
            work.pop()
            continue
        digest, pieces, total = hashlib.sha256(), [], 0
        for piece in stream:  # where it ends is known before its content is scanned
            digest.update(piece)
            total += len(piece)
            if total <= PIECE:
                pieces.append(piece)
        whole = stream.done > stream.start
        if not total or (whole, digest.digest()) in seen:
            continue
        seen.add((whole, digest.digest()))
        if total > PIECE:
            pieces = Stream(stream.data, stream.start)
        yield from (part for part in windows(pieces) if whole or STRETCH.search(part))
        work.append(streams(pieces))


def plain(data: bytes) -> str:
    """The bytes as text; every byte that is not UTF-8 becomes one U+FFFD."""
    return ODD.sub("\ufffd", data.decode("utf-8", "surrogateescape"))


def readable(data: bytes) -> str | None:
    """The bytes as text, if they are text throughout or hold a stretch that is long enough."""
    if STRETCH.search(data):
        return plain(data)
    try:
        text = data.decode("utf-8")
    except UnicodeDecodeError:
        return None
    return None if not text or CONTROL.search(text) else text


def sizes(data: bytes) -> np.ndarray:
    """How many bytes every code point of ``plain(data)`` stands for."""
    text = data.decode("utf-8", "surrogateescape")
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    odd = (code >= 0xDC80) & (code <= 0xDCFF)
    return np.where(odd, 1, 1 + (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF))


class Layer:
    """A decoded text; code point i stands for ``start[i]:end[i]`` of the original."""

    def __init__(self, text: str, start: np.ndarray, end: np.ndarray) -> None:
        self.text, self.start, self.end = text, start, end

    def place(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a]), int(self.end[b - 1])

    def replaced(self, pattern: re.Pattern, decode) -> Layer | None:
        """The layer with every run of ``pattern`` decoded in place."""
        text, starts, ends, at = [], [], [], 0
        for m in pattern.finditer(self.text):
            new = decode(m.group())
            text += [self.text[at : m.start()], new]
            s, e = self.place(m.start(), m.end())
            starts += [self.start[at : m.start()], np.full(len(new), s)]
            ends += [self.end[at : m.start()], np.full(len(new), e)]
            at = m.end()
        if not at:
            return None
        return Layer("".join([*text, self.text[at:]]), np.concatenate([*starts, self.start[at:]]), np.concatenate([*ends, self.end[at:]]))

    def inner(self) -> Iterator[Layer]:
        """What can be unwrapped here, one encoding at a time."""
        text = self.text
        if "%" in text and (x := self.replaced(PERCENT, _percent)):
            yield x
        if ("\\" in text or "&#" in text) and (x := self.replaced(ESCAPE, _escape)):
            yield x
        for m in BASE64.finditer(text):
            run = m.group().rstrip("=")
            wrapped = "\n" in run
            if wrapped:
                run = "".join(run.split())
            if len(run) < SHORTEST or not NOT_LOWER.search(run):
                continue
            at = None
            for skip in range(4):
                # glued or joined characters before the encoded ones only shift them, so one
                # of four alignments is theirs; what comes after does not matter
                data = _base64(run[skip:])
                for new, first, last in _carried(data, skip == 0):
                    if at is None:  # where the characters of the run are
                        at = np.arange(m.start(), m.end())
                        if wrapped:
                            part = np.frombuffer(m.group().encode(), np.uint8)
                            at = at[part > 0x20]
                    # bytes -> the characters that carry those bits
                    n, one = len(new), not first.strides[0]  # one place for all
                    first, last = (first[:1], last[:1]) if one else (first, last)
                    start = self.start[at[skip + first * 8 // 6]]
                    end = self.end[at[np.minimum(skip + (last * 8 - 1) // 6, len(at) - 1)]]
                    yield Layer(new, np.broadcast_to(start, n), np.broadcast_to(end, n))


def _carried(data: bytes, whole: bool) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """The texts in decoded bytes; code point i stands for the bytes ``first[i]:last[i]``.

    Not ``whole``: the bytes start somewhere in the run, so only a stretch tells text.
    """
    at, done = 0, []
    while m := STREAM.search(data, at):
        i = m.start()
        stream = Stream(data, i)
        for part in contents(stream):
            if new := readable(part):  # with the padding, if the stream ends the run
                last = stream.end if stream.end < len(data) else len(data) + 4
                yield new, np.broadcast_to(np.int64(i), len(new)), np.broadcast_to(np.int64(last), len(new))
        at = max(stream.done, i + 1)
        if stream.done > i:
            done.append((i, stream.done))
    if done:  # no part of a stream stands for a part of its content
        data = bytearray(data)
        for i, j in done:
            data[i:j] = bytes(j - i)
        data = bytes(data)
    new = readable(data) if whole else plain(data) if STRETCH.search(data) else None
    if new:
        size = sizes(data)
        last = np.cumsum(size)
        yield new, last - size, last


def _percent(run: str) -> str:
    return plain(urllib.parse.unquote_to_bytes(run))


def _escape(run: str) -> str:
    units = [int(next(g for g in m.groups()[:5] if g), 16) if m.group(6) is None else int(m.group(6)) for m in ONE.finditer(run)]
    # pairs of surrogates make one character; single ones and numbers of no character, U+FFFD
    return b"".join(chr(u if u < 0x110000 else 0xFFFD).encode("utf-16-le", "surrogatepass") for u in units).decode("utf-16-le", "replace")


# In base64 of what can be found, some character is not a-z: each of three letters in a
# row of every key word gives one where it starts a group, and so does any hex digit or
# capital. Runs of a-z only are words.
NOT_LOWER = re.compile(r"[^a-z]")


def _base64(run: str) -> bytes:
    """The bytes of a run; bits beyond the last whole byte are dropped."""
    run = run[: len(run) - (len(run) % 4 == 1)]
    return binascii.a2b_base64(run.encode().translate(_STANDARD) + b"=" * (-len(run) % 4))


_STANDARD = bytes.maketrans(b"-_", b"+/")


def find(text: str) -> tuple[Spans, Spans, list[str]]:
    """(base findings, all findings, decoded layers) of one text."""
    base = set(scan(text))
    found, layers = set(base), []
    if not (_MAY.search(text)):
        return base, found, layers
    at = np.arange(len(text) + 1)
    seen = {hashlib.sha256(text.encode("utf-8", "replace")).digest()}
    work = [Layer(text, at[:-1], at[1:])]
    while work:
        for layer in work.pop().inner():
            # the same text in another place is another finding, so the place counts too
            key = hashlib.sha256(layer.text.encode() + b"".join((x if x.strides[0] else x[:1]).tobytes() for x in (layer.start, layer.end))).digest()
            if key in seen:
                continue
            seen.add(key)
            layers.append(layer.text)
            work.append(layer)
            for a, kind, b in scan(layer.text):
                s, e = layer.place(a, b)
                found.add((s, kind, e))
    return base, found, layers


_MAY = re.compile(rf"%[0-9A-Fa-f]{{2}}|\\[uUx]|&\#|{BASE64.pattern}")


def listed(spans: Spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


MADE = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, layers long"


def secrets(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` beside the counts of base findings per kind, the digest of the base spans,
    all spans (kind:start:end in code points of the original), and the layers unwrapped.

    A null text is an empty one and has no findings. Spans of findings in compressed
    bytes are the whole run that carries them. Rows keep their number.
    """

    def make():
        def one(t: bytes | None) -> tuple:
            base, found, layers = find((t or b"").decode("utf-8", "replace"))
            n = [sum(k == kind for _, k, _ in base) for kind in range(3)]
            return (*n, hashlib.sha256(listed(base).encode()).hexdigest(), listed(found), len(layers))

        return one

    return per_text(df, list(keep), text, MADE, make)


def redacted(df: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every finding's place in ``text`` replaced by ``mark``; the rest stays.

    Every row stays, repeated ones and those with a null or empty text as they are; a
    finding within another's place is replaced with it. Texts of any length are read
    whole; no rows give none.
    """
    others = [c for c in df.columns if c != text]

    def make():
        def one(t: bytes | None) -> tuple:
            if t is None:
                return (None,)
            plain = t.decode("utf-8", "replace")
            out, at = [], 0
            for a, _, b in sorted(find(plain)[1]):
                if a >= at:
                    out += [plain[at:a], mark]
                at = max(at, b)
            return ("".join([*out, plain[at:]]),)

        return one

    return per_text(df, others, text, f"{text} string", make).select(df.columns)
