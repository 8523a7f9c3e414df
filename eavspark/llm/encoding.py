"""Token ids of whole texts by the tokenizers library, with each distinct piece encoded once.

Texts are cut where no token of either vocabulary can cross: before a run of white
space that follows other characters, and between a letter (ASCII or Latin-1) and an ASCII
mark other than the apostrophe. A piece's ids do not depend on its neighbours there, so a text's ids
are its pieces' ids in a row. Arrow tells the distinct pieces of many texts at once; their
ids are kept in a table of bounded size, which a Python worker keeps from task to task.
New pieces are encoded many at a time: words of such letters beside each other, as
tokens tell by their names that they begin (byte vocabularies) or end a word; others joined by one of the vocabulary's added tokens: the
tokenizer cuts a text at these first, so every piece stands alone, and the token's id
tells where it ends.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa

from eavspark.llm.common import small_slices

KEPT = 1 << 20  # pieces kept
JOINED = 256  # pieces encoded as one text
#: white space goes with the word after it (byte vocabularies), or counts for nothing
WITH_SPACE, WITHOUT_SPACE = True, False


def _bytes(chars: bytes) -> np.ndarray:
    """Whether each byte is one of ``chars``."""
    return np.isin(np.arange(256), list(chars))


_WHITE = _bytes(b"\t\n\v\f\r ")
_UPPER = _bytes(bytes(range(65, 91)))
_LETTER = _bytes(bytes(range(65, 91)) + bytes(range(97, 123)))
_LATIN = _bytes(bytes({*range(0x80, 0xC0)} - {0x97, 0xB7}))  # after 0xC3: a letter
_MARK = _bytes(b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~")
_LETTERS = rb"(?:[A-Za-z]+|\xC3[\x80-\x96\x98-\xB6\xB8-\xBF])+"
_ALPHABETIC = {WITH_SPACE: re.compile(b" " + _LETTERS), WITHOUT_SPACE: re.compile(_LETTERS)}


def _after_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether white space beyond ASCII (Unicode White_Space, in UTF-8) ends before each place."""
    a, b, c = (data[np.maximum(at - k, 0)].astype(int) for k in (3, 2, 1))
    three = a << 16 | b << 8 | c
    return (
        np.isin(three & 0xFFFF, [0xC285, 0xC2A0])
        | np.isin(three, [0xE19A80, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])
        | ((three >= 0xE28080) & (three <= 0xE2808A))
    )


class Encoder:
    """``encoder(texts)`` gives each text's ids as little-endian 32-bit bytes."""

    def __init__(self, path: str, spaced: bool, kept: int = KEPT) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already uses every core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._spaced, self._kept, self._calls = spaced, kept, 0
        # piece n of the table has the ids from place _first[n] to _first[n + 1], and was last met in call _met[n]
        self._piece: dict[bytes, int] = {}
        self._ids, self._first, self._met = np.empty(0, "<u4"), np.zeros(1, np.int64), np.empty(0, np.int64)
        added = self._tokenizer.get_added_tokens_decoder()
        marks = [(i, t.content) for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word or t.normalized)]
        self._mark = marks[0] if marks else None
        self._added = re.compile("|".join(re.escape(t.content) for t in added.values()) or "(?!)", re.IGNORECASE)
        self._contents = [t.content.encode().lower() for t in added.values()]
        one = [self._encode([chr(c), chr(c + 32)]) for c in range(65, 91)]
        names = self._tokenizer.get_vocab()
        ending = getattr(self._tokenizer.model, "end_of_word_suffix", None)
        self._edge = np.zeros(max(names.values(), default=0) + 1, bool)
        self._edge[[i for name, i in names.items() if (name.startswith("Ġ") if spaced else ending and name.endswith(ending))]] = True
        self._folds = all(np.array_equal(*pair) for pair in one)

    def __call__(self, texts: list[str] | pa.LargeBinaryArray) -> list[bytes]:
        if isinstance(texts, list):
            texts = pa.array([t.encode() for t in texts], pa.large_binary())
        texts = texts.fill_null(b"")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        if not len(data):
            return [b""] * len(texts)
        low = data.tobytes().lower()
        plain = not any(c in low for c in self._contents)
        data, edges, first = self._cut(data, at - at[0], plain)
        if len(edges) == 1:
            return [b""] * len(texts)
        cut = pa.Array.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]).dictionary_encode()
        piece = self._known(cut.dictionary.to_pylist(), plain)[cut.indices.to_numpy()]
        start, count = self._first[piece], np.diff(self._first)[piece]
        ends = np.append(0, np.cumsum(count))
        got = self._ids[np.repeat(start - ends[:-1], count) + np.arange(ends[-1])].tobytes()
        return [got[4 * a : 4 * b] for a, b in pairwise(ends[first].tolist())]

    def _cut(self, data: np.ndarray, at: np.ndarray, plain: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of texts that begin ``at`` places of ``data``: their bytes in a row, where
        each begins and the last one ends, and the number of pieces before each text."""
        white = _WHITE[data]
        begin = np.zeros(len(data), bool)
        heads = at[:-1][at[:-1] < at[1:]]
        if self._spaced:
            begin[1:] = white[1:] & ~white[:-1]
            beyond = np.flatnonzero(begin[1:] & (data[:-1] > 127)) + 1
            begin[beyond[_after_white(data, beyond)]] = False
            begin[heads] = True
        else:
            begin[1:] = ~white[1:] & white[:-1]
            begin[heads] = ~white[heads]
        if plain:  # else a cut, or a small letter, may break or make an added token
            letter = _LETTER[data]
            letter[1:] |= _LATIN[data[1:]] & (data[:-1] == 0xC3)
            begin[1:] |= letter[:-1] & _MARK[data[1:]]
            if self._folds:  # letters before a combining mark stay as they are
                upper = _UPPER[data]
                upper[:-1] &= data[1:] < 128
                data = np.where(upper, data | np.uint8(32), data)
        if not self._spaced:
            at = at - np.searchsorted(np.flatnonzero(white), at)
            data, begin = data[~white], begin[~white]
        starts = np.flatnonzero(begin)
        return np.ascontiguousarray(data), np.append(starts, len(data)), np.searchsorted(starts, at)

    def _known(self, pieces: list[bytes], plain: bool) -> np.ndarray:
        """Where pieces stand in the table; those it does not have are learned."""
        if len(self._piece) > self._kept:
            self._forget()
        new = [p for p in pieces if p not in self._piece]
        if new:
            self._learn(new, plain)
        where = np.fromiter(map(self._piece.__getitem__, pieces), np.int64, len(pieces))
        self._calls += 1
        self._met[where] = self._calls
        return where

    def _forget(self) -> None:
        """The half that was not met for the longest time goes."""
        keep = np.ones(len(self._met), bool)
        keep[np.argsort(self._met, kind="stable")[: len(keep) // 2]] = False
        count = np.diff(self._first)
        self._piece = {p: n for n, p in enumerate(p for p, k in zip(self._piece, keep.tolist(), strict=True) if k)}
        self._ids, self._met = self._ids[np.repeat(keep, count)], self._met[keep]
        self._first = np.append(0, np.cumsum(count[keep]))

    def _learn(self, new: list[bytes], plain: bool) -> None:
        """Ids of pieces not in the table; those that hold an added token go one by one."""
        alone, words, others = [], [], []
        for p in new:
            if self._mark is None or not plain and self._added.search(p.decode("utf-8", "replace")):
                alone.append(p)
            else:
                (words if _ALPHABETIC[self._spaced].fullmatch(p) else others).append(p)
        ids, count = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        between = "" if self._spaced else " "
        runs = [words[at : at + JOINED] for at in range(0, len(words), JOINED)]
        told = []
        for run, got in zip(runs, self._encode([between.join(p.decode() for p in r) for r in runs]), strict=True):
            edge = np.flatnonzero(self._edge[got])
            length = np.diff(edge, append=len(got)) if self._spaced else np.diff(edge, prepend=-1)
            if len(length) != len(run) or length.sum() != len(got):  # not a word a piece
                others += run
                continue
            told += run
            ids.append(got)
            count.append(length)
        runs = [others[at : at + JOINED] for at in range(0, len(others), JOINED)]
        mark, text = self._mark or (-1, "")
        for got in self._encode([text.join(p.decode("utf-8", "replace") for p in r) for r in runs]):
            is_mark = got == mark
            ids.append(got[~is_mark])
            count.append(np.diff(np.flatnonzero(is_mark), prepend=-1, append=len(got)) - 1)
        for got in self._encode([p.decode("utf-8", "replace") for p in alone]):
            ids.append(got)
            count.append(np.array([len(got)]))
        size = len(self._piece)
        self._piece.update((p, n) for n, p in enumerate([*told, *others, *alone], size))
        self._ids = np.concatenate([self._ids, *ids])
        self._first = np.append(self._first, self._first[-1] + np.cumsum(np.concatenate(count)))
        self._met = np.append(self._met, np.zeros(len(self._piece) - size, np.int64))

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 1024):
            for got in self._tokenizer.encode_batch_fast(texts[at : at + 1024], add_special_tokens=False):
                yield np.array(got.ids, "<u4")


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder_for(path: str, spaced: bool) -> Encoder:
    """The worker's own encoder of a vocabulary, with what it has learned so far."""
    if (path, spaced) not in _encoders:
        _encoders[path, spaced] = Encoder(path, spaced)
    return _encoders[path, spaced]


def gathered(batches: Iterator[pa.RecordBatch], text: str, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows in batches with about ``size`` bytes of text, the text as bytes."""
    held, total = [], 0
    for part in small_slices(batches, text, size):
        held.append(part)
        total += part.column(text).nbytes
        if total >= size:
            yield pa.concat_batches(held)
            held, total = [], 0
    if held:
        yield pa.concat_batches(held)
