"""Token ids of a word-level tokenizer, fast: equal units of texts are encoded once per Python worker.

The tokenizer splits a text at white space and between kinds of characters before it merges anything, so a text's ids
are those of its units in order: runs of letters or of other characters, and single digits. Units are cut and counted in
whole columns of texts; only those not met before go to the tokenizer. Where kinds of characters do not tell units apart
(apostrophes) or act in context (characters beyond Latin, rare controls, the tokenizer's own markers), a unit is all that
stands between white space: neither normalising nor lower-casing looks beyond that.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

from adpulse.llm.common import text_buffer

END_OF_TEXT = 1
CACHED_UNITS, CACHED_BYTES = 600_000, 32_000_000
# Bytes of text that are cut into units at once.
CUT_BYTES = 4_000_000
# Units that go to the tokenizer as one text.
JOINED_UNITS = 1_000

# Kinds of characters; a piece of text with any of the last kind is one unit.
_SPACE, _LETTER, _DIGIT, _OTHER, _WHOLE = range(5)
# Units that the tokenizer sees on their own.
_ALONE = re.compile("[\x1c-\x1fİƀ-\U0010ffff]|<\\|")


def _kind(char: str) -> int:
    if char in "\x1c\x1d\x1e\x1f'İ" or char >= "ƀ":
        return _WHOLE
    if char.isspace():
        return _SPACE
    return {"L": _LETTER, "N": _DIGIT}.get(unicodedata.category(char)[0], _OTHER)


_KIND = np.array([_kind(chr(code)) for code in range(0x180)], np.uint8)
# By byte; characters of two bytes are looked up by code.
_BYTE_KIND = _KIND[:128].tobytes() + bytes([_WHOLE]) * 128


def _units(data: bytes, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The units of the texts ``data[offsets[i]:offsets[i + 1]]``, and for each text the number of units up to its end."""
    values = np.frombuffer(data, np.uint8)
    kinds = np.frombuffer(bytearray(data.translate(_BYTE_KIND)), np.uint8)
    kinds[[marker.start() for marker in re.finditer(rb"<\|", data)]] = _WHOLE
    if not data.isascii():
        # Characters U+0080 to U+017F.
        lead = np.flatnonzero((values[:-1] >= 0xC2) & (values[:-1] <= 0xC5) & (values[1:] & 0xC0 == 0x80))
        kinds[lead] = kinds[lead + 1] = _KIND[(values[lead] & 0x1F).astype(np.int64) << 6 | values[lead + 1] & 0x3F]
    inside = kinds != _SPACE
    # Pieces begin behind white space and at the start of a text.
    piece = np.ones(len(values), bool)
    np.logical_not(inside[:-1], out=piece[1:])
    piece[offsets[offsets < len(values)]] = True
    # Without white space the units lie one behind the other.
    ends = offsets[1:] - np.searchsorted(np.flatnonzero(~inside), offsets[1:])
    values, kinds, piece = values[inside], kinds[inside], piece[inside]
    # Units begin also where the kind changes and at each digit.
    begins = piece.copy()
    begins[1:] |= kinds[1:] != kinds[:-1]
    begins |= (kinds == _DIGIT) & ((values < 0x80) | (values >= 0xC0))
    upper = values - np.uint8(65) < 26
    whole = np.flatnonzero(kinds == _WHOLE)
    if len(whole):
        pieces = np.flatnonzero(piece)
        undivided = np.zeros(len(pieces), bool)
        undivided[np.searchsorted(pieces, whole, "right") - 1] = True
        undivided = np.repeat(undivided, np.diff(pieces, append=len(values)))
        begins &= piece | ~undivided
        # Normalising comes before lower-casing and may depend on case.
        upper &= ~undivided
    values += upper.view(np.uint8) << np.uint8(5)
    starts = np.flatnonzero(begins)
    bounds = np.append(starts, len(values))
    units = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(values)])
    return units, np.searchsorted(starts, ends)


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One per Python worker, so that its tasks share the cache."""
    return WordTokenizer(path)


class WordTokenizer:
    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._ids: dict[bytes, bytes] = {}
        self._held = 0
        self.vocabulary = self._tokenizer.get_vocab_size()
        # A token has one character for each byte of text, and a mark where it ends a word.
        self._bytes = np.zeros(self.vocabulary, np.int64)
        for token, number in self._tokenizer.get_vocab().items():
            self._bytes[number] = len(token.removesuffix("</w>"))

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        # As ``encode``, without the offsets of the tokens.
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4") for one in found]

    def _add(self, units: list[bytes]) -> None:
        """Encodes new units, many in one text: their tokens tell by their bytes where a unit ends."""
        texts = [unit.decode() for unit in units]
        alone = [_ALONE.search(text) is not None for text in texts]
        joined = [at for at, own in enumerate(alone) if not own]
        singly = [at for at, own in enumerate(alone) if own]
        for begin in range(0, len(joined), JOINED_UNITS):
            own = joined[begin : begin + JOINED_UNITS]
            ids = self._encode([" ".join([texts[at] for at in own])])[0]
            ends = np.cumsum([len(units[at]) for at in own])
            done = np.cumsum(self._bytes[ids])
            cuts = np.searchsorted(done, ends)
            if done[-1] != ends[-1] or (done[cuts] != ends).any():
                singly += own
                continue
            data, start = ids.tobytes(), 0
            for at, cut in zip(own, (4 * cuts + 4).tolist()):
                self._ids[units[at]] = data[start:cut]
                start = cut
        for at, ids in zip(singly, self._encode([texts[at] for at in singly])):
            self._ids[units[at]] = ids.tobytes()
        self._held += sum(map(len, units))

    def _column(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        units, ends = _units(data, offsets)
        coded = units.dictionary_encode()
        keys = coded.dictionary.to_pylist()
        if len(self._ids) > CACHED_UNITS or self._held > CACHED_BYTES:
            self._ids.clear()
            self._held = 0
        found = list(map(self._ids.get, keys))
        if None in found:
            self._add([key for key, ids in zip(keys, found) if ids is None])
            found = list(map(self._ids.__getitem__, keys))
        found.append(END_OF_TEXT.to_bytes(4, "little"))
        codes = np.insert(coded.indices.to_numpy(), ends, len(keys))
        ids = pa.array(found, pa.large_binary()).take(pa.array(codes))
        _, bounds, data = ids.buffers()
        bounds = np.frombuffer(bounds, np.int64, len(ids) + 1)
        return np.frombuffer(data, "<u4", bounds[-1] // 4), bounds[ends + np.arange(1, len(ends) + 1)] // 4

    def columns(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, ends) of consecutive texts, about ``CUT_BYTES`` at once: 32-bit ids, with an end marker behind each text,
        and where each text's ids end. A null is an empty text."""
        data, offsets = text_buffer(texts)
        start, count = 0, len(offsets) - 1
        while start < count:
            end = int(np.searchsorted(offsets, offsets[start] + CUT_BYTES, "right")) - 1
            end = min(count, max(start + 1, end))
            own = offsets[start : end + 1]
            yield self._column(data[own[0] : own[-1]].tobytes(), own - own[0])
            start = end

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of ``text``."""
        return next(self.columns(pa.array([text], pa.string())))[0][:-1].tobytes()


@dataclass
class Pieces:
    """The ids of consecutive texts, each with its end marker, cut into pieces of a size."""

    ids: np.ndarray
    bounds: np.ndarray  # bounds[i]:bounds[i + 1] are the ids of piece i
    counts: np.ndarray  # pieces of each text
    piece: np.ndarray
    start: np.ndarray
    length: np.ndarray

    def crc(self) -> list[int]:
        """Checksum of the pieces' little-endian 32-bit ids."""
        view, at = memoryview(self.ids).cast("B"), (4 * self.bounds).tolist()
        return [zlib.crc32(view[begin:end]) for begin, end in zip(at, at[1:])]


def cut_pieces(path: str, size: int, texts: pa.Array) -> Iterator[Pieces]:
    for ids, ends in word_tokenizer(path).columns(texts):
        sizes = np.diff(ends, prepend=0)
        counts = -(-sizes // size)
        piece = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        start = piece * size
        length = np.minimum(size, np.repeat(sizes, counts) - start)
        # The pieces lie one behind the other.
        yield Pieces(ids, np.concatenate([[0], np.cumsum(length)]), counts, piece, start, length)


def token_pieces(path: str, size: int):
    """For ``mapInArrow`` over (doc_id, text): per document its ids and the end marker, cut into pieces of ``size``.
    Yields columns doc_id, piece, start, length, crc, ``part`` and ``place``: the task, and the number of earlier
    pieces of the same length in it."""
    names = ("doc_id", "piece", "start", "length", "crc", "part", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), np.zeros(size + 1, np.int64)
        for batch in batches:
            begin = 0
            for made in cut_pieces(path, size, batch.column("text")):
                doc_ids = batch.column("doc_id").slice(begin, len(made.counts))
                begin += len(made.counts)
                # Pieces of a length in order, each with its number among them.
                order = np.argsort(made.length, kind="stable")
                uses = np.bincount(made.length, minlength=size + 1)
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order)) + np.repeat(seen - (np.cumsum(uses) - uses), uses)
                seen += uses
                columns = [
                    doc_ids.take(pa.array(np.repeat(np.arange(len(made.counts)), made.counts))),
                    pa.array(made.piece.astype(np.int32)),
                    pa.array(made.start),
                    pa.array(made.length),
                    pa.array(made.crc(), pa.int64()),
                    pa.array(np.full(len(order), part, np.int32)),
                    pa.array(place),
                ]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


PIECE_SCHEMA = "doc_id long, piece int, start long, length long, crc long, part int, place long"


def token_sequences(path: str, size: int):
    """A function from a column of texts to (rows, sequences): the number of texts a batch of sequences covers, the
    sequences of each, and the batch: piece, start, length, crc and the ids as little-endian unsigned 16-bit numbers.
    Every text's ids and the end marker are cut into pieces of ``size``, as in :func:`token_pieces`."""
    if word_tokenizer(path).vocabulary > 2**16:
        raise ValueError("16-bit ids need a vocabulary of at most 65,536")

    def run(texts: pa.Array) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
        for made in cut_pieces(path, size, texts):
            buffers = [None, pa.py_buffer((2 * made.bounds).astype(np.int32)), pa.py_buffer(made.ids.astype("<u2"))]
            columns = [pa.array(made.piece.astype(np.int32)), pa.array(made.start), pa.array(made.length)]
            columns.append(pa.array(made.crc(), pa.int64()))
            columns.append(pa.Array.from_buffers(pa.binary(), len(made.piece), buffers))
            yield made.counts, pa.RecordBatch.from_arrays(columns, ["piece", "start", "length", "crc", "ids"])

    return run
