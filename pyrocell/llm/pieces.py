"""Vectorised pre-tokenisation: where a text's pieces begin, and exact-key tables of pieces.

Texts of a block are joined into one array of code points; the two public splitting patterns (word pieces without
white space, and byte-level pieces that may begin with a space) are evaluated on runs of character classes, so no
regular expression runs over the corpus.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Regex, normalizers
from tokenizers.pre_tokenizers import Split

LETTER, NUMBER, SPACE, OTHER = 1, 2, 3, 0
#: White space as the tokenizer's regular expressions know it (fixed values).
SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Characters, or bytes, of the texts that are worked on at once, about; a longer text is a block of its own.
BLOCK_CHARS = 1 << 18
#: Characters up to here are their own NFC and compose with none of each other.
ABOVE = re.compile("[^\x00-\u02ff]")


@functools.cache
def classes() -> np.ndarray:
    """The class of every code point, made once for each worker."""
    kind = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kind.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    out[SPACES] = SPACE
    # Characters younger than Python's tables: as the tokenizer library's expressions class them.
    young = "".join(chr(i) for i in range(0x40000) if unicodedata.category(chr(i)) == "Cn")
    for name, value in kind.items():
        for _, (a, b) in Split(Regex(rf"\p{{{name}}}+"), "removed", invert=True).pre_tokenize_str(young):
            out[[ord(c) for c in young[a:b]]] = value
    return out


@functools.cache
def library_normal():
    """NFC, then lower case code point by code point, by the tokenizer library's own tables."""
    return normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()]).normalize_str


def normal_word(text: str) -> str:
    """NFC and lower case as the library has them. White space needs no replacing: the pattern drops it."""
    return text.lower() if text.isascii() or not ABOVE.search(text) else library_normal()(text)


def blocks(texts: list[str], most: int = BLOCK_CHARS):
    """Index ranges of consecutive texts of about ``most`` code points, so that memory doesn't follow the batch."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def text_blocks(column: pa.Array, most: int = BLOCK_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """(begin, end, texts) of consecutive rows of at most ``most`` bytes or one row; nulls as empty texts.

    Only one block's texts are Python strings at a time, so memory follows the longest text and not the batch.
    """
    total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(column):
        before = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, before + most, side="right")))
        yield begin, end, [t or "" for t in column.slice(begin, end - begin).to_pylist()]
        begin = end


class Pieces:
    """Pieces of the texts of one block: byte ranges in ``data`` and the text that each belongs to."""

    def __init__(self, texts: list[str], byte_level: bool):
        joined = "".join(texts)
        cp = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        self.data = np.frombuffer(joined.encode("utf-8") + bytes(16), np.uint8)
        n = len(cp)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        first = np.zeros(n + 1, bool)
        first[(ends - lengths)[lengths > 0]] = True
        first[n] = True
        cls = classes()[cp]
        begin = np.empty(n + 1, bool)
        begin[n] = True
        if n:
            begin[0] = True
            np.not_equal(cls[1:], cls[:-1], out=begin[1:n])
            begin |= first
            if not byte_level:
                begin[:n] |= cls == NUMBER
            self._contractions(cp, cls, first, begin, byte_level)
            if byte_level:
                p = np.flatnonzero(begin[:n] & ~first[:n] & (cls != SPACE))
                p = p[cls[p - 1] == SPACE]
                begin[p - 1] = True
                begin[p[cp[p - 1] == 32]] = False
        start = np.flatnonzero(begin)
        stop = start[1:]
        start = start[:-1]
        if not byte_level:
            keep = cls[start] != SPACE if n else slice(0)
            start, stop = start[keep], stop[keep]
        if len(self.data) - 16 == n:  # ASCII only
            self.start, self.stop = start, stop
        else:
            width = np.ones(n, np.int8)
            for limit in (0x80, 0x800, 0x10000):
                width += cp >= limit
            at = np.zeros(n + 1, np.int64)
            np.cumsum(width, out=at[1:])
            self.start, self.stop = at[start], at[stop]
        #: Pieces before each text's end.
        self.until = np.searchsorted(start, ends, side="left")

    @staticmethod
    def _contractions(cp, cls, first, begin, byte_level):
        n = len(cp)
        at = np.flatnonzero(begin[:n] & (cp == 39))
        at = at[at + 1 < n]
        at = at[begin[at + 1] & ~first[at + 1] & (cls[at + 1] == LETTER)]
        if byte_level:
            at = at[first[at] | (cp[at - 1] != 32)]
        if not len(at):
            return
        c1 = cp[at + 1]
        one = np.isin(c1, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
        more = (at + 2 < n) & ~first[at + 2]
        c2 = np.where(more, cp[np.minimum(at + 2, n - 1)], 0)
        two = more & np.isin(c1.astype(np.int64) * 0x110000 + c2, [ord(a) * 0x110000 + ord(b) for a, b in ("re", "ve", "ll")])
        begin[at[one | two] + 1] = False
        begin[at[one] + 2] = True
        begin[at[two] + 3] = True

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two words that hold a piece of at most 15 bytes and its length exactly; the pieces that are longer."""
        size = self.stop - self.start
        words = np.ndarray((len(self.data) - 7,), "<u8", self.data.tobytes(), strides=(1,))
        low, high = words[self.start], words[np.minimum(self.start + 8, len(words) - 1)]
        bits = np.minimum(size, 8).astype(np.uint64) * np.uint64(8)
        low &= _mask(bits)
        bits = np.clip(size - 8, 0, 7).astype(np.uint64) * np.uint64(8)
        high = (high & _mask(bits)) | (np.minimum(size, 255).astype(np.uint64) << np.uint64(56))
        return low, high, np.flatnonzero(size > 15)


_MASKS = np.array([(1 << b) - 1 for b in range(65)], np.uint64)


def _mask(bits: np.ndarray) -> np.ndarray:
    return _MASKS[bits]


class PieceTable:
    """An exact hash table from pieces to entry numbers, looked up for whole arrays at once.

    It is a cache of about ``most`` entries and ``most_bytes`` of long pieces that begins anew when full, so a worker's
    memory is bounded.
    """

    def __init__(self, add, most: int = 1 << 20, most_bytes: int = 4 << 20):
        #: add(list of pieces as bytes, first entry number): make the entries.
        self.add, self.most, self.most_bytes = add, most, most_bytes
        self.clear()

    def clear(self):
        self.bits = 16
        self.count = self.long_bytes = 0
        self.long: dict[bytes, int] = {}
        self._arrays()

    def _arrays(self):
        size = 1 << self.bits
        self.low, self.high, self.entry = np.zeros(size, np.uint64), np.zeros(size, np.uint64), np.full(size, -1, np.int32)

    def _slot(self, low, high):
        h = (low ^ (high * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, low, high):
        out, at, todo = np.full(len(low), -1, np.int64), self._slot(low, high), None
        mask = (1 << self.bits) - 1
        while True:
            entry = self.entry[at]
            same = (entry >= 0) & (self.low[at] == low) & (self.high[at] == high)
            if todo is None:
                out[same] = entry[same]
            else:
                out[todo[same]] = entry[same]
            on = np.flatnonzero(~same & (entry >= 0))
            if not len(on):
                return out
            todo = on if todo is None else todo[on]
            low, high, at = low[on], high[on], (at[on] + 1) & mask

    def _put(self, low, high, entry):
        mask, at = (1 << self.bits) - 1, self._slot(low, high)
        while len(at):
            free = self.entry[at] < 0
            self.entry[at[free]] = entry[free]
            won = free & (self.entry[at] == entry)
            self.low[at[won]], self.high[at[won]] = low[won], high[won]
            on = ~won
            low, high, entry, at = low[on], high[on], entry[on], (at[on] + 1) & mask

    def find(self, pieces: Pieces) -> np.ndarray:
        """The entry number of each piece; makes the missing ones."""
        if self.count > self.most or self.long_bytes > self.most_bytes:
            self.clear()
            self.add(None, 0)
        low, high, longer = pieces.keys()
        out = self._find(low, high)
        if len(longer):
            data = pieces.data.tobytes()
            out[longer] = -2
            for i in longer.tolist():
                piece = data[pieces.start[i] : pieces.stop[i]]
                known = self.long.get(piece)
                if known is None:
                    self.add([piece], self.count)
                    known = self.long[piece] = self.count
                    self.count += 1
                    self.long_bytes += len(piece)
                out[i] = known
        missing = np.flatnonzero(out == -1)
        if len(missing):
            pairs = np.empty(len(missing), [("low", np.uint64), ("high", np.uint64)])
            pairs["low"], pairs["high"] = low[missing], high[missing]
            new, where, back = np.unique(pairs, return_index=True, return_inverse=True)
            data = pieces.data.tobytes()
            at = missing[where]
            self.add([data[a:b] for a, b in zip(pieces.start[at].tolist(), pieces.stop[at].tolist(), strict=True)], self.count)
            entry = np.arange(self.count, self.count + len(new), dtype=np.int32)
            self.count += len(new)
            if self.count * 2 > 1 << self.bits:
                old = self.entry >= 0
                kept = self.low[old], self.high[old], self.entry[old]
                while self.count * 2 > 1 << self.bits:
                    self.bits += 1
                self._arrays()
                self._put(*kept)
            self._put(new["low"].copy(), new["high"].copy(), entry)
            out[missing] = entry[back]
        return out


class Pool:
    """Rows of one array, of unequal lengths, by entry number."""

    def __init__(self, dtype):
        self.dtype = dtype
        self.clear()

    def clear(self):
        self.values, self.at, self.used, self.rows = np.zeros(1 << 16, self.dtype), np.zeros(1 << 12, np.int64), 0, 0

    def extend(self, rows: list):
        """rows: sequences of ``dtype``, or bytes for uint8."""
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.frombuffer(b"".join(rows), np.uint8) if self.dtype == np.uint8 else np.fromiter((x for r in rows for x in r), self.dtype, int(sizes.sum()))
        while self.used + len(flat) > len(self.values):
            self.values = np.concatenate([self.values, np.zeros_like(self.values)])
        while self.rows + len(rows) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.values[self.used : self.used + len(flat)] = flat
        self.at[self.rows + 1 : self.rows + 1 + len(rows)] = self.used + np.cumsum(sizes)
        self.used += len(flat)
        self.rows += len(rows)

    def size(self, entry: np.ndarray) -> np.ndarray:
        return self.at[entry + 1] - self.at[entry]

    def gather(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows of ``entry`` one after another, and where each ends."""
        size = self.size(entry)
        stop = np.cumsum(size)
        shift = self.at[entry] - (stop - size)
        return self.values[np.repeat(shift, size) + np.arange(stop[-1] if len(stop) else 0)], stop
