"""Vector work on whole texts inside a task: the bytes of an Arrow batch, its words and their hashes.

Words are the maximal runs of bytes outside ``\\x20\\x09-\\x0D``; these are ASCII, so bytes and code points agree on
them. Hashes have 64 bits and depend on nothing but the bytes of a word, so every task gets the same ones. A hash sums one
random number for every (place, byte), so no arrangement of letters makes two words agree.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

U64 = np.uint64
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, 9, 10, 11, 12, 13]] = False
#: White space beyond ASCII, as UTF-8.
WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: A batch is worked on in parts of about so many bytes, so memory depends on the longest text only.
PART_BYTES = 2_000_000

#: Random numbers for (place, byte) of the first places; later ones are computed.
SHORT = 32
PLACED = np.random.default_rng(20240607).integers(0, 2**64, SHORT * 256, dtype=U64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
STEP = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(n: int, base: np.uint64 = STEP) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


def text_parts(column: pa.Array, part_bytes: int = PART_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of its texts) for parts of a string column; a null text has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + part_bytes, "right")) - 1)
        yield at, data[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def _hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One hash for each run; ``data`` holds the runs one after the other, ``starts`` their places in it."""
    if not len(starts):
        return np.empty(0, U64)
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    with np.errstate(over="ignore"):
        if lengths.max() <= SHORT:
            codes = PLACED[place << 8 | data]
        else:
            codes = PLACED[(place & SHORT - 1) << 8 | data]
            late = np.flatnonzero(place >= SHORT)
            codes[late] = mix(mix((place[late] << 8 | data[late]).astype(U64) + STEP) + PLACED[0])
        return mix(np.add.reduceat(codes, starts) + lengths.astype(U64))


def distinct(part) -> tuple[np.ndarray, np.ndarray]:
    """(number of its text for every run of the part, one run for each number). Runs of one hash are compared byte by byte."""
    codes, found = pd.factorize(part.hash)
    first = np.empty(len(found), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    lengths = part.ends - part.starts
    other = lengths != lengths[first[codes]]
    same = np.flatnonzero(~other)
    n = lengths[same]
    unlike = part.data[ragged(part.starts[same], n)] != part.data[ragged(part.starts[first[codes[same]]], n)]
    if unlike.any():
        other[same[np.searchsorted(np.cumsum(n), np.flatnonzero(unlike), "right")]] = True
    if other.any():
        more: dict[bytes, int] = {}
        added: list[int] = []
        codes = codes.copy()
        for i in np.flatnonzero(other).tolist():
            key = part.data[part.starts[i]:part.ends[i]].tobytes()
            if key not in more:
                more[key] = len(first) + len(added)
                added.append(i)
            codes[i] = more[key]
        first = np.append(first, added)
    return codes, first


class Words:
    """The words of one part: byte range, hash and text of each, and where each text's words begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        inside = WORD_BYTE[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        first[heads], last[tails] = inside[heads], inside[tails]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        lengths = self.ends - self.starts
        runs = data[inside]
        self.hash = _hashes(LOWER[runs] if lower else runs, np.cumsum(lengths) - lengths, lengths)
        self.data = data
        #: words of text i: bounds[i] to bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, offsets)

    def of(self, i: int) -> slice:
        return slice(int(self.bounds[i]), int(self.bounds[i + 1]))


class Chunks:
    """Each run of white space with the run of other characters after it; a text's last white space is one too.

    No merge rule of the tokenizers here crosses the end of such a chunk: their patterns never match
    white space after anything else. ``uncut``: ASCII white space before which a text is not cut all the same.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, uncut: bytes = b""):
        inside = WORD_BYTE[data]
        raw = data.tobytes()
        if any(x in raw for x in (b"\xc2\xa0", b"\xc2\x85", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")):
            for m in WIDE_SPACE.finditer(raw):
                inside[m.start():m.end()] = False
        first = ~inside
        first[1:] &= inside[:-1]
        for byte in uncut:
            first &= data != byte
        heads = offsets[:-1][offsets[1:] > offsets[:-1]]
        first[heads] = True
        self.starts = np.flatnonzero(first)
        self.ends = np.append(self.starts[1:], len(data)) if len(self.starts) else self.starts
        self.hash = _hashes(data, self.starts, self.ends - self.starts)
        self.data = data
        self.bounds = np.searchsorted(self.starts, offsets)

    of = Words.of


#: What a byte can be for ``Pieces``. Odd: control characters, the apostrophe, and all that is neither ASCII nor a letter of U+00C0 to U+00FF.
WHITE, LETTER, DIGIT, MARK, ODD = range(5)
KIND = np.full(256, ODD, np.uint8)
KIND[33:127] = MARK
KIND[48:58] = DIGIT
KIND[65:91] = KIND[97:123] = LETTER
KIND[~WORD_BYTE] = WHITE
KIND[ord("'")] = ODD
#: The first 0 to 8 bytes of a 64-bit number.
FIRST_BYTES = np.array([(1 << 8 * i) - 1 for i in range(9)], U64)


class Pieces:
    """Runs of letters, single digits and runs of other marks in lower case: the words that word-level vocabularies encode apart.

    A run without white space that holds an odd byte or ``<|`` (a special string may stand there) is one piece, as it was
    written (``whole``). All other pieces consist of ASCII and letters of U+00C0 to U+00FF, which NFC leaves alone and
    which are one kind of letter each, so neither depends on what stands beside them.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind, low = KIND[data], np.zeros(len(data) + 16, np.uint8)
        low[:len(data)] = LOWER[data]
        at = np.flatnonzero(data[:-1] == 0xC3)
        second = data[at + 1]
        letter = (second >= 0x80) & (second <= 0xBF) & (second != 0x97) & (second != 0xB7)  # but the signs of times and divide
        at, second = at[letter], second[letter]
        kind[at] = kind[at + 1] = LETTER
        low[at[second < 0x9F] + 1] += 32
        kind[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = ODD
        begins = np.ones(len(data), bool)
        begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
        heads = offsets[:-1][offsets[1:] > offsets[:-1]]
        begins[heads] = True
        places = np.flatnonzero(begins)
        inside = kind[places] != WHITE
        self.starts, self.ends = places[inside], np.append(places, len(data))[1:][inside]
        self.whole = np.zeros(len(self.starts), bool)
        odd = kind[self.starts] == ODD
        if odd.any():
            first = np.ones(len(self.starts), bool)
            first[1:] = self.starts[1:] != self.ends[:-1]
            at = np.searchsorted(self.starts, heads)
            first[at[at < len(first)]] = True
            run = np.cumsum(first) - 1
            held = np.zeros(int(run[-1]) + 1, bool)
            held[run[odd]] = True
            whole = held[run]
            self.starts, self.ends = self.starts[~whole | first], self.ends[~whole | np.append(first[1:], True)]
            self.whole = whole[~whole | first]
            raw = ragged(self.starts[self.whole], (self.ends - self.starts)[self.whole])
            low[raw] = data[raw]
        #: lower case, with 16 bytes behind the last piece
        self.data = low
        #: pieces of text i: bounds[i] to bounds[i + 1]
        self.bounds = np.searchsorted(self.starts, offsets)

    def keys(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of pieces of at most 16 bytes as two numbers each; what is behind them is zero."""
        at, n = self.starts[which], (self.ends - self.starts)[which]
        eight = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))  # the 8 bytes at every place
        return eight[at] & FIRST_BYTES[np.minimum(n, 8)], eight[at + 8] & FIRST_BYTES[np.maximum(n, 8) - 8]


class Hashed:
    """Some pieces, with a hash each."""

    def __init__(self, pieces: Pieces, which: np.ndarray):
        self.starts, self.ends, self.data = pieces.starts[which], pieces.ends[which], pieces.data
        lengths = self.ends - self.starts
        self.hash = _hashes(self.data[ragged(self.starts, lengths)], np.cumsum(lengths) - lengths, lengths)


def rolling(h: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """Hash of every k consecutive word hashes, by doubling; empty if there are fewer."""
    n = len(h) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    with np.errstate(over="ignore"):
        out, done, block, width = None, 0, h, 1
        while True:
            if k & width:
                piece = block[done:done + n]
                out = piece.copy() if out is None else mix(out * STEP + piece)
                done += width
            if done == k:
                return mix(out + U64(salt * 2 + 1))
            block = mix(block[:-width] * U64(0xD6E8FEB86659FD93) + block[width:])
            width *= 2


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places start, start + 1, … for every run, one run after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total) + shift
