"""Results for the distinct pieces of text that a worker has met, in flat arrays.

Pieces (words or chunks) are found by a sorted search of their hashes and then compared byte by byte, so a result never rests
on a hash alone. A result is a run of numbers; pieces not yet known are handed over together.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np

from tidespan.llm.texts import U64, distinct, ragged

#: Pieces that are remembered. Only time depends on it: a full table is emptied.
PIECES = 600_000


class Arena:
    """Runs of numbers one after the other; grows by doubling."""

    def __init__(self, kind: type):
        self.data, self.n = np.empty(1024, kind), 0
        self.starts, self.sizes = np.empty(0, np.int64), np.empty(0, np.int64)

    def add(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        if self.n + len(flat) > len(self.data):
            grown = np.empty(max(2 * len(self.data), self.n + len(flat)), self.data.dtype)
            grown[:self.n] = self.data[:self.n]
            self.data = grown
        self.data[self.n:self.n + len(flat)] = flat
        self.starts = np.concatenate([self.starts, self.n + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.n += len(flat)

    def get(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the runs one after the other, their sizes)"""
        sizes = self.sizes[which]
        return self.data[ragged(self.starts[which], sizes)], sizes


class Memo:
    """``encode`` gets the bytes of pieces one after the other and their lengths; it returns the numbers of all results
    one after the other and how many each has."""

    def __init__(self, encode: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], kind: type = np.uint32):
        self.encode, self.kind = encode, kind
        self.clear()

    def clear(self) -> None:
        self.pieces, self.results = Arena(np.uint8), Arena(self.kind)
        self._sorted: list[tuple[np.ndarray, np.ndarray]] = []

    def of(self, part) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all pieces of the part, one piece after the other; numbers before each piece and in all)"""
        if not len(part.starts):
            return np.empty(0, self.kind), np.zeros(1, np.int64)
        codes, first = distinct(part)
        if len(self.pieces.sizes) > PIECES:
            self.clear()
        h, starts, lengths = part.hash[first], part.starts[first], (part.ends - part.starts)[first]
        slot = self._found(h, part.data, starts, lengths)
        new = np.flatnonzero(slot < 0)
        if len(new):
            raw = part.data[ragged(starts[new], lengths[new])]
            known = len(self.pieces.sizes)
            self.pieces.add(raw, lengths[new])
            self.results.add(*self.encode(raw, lengths[new]))
            slot[new] = known + np.arange(len(new))
            self._learn(h[new], slot[new])
        flat, sizes = self.results.get(slot[codes])
        return flat, np.concatenate([[0], np.cumsum(sizes)])

    def _found(self, h: np.ndarray, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        slot = np.full(len(h), -1)
        for hashes, slots in self._sorted:
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[at] == h)
            slot[hit] = slots[at[hit]]
        hit = np.flatnonzero(slot >= 0)
        hit = hit[self.pieces.sizes[slot[hit]] == lengths[hit]]
        known, sizes = self.pieces.get(slot[hit])
        unlike = known != data[ragged(starts[hit], sizes)]
        same = np.ones(len(hit), bool)
        if unlike.any():
            same[np.searchsorted(np.cumsum(sizes), np.flatnonzero(unlike), "right")] = False
        out = np.full(len(h), -1)
        out[hit[same]] = slot[hit[same]]
        return out

    def _learn(self, h: np.ndarray, slots: np.ndarray) -> None:
        order = np.argsort(h)
        run = h[order], slots[order]
        while self._sorted and len(self._sorted[-1][0]) < 2 * len(run[0]):  # few sorted runs, each at least half the one before
            more = self._sorted.pop()
            both = np.concatenate([more[0], run[0]])
            order = np.argsort(both, kind="stable")
            run = both[order], np.concatenate([more[1], run[1]])[order]
        self._sorted.append(run)


def one_by_one(encode: Callable[[bytes], list[int]]) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """For a ``Memo``: every new piece by itself."""

    def run(raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        whole, ends = raw.tobytes(), np.cumsum(lengths).tolist()
        found = [encode(whole[a:b]) for a, b in zip([0, *ends], ends)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(itertools.chain.from_iterable(found), np.int64, int(sizes.sum())), sizes

    return run


def split_together(raw: np.ndarray, lengths: np.ndarray, joins: np.ndarray, token_bytes: np.ndarray, together: Callable[[str], np.ndarray],
                   alone: Callable[[str], list[int]], limit: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """Ids of pieces with few calls of a library: those that may stand side by side (``joins``) are encoded as one text,
    and the ids dealt out by the bytes that each stands for (``token_bytes``); the others go one by one."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    side = np.flatnonzero(joins)
    sizes = np.zeros(len(lengths), np.int64)
    found: list[np.ndarray] = []
    upto = np.cumsum(lengths[side])
    cuts = np.unique(np.append(np.searchsorted(upto, np.arange(0, int(upto[-1]) if len(upto) else 0, limit), "left"), len(side)))
    for a, b in zip(cuts, cuts[1:]):
        some = side[a:b]
        ids = together(raw[ragged(starts[some], lengths[some])].tobytes().decode())
        after = np.searchsorted(np.cumsum(token_bytes[ids]), np.cumsum(lengths[some])) + 1
        sizes[some] = np.diff(after, prepend=0)
        found.append(ids)
    for i in np.flatnonzero(~joins).tolist():
        ids = alone(raw[starts[i]:ends[i]].tobytes().decode())
        sizes[i] = len(ids)
        found.append(np.array(ids, np.int64))
    flat = np.concatenate(found) if found else np.empty(0, np.int64)
    # results in the order of the pieces: those side by side were found first
    order = np.concatenate([side, np.flatnonzero(~joins)])
    at = np.empty(len(order), np.int64)
    at[order] = np.cumsum(sizes[order]) - sizes[order]
    return flat[ragged(at, sizes)], sizes


def joinable(raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Pieces that begin with ASCII white space and end with another ASCII character: no rule of the tokenizers here
    looks across their borders."""
    ends = np.cumsum(lengths)
    head, tail = raw[ends - lengths], raw[ends - 1]
    return ((head == 0x20) | (head >= 9) & (head <= 13)) & (tail > 0x20) & (tail < 0x7F)


def holding(raw: np.ndarray, lengths: np.ndarray, text: bytes) -> np.ndarray:
    """Pieces in which the two bytes stand."""
    at = np.flatnonzero((raw[:-1] == text[0]) & (raw[1:] == text[1]))
    out = np.zeros(len(lengths), bool)
    which = np.searchsorted(np.cumsum(lengths), at, "right")
    out[which] = True  # a pair across a border marks one piece too many, which costs a call only
    return out


#: Decimal digits of 0 .. 65535 from the left, and how many.
_DIGITS = np.frombuffer(b"".join(str(i).encode().ljust(6) for i in range(65536)), np.uint8).reshape(-1, 6)
_COUNT = np.array([len(str(i)) for i in range(65536)])


def decimals(ids: np.ndarray, after: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Ids (below 65,536) in decimal, each with the byte ``after`` behind it; bytes before each and in all."""
    if not len(ids):
        return b"", np.zeros(1, np.int64)
    if int(ids.max()) > 65535:
        raise ValueError("an id of more than 16 bits")
    size = _COUNT[ids]
    rows = _DIGITS[ids]
    rows[np.arange(len(ids)), size] = after
    return rows[np.arange(6) <= size[:, None]].tobytes(), np.concatenate([[0], np.cumsum(size + 1)])
