"""A bidirectional FM-index over a delimited vocabulary, searched for all patterns at once.

The text is ``$word$word$…$`` with an end mark. One index is over the text, one over its reversal; a pattern is an
interval of suffix ranks in each of them, of one size, so it can be extended at either end. Extensions at one end go by
the other index's last column and keep both intervals in step.
"""

from __future__ import annotations

import numpy as np

from tidespan.llm.texts import ragged

END, STOP = 0, 1
#: Symbols between two rows of counts.
STEP = 64


def suffix_array(text: np.ndarray, bits: int) -> np.ndarray:
    """Places of all suffixes in their order; the last symbol is the only smallest one. Ranks of k symbols give those of 2k."""
    n, width = len(text), 62 // bits
    padded = np.concatenate([text.astype(np.int64), np.zeros(width, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(width):
        key = key << bits | padded[i:i + n]
    while True:
        order = np.argsort(key, kind="stable")
        new = np.append(False, key[order][1:] != key[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        if rank[order[-1]] == n - 1:
            return order
        key = rank << 31 | np.append(rank[width:] + 1, np.zeros(min(width, n), np.int64))[:n]
        width *= 2


class Column:
    """The last column of the sorted rotations: how many symbols before a place equal or are smaller than one."""

    def __init__(self, text: np.ndarray, symbols: int):
        self.suffixes = suffix_array(text, max(1, int(symbols).bit_length()))
        self.last = text[self.suffixes - 1]
        n = len(text)
        blocks = n // STEP + 1
        counts = np.bincount(np.arange(n) // STEP * (symbols + 1) + self.last + 1, minlength=blocks * (symbols + 1) + 1)[:blocks * (symbols + 1)].reshape(blocks, -1)
        counts = np.cumsum(counts, axis=1)  # symbols smaller than c in a block; the last symbol's own count needs no column
        self.table = np.concatenate([np.zeros((1, symbols + 1), np.int64), np.cumsum(counts, axis=0)]).astype(np.int32)
        self.padded = np.concatenate([self.last, np.full(STEP, 255, np.uint8)])

    def counts(self, place: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(smaller symbols, equal ones) before each place."""
        block, rest = place // STEP, place % STEP
        smaller, equal = self.table[block, symbol].astype(np.int64), np.empty(len(place), np.int64)
        upto = self.table[block, np.minimum(symbol + 1, self.table.shape[1] - 1)]
        for a in range(0, len(place), 1 << 16):  # a block of rows at a time keeps the comparison small
            some = slice(a, a + (1 << 16))
            near = self.padded[block[some, None] * STEP + np.arange(STEP)]
            before = np.arange(STEP) < rest[some, None]
            equal[some] = (before & (near == symbol[some, None])).sum(axis=1) + upto[some] - self.table[block[some], symbol[some]]
            smaller[some] += (before & (near < symbol[some, None])).sum(axis=1)
        return smaller, equal


class Intervals:
    """Patterns as intervals of suffix ranks: ``by`` in the column that extends them, ``at`` in the other one, of one ``size``."""

    def __init__(self, by: np.ndarray, at: np.ndarray, size: np.ndarray):
        self.by, self.at, self.size = by, at, size

    def take(self, which: np.ndarray) -> Intervals:
        return Intervals(self.by[which], self.at[which], self.size[which])

    def turned(self) -> Intervals:
        return Intervals(self.at, self.by, self.size)


class Vocabulary:
    """Distinct words (as symbols from 2 on, one after the other, and their lengths) in an index of both directions."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray):
        size = np.append(lengths + 1, 0)
        starts = np.cumsum(size) - size
        text = np.full(int(size.sum()) + 1, STOP, np.uint8)
        text[ragged(starts[:-1] + 1, lengths)] = symbols
        kinds = int(symbols.max(initial=STOP)) + 1
        if kinds > 254:
            raise ValueError("an alphabet of more than 252 letters")
        text = np.append(text, np.uint8(END))
        backward = np.append(text[-2::-1], np.uint8(END))
        #: extends to the left, to the right
        self.left, self.right = Column(text, kinds), Column(backward, kinds)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=kinds + 1))])
        self.n = len(text)
        self._starts = starts[:-1]

    def all(self, n: int) -> Intervals:
        return Intervals(np.zeros(n, np.int64), np.zeros(n, np.int64), np.full(n, self.n))

    def extended(self, column: Column, x: Intervals, symbol: np.ndarray) -> Intervals:
        n = len(symbol)
        smaller, equal = column.counts(np.concatenate([x.by, x.by + x.size]), np.concatenate([symbol, symbol]))
        return Intervals(self.first[symbol] + equal[:n], x.at + smaller[n:] - smaller[:n], equal[n:] - equal[:n])

    def children(self, column: Column, x: Intervals) -> tuple[np.ndarray, np.ndarray, Intervals]:
        """(interval, symbol, extended interval) for every letter by which each interval can be extended."""
        of = np.repeat(np.arange(len(x.size)), x.size)
        keys = np.sort(of << 8 | column.last[ragged(x.by, x.size)])
        head = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        size, of, symbol = np.diff(np.append(head, len(keys))), keys[head] >> 8, keys[head] & 255
        before = head - (np.cumsum(x.size) - x.size)[of]  # smaller symbols of the same interval
        letter = symbol > STOP
        of, symbol, size, before = of[letter], symbol[letter], size[letter], before[letter]
        _, equal = column.counts(x.by[of], symbol)
        return of, symbol, Intervals(self.first[symbol] + equal, x.at[of] + before, size)

    def exact(self, column: Column, symbols: np.ndarray, lengths: np.ndarray) -> Intervals:
        """Patterns from the delimiter on: extended letter by letter, then at their other end by the delimiter."""
        x, starts = self.all(len(lengths)), np.cumsum(lengths) - lengths
        for j in range(int(lengths.max(initial=0))):
            go = np.flatnonzero(lengths > j)
            y = self.extended(column, x.take(go), symbols[starts[go] + j])
            x.by[go], x.at[go], x.size[go] = y.by, y.at, y.size
        other = self.left if column is self.right else self.right
        return self.extended(other, x.turned(), np.full(len(lengths), STOP)).turned()

    def one_error(self, column: Column, x: Intervals, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, word) for all words that follow an interval's exact part with the rest of the pattern (letters in the
        order of extension) but for exactly one error, and then end. A pair may come more than once."""
        starts = np.cumsum(lengths) - lengths
        q = np.flatnonzero(x.size > 0)
        x = x.take(q)
        who, j, late = np.empty(0, np.int64), np.empty(0, np.int64), self.all(0)  # patterns that have their error
        done_q, done = [], []
        step = 0
        while len(q) or len(who):
            # those with an error go on without one
            over = j == lengths[who]
            if over.any():
                y = self.extended(column, late.take(over), np.full(int(over.sum()), STOP))
                done_q.append(who[over][y.size > 0])
                done.append((y.at if column is self.right else y.by)[y.size > 0])
            go = np.flatnonzero(~over)
            late = self.extended(column, late.take(go), symbols[starts[who[go]] + j[go]])
            alive = np.flatnonzero(late.size > 0)
            who, j, late = who[go][alive], j[go][alive] + 1, late.take(alive)
            if not len(q):
                continue
            # those without: equal intervals are extended once
            keys, same = np.unique(x.by * (self.n + 1) + x.size, return_inverse=True)
            one = np.empty(len(keys), np.int64)
            one[same] = np.arange(len(q))
            of, symbol, child = self.children(column, x.take(one))
            first = np.searchsorted(of, np.arange(len(keys) + 1))
            n = np.diff(first)[same]
            pattern, c = np.repeat(np.arange(len(q)), n), ragged(first[same], n)
            left = lengths[q] - step
            wanted = np.full(len(q), -1)
            wanted[left > 0] = symbols[starts[q[left > 0]] + step]
            hit = symbol[c] == wanted[pattern]
            other = np.flatnonzero(~hit)
            changed = other[left[pattern[other]] > 0]
            after = np.full(len(q), -1)
            after[left > 1] = symbols[starts[q[left > 1]] + step + 1]
            dropped = np.flatnonzero((left > 0) & (after != wanted))  # of equal letters the last one
            new = [(q[pattern[other]], np.full(len(other), step), child.take(c[other])), (q[pattern[changed]], np.full(len(changed), step + 1), child.take(c[changed])),
                   (q[dropped], np.full(len(dropped), step + 1), x.take(dropped))]
            who = np.concatenate([who, *[a for a, _, _ in new]])
            j = np.concatenate([j, *[b for _, b, _ in new]])
            late = Intervals(*[np.concatenate([getattr(late, f), *[getattr(y, f) for _, _, y in new]]) for f in ("by", "at", "size")])
            q, x, step = q[pattern[hit]], child.take(c[hit]), step + 1
        if not done:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        ranks = np.concatenate(done)
        return np.concatenate(done_q), np.searchsorted(self._starts, self.left.suffixes[ranks])
