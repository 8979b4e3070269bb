"""Token ids as wavelet matrices, one per shard, in compressed files.

A shard is a run of documents in ascending doc_id order. Its ids are stored as bit-planes, highest bit first; after
each plane the ids with a 0 bit go before those with a 1 bit. A plane is cut into frames of 524,288 bits, each compressed by itself, with
the count of ones before every frame; so one file answers access (the id at a place), rank (how often an id occurs
before a place) and select (where its n-th occurrence is) by unpacking one or two frames a plane.

File format, little-endian: ``WVM2``, uint32 bits a number, uint64 numbers, uint64 documents, uint32 bytes of the packed document
table; for each plane uint64 ones before every frame and in all, then uint32 bytes of every packed frame; then the zstandard
frames: the document table (doc_id, int64 each; a null flag, uint8; ids of each document, int64), and the frames of all planes (bits
in 64-bit words). Files are the ``payload`` of rows in Parquet, written through Spark's committer; so a lost executor costs its running tasks.

Defined results: null text: empty, so a document is its end id alone; rows of equal doc_id are ordered by text; null
doc_ids come first; an empty table gives no shard; other columns are ignored.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidespan.llm.bpe_files import word_bpe
from tidespan.llm.memo import Arena, Memo, holding
from tidespan.llm.tables import prepared, texts_of
from tidespan.llm.texts import U64, Pieces, Hashed, ragged, text_parts

MAGIC = b"WVM2"
#: Bits of a plane that are compressed together.
FRAME = 1 << 19
#: Places of a plane that are dealt together when it is read; they fit in a processor's cache.
NEAR = 1 << 16
#: A shard is closed at so many ids; the longest document may go beyond.
SHARD_IDS = 1 << 21
#: Words that a worker remembers: those of odd pieces, and short ones. Only time depends on it.
KNOWN_WORDS, SHORT_WORDS = 400_000, 1_000_000
#: Words that are looked up together.
BLOCK = 1 << 19
#: Odd numbers that spread the keys of a word over the table.
SPREAD = np.random.default_rng(20240608).integers(0, 2**64, 2, dtype=U64) | U64(1)
SHARDS = "first_doc_id long, shard long, n_tokens long, payload binary"


class Plane:
    """One bit of every number: frames of 64-bit words, unpacked when they are first touched."""

    def __init__(self, n: int, before: np.ndarray, packed: list[bytes], opened: dict[int, np.ndarray]):
        self.n, self.before, self.packed, self.opened = n, before, packed, opened
        self.zeros = n - int(before[-1])

    @classmethod
    def of(cls, bit: np.ndarray) -> Plane:
        raw = np.zeros(-(-len(bit) // 64) * 8, np.uint8)
        packed = np.packbits(bit, bitorder="little")
        raw[:len(packed)] = packed
        words = raw.view("<u8")
        frames = [words[a:a + FRAME // 64] for a in range(0, len(words), FRAME // 64)]
        ones = [int(np.bitwise_count(w).sum(dtype=np.int64)) for w in frames]
        return cls(len(bit), np.concatenate([[0], np.cumsum(ones, dtype=np.int64)]), [], dict(enumerate(frames)))

    def frame(self, f: int) -> np.ndarray:
        if f not in self.opened:
            self.opened[f] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.packed[f]), "<u8")
        return self.opened[f]

    def bit(self, i: int) -> int:
        f, r = divmod(i, FRAME)
        return int(self.frame(f)[r >> 6]) >> (r & 63) & 1

    def ones(self, i: int) -> int:
        """Ones before place i."""
        f, r = divmod(i, FRAME)
        out = int(self.before[f])
        if r:
            words = self.frame(f)
            out += int(np.bitwise_count(words[:r >> 6]).sum(dtype=np.int64))
            if r & 63:
                out += (int(words[r >> 6]) & (1 << (r & 63)) - 1).bit_count()
        return out

    def nth(self, k: int, one: int) -> int:
        """Place of the k-th (from 0) one or zero: frames by binary search, then words, then bits."""
        places = np.minimum(np.arange(len(self.before)) * FRAME, self.n)
        before = self.before if one else places - self.before
        f = int(np.searchsorted(before, k, "right")) - 1
        k -= int(before[f])
        words = self.frame(f) if one else ~self.frame(f)
        upto = np.cumsum(np.bitwise_count(words), dtype=np.int64)
        w = int(np.searchsorted(upto, k, "right"))
        k -= int(upto[w - 1]) if w else 0
        word = int(words[w])
        for _ in range(k):
            word &= word - 1
        return f * FRAME + w * 64 + (word & -word).bit_length() - 1

    def bits(self) -> np.ndarray:
        words = [self.frame(f) for f in range(len(self.before) - 1)]
        return np.unpackbits(np.concatenate(words).view(np.uint8), count=self.n, bitorder="little").view(bool) if words else np.zeros(0, bool)


class WaveletMatrix:
    """Bit-planes over a sequence of unsigned numbers, with rank and select."""

    def __init__(self, n: int, planes: list[Plane]):
        self.n, self.planes, self.levels = n, planes, len(planes)

    @classmethod
    def build(cls, values: np.ndarray, bits: int) -> WaveletMatrix:
        n, planes = len(values), []
        for level in range(bits - 1, -1, -1):
            bit = values & values.dtype.type(1 << level) != 0
            planes.append(Plane.of(bit))
            values = np.concatenate([values.compress(~bit), values.compress(bit)])
        return cls(n, planes)

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        out = 0
        for plane in self.planes:
            bit, ones = plane.bit(i), plane.ones(i)
            out = out << 1 | bit
            i = plane.zeros + ones if bit else i - ones
        return out

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of the value before ``end`` stand below the last plane."""
        a = 0
        for level, plane in enumerate(self.planes):
            below, upto = plane.ones(a), plane.ones(end)
            a, end = (plane.zeros + below, plane.zeros + upto) if value >> (self.levels - 1 - level) & 1 else (a - below, end - upto)
        return a, end

    def rank(self, value: int, end: int | None = None) -> int:
        """Occurrences of the value before place ``end``."""
        if not 0 <= value < 1 << self.levels:
            return 0
        a, b = self._range(value, self.n if end is None else end)
        return b - a

    def select(self, value: int, nth: int) -> int:
        """Place of occurrence ``nth`` (from 0) of the value."""
        if not 0 <= nth < self.rank(value):
            raise IndexError(nth)
        i = self._range(value, self.n)[0] + nth
        for level in range(self.levels - 1, -1, -1):
            plane, one = self.planes[level], value >> (self.levels - 1 - level) & 1
            i = plane.nth(i - plane.zeros if one else i, one)
        return i

    def values(self) -> np.ndarray:
        """The whole sequence, plane by plane from the last one up."""
        kind = np.uint16 if self.levels <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            plane = self.planes[level]
            bit, zero, one = plane.bits(), 0, plane.zeros
            out[one:] |= kind(1 << self.levels - 1 - level)
            above = np.empty_like(out)
            for at in range(0, self.n, NEAR):  # places in a block cost less than a mask over all
                zeros, ones = np.flatnonzero(~bit[at:at + NEAR]), np.flatnonzero(bit[at:at + NEAR])
                part = above[at:at + NEAR]
                part[zeros], part[ones] = out[zero:zero + len(zeros)], out[one:one + len(ones)]
                zero, one = zero + len(zeros), one + len(ones)
            out = above
        return out


def to_file(doc_ids: list[int | None], sizes: np.ndarray, matrix: WaveletMatrix) -> bytes:
    pack = zstandard.ZstdCompressor(level=1).compress
    table = pack(b"".join(x.tobytes() for x in (np.array([x or 0 for x in doc_ids], "<i8"), np.array([x is None for x in doc_ids], np.uint8), sizes.astype("<i8"))))
    head, frames = [MAGIC, struct.pack("<IQQI", matrix.levels, matrix.n, len(doc_ids), len(table))], [table]
    for plane in matrix.planes:
        packed = [pack(plane.frame(f).tobytes()) for f in range(len(plane.before) - 1)]
        head += [plane.before.astype("<u8").tobytes(), np.array(list(map(len, packed)), "<u4").tobytes()]
        frames += packed
    return b"".join(head + frames)


def from_file(payload: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """The documents of a shard, their numbers of ids, and the matrix, whose frames stay packed until they are asked for."""
    if payload[:4] != MAGIC:
        raise ValueError("not a wavelet shard")
    bits, n, docs, size = struct.unpack_from("<IQQI", payload, 4)
    count, at = -(-n // FRAME), 4 + struct.calcsize("<IQQI")
    heads = []
    for _ in range(bits):
        heads.append((np.frombuffer(payload, "<u8", count + 1, at).astype(np.int64), np.frombuffer(payload, "<u4", count, at + 8 * (count + 1)).tolist()))
        at += 8 * (count + 1) + 4 * count
    raw = zstandard.ZstdDecompressor().decompress(payload[at:at + size])
    at += size
    ids, null, sizes = np.frombuffer(raw, "<i8", docs).tolist(), np.frombuffer(raw, "u1", docs, 8 * docs), np.frombuffer(raw, "<i8", docs, 9 * docs)
    for i in np.flatnonzero(null):
        ids[i] = None
    planes = []
    for before, lengths in heads:
        ends = np.cumsum(lengths, dtype=np.int64) + at
        planes.append(Plane(n, before, [payload[e - m:e] for e, m in zip(ends.tolist(), lengths)], {}))
        at = int(ends[-1]) if lengths else at
    return ids, sizes, WaveletMatrix(n, planes)


class WordIds:
    """Ids of texts by the tokenizers library's own merges. A word of at most 16 bytes is known by its bytes, as two numbers, in a table that is
    searched for all words of a part at once; longer pieces and those with odd bytes are remembered by a ``Memo``. Words not met before go
    to the library together."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.bpe, self.merges = word_bpe(path), Tokenizer(Tokenizer.from_file(path).model)
        self.merges.pre_tokenizer = WhitespaceSplit()  # no letter that stands for a byte is white space
        self.letters = {b: c for b, c in self.bpe.letters.items() if b != 0x20}
        self.last = np.zeros(max(self.bpe.names) + 1, bool)
        self.last[[i for t, i in self.bpe.vocab.items() if t.endswith(self.bpe.suffix)]] = True
        self.kind = np.uint16 if len(self.last) <= 1 << 16 else np.uint32
        self.known: dict[str, int] = {}
        self.memo = Memo(self.encode, self.kind)
        self.forget()
        self.clear()

    def forget(self) -> None:
        self.known.clear()
        self.known["\n"] = 0  # between chunks, without ids
        self.ids = Arena(self.kind)
        self.ids.add(np.empty(0, self.kind), np.zeros(1, np.int64))

    def clear(self) -> None:
        self.table = np.zeros(1 << 12, np.int32)  # by hash, then the next free place: number of a short word; 0: none
        self.keys = np.zeros((2, 1 << 10), U64)  # of every short word; no piece has the keys of word 0
        self.short = Arena(self.kind)
        self.short.add(np.empty(0, self.kind), np.zeros(1, np.int64))

    def encoded(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with a space between each two, and how many each has."""
        letters = text.decode("latin-1")
        if not (letters.isascii() and letters.isprintable()):  # these letters stand for themselves
            letters = letters.translate(self.letters)
        ids = np.array(self.merges.encode_batch_fast([letters], add_special_tokens=False)[0].ids, self.kind)
        return ids, np.diff(np.flatnonzero(self.last[ids]) + 1, prepend=0)  # a word's last token carries the word end

    def learn(self, words: list[str]) -> None:
        if words:
            self.known.update(zip(words, range(len(self.known), len(self.known) + len(words))))
            self.ids.add(*self.encoded(" ".join(words).encode()))

    def places(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((a * SPREAD[0] + b * SPREAD[1]) >> U64(65 - len(self.table).bit_length())).astype(np.int64)

    def numbers(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of short words by their keys. New ones are learned."""
        at = self.places(a, b)
        out = self.table[at]
        left = np.flatnonzero((self.keys[0][out] != a) | (self.keys[1][out] != b))
        while len(left := left[out[left] > 0]):  # another word stands there
            at[left] = at[left] + 1 & len(self.table) - 1
            out[left] = found = self.table[at[left]]
            left = left[(self.keys[0][found] != a[left]) | (self.keys[1][found] != b[left])]
        new = np.flatnonzero(out == 0)
        if len(new):
            out[new] = self.added(a[new], b[new])
        return out

    def added(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Numbers of short words that are not in the table yet, which may repeat."""
        n = before = len(self.short.sizes)
        if n + len(a) > self.keys.shape[1]:
            grown = np.zeros((2, 2 * (n + len(a))), U64)
            grown[:, :n] = self.keys[:, :n]
            self.keys = grown
        if 2 * (n + len(a)) > len(self.table):  # at least half of the table stays free
            self.table = np.zeros(1 << (4 * (n + len(a))).bit_length(), np.int32)
            at, left = self.places(*self.keys[:, 1:n]), np.arange(1, n)
            while len(left):
                free = self.table[at] == 0
                self.table[at[free]] = left[free]
                open_ = self.table[at] != left
                at, left = at[open_] + 1 & len(self.table) - 1, left[open_]
        out, at, left = np.zeros(len(a), np.int32), self.places(a, b), np.arange(len(a))
        while len(left):
            free = np.flatnonzero(self.table[at] == 0)
            self.table[at[free]] = np.arange(n, n + len(free))
            first = free[self.table[at[free]] == np.arange(n, n + len(free))]  # of several that want a place one gets it
            numbers = np.arange(n, n + len(first))
            self.table[at[first]] = numbers
            self.keys[:, numbers] = a[left[first]], b[left[first]]
            n += len(first)
            out[left] = found = self.table[at]
            open_ = (self.keys[0][found] != a[left]) | (self.keys[1][found] != b[left])
            at, left = at[open_] + 1 & len(self.table) - 1, left[open_]
        words = np.full((n - before, 17), 0x20, np.uint8)
        words[:, :16] = np.ascontiguousarray(self.keys[:, before:n].T.astype("<u8")).view(np.uint8)
        self.short.add(*self.encoded(words[words != 0].tobytes()[:-1]))
        return out

    def of(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts of a part, ids before each text and in all)"""
        if len(self.short.sizes) > SHORT_WORDS:
            self.clear()
        pieces = Pieces(data, offsets)
        short = ~pieces.whole & (pieces.ends - pieces.starts <= 16)
        which = np.flatnonzero(short)
        a, b = pieces.keys(which)
        slots = np.concatenate([np.empty(0, np.int32), *[self.numbers(a[i:i + BLOCK], b[i:i + BLOCK]) for i in range(0, len(which), BLOCK)]])
        if len(which) == len(short):
            flat, sizes = self.short.get(slots)
        else:
            rest = np.flatnonzero(~short)
            more, before = self.memo.of(Hashed(pieces, rest))
            starts, sizes = np.empty(len(short), np.int64), np.empty(len(short), np.int64)
            starts[which], sizes[which] = self.short.starts[slots], self.short.sizes[slots]
            starts[rest], sizes[rest] = self.short.n + before[:-1], np.diff(before)
            flat = np.concatenate([self.short.data[:self.short.n], more])[ragged(starts, sizes)]
        return flat, np.concatenate([[0], np.cumsum(sizes)])[pieces.bounds]

    def encode(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        special = holding(raw, lengths, b"<|")
        ends = np.cumsum(lengths)
        if special.any():  # special strings may stand in these
            plain = np.repeat(~special, lengths)
            words = self.bpe.lines(np.insert(raw[plain], np.cumsum(lengths[~special]), 10).tobytes().decode())
        else:
            words = self.bpe.lines(np.insert(raw, ends, 10).tobytes().decode())
        apart = [self.bpe.pieces(raw[ends[i] - lengths[i]:ends[i]].tobytes()) for i in np.flatnonzero(special).tolist()]
        met = dict.fromkeys(words)
        met.update((w, None) for pieces in apart for is_special, w in pieces if not is_special)
        self.learn([w for w in met if w not in self.known])
        which = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        flat, n = self.ids.get(which)
        sizes = np.zeros(len(lengths), np.int64)
        sizes[~special] = np.diff(np.cumsum(n)[which == 0], prepend=0)
        if not special.any():
            return flat, sizes
        found = np.split(flat, np.cumsum(sizes[~special])[:-1]) if (~special).any() else []
        out: list = [None] * len(lengths)
        for i, x in zip(np.flatnonzero(~special).tolist(), found):
            out[i] = x
        for i, pieces in zip(np.flatnonzero(special).tolist(), apart):
            out[i] = np.concatenate([np.empty(0, self.kind), *[np.array([self.bpe.special[w]], self.kind) if s else self.ids.get(np.array([self.known[w]]))[0] for s, w in pieces]])
            sizes[i] = len(out[i])
        return np.concatenate(out), sizes


@functools.cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)


def shards(docs: DataFrame, path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a shard, to be written as files: ranges of doc_id are dealt to tasks, which stream over their
    documents in order and close a shard every ``SHARD_IDS`` ids."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        bits = max(max(bpe.names), end_id).bit_length()
        kind = np.uint16 if bits <= 16 else np.uint32
        names: list = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = done = 0

        def closed() -> pa.RecordBatch:
            nonlocal names, sizes, ids, held, done
            size = np.concatenate(sizes)
            payload = to_file(names, size, WaveletMatrix.build(np.concatenate(ids), bits))
            out = pa.RecordBatch.from_arrays([pa.array([names[0]], pa.int64()), pa.array([done]), pa.array([held]), pa.array([payload], pa.binary())], names=["first_doc_id", "shard", "n_tokens", "payload"])
            names, sizes, ids, held, done = [], [], [], 0, done + 1
            return out

        for batch in batches:
            for at, data, offsets in text_parts(batch.column(1)):
                flat, ends = word_ids(path).of(data, offsets)
                rows = len(offsets) - 1
                names += batch.column(0).slice(at, rows).to_pylist()
                sizes.append(np.diff(ends) + 1)
                ids.append(np.insert(flat.astype(kind), ends[1:], kind(end_id)))
                held += len(ids[-1])
                if held >= SHARD_IDS:
                    yield closed()
        if names:
            yield closed()

    rows = texts_of(docs, id_col, text_col)
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, SHARDS)


def write_shards(docs: DataFrame, path: str, folder: str, end_id: int = 2) -> None:
    shards(docs, path, end_id).write.option("compression", "uncompressed").mode("overwrite").parquet(folder)


def read_shards(files: DataFrame) -> DataFrame:
    """Per document, decoded from its shard: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    order = [F.col("first_doc_id").asc_nulls_first(), F.col("shard")]
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # one small row a shard of two million ids
    starts = files.select("first_doc_id", "shard", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("__start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, shard, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                names, sizes, matrix = from_file(payload.as_py())
                raw = memoryview(matrix.values().astype("<u4").tobytes())
                ends = np.cumsum(sizes)
                crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                n = len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first] * n, pa.int64()), pa.array([shard] * n), pa.array(names, pa.int64()), pa.array(ends - sizes), pa.array(sizes), pa.array(crc, pa.int64())],
                    names=["first_doc_id", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])

    rows = files.select("first_doc_id", "shard", "payload").mapInArrow(run, "first_doc_id long, shard long, doc_id long, at long, n_tokens long, ids_crc32 long").alias("r")
    same = F.col("r.first_doc_id").eqNullSafe(F.col("s.first_doc_id")) & (F.col("r.shard") == F.col("s.shard"))
    return rows.join(starts.alias("s"), same).select("doc_id", (F.col("__start") + F.col("at")).alias("start"), "r.n_tokens", "ids_crc32")
