"""Best-fit packing of documents into sequences of a fixed number of tokens.

Best-fit decreasing looks at nothing but lengths, so it runs on their histogram (at most ``capacity`` rows for any
number of documents). Open sequences with equal room are one class; a segment tree over the possible remaining
capacities finds the tightest class that takes a length in logarithmic time. The outcome is a list of runs:
the pieces of one length with ranks r .. r + n go to these sequences at that offset. Its size depends on
``capacity`` alone, so it is handed to every task; the pieces find their place by their rank among equal lengths,
which is counted in blocks without gathering a length in one task.

Defined results: null text: empty, so a document is its end id alone; a null doc_id stays null; equal lengths are
interchangeable; repeated rows are packed as often as they occur; an empty table gives none; other columns are
ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidespan.llm.bpe_files import byte_bpe
from tidespan.llm.tables import prepared, texts_of, written
from tidespan.llm.texts import Chunks, text_parts

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: Blocks in which the pieces of one length are ranked.
RANK_BLOCKS = 256


class Capacities:
    """Which remaining capacities 0 .. capacity are open: a segment tree of flags."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, room: int, is_open: bool) -> None:
        i = room + self.leaves
        self.any[i] = is_open
        while (i := i >> 1) and self.any[i] != (now := self.any[2 * i] or self.any[2 * i + 1]):
            self.any[i] = now

    def tightest(self, size: int) -> int | None:
        """The smallest open capacity of at least ``size``."""
        i = size + self.leaves
        if self.any[i]:
            return size
        while i > 1:
            if not i & 1 and self.any[i + 1]:  # the right sibling holds the next larger ones
                i += 1
                while i < self.leaves:
                    i = 2 * i if self.any[2 * i] else 2 * i + 1
                return i - self.leaves
            i >>= 1
        return None


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> dict[str, np.ndarray]:
    """Runs (size, rank, per, sequence, offset): the pieces of a size from ``rank`` on fill sequences from ``sequence``
    on, ``per`` in each, the first at ``offset``. The same as placing one piece after the other, longest first."""
    tree, rooms = Capacities(capacity), defaultdict(list)  # room: ranges (first sequence, how many)
    runs: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(room: int, first: int, n: int) -> None:
        if n and room:
            rooms[room].append((first, n))
            tree.set(room, True)

    for size in sorted((s for s, n in counts.items() if n), reverse=True):
        if not 0 < size <= capacity:
            raise ValueError(f"a length of {size} does not fit {capacity}")
        left, rank = counts[size], 0
        while left:
            room = tree.tightest(size)
            if room is None:
                room, first, there = capacity, opened, -(-left // (capacity // size))
                opened += there
            else:
                first, there = rooms[room].pop()
                if not rooms[room]:
                    tree.set(room, False)
            per = room // size  # a sequence stays the tightest until nothing more of this size fits
            full = min(there, left // per)
            offset = capacity - room
            if full:
                runs.append((size, rank, per, first, offset))
                put(room - per * size, first, full)
                left, rank = left - full * per, rank + full * per
            used = full
            if left and full < there:  # the last one takes fewer
                runs.append((size, rank, left, first + full, offset))
                put(room - left * size, first + full, 1)
                left, used = 0, full + 1
            if room < capacity or used < there:
                put(room, first + used, there - used)
    names = ("size", "rank", "per", "sequence", "offset")
    return dict(zip(names, np.array(runs, np.int64).reshape(-1, 5).T))


def token_pieces(docs: DataFrame, path: str, pattern: str, special: tuple[tuple[str, int], ...] = (), end_id: int = 0,
                 capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids of every whole text by the byte-level rank file at ``path``, then ``end_id``, cut where longer than
    ``capacity``; the first piece takes what is over. ``ids`` holds the ids as little-endian 32-bit numbers."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = byte_bpe(path, special, pattern)
        for batch in batches:
            names = batch.column(0)
            for at, data, offsets in text_parts(batch.column(1)):
                chunks = Chunks(data, offsets)
                ids, before = known.of(chunks)
                ends = before[chunks.bounds]
                out: list[tuple] = []
                for i, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
                    n = b - a + 1
                    first = n % capacity or capacity
                    raw = ids[a:b].astype("<u4").tobytes() + end_id.to_bytes(4, "little")
                    cuts = [0, *range(first, n + 1, capacity)]
                    out += [(at + i, k, s, raw[4 * s:4 * e]) for k, (s, e) in enumerate(zip(cuts, cuts[1:]))]
                row, piece, start, raws = zip(*out)
                yield pa.RecordBatch.from_arrays([
                    names.take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in raws], pa.int64()), pa.array([zlib.crc32(x) for x in raws], pa.int64()), pa.array(raws, pa.binary()),
                ], names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, PIECES + ", ids binary")


def packed(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """The pieces (any columns, ``length`` among them) with ``sequence_id`` and ``offset``. ``pieces`` is read
    three times, so hand in a written table."""
    spark = pieces.sparkSession
    histogram = {r.length: r["count"] for r in pieces.groupBy("length").count().collect()}  # one row a length
    runs = best_fit_decreasing(histogram, capacity)
    order = np.lexsort((runs["rank"], runs["size"]))
    runs = spark.sparkContext.broadcast({k: v[order] for k, v in runs.items()})  # bounded by the capacity

    block = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(RANK_BLOCKS)).cast("int")
    rows = pieces.withColumn("__block", block)
    counts = rows.groupBy("length", "__block").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.sum("__n").over(Window.partitionBy("length").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)))
    within = Window.partitionBy("length", "__block").orderBy("doc_id", "piece", "ids_crc32")
    ranked = rows.withColumn("__at", F.row_number().over(within) - F.lit(1)).join(before.drop("__n"), ["length", "__block"])
    ranked = ranked.select(*pieces.columns, (F.col("__at") + F.coalesce("__before", F.lit(0))).cast("long").alias("__rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = runs.value
        keys = r["size"] << 44 | r["rank"]
        for batch in batches:
            size, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "__rank"))
            run = np.searchsorted(keys, size << 44 | rank, "right") - 1
            nth, k = np.divmod(rank - r["rank"][run], r["per"][run])
            columns = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != "__rank"]
            names = [f.name for f in batch.schema if f.name != "__rank"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(r["sequence"][run] + nth), pa.array(r["offset"][run] + k * size)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")


def packed_documents(docs: DataFrame, path: str, pattern: str, special=(), end_id: int = 0, capacity: int = 2048, ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place, and with their ids if asked for (``sequences`` joins them)."""
    pieces = token_pieces(docs, path, pattern, special, end_id, capacity)
    return packed(written(pieces if ids else pieces.drop("ids"), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed sequences themselves, from pieces that still have ``ids``: one row each, ids in order of offset."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` pieces a sequence
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.expr("aggregate(p, X'', (s, x) -> concat(s, x.ids))").alias("ids"))
