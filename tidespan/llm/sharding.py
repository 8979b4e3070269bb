"""Byte-balanced shards of indivisible groups, by Karmarkar-Karp differencing.

Each item starts as a partial partition with its size in one of the shards. Again and again the two partial
partitions with the largest spread are combined in opposite order (largest sum to smallest), until one is left.

Groups are rows of equal text, by SHA-256. Groups that are large (over the mean of ``BUCKETS``) are items
of their own, at most ``BUCKETS`` of them; the others fall into ``BUCKETS`` buckets by their hash and a bucket is
an item. So there are never more than 2 * BUCKETS items, at any number of documents, and the table of items to shards is
small enough to be handed to every task. With fewer groups than buckets nearly every item is a single group. A shard's
slots are numbered in blocks, so no shard is gathered in one task.

Defined results: null text: no bytes, crc32 of nothing (0), all null texts are one group; a null doc_id is kept;
repeated rows are rows of one group; shards may stay empty if there are fewer groups; an empty table gives none; other columns are
ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidespan.llm.tables import written

BUCKETS = 8192
SLOT_BLOCKS = 256


def differencing(sizes: list[int], k: int) -> list[int]:
    """A shard 0 .. k - 1 for each size."""
    if not sizes:
        return []
    # a partial partition: (-spread, number, sums in descending order); joins remember where its slots went
    heap = [(-size, i, (size, *[0] * (k - 1))) for i, size in enumerate(sizes)]
    heapq.heapify(heap)
    joins: list[tuple[int, int, list[int]]] = []
    number = len(sizes)
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heapq.heappop(heap)
        sums = [x + y for x, y in zip(left, reversed(right))]
        order = sorted(range(k), key=lambda s: -sums[s])
        joins.append((a, b, order))
        sums = tuple(sums[s] for s in order)
        heapq.heappush(heap, (sums[-1] - sums[0], number, sums))
        number += 1
    slots: dict[int, list[int]] = {heap[0][1]: list(range(k))}
    for n in range(number - 1, len(sizes) - 1, -1):
        a, b, order = joins[n - len(sizes)]
        where, mine = slots.pop(n), [0] * k
        for at, s in enumerate(order):
            mine[s] = where[at]
        slots[a], slots[b] = mine, mine[::-1]
    return [slots[i][0] for i in range(len(sizes))]


def sharded(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row; rows of equal text share a shard."""
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(8)).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), F.unhex(F.coalesce(F.sha2(text, 256), F.lit("00"))).alias("key"),
    ).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS)).cast("int"))
    rows = written(rows, "sizes")
    total = rows.agg(F.sum("size")).first()[0] or 0
    groups = rows.groupBy("key", "bucket").agg(F.sum("size").alias("bytes"))
    large = F.col("bytes").cast("decimal(38,0)") * F.lit(BUCKETS) > F.lit(total)
    items = groups.groupBy(F.when(large, F.col("key")).alias("key"), "bucket").agg(F.sum("bytes").alias("bytes"))
    found = sorted(items.collect(), key=lambda r: (-r.bytes, r.bucket, r.key or b""))  # 2 * BUCKETS rows at most
    placed = list(zip(found, differencing([r.bytes for r in found], shards)))
    own = spark.createDataFrame([(r.key, s) for r, s in placed if r.key is not None], "key binary, own int")
    shared = spark.createDataFrame([(r.bucket, s) for r, s in placed if r.key is None], "bucket int, shared int")
    rows = rows.join(F.broadcast(own), "key", "left").join(F.broadcast(shared), "bucket", "left")
    rows = rows.select("doc_id", "size", "text_crc32", F.coalesce("own", "shared").alias("shard"))
    return with_slots(rows)


def with_slots(rows: DataFrame) -> DataFrame:
    """``slot``: numbers from 0 without gaps in each shard."""
    rows = rows.withColumn("__block", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(SLOT_BLOCKS)).cast("int"))
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("__n")).select("shard", "__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy("shard", "__block").orderBy("doc_id", "text_crc32")
    numbered = rows.withColumn("__at", F.row_number().over(within)).join(starts, ["shard", "__block"])
    return numbered.withColumn("slot", (F.col("__start") + F.col("__at") - F.lit(1)).cast("long")).drop("__block", "__start", "__at")
