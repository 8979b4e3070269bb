"""Order MinHash slots against a plain version, texts of many words, and the ranges of rows."""

import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import make
from tidespan.llm import order_minhash

LOW34 = (1 << 34) - 1


def chained(*longs, seed=42):
    for x in longs:
        seed = xxhash.xxh64_intdigest(struct.pack("<Q", x), seed)
    return seed


def plain(text, k=3, size=2):
    """Slots as the docstring of the module defines them, with lists and dicts."""
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in re.split("[ \t-\r]+", (text or "").strip(" \t-\r\n\x0b\x0c"))]
    grams = [chained(*words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [chained(*words)]
    seen, bins = Counter(), defaultdict(list)
    for place, gram in enumerate(grams):
        gram >>= 30
        signed = gram  # 34 bits, never negative as a long
        h = xxhash.xxh64_intdigest(struct.pack("<I", seen[gram]), xxhash.xxh64_intdigest(struct.pack("<Q", signed), 42)) >> 30
        seen[gram] += 1
        bins[h >> 28].append((h, place))
    slots = []
    for b, found in sorted(bins.items()):
        found = sorted(sorted(found)[:size], key=lambda f: f[1])
        slots.append((b << 26) + (chained(*[h & ((1 << 28) - 1) for h, _ in found]) & ((1 << 26) - 1)) - (1 << 31))
    return sorted(slots)


def test_plain_version(spark, odd, odd_rows):
    got = odd.select("text", F.sort_array(order_minhash.fingerprint("coalesce(text, '')")).alias("s")).collect()
    assert Counter((r.text, tuple(r.s)) for r in got) == Counter((t, tuple(plain(t))) for _, t in odd_rows)
    assert order_minhash.PLACE_BITS + order_minhash.BIN_BITS < 64 and 2 << order_minhash.PLACE_BITS > (1 << 31) - 1


def test_order_far_behind(spark):
    """Order counts at any place: the tail of a long text, its words reversed. Words differ, so places alone tell."""
    words = [f"w{i}" for i in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:200_000] + words[200_000:][::-1]))]
    got = {r.doc_id: r.s for r in make(spark, rows).select("doc_id", order_minhash.fingerprint("text").alias("s")).collect()}
    assert got[1] != got[2] and sorted(got[1]) == plain(rows[0][1]) and sorted(got[2]) == plain(rows[1][1])


def reference(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    return Counter((d, t, order[(i + 1) % len(order)][1]) for i, (d, t) in enumerate(order))


@pytest.mark.parametrize("ranges", [1, 2, 7, 4096])
def test_next_in_ranges(spark, ranges):
    rows = [(i, f"text {i}") for i in range(150)] + [((1 << 60) + i, f"far {i}") for i in range(5)] + [(-(1 << 63), "least"), ((1 << 63) - 1, "most")]
    rows += [(None, f"none {i}") for i in range(40)] + [(77, f"{i} same id") for i in range(40)] + [(5, "twice")] * 3 + [(None, ""), (8, ""), (9, "é" * 40 + "a"), (9, "é" * 40 + "b")]
    got = order_minhash.with_next(make(spark, rows), ranges=ranges).collect()
    assert Counter((r.doc_id, r.text, r.next_text) for r in got) == reference(rows)


def test_ranges_hold_few_rows(spark):
    rows = spark.range(20_000).selectExpr(
        "CASE WHEN id < 8000 THEN null WHEN id < 12000 THEN 3 WHEN id = 19999 THEN 1152921504606846976 ELSE id END AS doc_id", "concat(id % 9973, ' text') AS text")
    sizes = [r["count"] for r in order_minhash.with_part(rows, 64).groupBy("part").count().collect()]
    assert sum(sizes) == 20_000 and max(sizes) < 1200 and len(sizes) > 50
