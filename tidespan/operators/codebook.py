"""Code-set flags for large code books.

``codes.code_flags`` asks every rule of every row, which suits a few dozen rules. Here the rules are compiled first: for each
version and prefix length their lists and ranges become disjoint ranges in ascending order, each with the mask of all flags that
hold in it. A code is then placed by binary search, once for each distinct code of the table, and the masks found are joined
back to the rows. The plan has the same size for ten rules and for ten thousand.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidespan.functions.search import rank_in
from tidespan.operators.codes import MASK_BITS, CodeRule
from tidespan.operators.skew import HOT_ROWS, salted_join

Segments = tuple[list[str], list[int]]


def disjoint_ranges(intervals: Sequence[tuple[str, str, int]]) -> Segments:
    """Ascending bounds, and for the codes from each bound to the next the bits of all closed intervals ``(low, high, bit)`` that hold them."""
    edges = defaultdict(list)
    for low, high, bit in intervals:
        if low <= high:
            edges[low].append((bit, 1))
            edges[high + "\0"].append((bit, -1))  # the least string above high
    bounds, masks, open_, mask = [], [], Counter(), 0
    for at in sorted(edges):
        for bit, step in edges[at]:
            open_[bit] += step
            mask = mask | 1 << bit if open_[bit] else mask & ~(1 << bit)
        if not masks or masks[-1] != mask:
            bounds.append(at)
            masks.append(mask)
    return bounds, masks


def compiled(rules: dict[str, Sequence[CodeRule]]) -> dict[tuple, Segments]:
    """Disjoint ranges for each (version, prefix length, any case) the rules use."""
    intervals = defaultdict(list)
    for bit, of_flag in enumerate(rules.values()):
        for r in of_flag:
            same = str.upper if r.any_case else str
            found = [*((m, m) for m in r.members), *r.ranges]
            intervals[r.version, r.length, r.any_case] += [(same(low), same(high), bit) for low, high in found]
    return {key: disjoint_ranges(x) for key, x in intervals.items()}


def _book(spark: SparkSession, rules: dict[str, Sequence[CodeRule]], words: int) -> tuple[DataFrame, int]:
    """The compiled rules as one row for each version, length and case; and the most bounds of a row."""
    found = compiled(rules)
    part = (1 << MASK_BITS) - 1
    rows = [(v, n, case, bounds, [[m >> MASK_BITS * w & part for m in masks] for w in range(words)]) for (v, n, case), (bounds, masks) in found.items()]
    book = spark.createDataFrame(rows, "_of long, _length int, _any_case boolean, _bounds array<string>, _masks array<array<long>>")
    return book, max((len(r[3]) for r in rows), default=0)


def code_book_flags(df: DataFrame, keys: Sequence[str], code: str, version: str | None, rules: dict[str, Sequence[CodeRule]],
                    hot_rows: int = HOT_ROWS, apart: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys`` with a 0/1 column per flag: the result of ``code_flags`` at a cost that the number of rules hardly touches.

    ``code`` and ``version`` (a number) are SQL expressions. A NULL code matches nothing, a NULL version only rules without one. The book is broadcast: its
    size is that of ``rules``, not of any table. Codes with more than ``hot_rows`` rows are salted (``apart`` as in ``salted_join``).
    """
    names, keys = list(rules), list(keys)
    words = -(-len(names) // MASK_BITS)
    book, most = _book(df.sparkSession, rules, words)
    of = f"cast({version} AS long)" if version is not None else "cast(NULL AS long)"
    key = f"concat(coalesce(cast({of} AS string), ''), ':', {code})"
    codes = df.selectExpr(f"{key} AS _key", f"{of} AS _version", f"{code} AS _code").where("_key IS NOT NULL").distinct()
    # rules of the code's version, and rules of any
    asked = codes.selectExpr("_key", "_code", "explode(array_distinct(array(_version, NULL))) AS _of")
    head = "CASE WHEN _length IS NULL THEN _code ELSE substring(_code, 1, _length) END"
    head = f"CASE WHEN _any_case THEN upper({head}) ELSE {head} END"
    placed = asked.join(F.broadcast(book), asked["_of"].eqNullSafe(book["_of"])).selectExpr("_key", "_bounds", "_masks", f"{head} AS _head")
    placed = placed.selectExpr("_key", "_masks", f"{rank_in('_bounds', '_head', most)} - 1 AS _at").where("_at >= 0")
    masks = [f"bit_or(get(get(_masks, {w}), _at)) AS _mask{w}" for w in range(words)]
    found = placed.groupBy("_key").agg(*[F.expr(m) for m in masks]).where(" OR ".join(f"_mask{w} <> 0" for w in range(words)))
    rows = df.selectExpr(*keys, f"{key} AS _key", *[f"{c} AS _apart{i}" for i, c in enumerate(apart or ())])
    joined = salted_join(rows, found, ["_key"], "left", hot_rows, apart=[f"_apart{i}" for i in range(len(apart))] if apart else None)
    total = joined.groupBy(*keys).agg(*[F.expr(f"coalesce(bit_or(_mask{w}), 0L) AS _mask{w}") for w in range(words)])
    flags = [f"cast(shiftright(_mask{i // MASK_BITS}, {i % MASK_BITS}) & 1L AS int) AS {n}" for i, n in enumerate(names)]
    return total.selectExpr(*keys, *flags)
