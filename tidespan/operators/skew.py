"""Skew handling shared by the operators.

Two tools, both exact and both without a driver-side step:

* ``salted_join`` spreads the rows of heavy keys over several join partitions.
* ``time_chunks`` cuts the ordered rows of heavy keys into pieces, so ordered (window) work on one key
  runs in many tasks; ``chunk_carry`` then hands values on from piece to piece: a prefix scan over the pieces. A piece is a
  stretch of calendar time; where that alone holds more than ``hot_rows`` rows (many at one instant, or without time) it is cut
  further, by the full order of the rows, at splitters taken from a sample.

Both start from ``hot_keys``: the keys with more than ``hot_rows`` rows, and of these the ``HOT_KEYS`` with the
most. That constant makes broadcasting the list safe at any size. Whether a key is on the list never changes a
result, only where its rows are worked on.

A NULL key is no key: rows without one match nothing in a join, so ``time_chunks`` spreads them over many chunks.
Rows of one such chunk may still be neighbours in a window; callers keep them from seeing each other.

Salts and the chunks of rows without key become shuffle keys, so a task that runs again must give a row the same ones. In
a frame read from a table that is the place of the row, which spreads equal rows too. Behind an exchange the order of
rows may change from one run to the next: such frames name in ``apart`` columns that tell their rows apart, and the hash
of these takes the place's part. Columns whose values depend on the order of rows (sums of doubles) don't belong there.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.temporal import SECOND, floor_div, micros

HOT_ROWS = 5_000_000
HOT_KEYS = 100_000
CHUNK_SECONDS = 600
#: The columns that number a piece: its stretch of time, and the part of it.
CHUNK = ("_chunk", "_sub")
#: Sampled rows for each part of a crowded stretch, and parts of a stretch at most.
SAMPLES, PARTS = 16, 1000


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """``keys, _hot_n`` for the keys with more than ``hot_rows`` rows, ``HOT_KEYS`` of them at most."""
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    counted = df.filter(present).groupBy(*keys).agg(F.expr("count(1) AS _hot_n")).filter(f"_hot_n > {hot_rows}")
    return counted.orderBy(F.desc("_hot_n"), *keys).limit(HOT_KEYS)


def has_heavy(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> bool:
    """Whether ``hot_keys`` lists any key, counted now. Where none is heavy, operators given ``heavy=False`` leave what they make for such
    keys out of the plan: adaptive execution drops it too, but the driver has to hold and plan all of it until then."""
    return not hot_keys(df, keys, hot_rows).isEmpty()


def dealing_number(apart: Sequence[str] | None) -> str:
    """A number that spreads rows: their hash, or the place in a table that is read."""
    return f"xxhash64({', '.join(apart)})" if apart else "monotonically_increasing_id()"


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", hot_rows: int = HOT_ROWS,
                count_on: DataFrame | None = None, apart: Sequence[str] | None = None, heavy: bool = True) -> DataFrame:
    """Equi join in which a heavy key of ``big`` is spread over ``ceil(rows / hot_rows)`` salts.

    ``small`` is repeated once per salt, for heavy keys only. ``how`` may be any type that keeps rows of
    ``big`` alone (inner, left, left_semi, left_anti). ``count_on`` names a cheaper frame to count the keys
    on (for example the scan ``big`` was aggregated from); salting too much is harmless. ``apart`` is needed where
    ``big`` is not read from a table (see above). ``heavy=False``: no key is heavy (``has_heavy``), the join is a plain one.
    """
    keys = list(keys)
    if not heavy:
        return big.join(small, keys, how)
    hot = hot_keys(count_on if count_on is not None else big, keys, hot_rows).selectExpr(
        *keys, f"cast(ceil(_hot_n / {hot_rows}D) AS int) AS _salts"
    )
    left = big.join(F.broadcast(hot), keys, "left").selectExpr(
        *big.columns, f"CASE WHEN _salts IS NULL THEN 0 ELSE cast(pmod({dealing_number(apart)}, _salts) AS int) END AS _salt"
    )
    right = small.join(F.broadcast(hot), keys, "left").selectExpr(
        *small.columns, "explode(sequence(0, coalesce(_salts, 1) - 1)) AS _salt"
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def time_chunks(df: DataFrame, keys: Sequence[str], time: str, hot_rows: int = HOT_ROWS,
                chunk_seconds: int = CHUNK_SECONDS, count_on: DataFrame | None = None,
                apart: Sequence[str] | None = None, order: Sequence[str] = (), tell: Sequence[str] | None = None,
                crowded: bool = True, heavy: bool = True) -> tuple[DataFrame, DataFrame | None]:
    """Two frames with ``_chunk, _sub``: all rows, and the rows of heavy keys alone (for ``chunk_carry``).

    A normal key has one piece, a heavy one a calendar grid of pieces, a row without key one by its place or by ``apart``. The second frame is a semi join, which
    Catalyst moves down through aggregates and unions to the scan; where no key is heavy, AQE sees the empty
    list and drops that whole branch before it reads anything. ``order`` says how rows of one time are ordered;
    crowded pieces are cut by ``(time, order, hash of the row)``, so rows of one instant, or without time, are spread too. Rows
    equal in all columns (in ``tell``, else in ``apart``, where these are given) stay together. ``crowded=False`` leaves such pieces whole and the plan
    smaller, for tables in which a key has few rows in ``chunk_seconds``. ``heavy=False``: no key is heavy (``has_heavy``), and there is no second frame.
    """
    keys = list(keys)
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    if not heavy:
        return df.selectExpr("*", f"CASE WHEN {missing} THEN {dealing_number(apart)} ELSE 0L END AS _chunk", "0 AS _sub"), None
    hot = hot_keys(count_on if count_on is not None else df, keys, hot_rows)
    cell = f"coalesce({floor_div(micros(time), chunk_seconds * SECOND)}, -1L << 62)"
    values = tell or apart or [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString()]
    place = "struct(" + ", ".join([f"{time} AS a0", *[f"{c} AS a{i + 1}" for i, c in enumerate(order)], f"xxhash64({', '.join(values)}) AS h"]) + ")"
    of_heavy = df.join(F.broadcast(hot.select(*keys)), keys, "left_semi").selectExpr("*", f"{cell} AS _chunk")
    part = f"CASE WHEN _splits IS NULL THEN 0 ELSE size(filter(_splits, _one -> _one <= {place})) END AS _sub"
    every = df.join(F.broadcast(hot), keys, "left").selectExpr(
        *df.columns, f"CASE WHEN {missing} THEN {dealing_number(apart)} WHEN _hot_n IS NULL THEN 0L ELSE {cell} END AS _chunk")
    if not crowded:
        return every.selectExpr("*", "0 AS _sub"), of_heavy.selectExpr("*", "0 AS _sub")
    splits = _splitters(of_heavy, keys, place, hot_rows)
    cut = [x.join(F.broadcast(splits), [*keys, "_chunk"], "left").selectExpr(*df.columns, "_chunk", part) for x in (every, of_heavy)]
    return cut[0], cut[1]


def _splitters(heavy: DataFrame, keys: Sequence[str], place: str, hot_rows: int) -> DataFrame:
    """``keys, _chunk, _splits`` for the pieces with more than ``hot_rows`` rows, ``HOT_KEYS`` of them at most: ascending places that
    cut them into parts of about ``hot_rows``. There is less than one place for ``hot_rows`` rows of the table."""
    by = [*keys, "_chunk"]
    drawn = f"CASE WHEN pmod(_place.h, {max(1, hot_rows // SAMPLES)}L) = 0 THEN _place END"
    lists = heavy.selectExpr(*by, f"{place} AS _place").groupBy(*by).agg(F.expr("count(1) AS _n"), F.expr(f"collect_list({drawn}) AS _all"))
    lists = lists.filter(f"_n > {hot_rows}").orderBy(F.desc("_n"), *by).limit(HOT_KEYS)
    step = f"greatest({SAMPLES}, cast(ceil(size(_all) / {PARTS}D) AS int))"
    return lists.selectExpr(*by, f"filter(array_sort(_all), (x, i) -> i % {step} = {step} - 1) AS _splits")


def chunk_carry(heavy: DataFrame, keys: Sequence[str], summaries: Sequence[str], carries: Sequence[str]) -> DataFrame:
    """One row per piece of a heavy key: values computed over the summaries of the pieces in order.

    ``summaries`` are aggregates per piece (SQL with alias), ``carries`` window expressions over them, built
    with the functions below. A key has at most (calendar span / chunk length) stretches and (rows / ``hot_rows``)
    further parts, so the window stays small.
    """
    keys = list(keys)
    per_chunk = heavy.groupBy(*keys, *CHUNK).agg(*[F.expr(s) for s in summaries])
    return per_chunk.selectExpr(*keys, *CHUNK, *[c.format(w=f"PARTITION BY {', '.join(keys)} ORDER BY {', '.join(CHUNK)}") for c in carries])


BEFORE = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def last_before(name: str) -> str:
    """Carry: the last non-NULL ``name`` of the earlier chunks."""
    return f"last({name}, true) OVER ({{w}} {BEFORE})"


def total_before(name: str) -> str:
    """Carry: the sum of ``name`` over the earlier chunks."""
    return f"coalesce(sum({name}) OVER ({{w}} {BEFORE}), 0)"


def previous(name: str) -> str:
    """Carry: ``name`` of the chunk before."""
    return f"lag({name}) OVER ({{w}})"


def following(name: str) -> str:
    """Carry: ``name`` of the chunk after."""
    return f"lead({name}) OVER ({{w}})"
