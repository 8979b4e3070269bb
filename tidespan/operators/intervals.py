"""Joins of points with windows and of intervals with intervals, on time cells of many widths.

A window is cut into the cells of a tree over time: a leaf is ``leaf_seconds`` wide, a cell of level *x* holds ``4**x`` leaves. The
largest cells that fit inside cover the middle, smaller ones the edges, so a window becomes O(log span) rows
however wide it is, and no two of its cells overlap. A point lies in one cell of each level. So a point meets a window in
exactly one cell, the join is an equi join on ``(keys, level, cell)``, and every match of it is a result but for those in the
two leaves at a window's ends. A heavy key is spread over its cells, and AQE may split a heavy cell further.

Points are repeated once for each level in use; the list of these is a broadcast of a few numbers. With ``whole_cells=False`` a window
takes cells of one level alone, the one of which ``CELLS`` reach over it; points then meet a few windows that end in
their cell without holding them, but are repeated once for each width class in use. That suits windows of about one width.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.temporal import HOUR, SECOND, floor_div, micros

#: Ten thousand years, the span of all timestamps; the largest cell is as wide.
SPAN_SECONDS = 320_000_000_000
#: Cells of one level that reach over a window, at most, without the one at its end.
CELLS = 4
LEAF_SECONDS = HOUR // SECOND


def levels_of(leaf_seconds: int) -> int:
    """The level of the largest cells."""
    return next(x for x in range(64) if leaf_seconds * 4 ** x >= SPAN_SECONDS)


def _tree_cells(level: str, top: int) -> str:
    """Cells of a level that lie inside leaves ``_l`` to ``_r`` (exclusive) and in no larger cell that does, as an array."""
    low, high = f"-shiftright(-_l, 2 * {level})", f"shiftright(_r, 2 * {level})"  # inwards
    above_low, above_high = f"-4 * shiftright(-_l, 2 * {level} + 2)", f"4 * shiftright(_r, 2 * {level} + 2)"

    def cells(a: str, b: str) -> str:
        return f"CASE WHEN {a} < {b} THEN sequence({a}, {b} - 1) ELSE array() END"

    return (f"CASE WHEN {low} >= {high} THEN array() WHEN {above_low} >= {above_high} OR {level} = {top} THEN {cells(low, high)} "
            f"ELSE concat({cells(low, above_low)}, {cells(above_high, high)}) END")


def window_cells(windows: DataFrame, low: str, high: str, leaf_seconds: int = LEAF_SECONDS, whole_cells: bool = True) -> DataFrame:
    """One row for each cell of a window ``[low, high]``: all columns, ``_low`` and ``_high`` in microseconds, ``_level``, ``_cell``.

    A window whose bounds are missing or reversed has none.
    """
    leaf = leaf_seconds * SECOND
    bounded = windows.selectExpr("*", f"{micros(low)} AS _low", f"{micros(high)} AS _high").filter("_low <= _high")
    leaves = bounded.selectExpr("*", f"{floor_div('_low', leaf)} AS _l", f"{floor_div('_high', leaf)} + 1 AS _r")
    if whole_cells:
        tree = f"flatten(transform(sequence(0, {levels_of(leaf_seconds)}), x -> transform({_tree_cells('x', levels_of(leaf_seconds))}, c -> struct(x AS level, c AS cell))))"
        cells = leaves.selectExpr(*bounded.columns, f"explode({tree}) AS _at").selectExpr(*bounded.columns, "_at.level AS _level", "_at.cell AS _cell")
        return cells
    level = f"cast(greatest(0, ceil(round(log2((_r - _l) / {CELLS}D), 9) / 2)) AS int)"
    return leaves.selectExpr("*", f"{level} AS _level").selectExpr(
        *bounded.columns, "_level", "explode(sequence(shiftright(_l, 2 * _level), shiftright(_r - 1, 2 * _level))) AS _cell")


def point_cells(points: DataFrame, cells: DataFrame, time: str, leaf_seconds: int = LEAF_SECONDS) -> DataFrame:
    """One row for each point and level that ``cells`` have: all columns, ``_t`` in microseconds, ``_level``, ``_cell``.

    The levels in use are broadcast: one small row for each, some twenty at most whatever the windows.
    """
    levels = cells.select("_level").distinct()
    timed = points.selectExpr("*", f"{micros(time)} AS _t").filter("_t IS NOT NULL")
    spread = timed.selectExpr("*", f"explode(sequence(0, {levels_of(leaf_seconds)})) AS _level").join(F.broadcast(levels), "_level", "left_semi")
    return spread.selectExpr("*", f"shiftright({floor_div('_t', leaf_seconds * SECOND)}, 2 * _level) AS _cell")


def points_in_windows(points: DataFrame, windows: DataFrame, keys: Sequence[str], time: str, low: str, high: str,
                      leaf_seconds: int = LEAF_SECONDS, whole_cells: bool = True) -> DataFrame:
    """Inner join of points with the windows ``[low, high]`` of their key that hold them (both ends included).

    Columns of the two sides must differ but for ``keys``; ``low`` and ``high`` are expressions over the columns of
    ``windows``. The result also has ``_t``, ``_low`` and ``_high`` in microseconds. NULL keys and times match nothing.
    """
    cells = window_cells(windows, low, high, leaf_seconds, whole_cells)
    joined = point_cells(points, cells, time, leaf_seconds).join(cells, [*keys, "_level", "_cell"])
    return joined.filter("_t >= _low AND _t <= _high").drop("_level", "_cell")


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_bounds: tuple[str, str], right_bounds: tuple[str, str],
                  leaf_seconds: int = LEAF_SECONDS) -> DataFrame:
    """Inner join of two tables of intervals: pairs of one key that share at least one instant (both ends included).

    Of two intervals that overlap, the one that starts later starts inside the other. So pairs are the starts of the right inside the
    left, and the starts of the left inside the right but for equal starts, which the first part has: each pair comes
    once, and the work grows with the rows and the result, never with the square of a key. Columns of the two sides must
    differ but for ``keys``. An interval without a bound or that ends before it starts overlaps nothing.
    """
    (a, b), (c, d) = left_bounds, right_bounds
    whole_left, whole_right = left.filter(f"{a} <= {b}"), right.filter(f"{c} <= {d}")
    columns = [*keys, *[x for x in left.columns if x not in keys], *[x for x in right.columns if x not in keys]]
    later_right = points_in_windows(whole_right, whole_left, keys, c, a, b, leaf_seconds)
    later_left = points_in_windows(whole_left, whole_right, keys, a, c, d, leaf_seconds).filter("_t > _low")
    return later_right.select(*columns).unionByName(later_left.select(*columns))
