"""Assign events and intervals to the bins of a stay without a range join.

The plain form of these operators joins every bin of a stay with every event of that stay. Here the bin
numbers an event belongs to are computed by integer arithmetic, so the work is linear in the events and
what follows is a hash aggregation with map-side combine on ``(stay, bin_index)``.

Joining events to their stay would put all events of one stay in one task. Point events are therefore
joined on ``(key, calendar day)``, with the stay repeated once per day it covers; AQE may split a heavy
day further, because the aggregation that follows needs a different partitioning anyway. Intervals have no
single day and use ``salted_join``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.temporal import DAY, HOUR, SECOND, floor_div, micros
from tidespan.operators.skew import HOT_ROWS, salted_join
from tidespan.operators.spine import STEP_HOURS


def events_in_window(events: DataFrame, stays: DataFrame, keys: Sequence[str], time: str, low: str,
                     high: str, slice_hours: int = 24) -> DataFrame:
    """Inner join of events with the stay windows ``[low, high]`` that hold them (both ends included).

    ``low`` and ``high`` are expressions over the columns of ``stays``. A window is repeated once per slice of
    ``slice_hours`` it covers, so wide windows with few events want longer slices. The result also has
    ``_t``, ``_low`` and ``_high``, the event time and the window bounds in microseconds.
    """
    keys = list(keys)
    width = slice_hours * HOUR
    sliced_events = events.selectExpr("*", f"{micros(time)} AS _t").selectExpr("*", f"{floor_div('_t', width)} AS _slice")
    sliced_stays = (
        stays.selectExpr("*", f"{micros(low)} AS _low", f"{micros(high)} AS _high")
        .filter("_low <= _high")
        .selectExpr("*", f"explode(sequence({floor_div('_low', width)}, {floor_div('_high', width)})) AS _slice")
    )
    joined = sliced_events.join(sliced_stays, [*keys, "_slice"])
    return joined.filter("_t >= _low AND _t <= _high").drop("_slice")


def _own_bins(step: int, closed: str) -> tuple[str, str]:
    """First and last bin of an event at ``_t`` in a stay that starts at ``_low``."""
    index = floor_div("_t - _low", step)
    if closed == "left":
        return index, index
    return f"CASE WHEN _t > _low AND pmod(_t - _low, {step}L) = 0 THEN {index} - 1 ELSE {index} END", index


def _last_lookback(time: str, days: int, step: int) -> str:
    """Last bin of the stay with ``date(bin) <= date(time) + days``."""
    horizon = f"{micros(f'cast({time} AS date)')} + {(days + 1) * DAY - 1}L - _low"
    return f"least({floor_div(horizon, step)}, {floor_div('_high - _low', step)})"


def _explode_bins(df: DataFrame, first: str, last: str, *extra: str) -> DataFrame:
    """One row per bin number from ``first`` to ``last``; no row when the range is empty."""
    ranged = df.selectExpr("*", f"{first} AS _from", f"{last} AS _to").filter("_from <= _to")
    exploded = ranged.selectExpr("*", "explode(sequence(_from, _to)) AS bin_index")
    return (exploded.selectExpr("*", *extra) if extra else exploded).drop("_from", "_to", "_t", "_low", "_high")


def assign_bins(events: DataFrame, stays: DataFrame, keys: Sequence[str], time: str, start: str, end: str,
                step_hours: int = STEP_HOURS, closed: str = "both") -> DataFrame:
    """Add ``bin_index`` to events inside their stay.

    ``closed="both"``: bin *b* takes ``b <= t <= b + step``, so an event on a grid line belongs to two
    bins; ``own`` marks the later one. ``closed="left"``: ``b <= t < b + step``.
    """
    inside = events_in_window(events, stays, keys, time, start, end)
    first, own = _own_bins(step_hours * HOUR, closed)
    return _explode_bins(inside, first, own, "bin_index = _to AS own")


def bins_with_lookback(events: DataFrame, stays: DataFrame, keys: Sequence[str], time: str, start: str, end: str,
                       days: int = 1, step_hours: int = STEP_HOURS) -> DataFrame:
    """``assign_bins`` and ``lookback_bins`` in one pass over the events.

    The bins an event lies in and the later bins that look back at it are consecutive numbers, so one
    generator yields both; ``in_bin`` tells them apart.
    """
    step = step_hours * HOUR
    inside = events_in_window(events, stays, keys, time, start, end)
    first, own = _own_bins(step, "both")
    last = f"greatest({own}, {_last_lookback(time, days, step)})"
    return _explode_bins(inside, first, last, f"bin_index <= {own} AS in_bin")


def bin_aggregate(events: DataFrame, stays: DataFrame, keys: Sequence[str], time: str, start: str, end: str,
                  aggs: Sequence[str], stay_keys: Sequence[str] | None = None, step_hours: int = STEP_HOURS,
                  closed: str = "both") -> DataFrame:
    """Aggregates (SQL with alias) per ``(stay_keys, bin_index)``, only for bins that hold events.

    Left join the result to the spine to get every bin.
    """
    binned = assign_bins(events, stays, keys, time, start, end, step_hours, closed)
    return binned.groupBy(*(stay_keys or keys), "bin_index").agg(*[F.expr(a) for a in aggs])


def overlapped_bins(intervals: DataFrame, stays: DataFrame, keys: Sequence[str], start: str, stop: str,
                    stay_start: str, stay_end: str, step_hours: int = STEP_HOURS, reach_minutes: int | None = None,
                    hot_rows: int = HOT_ROWS, count_on: DataFrame | None = None, apart: Sequence[str] | None = None, heavy: bool = True) -> DataFrame:
    """One row per interval and bin with ``start <= bin + reach`` and ``stop >= bin``.

    ``reach_minutes`` defaults to the full step. An interval without ``stop`` matches no bin. ``apart``, ``heavy``: as in
    ``salted_join``, the first where the intervals are not read from a table.
    """
    step = step_hours * HOUR
    placed = _placed_intervals(intervals, stays, keys, start, stop, stay_start, stay_end, step, step_hours, reach_minutes, hot_rows, count_on, apart, heavy)
    return _explode_bins(placed, *_touched(step))


def covered_bins(intervals: DataFrame, stays: DataFrame, keys: Sequence[str], start: str, stop: str, stay_start: str,
                 stay_end: str, stay_keys: Sequence[str], step_hours: int = STEP_HOURS, reach_minutes: int | None = None,
                 hot_rows: int = HOT_ROWS, count_on: DataFrame | None = None, apart: Sequence[str] | None = None, heavy: bool = True) -> DataFrame:
    """The bins (``stay_keys, bin_index``) that at least one interval touches, each once; touched as in ``overlapped_bins``.

    Work is linear in the intervals: each adds one at its first bin and takes one away behind its last; a running
    sum over a stay's bins tells which are covered. A stay has as many sums as bins at most.
    """
    step = step_hours * HOUR
    placed = _placed_intervals(intervals, stays, keys, start, stop, stay_start, stay_end, step, step_hours, reach_minutes, hot_rows, count_on, apart, heavy)
    first, last = _touched(step)
    spans = placed.selectExpr(*stay_keys, f"{first} AS _from", f"{last} AS _to").filter("_from <= _to")
    steps = spans.selectExpr(*stay_keys, "explode(array(struct(_from AS bin, 1L AS d), struct(_to + 1 AS bin, -1L AS d))) AS _s")
    sums = steps.groupBy(*stay_keys, F.expr("_s.bin AS _bin")).agg(F.expr("sum(_s.d) AS _d"))
    order = f"PARTITION BY {', '.join(stay_keys)} ORDER BY _bin"
    open_from = sums.selectExpr(*stay_keys, "_bin", f"sum(_d) OVER ({order}) AS _open", f"lead(_bin) OVER ({order}) AS _next")
    return open_from.filter("_open > 0").selectExpr(*stay_keys, "explode(sequence(_bin, _next - 1)) AS bin_index")


def _touched(step: int) -> tuple[str, str]:
    """First and last bin of a placed interval."""
    return floor_div(f"_t + {step - 1}L", step), floor_div("_high", step)


def _placed_intervals(intervals: DataFrame, stays: DataFrame, keys: Sequence[str], start: str, stop: str, stay_start: str,
                      stay_end: str, step: int, step_hours: int, reach_minutes: int | None, hot_rows: int,
                      count_on: DataFrame | None, apart: Sequence[str] | None, heavy: bool) -> DataFrame:
    """Intervals with their stay, cut to it: ``_t`` to ``_high`` in microseconds from its start."""
    reach = (reach_minutes if reach_minutes is not None else step_hours * 60) * 60 * SECOND
    # greatest and least skip NULLs, so missing bounds have to go first
    bounded = intervals.filter(f"{start} IS NOT NULL AND {stop} IS NOT NULL")
    joined = salted_join(bounded, stays.filter(f"{stay_start} <= {stay_end}"), keys, hot_rows=hot_rows, count_on=count_on, apart=apart, heavy=heavy)
    return joined.selectExpr(
        "*",
        f"greatest({micros(start)} - {reach}L - {micros(stay_start)}, 0L) AS _t",
        f"least({micros(stop)}, {micros(stay_end)}) - {micros(stay_start)} AS _high",
    )


def lookback_bins(events: DataFrame, stays: DataFrame, keys: Sequence[str], time: str, stay_start: str,
                  stay_end: str, active_until: str | None = None, days: int = 1,
                  step_hours: int = STEP_HOURS) -> DataFrame:
    """One row per event and later bin that looks back at it.

    Bin *b* sees an event inside the stay when ``date(t) >= date(b) - days`` and ``t < b``. With
    ``active_until`` the event must also still be active: ``active_until >= b`` (a NULL there means the
    event needs no activity test).
    """
    step = step_hours * HOUR
    inside = events_in_window(events, stays, keys, time, stay_start, stay_end)
    last = _last_lookback(time, days, step)
    if active_until is not None:
        last = f"least({last}, {floor_div(f'{micros(active_until)} - _low', step)})"
    return _explode_bins(inside, f"{floor_div('_t - _low', step)} + 1", last)
