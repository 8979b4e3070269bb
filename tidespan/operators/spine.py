"""Time spine: the regular bins of every stay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidespan.functions.temporal import HOUR, floor_div, micros

STEP_HOURS = 4


def last_bin(start: str, end: str, step_hours: int = STEP_HOURS) -> str:
    return floor_div(f"({micros(end)} - {micros(start)})", step_hours * HOUR)


def time_spine(stays: DataFrame, start: str, end: str, step_hours: int = STEP_HOURS, name: str = "bin_start",
               columns: Sequence[str] | None = None) -> DataFrame:
    """One row per stay and bin, ``start, start + step, …`` up to and including ``end``.

    A stay with a missing bound or with ``start > end`` has no bins. Adds ``bin_index`` (0, 1, …) and the
    bin's start time. The row count is bounded by the length of the stays, not by their events.
    """
    bins = stays.filter(f"{start} <= {end}").selectExpr(
        "*", f"explode(sequence(0L, {last_bin(start, end, step_hours)})) AS bin_index"
    )
    return bins.selectExpr(
        *(columns or stays.columns), "bin_index", f"{start} + bin_index * INTERVAL '{step_hours}' HOUR AS {name}"
    )
