"""Backward as-of join and carry-forward, both as one ordered pass per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidespan.functions.temporal import SECOND, micros
from tidespan.operators.skew import BEFORE, CHUNK, CHUNK_SECONDS, HOT_ROWS, chunk_carry, last_before, time_chunks


def asof_backward(probes: DataFrame, sources: DataFrame, by: Sequence[str], time: str,
                  tolerance_hours: float, hot_rows: int = HOT_ROWS, chunk_seconds: int = CHUNK_SECONDS,
                  count_on: DataFrame | None = None, apart: Sequence[str] | None = None,
                  crowded: bool = True, heavy: bool = True) -> DataFrame:
    """For every probe the latest entry of each source with ``t - tolerance <= time <= t``.

    ``sources`` has ``by, time`` (unique) and a column ``struct<v>`` for each source, NULL where that source has no
    entry at the time; an entry whose ``v`` is NULL counts. Sources and probes are merged into one stream per key and
    read in a single window pass; no range join, every probe comes back exactly once. A probe without key matches
    nothing. ``apart``: as in ``time_chunks``, where the probes are not read from a table; ``crowded`` and ``heavy`` as there too.
    """
    by = list(by)
    names = [c for c in sources.columns if c not in (*by, time)]
    present = " AND ".join(f"{k} IS NOT NULL" for k in by)
    rows = sources.filter(present).selectExpr(*by, time, *[f"CASE WHEN {n} IS NOT NULL THEN struct({time} AS at, {n}.v AS v) END AS _r_{n}" for n in names], "0 AS _probe")
    merged = probes.selectExpr("*", "1 AS _probe").unionByName(rows, allowMissingColumns=True)
    every, of_heavy = time_chunks(merged, by, time, hot_rows, chunk_seconds, count_on, apart, ["_probe"], apart or probes.columns, crowded, heavy)
    upto = (f"(PARTITION BY {', '.join((*by, *CHUNK))} ORDER BY {time}, _probe "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
    seen = every.selectExpr("*", *[f"last(_r_{n}, true) OVER {upto} AS _s_{n}" for n in names])
    asked = seen.filter("_probe = 1")
    if of_heavy is None:
        matches = asked.withColumnsRenamed({f"_s_{n}": f"_m_{n}" for n in names})
    else:
        carried = chunk_carry(
            of_heavy, by, [f"max(_r_{n}) AS _c_{n}" for n in names], [f"{last_before(f'_c_{n}')} AS _c_{n}" for n in names]
        )
        matches = asked.join(carried, [*by, *CHUNK], "left").selectExpr("*", *[f"coalesce(_s_{n}, _c_{n}) AS _m_{n}" for n in names])
    limit = round(tolerance_hours * 3600 * SECOND)
    return matches.selectExpr(
        *probes.columns,
        *[f"CASE WHEN {micros(time)} - {micros(f'_m_{n}.at')} <= {limit}L THEN _m_{n}.v END AS {n}" for n in names],
    )


def carry_previous(df: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str], limit_hours: float,
                   tie: Sequence[str] = (), only: str | None = None, hot_rows: int = HOT_ROWS,
                   chunk_seconds: int = CHUNK_SECONDS, count_on: DataFrame | None = None, apart: Sequence[str] | None = None,
                  crowded: bool = True, pieces: bool = False, heavy: bool = True) -> DataFrame:
    """Add ``prev_<column>`` from the row just before, if it is less than ``limit_hours`` old.

    The previous row counts even when its values are NULL: an older value is never reached back to. A row without
    key has no previous row.
    ``only`` is a condition on which rows can be a previous row. ``apart``: as in ``time_chunks``, where ``df`` is not
    read from a table; ``crowded`` and ``heavy`` as there too. ``pieces``: the columns that number a row's piece stay, and its rows together.
    """
    keys = list(keys)
    kept = [*df.columns, *(CHUNK if pieces else ())]
    order = [time, *tie]
    row = "struct(" + ", ".join([f"{time} AS at", *tie, *columns]) + ")"
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    candidate = f"CASE WHEN {present} AND ({only or 'true'}) THEN {row} END"
    every, of_heavy = time_chunks(df, keys, time, hot_rows, chunk_seconds, count_on, apart, tie, crowded=crowded, heavy=heavy)
    window = f"(PARTITION BY {', '.join((*keys, *CHUNK))} ORDER BY {', '.join(order)} {BEFORE})"
    seen = every.selectExpr("*", f"{candidate} AS _row").selectExpr("*", f"last(_row, true) OVER {window} AS _prev")
    if of_heavy is None:
        joined = seen.selectExpr(*kept, "_prev AS _p")
    else:
        carried = chunk_carry(of_heavy, keys, [f"max({candidate}) AS _last"], [f"{last_before('_last')} AS _carried"])
        joined = seen.join(carried, [*keys, *CHUNK], "left").selectExpr(*kept, "coalesce(_prev, _carried) AS _p")
    recent = f"{micros(time)} - {micros('_p.at')} < {round(limit_hours * 3600 * SECOND)}L"
    return joined.selectExpr(*kept, *[f"CASE WHEN {recent} THEN _p.{c} END AS prev_{c}" for c in columns])
