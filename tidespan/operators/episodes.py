"""State episodes (gaps and islands) and their descriptors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.temporal import HOUR, hours_between, micros
from tidespan.functions.text import in_list
from tidespan.operators.skew import (
    CHUNK,
    CHUNK_SECONDS,
    HOT_ROWS,
    chunk_carry,
    following,
    previous,
    time_chunks,
    total_before,
)


def state_episodes(df: DataFrame, keys: Sequence[str], time: str, state: str, keep: Sequence[str] | None = None,
                   min_hours: float = 1.0, earliest: Sequence[str] = (), tie: Sequence[str] = (),
                   max_gap_hours: float | None = None, hot_rows: int = HOT_ROWS,
                   chunk_seconds: int = CHUNK_SECONDS, count_on: DataFrame | None = None, crowded: bool = True,
                   heavy: bool = True) -> DataFrame:
    """Maximal runs of equal ``state`` in time order, one row each: ``keys, state, starttime, endtime``.

    Rows without state or without key are ignored. A run ends at the time of the row that follows it (the last run of a
    key at its own last row). Runs need two distinct times and at least ``min_hours``. Of the columns in
    ``earliest`` the minimum per run is kept. ``max_gap_hours`` additionally opens a new run after a longer
    silence (off by default).

    Heavy keys are cut into pieces: runs are found inside each piece, and a run that continues over a border gets one number
    through the summaries of the pieces. Rows of one time share a number, so where an instant reaches over several
    pieces those before the border also count the runs that begin at that instant behind it. ``crowded`` and ``heavy``: as in ``time_chunks``.
    """
    keys = list(keys)
    key_list = ", ".join(keys)
    every, of_heavy = time_chunks(df.filter(" AND ".join(f"{c} IS NOT NULL" for c in (state, *keys))), keys, time, hot_rows, chunk_seconds, count_on,
                               apart=keys, order=[state, *tie], tell=df.columns, crowded=crowded, heavy=heavy)  # no row without key is left to be spread
    piece = f"PARTITION BY {', '.join((*keys, *CHUNK))} ORDER BY {time} NULLS FIRST"
    ordered = ", ".join([piece, state, *tie])
    limit = None if max_gap_hours is None else round(max_gap_hours * HOUR)
    gap = "" if limit is None else f" OR {micros(time)} - {micros('_lag_t')} > {limit}L"

    def flagged(rows: DataFrame) -> DataFrame:
        """Neighbours inside the piece, and whether a run begins here."""
        return rows.selectExpr(
            "*",
            f"lag({state}) OVER ({ordered}) AS _lag",
            f"lag({time}) OVER ({ordered}) AS _lag_t",
            f"lead({time}) OVER ({ordered}) AS _lead_t",
            f"lead({state}) OVER ({ordered}) IS NULL AS _tail",
        ).selectExpr("*", f"CASE WHEN _lag IS NULL OR _lag <> {state}{gap} THEN 1 ELSE 0 END AS _new")

    # the default frame of a running sum: rows of equal time share the number
    numbered = flagged(every).selectExpr("*", f"sum(_new) OVER ({piece}) AS _seq")

    def runs_of(rows: DataFrame, tail: str) -> DataFrame:
        """The runs that are kept; ``tail``: where one ends that reaches to the end of its piece."""
        runs = rows.groupBy(*keys, state, "_run").agg(*[F.expr(e) for e in (
            f"min({time}) AS starttime",
            f"max({time}) AS _last",
            f"max(CASE WHEN _tail THEN {tail} ELSE greatest(_lead_t, {time}) END) AS endtime",
            *[f"min({c}) AS {c}" for c in earliest],
        )])
        long_enough = f"starttime <> _last AND {micros('endtime')} - {micros('starttime')} >= {round(min_hours * HOUR)}L"
        kept = runs.filter(long_enough if keep is None else f"{long_enough} AND {in_list(state, keep)}")
        return kept.drop("_last", "_run")

    if of_heavy is None:
        return runs_of(numbered.withColumnRenamed("_seq", "_run"), time)

    instants = flagged(of_heavy).groupBy(*keys, *CHUNK, time).agg(
        F.expr("sum(_new) AS _n"), F.expr(f"max(CASE WHEN _lag IS NULL THEN {state} END) AS _head"), F.expr(f"max(CASE WHEN _tail THEN {state} END) AS _end"))
    near = "" if limit is None else f" AND NOT coalesce({micros('_first.t')} - {micros(previous('_last_t'))} > {limit}L, false)"
    links = chunk_carry(
        instants,
        keys,
        [
            "sum(_n) AS _n",
            "max(_head) AS _first_state",
            "max(_end) AS _last_state",
            f"min(struct({time} AS t, _n AS n)) AS _first",
            f"max({time}) AS _last_t",
        ],
        [
            f"{total_before('_n')} AS _before",
            f"{following('_first.t')} AS _next_t",
            f"CASE WHEN {previous('_last_state')} = _first_state{near} THEN 1 ELSE 0 END AS _joins",
            "_first",
            "_last_t",
        ],
    ).selectExpr("*", f"_before - sum(_joins) OVER (PARTITION BY {key_list} ORDER BY {', '.join(CHUNK)}) AS _base")
    begun = links.selectExpr(*keys, *CHUNK, "explode(array(struct(_first.t AS t, _first.n - _joins AS n, 0 AS asks), struct(_last_t AS t, 0L AS n, 1 AS asks))) AS _i")
    behind = (f"coalesce(sum(_i.n) OVER (PARTITION BY {key_list}, _i.t ORDER BY {', '.join(CHUNK)}, _i.asks "
              "ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0)")
    shared = begun.selectExpr(*keys, *CHUNK, "_i.asks AS _asks", f"{behind} AS _shared").filter("_asks = 1").drop("_asks")
    links = links.select(*keys, *CHUNK, "_next_t", "_last_t", "_base").join(shared, [*keys, *CHUNK])

    linked = numbered.join(links, [*keys, *CHUNK], "left").selectExpr(
        "*", f"_seq + coalesce(_base, 0) + CASE WHEN {time} <=> _last_t THEN coalesce(_shared, 0) ELSE 0 END AS _run")
    return runs_of(linked, f"greatest({time}, _next_t)")


def episode_features(episodes: DataFrame, keys: Sequence[str], start: str = "starttime", end: str = "endtime",
                     marker: str | None = None) -> DataFrame:
    """Ordinal, hours, end of the last episode from here on, gap to the next one, any marker per key.

    Episodes of one key do not overlap and last at least ``min_hours``, so a key has at most (calendar
    span / ``min_hours``) of them: the windows are bounded by the calendar.
    """
    whole = f"PARTITION BY {', '.join(keys)}"
    following_start = f"lead({start}) OVER ({whole} ORDER BY {start})"
    marked = [f"CASE WHEN count({marker}) OVER ({whole}) > 0 THEN 1 ELSE 0 END AS is_tracheo"] if marker else []
    return episodes.selectExpr(
        "*",
        *marked,
        f"round({hours_between(end, start)}) AS ventduration",
        f"cast(row_number() OVER ({whole} ORDER BY {start}) AS bigint) AS num_event",
        f"max({end}) OVER ({whole} ORDER BY {start} DESC) AS end_mech_vent",
        f"round({hours_between(following_start, end)}) AS time_no_mech_vent",
    )
