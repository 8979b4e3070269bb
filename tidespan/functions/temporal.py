"""Time arithmetic on ``timestamp_ntz`` columns.

Everything is reduced to 64-bit microseconds, so bin numbers are exact integers and never depend on
floating point. No expression here passes through a zoned timestamp, so the session time zone has no say.
"""

from __future__ import annotations

from tidespan.functions.rounding import round_half_up

SECOND = 1_000_000
HOUR = 3600 * SECOND
DAY = 24 * HOUR


def micros(c: str) -> str:
    """Microseconds since 1970-01-01 of a timestamp or date."""
    return f"((cast({c} AS timestamp_ntz) - TIMESTAMP_NTZ '1970-01-01 00:00:00') div INTERVAL '0.000001' SECOND)"


def floor_div(value: str, n: int) -> str:
    """Exact floor division of a long by a positive integer."""
    return f"((({value}) - pmod({value}, {n}L)) div {n}L)"


def seconds_between(later: str, earlier: str) -> str:
    return f"(({micros(later)} - {micros(earlier)}) / 1000000D)"


def hours_between(later: str, earlier: str) -> str:
    return f"(({micros(later)} - {micros(earlier)}) / 3600000000D)"


def plus_hours(c: str, hours: float) -> str:
    minutes = round(hours * 60)
    return f"({c} {'+' if minutes >= 0 else '-'} INTERVAL '{abs(minutes)}' MINUTE)"


def truncate_hour(c: str) -> str:
    """``date_trunc`` to the hour without a zone."""
    return f"(cast({c} AS timestamp_ntz) - pmod({micros(c)}, {HOUR}L) * INTERVAL '0.000001' SECOND)"


def age_at(anchor_age: str, anchor_year: str, at: str) -> str:
    """Age in years: the anchor age plus the time since 1 January of the anchor year, two decimals."""
    new_year = f"make_timestamp_ntz({anchor_year}, 1, 1, 0, 0, 0)"
    # fixed value: seconds per year
    return round_half_up(f"{anchor_age} + {seconds_between(at, new_year)} / 31556908.8D")


def days_between(later: str, earlier: str, digits: int = 2) -> str:
    """Length of a stay in days."""
    return round_half_up(f"{seconds_between(later, earlier)} / 86400D", digits)


def died_within(died: str, admitted: str, days: int) -> str:
    """1 when the death date lies before ``admitted + days``; a missing death date gives 0."""
    return f"CASE WHEN {micros(died)} < {micros(admitted)} + {days * DAY}L THEN 1 ELSE 0 END"
