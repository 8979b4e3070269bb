"""Rounding of decimal numbers kept as doubles."""

from __future__ import annotations


def round_half_up(x: str, digits: int = 2) -> str:
    """Round half away from zero on the decimal value.

    A double such as 33.994999999999997 stands for 33.995. Going through a decimal with ten places restores
    that before rounding, as a cast to an SQL numeric does.
    """
    return f"cast(round(try_cast({x} AS decimal(38, 10)), {digits}) AS double)"
