"""Binary search as an SQL expression."""

from __future__ import annotations


def rank_in(bounds: str, value: str, most: int) -> str:
    """How many of the ascending array ``bounds`` (``most`` entries at most) are at or below ``value``; 0 for a NULL value.

    The rank is built bit by bit, so an array of a million bounds takes twenty steps.
    """
    steps = ", ".join(str(1 << b) for b in reversed(range(most.bit_length())))
    further = f"get({bounds}, _rank_at + _rank_step - 1) <= {value}"
    return f"aggregate(array({steps or '0'}), 0, (_rank_at, _rank_step) -> CASE WHEN {further} THEN _rank_at + _rank_step ELSE _rank_at END)"
