"""Banded severity scores, totals, risk and ratios."""

from __future__ import annotations

from collections.abc import Sequence


def _points(p: int | None) -> str:
    return "cast(NULL AS int)" if p is None else str(p)


def rule_score(rules: Sequence[tuple[str, int | None]], otherwise: int | None = None, present: str | None = None) -> str:
    """Points of the first condition that holds, NULL while ``present`` is NULL."""
    arms = [f"WHEN ({present}) IS NULL THEN cast(NULL AS int)"] if present else []
    arms += [f"WHEN {condition} THEN {_points(points)}" for condition, points in rules]
    return f"CASE {' '.join(arms)} ELSE {_points(otherwise)} END"


def band_score(value: str, bands: Sequence[tuple[str, float, int | None]], otherwise: int | None = None) -> str:
    """Points of the first band ``(comparison, limit, points)`` that holds; a NULL value scores NULL."""
    return rule_score([(f"{value} {op} {limit}", points) for op, limit, points in bands], otherwise, present=value)


def two_sided_score(low: str, high: str, rules: Sequence[tuple[str, str, float, int]], normal: tuple[float, float]) -> str:
    """Score of a measure from its minimum and maximum.

    ``rules`` is an ordered list of ``(side, comparison, limit, points)`` with side ``min`` or ``max``. When
    no rule holds and both ends lie in ``[normal[0], normal[1])`` the score is 0; a measure outside that
    range and every rule scores NULL.
    """
    sides = {"min": low, "max": high}
    conditions = [(f"{sides[s]} {op} {limit}", points) for s, op, limit, points in rules]
    in_range = " AND ".join(f"{c} >= {normal[0]} AND {c} < {normal[1]}" for c in (low, high))
    return rule_score([*conditions, (in_range, 0)], present=high)


def score_total(scores: Sequence[str]) -> str:
    """Sum of component scores, a missing component counting as 0."""
    return " + ".join(f"coalesce({s}, 0)" for s in scores)


def missing_pct(scores: Sequence[str]) -> str:
    """Whole per cent of components that are NULL (integer division)."""
    missing = " + ".join(f"cast({s} IS NULL AS bigint)" for s in scores)
    return f"(({missing}) * 100 div {len(scores)})"


def logistic_risk(score: str) -> str:
    """Probability of hospital death from the total severity score (fixed coefficients)."""
    return f"(1D / (1D + exp(-(-7.7631D + 0.0737D * {score} + 0.9971D * ln({score} + 1)))))"


def safe_ratio(numerator: str, denominator: str, scale: float = 1.0) -> str:
    """Ratio that is NULL, not an error, when the denominator is 0."""
    return f"(try_divide({numerator}, {denominator}) * {scale}D)"


def weighted_sum(weights: dict[str, float]) -> str:
    """Sum of ``weight * column`` with NULL as 0."""
    return " + ".join(f"coalesce({name} * {weight}D, 0D)" for name, weight in weights.items())
