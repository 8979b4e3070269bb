"""Ordered text rules."""

from __future__ import annotations

from collections.abc import Sequence


def quote(value: str | int | float) -> str:
    """SQL literal."""
    if not isinstance(value, str):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_list(c: str, values: Sequence) -> str:
    return f"{c} IN ({', '.join(quote(v) for v in values)})"


def matches_any(c: str, words: Sequence[str]) -> str:
    """Case-insensitive search for any of the words (regular expression alternation)."""
    return f"lower({c}) RLIKE {quote('|'.join(words))}"


def contains_any(c: str, words: Sequence[str | tuple[str, ...]]) -> str:
    """Case-insensitive substring search; a tuple inside ``words`` needs all of its parts."""
    found = []
    for word in words:
        parts = (word,) if isinstance(word, str) else word
        found.append("(" + " AND ".join(f"contains(lower({c}), {quote(p.lower())})" for p in parts) + ")")
    return "(" + " OR ".join(found) + ")"


def first_match(rules: Sequence[tuple[str, str]], default: str | None = None, present: str | None = None) -> str:
    """Label of the first condition that holds; NULL while ``present`` is NULL."""
    arms = [f"WHEN {present} IS NULL THEN cast(NULL AS string)"] if present else []
    arms += [f"WHEN {condition} THEN {quote(label)}" for condition, label in rules]
    return f"CASE {' '.join(arms)} ELSE {quote(default) if default is not None else 'cast(NULL AS string)'} END"


def classify_text(c: str, rules: Sequence[tuple[str, Sequence]], default: str | None = None) -> str:
    """First rule ``(label, substrings)`` found in the text, else ``default``; NULL text stays NULL."""
    return first_match([(contains_any(c, words), label) for label, words in rules], default, present=c)
