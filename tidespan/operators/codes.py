"""Code-set flags per group.

Each row is classified into bit masks and the masks are combined with ``bit_or``, so 62 flags cost a single
long in the aggregation buffer and in the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.text import in_list, quote


@dataclass(frozen=True)
class CodeRule:
    """Codes of one system (``version``) whose first ``length`` characters are listed or in a range.

    ``any_case`` compares them without regard to case.
    """

    version: int | None
    length: int | None
    members: tuple[str, ...] = ()
    ranges: tuple[tuple[str, str], ...] = ()
    any_case: bool = False

    def condition(self, code: str, version: str | None) -> str:
        head = f"substring({code}, 1, {self.length})" if self.length else code
        same = str.upper if self.any_case else str
        head = f"upper({head})" if self.any_case else head
        found = [in_list(head, [same(m) for m in self.members])] if self.members else []
        found += [f"{head} BETWEEN {quote(same(low))} AND {quote(same(high))}" for low, high in self.ranges]
        either = "(" + " OR ".join(found) + ")"
        return f"({version} = {self.version} AND {either})" if self.version is not None else either


MASK_BITS = 62


def any_rule(rules: Sequence[CodeRule], code: str, version: str | None) -> str:
    return "(" + " OR ".join(r.condition(code, version) for r in rules) + ")"


def code_flags(df: DataFrame, keys: Sequence[str], code: str, version: str | None,
               rules: dict[str, Sequence[CodeRule]]) -> DataFrame:
    """One row per ``keys`` with a 0/1 column per flag."""
    names = list(rules)
    masks = []
    for at in range(0, len(names), MASK_BITS):
        bits = [f"CASE WHEN {any_rule(rules[n], code, version)} THEN {1 << i}L ELSE 0L END" for i, n in enumerate(names[at:at + MASK_BITS])]
        masks.append(f"bit_or({' + '.join(bits)}) AS _mask{at // MASK_BITS}")
    found = df.groupBy(*keys).agg(*[F.expr(m) for m in masks])
    flags = [f"cast(shiftright(_mask{i // MASK_BITS}, {i % MASK_BITS}) & 1L AS int) AS {n}" for i, n in enumerate(names)]
    return found.selectExpr(*keys, *flags)
