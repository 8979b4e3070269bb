"""Long-to-wide operators: one pass over the events, one conditional aggregate per measure."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.functions.text import in_list


@dataclass(frozen=True)
class Measure:
    """A wide column: its codes and the plausible range ``low < v < high`` (``<=`` with ``closed_high``).

    ``convert`` is an SQL template with ``{v}`` for the value.
    """

    name: str
    codes: tuple
    low: float | None = None
    high: float | None = None
    closed_high: bool = False
    convert: str = "{v}"

    def arm(self, code: str, value: str) -> str:
        """``WHEN … THEN …`` for a row of this measure inside its range."""
        ok = [in_list(code, self.codes)]
        if self.low is not None:
            ok.append(f"{value} > {self.low}")
        if self.high is not None:
            ok.append(f"{value} {'<=' if self.closed_high else '<'} {self.high}")
        return f"WHEN {' AND '.join(ok)} THEN {self.convert.format(v=value)}"


def all_codes(measures: Sequence[Measure]) -> list:
    return [c for m in measures for c in m.codes]


def guarded_value(measures: Sequence[Measure], code: str, value: str) -> str:
    """The value under whichever of the measures its code belongs to, NULL outside the range."""
    return f"CASE {' '.join(m.arm(code, value) for m in measures)} END"


def guarded_pivot(events: DataFrame, keys: Sequence[str], measures: Sequence[Measure], code: str, value: str,
                  agg: str = "avg", extra: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``, one guarded aggregate per measure name; the code list is pushed to the scan."""
    names = list(dict.fromkeys(m.name for m in measures))
    aggs = [f"{agg}({guarded_value([m for m in measures if m.name == n], code, value)}) AS {n}" for n in names]
    return events.filter(in_list(code, all_codes(measures))).groupBy(*keys).agg(*[F.expr(a) for a in (*aggs, *extra)])
