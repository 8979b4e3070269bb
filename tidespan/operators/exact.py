"""Sums and averages of doubles that do not depend on the order of the rows.

A double is split without error into digits of 20 bits on one fixed grid of exponents, so that a digit of one row and the
same digit of another can be added as longs, which is exact and may happen in any order: in the map tasks first, then in one
row per key and digit. A key then has at most 106 sums; they are carried into one long number, which is rounded
once, half to even. The result is the double next to the true sum, whatever the partitioning, retries included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 20
#: Exponents of the grid for which a power of two is a normal double; smaller values are scaled up by 2 ** (20 * RAISED) first.
LOW, HIGH, RAISED = -48, 51, 15
#: In place of a digit's number: rows with a value, not a number, infinite ones.
COUNT, NAN, PLUS, MINUS = 1000, 1001, 1002, 1003

POWERS = "array(" + ", ".join(f"{2.0 ** (BITS * k)!r}D" for k in range(LOW, HIGH + 1)) + ")"
MASK = (1 << BITS) - 1


def _let(name: str, value: str, body: str) -> str:
    return f"transform(array({value}), {name} -> {body})[0]"


def _power(k: str) -> str:
    return f"get({POWERS}, {k} - ({LOW}))"


def _digits(v: str, column: int) -> str:
    """Array of (column, digit number, digit) of one double; four digits hold 53 bits wherever they begin."""
    entry = lambda k, d: f"named_struct('c', {column}, 'k', cast({k} AS int), 'd', cast({d} AS bigint))"
    tiny = f"abs({v}) < {2.0 ** (BITS * LOW)!r}D"
    rest, digits = "x", []
    for i in range(4):
        digits.append(entry(f"k - {i} - if({tiny}, {RAISED}, 0)", rest))
        rest = f"({rest} - cast({rest} AS bigint)) * {float(1 << BITS)}D"
    split = _let("x", f"w / {_power('k')}", f"filter(array({', '.join(digits)}), e -> e.d <> 0)")
    top = f"cast(greatest(least(floor(log2(abs(w)) / {BITS}), {HIGH}), {LOW}) AS int)"
    split = _let("w", f"if({tiny}, {v} * {2.0 ** (BITS * RAISED)!r}D, {v})", _let("k", top, split))
    one = entry(COUNT, 1)
    return f"""CASE WHEN {v} IS NULL THEN slice(array({one}), 1, 0) WHEN isnan({v}) THEN array({one}, {entry(NAN, 1)})
        WHEN {v} = double('Infinity') THEN array({one}, {entry(PLUS, 1)}) WHEN {v} = double('-Infinity') THEN array({one}, {entry(MINUS, 1)})
        WHEN {v} = 0 THEN array({one}) ELSE concat(array({one}), {split}) END"""


def _carried(sign: str) -> str:
    """The digits in 0 .. 2^20 - 1 and what is carried out of the last one, -1 if the number is negative."""
    t = f"({sign} * coalesce(try_element_at(m, k), 0L) + a.carry)"
    return (f"aggregate(sequence(low, high + 4), named_struct('carry', 0L, 'g', slice(array(0L), 1, 0)), "
            f"(a, k) -> named_struct('carry', shiftright({t}, {BITS}), 'g', concat(a.g, array({t} & {MASK}L))))")


def _rounded(limbs: str) -> str:
    """The double next to the sum of ``d * 2 ** (20 * k)`` over an array of (k, d)."""
    digit = lambda i: f"coalesce(get(g, j - {i}), 0L)"
    # three digits from the first that is not zero, 41 to 60 bits, and s bits of the next: 58 at least, the lowest says if any is left
    s = "CASE WHEN u < 4398046511104L THEN 20 WHEN u < 140737488355328L THEN 15 WHEN u < 4503599627370496L THEN 10 WHEN u < 144115188075855872L THEN 5 ELSE 0 END"
    left = f"({digit(3)} & (shiftleft(1L, {BITS} - s) - 1)) <> 0 OR exists(slice(g, 1, greatest(j - 3, 0)), x -> x <> 0)"
    whole = f"(shiftleft(u, s) | shiftright({digit(3)}, {BITS} - s) | if({left}, 1L, 0L))"
    scaled = f"cast({whole} AS double) / shiftleft(1L, s)"
    unit = _let("e", "low + j - 2", f"""CASE WHEN e > {HIGH} THEN double('Infinity') WHEN e >= {LOW} THEN {scaled} * {_power('e')}
        ELSE {scaled} * {_power(str(LOW))} * {_power(f'(e - ({LOW}))')} END""")
    top = f"shiftleft({digit(0)}, {2 * BITS}) | shiftleft({digit(1)}, {BITS}) | {digit(2)}"
    body = _let("u", top, _let("s", s, unit))
    j = "aggregate(sequence(0, size(g) - 1), -1, (a, i) -> if(g[i] <> 0, i, a))"
    magnitude = _let("j", j, f"if(j < 0, 0D, {body})")
    signed = _let("p", _carried("1"), f"if(p.carry < 0, -{_let('g', _carried('-1') + '.g', magnitude)}, {_let('g', 'p.g', magnitude)})")
    ends = _let("low", f"array_min(transform({limbs}, x -> x.k))", _let("high", f"array_max(transform({limbs}, x -> x.k))", signed))
    return f"if(size({limbs}) = 0, 0D, {_let('m', f'map_from_entries({limbs})', ends)})"


def exact_aggregate(df: DataFrame, keys: list[str], sums: dict[str, str] | None = None, means: dict[str, str] | None = None) -> DataFrame:
    """``keys`` with exact sums and averages of SQL expressions: ``sums={"total": "value"}``, ``means={"mean": "value"}``.

    A sum is rounded once; an average is that sum divided by the number of values. NULL values are left out; a key without any
    has NULL. Not-a-number and infinite values give what adding them gives; a negative zero counts as zero; a sum beyond the largest double
    is infinite. NULL keys are a group. Without keys there is one row, also of an empty table. A key may have
    8e12 rows; beyond that the sum of a digit overflows, which is an error, not a wrong result.
    """
    sums, means = sums or {}, means or {}
    values = list(dict.fromkeys([*sums.values(), *means.values()]))
    at = [f"__k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(f"`{c}`").alias(a) for c, a in zip(keys, at)], *[F.expr(v).cast("double").alias(f"__v{i}") for i, v in enumerate(values)])
    every = f"concat({', '.join(_digits(f'__v{i}', i) for i in range(len(values)))})"
    rows = rows.select(*at, F.explode_outer(F.expr(every)).alias("__e")).selectExpr(*at, "__e.*")
    digits = rows.groupBy(*at, "c", "k").agg(F.expr("sum(d) AS d"))
    parts = []
    for i in range(len(values)):
        parts += [F.expr(f"max(d) FILTER (WHERE c = {i} AND k = {COUNT}) AS __n{i}"), F.expr(f"collect_list(struct(k, d)) FILTER (WHERE c = {i} AND k < {COUNT} AND d <> 0) AS __l{i}")]
        parts += [F.expr(f"count_if(c = {i} AND k IN ({NAN}, {kind})) AS __{name}{i}") for name, kind in (("p", PLUS), ("m", MINUS))]
    found = digits.groupBy(*at).agg(*parts)
    total = lambda i: f"""CASE WHEN __n{i} IS NULL THEN null WHEN __p{i} > 0 AND __m{i} > 0 THEN double('NaN') WHEN __p{i} > 0 THEN double('Infinity')
        WHEN __m{i} > 0 THEN double('-Infinity') ELSE {_rounded(f'__l{i}')} END"""  # noqa: E731
    found = found.selectExpr(*at, *[f"__n{i}" for i in range(len(values))], *[f"{total(i)} AS __t{i}" for i in range(len(values))])
    place = {v: i for i, v in enumerate(values)}
    return found.select(
        *[F.col(a).alias(c) for c, a in zip(keys, at)],
        *[F.col(f"__t{place[v]}").alias(name) for name, v in sums.items()],
        *[F.expr(f"__t{place[v]} / __n{place[v]}").alias(name) for name, v in means.items()],
    )
