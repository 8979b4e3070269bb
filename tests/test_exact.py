"""Exact sums and averages against rational arithmetic, over many partitionings."""

import math
import random
import struct
from fractions import Fraction

import pytest

from tidespan.operators.exact import exact_aggregate


def bits(x):
    return None if x is None else struct.pack("<d", x)


def true_sum(values):
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(math.isnan(v) for v in values) or {math.inf, -math.inf} <= set(values):
        return math.nan
    if any(math.isinf(v) for v in values):
        return next(v for v in values if math.isinf(v))
    total = sum(map(Fraction, values))
    try:
        return float(total) + 0.0
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def groups():
    rng = random.Random(11)
    any_double = lambda: struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0]
    finite = lambda: next(x for x in iter(any_double, None) if math.isfinite(x))
    out = {f"wide {i}": [finite() for _ in range(rng.randint(1, 30))] for i in range(60)}
    out |= {f"cents {i}": [rng.randint(-10**6, 10**6) / 100 for _ in range(200)] for i in range(30)}
    out |= {f"near {i}": [rng.uniform(-1, 1) * 2.0 ** rng.randint(-80, 80) for _ in range(40)] for i in range(60)}
    out |= {f"small {i}": [rng.randint(-2**53, 2**53) * 5e-324 * rng.choice([1, 2.0 ** 40, 2.0 ** 60]) for _ in range(12)] for i in range(30)}
    for i in range(60):  # all but the last places cancel, or stand at a tie
        a = [finite() * 1e-10 for _ in range(10)]
        out[f"cancel {i}"] = a + [-x for x in a] + [rng.choice([1.0, 5e-324, -2.0 ** -60, 0.1])]
        e = rng.randint(-900, 900)
        out[f"tie {i}"] = [2.0 ** e, math.ldexp(1, e - 53), rng.choice([0.0, math.ldexp(1, e - 170), -math.ldexp(1, e - 170)]) if e > -800 else 0.0]
        out[f"power {i}"] = [math.nextafter(2.0 ** e, rng.choice([0, math.inf])), 2.0 ** (20 * rng.randint(-45, 50)), -(2.0 ** e)]
    top = math.nextafter(math.inf, 0)
    out |= {"top": [top, top, -top], "over": [top, top], "under": [-top, -top], "edge": [top, 2.0 ** 969], "tie up": [top, 2.0 ** 970]}
    out |= {"zero": [0.0, -0.0], "minus zero": [-0.0], "none": [None, None], "some": [None, 2.5], "least": [5e-324], "subnormal": [2.0 ** -1030, 5e-324]}
    out |= {"nan": [1.0, math.nan], "inf": [math.inf, 1.0], "minus inf": [-math.inf, top], "both": [math.inf, -math.inf], None: [1.0, 0.1]}
    return out


@pytest.fixture(scope="module")
def found():
    return groups()


def frame(spark, groups, seed):
    rows = [(k, v) for k, values in groups.items() for v in values]
    random.Random(seed).shuffle(rows)
    return spark.createDataFrame(rows, "`the key` string, v double")


def test_true_sums(spark, found):
    got = {r["the key"]: r for r in exact_aggregate(frame(spark, found, 1), ["the key"], {"total": "v", "twice": "v * 2"}, {"mean": "v"}).collect()}
    assert set(got) == set(found)
    for k, values in found.items():
        want, n = true_sum(values), sum(v is not None for v in values)
        assert bits(got[k].total) == bits(want) or math.isnan(want) and math.isnan(got[k].total), (k, got[k].total, want)
        if want is not None and math.isfinite(want):
            assert got[k].mean == want / n


def test_twenty_partitionings(spark, found):
    """Equal to the last bit however the rows are dealt and ordered."""
    seen = set()
    for seed in range(20):
        df = frame(spark, found, seed).repartition(1 + seed)
        rows = exact_aggregate(df, ["the key"], {"total": "v"}, {"mean": "v"}).collect()
        seen.add(frozenset((r["the key"], bits(r.total), bits(r.mean)) for r in rows))
    assert len(seen) == 1


def test_no_keys_and_empty(spark):
    df = spark.createDataFrame([(0.1, 1)] * 10, "x double, k int")
    assert [tuple(r) for r in exact_aggregate(df, [], {"s": "x"}, {"m": "k"}).collect()] == [(1.0, 1.0)]
    assert [tuple(r) for r in exact_aggregate(df.limit(0), [], {"s": "x"}).collect()] == [(None,)]
    assert exact_aggregate(df.limit(0), ["k"], {"s": "x"}).collect() == []


def test_heavy_key_is_combined_before_the_exchange(spark):
    df = spark.range(0, 300_000, 1, 6).selectExpr("1 AS k", "if(id % 2 = 0, 1e16D, 1D) * if(id % 4 < 2, 1, -1) + 0.25D AS v")
    (r,) = exact_aggregate(df, ["k"], {"s": "v"}).collect()
    assert r.s == float(sum(Fraction((1e16 if i % 2 == 0 else 1.0) * (1 if i % 4 < 2 else -1) + 0.25) for i in range(4)) * 75_000)
