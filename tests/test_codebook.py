"""Compiled code books give what asking every rule gives."""

import random
import time

from tests.helpers import rows, same
from tidespan.operators.codebook import code_book_flags, disjoint_ranges
from tidespan.operators.codes import CodeRule, code_flags

RULES = {
    "listed": [CodeRule(None, None, ("A1", "b2", "Z"))],
    "prefix": [CodeRule(9, 1, ("A",)), CodeRule(10, 2, ("b2", "b"), (("A0", "A5"),))],
    "nested": [CodeRule(9, 3, ranges=(("A", "C"), ("B", "B5"), ("B3", "D")))],
    "any_case": [CodeRule(None, 2, ("a1",), (("b0", "b9"),), True)],
    "backwards": [CodeRule(None, 2, ranges=(("Z", "A"),))],
    "text": [CodeRule(None, None, ("é", "it's", "\\", "\U0001F600"))],
}
SCHEMA = "id int, code string, version int"


def _table(spark):
    deal = random.Random(5)
    codes = ["", "A", "A1", "a1", "A12", "b2", "B25", "B3", "Z", "D", "D0", "é", "it's", "\\", "\U0001F600", "￿", None]
    return spark.createDataFrame([(deal.choice([*range(30), None]), deal.choice(codes), deal.choice([9, 10, None])) for _ in range(400)], SCHEMA)


def test_equals_asking_every_rule(spark):
    df = _table(spark)
    for hot in (5_000_000, 10):
        got = same(code_book_flags(df, ["id"], "code", "version", RULES, hot), code_flags(df, ["id"], "code", "version", RULES))
        assert len(got) == 31
    assert code_book_flags(df.limit(0), ["id"], "code", "version", RULES).count() == 0


def test_no_version(spark):
    rules = {"x": [CodeRule(None, 1, ("A", "é"))], "y": [CodeRule(None, 2, ranges=(("A1", "B3"),))]}
    df = _table(spark)
    same(code_book_flags(df, ["id"], "code", None, rules, apart=["id", "code", "version"], hot_rows=3), code_flags(df, ["id"], "code", None, rules))


def test_more_flags_than_a_mask(spark):
    rules = {f"f{i}": [CodeRule(None, 2, ranges=((f"{i % 90:02d}", f"{i % 90 + i % 5:02d}"),))] for i in range(150)}
    df = spark.range(200).selectExpr("id % 13 AS k", "lpad(cast(id % 100 AS string), 2, '0') AS code")
    same(code_book_flags(df, ["k"], "code", None, rules), code_flags(df, ["k"], "code", None, rules))


def test_ranges_are_disjoint_and_ascending():
    bounds, masks = disjoint_ranges([("b", "d", 0), ("c", "c", 1), ("d", "x", 2), ("q", "p", 3)])
    assert bounds == ["b", "c", "c\0", "d", "d\0", "x\0"] and masks == [1, 3, 1, 5, 4, 0]


def test_plan_does_not_grow_with_the_rules(spark):
    def book(n):
        return {f"f{f}": [CodeRule(None, 6, ranges=((f"{i:06d}", f"{i + 3:06d}"),)) for i in range(f, n, 20)] for f in range(20)}

    df = spark.range(2000).selectExpr("id % 50 AS k", "lpad(cast(id * 7 % 6000 AS string), 6, '0') AS code")
    start = time.time()
    large = code_book_flags(df, ["k"], "code", None, book(5000))
    got = {r[0]: r[1:] for r in rows(large)}
    assert time.time() - start < 60
    expect = {k: [0] * 20 for k in range(50)}
    for i in range(2000):
        code = i * 7 % 6000
        for low in range(max(0, code - 3), min(code, 4999) + 1):
            expect[i % 50][low % 20] = 1
    assert {k: list(v) for k, v in got.items()} == expect
    assert large._jdf.queryExecution().analyzed().toString().count("BETWEEN") == 0
