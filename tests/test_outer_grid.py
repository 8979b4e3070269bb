"""Outer join of keys that are heavy on both sides."""

import pytest

from tests.helpers import same
from tidespan.operators.outer import full_outer_distinct, full_outer_grid, grid_sides


@pytest.fixture(scope="module")
def sides(spark):
    """Key 0 holds a third of both; keys of one side only, NULL keys, copies and all-NULL rows."""
    key = "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 50 = 1 THEN NULL ELSE {n} + id % 40 END"
    left = spark.range(1200).selectExpr(f"{key.format(n=0)} AS k", "CASE WHEN id % 7 <> 1 THEN id % 900 END AS a")
    right = spark.range(900).selectExpr(f"{key.format(n=20)} AS k", "CASE WHEN id % 5 <> 1 THEN id % 700 END AS b")
    return left.persist(), right.persist()


@pytest.mark.parametrize("cell_rows", [5_000_000, 60, 7])
def test_equals_the_plain_join(sides, cell_rows):
    got = same(full_outer_grid(*sides, ["k"], cell_rows), full_outer_distinct(*sides, ["k"]))
    assert len(got) == len(set(got))


def test_cells_are_even(sides):
    left, right = (x.distinct() for x in sides)
    a, b = grid_sides(left, right, ["k"], 50)
    for side in (a, b):
        sizes = sorted(r["count"] for r in side.where("k = 0").groupBy("_r", "_c").count().collect())
        assert len(sizes) >= 20 and sizes[-1] < 2 * sizes[len(sizes) // 2]
    # every row of one side meets every row of the other once
    n = [x.where("k = 0").count() for x in (left, right)]
    assert a.join(b, ["k", "_r", "_c"]).where("k = 0").count() == n[0] * n[1]


def test_empty_sides(sides):
    left, right = sides
    same(full_outer_grid(left.limit(0), right, ["k"], 7), full_outer_distinct(left.limit(0), right, ["k"]))
    same(full_outer_grid(left, right.limit(0), ["k"], 7), full_outer_distinct(left, right.limit(0), ["k"]))
