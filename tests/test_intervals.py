"""Joins on time cells against the plain range joins."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import T0, at, rows, same
from tidespan.operators.intervals import interval_join, point_cells, points_in_windows, window_cells


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)

    def moment():
        minutes = rng.randint(-60 * 24 * 30, 60 * 24 * 30)
        return T0 + timedelta(minutes=minutes - minutes % 60 if rng.random() < 0.5 else minutes)

    def interval():
        start = moment()
        stop = rng.choice([start, start + timedelta(minutes=rng.choice([1, 59, 60, 61, 300, 5000, 40000])), moment(), None])
        return rng.choice([start] * 9 + [None]), stop

    left = [(i, rng.choice([0, 0, 0, 1, 2, None]), *interval()) for i in range(200)]
    right = [(i, rng.choice([0, 0, 0, 1, 3, None]), *interval()) for i in range(220)]
    points = [(i, rng.choice([0, 0, 1, 2, None]), rng.choice([moment()] * 9 + [None])) for i in range(400)] + [(500, 0, T0), (500, 0, T0)]
    return (
        spark.createDataFrame(left, "i long, k long, a timestamp_ntz, b timestamp_ntz").persist(),
        spark.createDataFrame(right, "j long, k long, c timestamp_ntz, d timestamp_ntz").persist(),
        spark.createDataFrame(points, "p long, k long, t timestamp_ntz").persist(),
    )


@pytest.mark.parametrize("leaf", [1, 3600, 86400])
@pytest.mark.parametrize("whole", [True, False])
def test_points_in_windows(data, leaf, whole):
    windows, _, points = data
    got = points_in_windows(points, windows, ["k"], "t", "a", "b", leaf, whole).select("p", "i")
    assert len(same(got, points.join(windows, "k").filter("t BETWEEN a AND b").select("p", "i"))) > 500


@pytest.mark.parametrize("leaf", [60, 3600])
def test_interval_join(data, leaf):
    left, right, _ = data
    got = interval_join(left, right, ["k"], ("a", "b"), ("c", "d"), leaf)
    want = left.join(right, "k").filter("a <= d AND c <= b AND a <= b AND c <= d")
    assert len(same(got, want)) > 500
    assert interval_join(left.limit(0), right, ["k"], ("a", "b"), ("c", "d")).count() == interval_join(left, right.limit(0), ["k"], ("a", "b"), ("c", "d")).count() == 0


def test_touching_and_equal_intervals(spark):
    left = spark.createDataFrame([(1, at(0), at(2)), (2, at(2), at(2)), (3, at(5), at(4))], "k long, a timestamp_ntz, b timestamp_ntz").selectExpr("7L AS k", "k AS i", "a", "b")
    right = spark.createDataFrame([(1, at(2), at(3)), (2, at(0), at(2)), (3, at(-1), at(0))], "j long, c timestamp_ntz, d timestamp_ntz").selectExpr("7L AS k", "*")
    got = interval_join(left, right, ["k"], ("a", "b"), ("c", "d")).select("i", "j")
    assert rows(got) == [(1, 1), (1, 2), (1, 3), (2, 1), (2, 2)]


def test_a_window_of_a_year_has_few_cells(spark):
    windows = spark.range(400).selectExpr("id AS k", "TIMESTAMP_NTZ '1969-03-01 00:30:00' + id * INTERVAL '37' HOUR AS a").selectExpr("*", "a + INTERVAL '365' DAY AS b")
    for whole, most in ((True, 40), (False, 18)):
        cells = window_cells(windows, "a", "b", 3600, whole)
        assert cells.groupBy("k").count().agg(F.max("count")).first()[0] < most
    decade = windows.selectExpr("k", "a", "a + INTERVAL '3650' DAY AS b")
    assert window_cells(decade, "a", "b").groupBy("k").count().agg(F.max("count")).first()[0] < 52
    # the cells of a window are disjoint and cover its leaves exactly
    spans = window_cells(windows, "a", "b").selectExpr("k", "_low", "_high", "shiftleft(_cell, 2 * _level) AS f", "shiftleft(_cell + 1, 2 * _level) AS u")
    covered = spans.groupBy("k", "_low", "_high").agg(F.expr("min(f) AS f"), F.expr("max(u) AS u"), F.expr("sum(u - f) AS n"))
    assert covered.filter("n <> u - f OR f <> floor(_low / 3600000000D) OR u <> floor(_high / 3600000000D) + 1").isEmpty()


def test_work_follows_the_result(spark):
    """One key with all rows, intervals that hardly overlap: rows that meet in the join are hardly more than those of the result."""
    left = spark.range(20_000).selectExpr("1L AS k", "id AS i", "TIMESTAMP_NTZ '2020-01-01 00:00:00' + id * INTERVAL '1' HOUR AS a").selectExpr("*", "a + INTERVAL '3' HOUR AS b")
    right = spark.range(20_000).selectExpr("1L AS k", "id AS j", "TIMESTAMP_NTZ '2020-01-01 00:30:00' + id * INTERVAL '1' HOUR AS c").selectExpr("*", "c + INTERVAL '10' MINUTE AS d")
    cells = window_cells(left, "a", "b")
    points = point_cells(right, cells, "c")
    met = points.join(cells, ["k", "_level", "_cell"])
    result = interval_join(left, right, ["k"], ("a", "b"), ("c", "d"))
    assert met.count() <= 1.5 * result.count() and result.count() == 20_000 * 3 - 3
    # no cell holds a noticeable share of the key's rows
    assert points.groupBy("k", "_level", "_cell").count().agg(F.max("count")).first()[0] <= 64
    assert cells.groupBy("k", "_level", "_cell").count().agg(F.max("count")).first()[0] <= 64


def test_plan_is_an_equi_join(spark, data):
    left, right, _ = data
    text = interval_join(left, right, ["k"], ("a", "b"), ("c", "d"))._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text
