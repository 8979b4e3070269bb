"""Very many rows of one key at one instant, or without time: spread over many pieces, results as without."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import same
from tidespan.operators.asof import asof_backward, carry_previous
from tidespan.operators.episodes import state_episodes
from tidespan.operators.skew import time_chunks

INSTANT = "TIMESTAMP_NTZ '2024-01-01 10:00:00'"
HEAVY = {"hot_rows": 40, "chunk_seconds": 3600}


@pytest.fixture(scope="module")
def crowd(spark):
    """Two users: 900 rows at one instant, 300 without time, others around; runs of one kind across the instant."""
    time = f"CASE WHEN id < 900 THEN {INSTANT} WHEN id < 1200 THEN NULL ELSE {INSTANT} + (id - 1300) * INTERVAL '7' SECOND END"
    kind = "CASE WHEN id BETWEEN 1290 AND 1310 THEN 'b' WHEN id % 50 = 0 THEN 'a' WHEN id % 3 = 0 THEN 'c' ELSE 'b' END"
    one = spark.range(1400).selectExpr("id", "1L AS k", f"{time} AS t", f"{kind} AS kind", "cast(id AS double) AS v")
    two = spark.range(2000, 2030).selectExpr("id", "CASE WHEN id % 7 = 0 THEN NULL ELSE 2L END AS k", f"{INSTANT} + id * INTERVAL '1' MINUTE AS t", "'b' AS kind", "1D AS v")
    return one.union(two).persist()


def test_a_million_rows_of_one_instant_are_spread(spark):
    rows = spark.range(0, 1_000_000, 1, 8).selectExpr("id", "1L AS k", f"{INSTANT} AS t")
    every, heavy = time_chunks(rows, ["k"], "t", 20_000)
    sizes = [r["count"] for r in heavy.groupBy("_chunk", "_sub").count().collect()]
    assert len(sizes) >= 40 and max(sizes) <= 60_000 and sum(sizes) == 1_000_000
    assert every.groupBy("_chunk", "_sub").count().count() == len(sizes)
    without = rows.withColumn("t", F.expr("cast(NULL AS timestamp_ntz)"))
    assert time_chunks(without, ["k"], "t", 20_000)[1].groupBy("_sub").count().count() >= 40


def test_parts_follow_the_order(spark, crowd):
    _, heavy = time_chunks(crowd, ["k"], "t", 40, 3600, order=["kind"])
    parts = heavy.groupBy("_chunk", "_sub").agg(F.expr("min(struct(t, kind)) AS a"), F.expr("max(struct(t, kind)) AS b"), F.count("*").alias("n"))
    rows = sorted(parts.collect(), key=lambda r: (r._chunk, r._sub))
    key = lambda s: (s.t is not None, s.t, s.kind)
    assert len(rows) > 15 and max(r.n for r in rows) < 200
    assert all(key(x.b) <= key(y.a) for x, y in zip(rows, rows[1:]))


def test_asof(crowd):
    probes = crowd.filter("id % 2 = 1")
    sources = crowd.filter("id % 97 = 0").groupBy("k", "t").agg(F.expr("named_struct('v', max(v)) AS s")).filter("t IS NOT NULL")
    got = same(asof_backward(probes, sources, ["k"], "t", 30, **HEAVY), asof_backward(probes, sources, ["k"], "t", 30))
    assert len(got) == probes.count()


@pytest.mark.parametrize("only", [None, "kind = 'b'"])
def test_carry(crowd, only):
    args = (crowd, ["k"], "t", ["v", "kind"], 40)
    same(carry_previous(*args, tie=["id"], only=only, **HEAVY), carry_previous(*args, tie=["id"], only=only))


@pytest.mark.parametrize("gap", [None, 0.003])
@pytest.mark.parametrize("tie", [(), ("id",)])
@pytest.mark.parametrize("kinds", ["kind", "'b'", "CASE WHEN id < 1200 THEN kind ELSE 'b' END"])
def test_episodes(crowd, gap, tie, kinds):
    rows = crowd.withColumn("kind", F.expr(kinds))
    args = (rows, ["k"], "t", "kind")
    more = {"max_gap_hours": gap, "earliest": ["id"], "tie": tie, "min_hours": 0.001}
    got = same(state_episodes(*args, **more, **HEAVY), state_episodes(*args, **more))
    assert got


def test_whole_pieces(crowd):
    args = (crowd, ["k"], "t", ["v"], 40)
    same(carry_previous(*args, tie=["id"], crowded=False, **HEAVY), carry_previous(*args, tie=["id"]))


def test_columns_of_any_name(crowd):
    """Names of the operators' own variables are free for columns."""
    rows = crowd.selectExpr("k AS x", "t AS i", "kind AS s", "id AS c")
    same(state_episodes(rows, ["x"], "i", "s", tie=["c"], **HEAVY), state_episodes(rows, ["x"], "i", "s", tie=["c"]))
