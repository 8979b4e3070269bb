"""Plans a small driver can hold: tables of the pipeline are cut into parts, and what heavy keys need is left out where there are none."""

from datetime import timedelta

import pytest

from __spark_entry__ import rounded
from tests.helpers import T0, same
from tidespan.operators.asof import asof_backward, carry_previous
from tidespan.operators.bins import covered_bins, overlapped_bins
from tidespan.operators.episodes import state_episodes
from tidespan.operators.skew import has_heavy, salted_join, time_chunks
from tidespan.plans import pipeline as module
from tidespan.plans.pipeline import Pipeline
from tidespan.sources.recast import clinical_sources


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    """Keys with many rows, a key of one row, rows without key or time, rows that come twice."""
    made = [(k, T0 + timedelta(minutes=17 * i * (k + 1)), f"s{(i // 3 + k) % 3}", float(i)) for k in range(3) for i in range(12)]
    made += [(7, T0, "s1", 1.0), (None, T0, "s1", 2.0), (None, T0 + timedelta(hours=2), "s1", 3.0), (1, None, "s2", 4.0), (1, None, None, 5.0)]
    return spark.createDataFrame(made + made[3:6] + made[-4:], "k long, t timestamp_ntz, state string, x double")


def test_has_heavy(rows):
    assert has_heavy(rows, ["k"], 12) and not has_heavy(rows, ["k"], 1000)
    assert not has_heavy(rows.filter("k IS NULL"), ["k"], 1)  # rows without key belong to none


def test_without_heavy_keys_rows_are_the_same(spark, rows):
    alone = rows.groupBy("k", "t").agg({"x": "max"}).withColumnRenamed("max(x)", "x")
    source = alone.filter("x % 2 = 0").selectExpr("k", "t", "named_struct('v', x * 10) AS v")
    asked = rows.select("k", "t", "x")
    for make in (
        lambda **kw: asof_backward(asked, source, ["k"], "t", 1.0, **kw),
        lambda **kw: carry_previous(alone, ["k"], "t", ["x"], 1.0, **kw),
        lambda **kw: state_episodes(rows, ["k"], "t", "state", min_hours=0.1, earliest=["x"], **kw),
        lambda **kw: state_episodes(rows, ["k"], "t", "state", min_hours=0.1, max_gap_hours=0.5, **kw),
    ):
        got = make(heavy=False, crowded=False)
        assert same(got, make(crowded=False)) and "_hot_n" not in optimized(got)
        same(got, make(hot_rows=4, chunk_seconds=600))


def test_joins_without_heavy_keys_are_plain(spark, rows):
    small = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c"), (None, "d"), (9, "e")], "k long, name string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = salted_join(rows, small, ["k"], how, heavy=False)
        other = salted_join(rows, small, ["k"], how, hot_rows=3)
        assert got.columns == other.columns and same(got, other) and "_salt" not in optimized(got)
    spans = rows.selectExpr("k", "t AS a", "t + INTERVAL '5' HOUR AS b")
    stays = spark.createDataFrame([(k, 10 * k, T0, T0 + timedelta(hours=20)) for k in (0, 1, 1, 2)], "k long, s long, lo timestamp_ntz, hi timestamp_ntz")
    for make in (lambda **kw: covered_bins(spans, stays, ["k"], "a", "b", "lo", "hi", ["s"], **kw),
                 lambda **kw: overlapped_bins(spans, stays, ["k"], "a", "b", "lo", "hi", **kw)):
        got = make(heavy=False)
        assert same(got, make(hot_rows=3)) and "_salt" not in optimized(got)


def test_rows_without_key_are_spread_without_heavy_keys_too(rows):
    every, of_heavy = time_chunks(rows, ["k"], "t", heavy=False)
    assert of_heavy is None
    assert every.filter("k IS NULL").select("_chunk").distinct().count() > 1
    assert every.filter("k IS NOT NULL AND (_chunk <> 0 OR _sub <> 0)").count() == 0


def test_no_table_has_a_large_plan(spark, tiny, monkeypatch):
    sizes, write = {}, module.materialize

    def measured(df, name, made=None):
        sizes[name] = len(optimized(df).splitlines())
        return write(df, name, made)

    monkeypatch.setattr(module, "materialize", measured)
    p = Pipeline(clinical_sources(spark, tiny))
    sizes["final_data"] = len(optimized(p.final_data()).splitlines())
    sizes["overalltable2"] = len(optimized(p.overalltable2()).splitlines())
    assert max(sizes.values()) <= 140, sizes  # 368 before
    # what nothing reads any more is gone
    assert not [path for path in p._made if path.rpartition("/")[2].split("-")[0] in ("labs", "vitals", "treated")]


def test_heavy_keys_change_no_row_of_the_pipeline(spark, tiny, monkeypatch):
    plain = Pipeline(clinical_sources(spark, tiny))
    monkeypatch.setattr(module, "has_heavy", lambda *_: True)
    heavy = Pipeline(clinical_sources(spark, tiny))
    for got, other in ((plain.wide_table, heavy.wide_table), (plain.final_data(), heavy.final_data()),
                       (plain.wide_table, plain.overalltable1())):  # the last: in parts, and in one plan
        assert same(rounded(got), rounded(other))
