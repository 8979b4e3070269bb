"""Edge cases of every operator on literal rows."""

import re
from datetime import datetime

import pytest

from tests.helpers import T0, at, rows, same
from tidespan.functions.rounding import round_half_up
from tidespan.functions.scoring import band_score, logistic_risk, missing_pct, safe_ratio, score_total, two_sided_score
from tidespan.functions.temporal import age_at, days_between, died_within, floor_div, micros, plus_hours, truncate_hour
from tidespan.functions.text import classify_text, contains_any, first_match, matches_any, quote
from tidespan.operators.asof import asof_backward, carry_previous
from tidespan.operators.bins import (
    assign_bins,
    bin_aggregate,
    bins_with_lookback,
    covered_bins,
    events_in_window,
    lookback_bins,
    overlapped_bins,
)
from tidespan.operators.codes import CodeRule, code_flags
from tidespan.operators.episodes import episode_features, state_episodes
from tidespan.operators.outer import full_outer_distinct, keep_groups
from tidespan.operators.pivot import Measure, guarded_pivot
from tidespan.operators.ranking import dense_rank_by_time, earliest_by_time, first_per_key
from tidespan.operators.skew import salted_join, time_chunks
from tidespan.operators.spine import time_spine

STAY = "k long, s timestamp_ntz, e timestamp_ntz"


def value(spark, sql):
    return spark.sql(f"SELECT {sql} AS x").first()[0]


@pytest.fixture(scope="module")
def stays(spark):
    # 10 hours from 10:00: bins at 10:00, 14:00, 18:00
    return spark.createDataFrame([(1, T0, at(10))], STAY)


def entries(source):
    """Values of a source as the structs that the as-of join takes."""
    return source.selectExpr("k", "t", "struct(v) AS got")


def events(spark, *times, schema="k long, t timestamp_ntz"):
    return spark.createDataFrame([(1, t) for t in times], schema)


def test_spine_bounds(spark):
    stays = spark.createDataFrame(
        [(1, T0, at(8)), (2, T0, T0), (3, at(1), T0), (4, T0, None), (5, T0, at(7, 3599))], STAY)
    found = rows(time_spine(stays, "s", "e"), "k", "bin_index")
    assert found == [(1, 0), (1, 1), (1, 2), (2, 0), (5, 0), (5, 1)]
    assert rows(time_spine(stays, "s", "e").filter("k = 1 AND bin_index = 2"), "bin_start") == [(at(8),)]


def test_bins_closed_both(spark, stays):
    df = events(spark, T0, at(4), at(4, 1), at(8), at(10), at(10, 1), at(-1))
    found = rows(assign_bins(df, stays, ["k"], "t", "s", "e"), "t", "bin_index")
    assert found == [(T0, 0), (at(4), 0), (at(4), 1), (at(4, 1), 1), (at(8), 1), (at(8), 2), (at(10), 2)]


def test_bins_closed_left(spark, stays):
    df = events(spark, T0, at(4), at(10))
    assert rows(assign_bins(df, stays, ["k"], "t", "s", "e", closed="left"), "t", "bin_index") == [(T0, 0), (at(4), 1), (at(10), 2)]


def test_bin_aggregate_keeps_only_filled_bins(spark, stays):
    df = spark.createDataFrame([(1, at(4), 1.0), (1, at(5), 3.0), (1, at(9), None)], "k long, t timestamp_ntz, v double")
    found = rows(bin_aggregate(df, stays, ["k"], "t", "s", "e", ["avg(v) AS v"]), "bin_index", "v")
    assert found == [(0, 1.0), (1, 2.0), (2, None)]


def test_window_join_over_midnight(spark):
    stays = spark.createDataFrame([(1, datetime(2024, 1, 1, 23, 0), datetime(2024, 1, 3, 1, 0))], STAY)
    df = events(spark, datetime(2024, 1, 1, 22, 59), datetime(2024, 1, 1, 23, 0), datetime(2024, 1, 2, 12, 0),
                datetime(2024, 1, 3, 1, 0), datetime(2024, 1, 3, 1, 1))
    assert events_in_window(df, stays, ["k"], "t", "s", "e").count() == 3


def overlap(spark, stays, start, stop, **kw):
    df = spark.createDataFrame([(1, start, stop)], "k long, a timestamp_ntz, b timestamp_ntz")
    return [r[0] for r in rows(overlapped_bins(df, stays, ["k"], "a", "b", "s", "e", **kw), "bin_index")]


def test_overlap_edges(spark, stays):
    assert overlap(spark, stays, at(-5), at(-1)) == []
    assert overlap(spark, stays, at(-5), T0) == [0]
    assert overlap(spark, stays, at(-5), at(50)) == [0, 1, 2]
    assert overlap(spark, stays, at(4), at(4)) == [0, 1]
    assert overlap(spark, stays, at(4, 1), at(5)) == [1]
    assert overlap(spark, stays, at(12), at(13)) == [2]
    assert overlap(spark, stays, at(12, 1), at(13)) == []
    assert overlap(spark, stays, at(1), None) == []
    assert overlap(spark, stays, at(4), at(4), reach_minutes=239) == [1]
    assert overlap(spark, stays, at(3, 3540), at(4), reach_minutes=239) == [0, 1]


def test_lookback_is_by_calendar_day(spark):
    start = datetime(2024, 1, 1, 0, 0)
    stays = spark.createDataFrame([(1, start, datetime(2024, 1, 4, 0, 0))], STAY)

    def bins(t, until=None, **kw):
        df = spark.createDataFrame([(1, t, until)], "k long, t timestamp_ntz, u timestamp_ntz")
        return [r[0] for r in rows(lookback_bins(df, stays, ["k"], "t", "s", "e", **kw), "bin_index")]

    # bins 1..11 are 1 January 04:00 to 2 January 20:00
    assert bins(start) == list(range(1, 12))
    assert bins(datetime(2024, 1, 1, 23, 59)) == list(range(6, 12))
    assert bins(datetime(2024, 1, 1, 4, 0)) == list(range(2, 12))
    assert bins(datetime(2024, 1, 3, 23, 0)) == [18]
    assert bins(datetime(2024, 1, 1, 1, 0), datetime(2024, 1, 1, 8, 0), active_until="u") == [1, 2]
    assert bins(datetime(2024, 1, 1, 1, 0), None, active_until=f"coalesce(u, {plus_hours('t', 1)})") == []
    assert bins(datetime(2024, 1, 1, 1, 0), None, active_until="u") == list(range(1, 12))


def test_bins_with_lookback_is_both_operators(spark, stays):
    df = events(spark, T0, at(1), at(4), at(8), at(9.5))
    both = bins_with_lookback(df, stays, ["k"], "t", "s", "e")
    same(both.filter("in_bin").select("t", "bin_index"), assign_bins(df, stays, ["k"], "t", "s", "e").select("t", "bin_index"))
    same(both.filter("NOT in_bin").select("t", "bin_index"), lookback_bins(df, stays, ["k"], "t", "s", "e").select("t", "bin_index"))


def test_asof_tolerance(spark):
    probes = events(spark, at(2), at(5), at(5, 1), at(20))
    source = spark.createDataFrame([(1, at(1), 1.0), (1, at(2), 2.0), (1, at(3), 3.0), (1, at(21), 9.0)], "k long, t timestamp_ntz, v double")
    found = asof_backward(probes, entries(source), ["k"], "t", 2)
    assert rows(found, "t", "got") == [(at(2), 2.0), (at(5), 3.0), (at(5, 1), None), (at(20), None)]


def test_asof_takes_a_null_value_of_the_latest_row(spark):
    source = spark.createDataFrame([(1, at(1), 1.0), (1, at(2), None)], "k long, t timestamp_ntz, v double")
    assert rows(asof_backward(events(spark, at(2)), entries(source), ["k"], "t", 2), "got") == [(None,)]


def test_null_keys_match_nothing(spark):
    """Rows without key see neither each other nor rows with one, and there may be very many of them."""
    probes = spark.createDataFrame([(None, at(2)), (1, at(2))], "k long, t timestamp_ntz")
    source = spark.createDataFrame([(None, at(1), 5.0), (1, at(1), 7.0)], "k long, t timestamp_ntz, v double")
    for more in ({}, {"hot_rows": 1, "chunk_seconds": 3600}):
        assert rows(asof_backward(probes, entries(source), ["k"], "t", 2, **more), "k", "got") == [(None, None), (1, 7.0)]
        found = carry_previous(source.union(source.selectExpr("k", "t + INTERVAL '1' HOUR", "v + 1")), ["k"], "t", ["v"], 6, **more)
        assert rows(found, "k", "v", "prev_v") == [(None, 5.0, None), (None, 6.0, None), (1, 7.0, None), (1, 8.0, 7.0)]
        states = spark.createDataFrame([(k, at(h), "a") for k in (None, 1) for h in range(3)], "k long, t timestamp_ntz, s string")
        assert rows(state_episodes(states, ["k"], "t", "s", **more), "k") == [(1,)]
    lone = time_chunks(spark.range(500).selectExpr("cast(NULL AS long) AS k", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS t"), ["k"], "t")[0]
    assert lone.select("_chunk").distinct().count() == 500


def test_bins_do_not_depend_on_the_session_zone(spark):
    """The night of 10 March 2024 has no 02:00 in New York."""
    stay = spark.createDataFrame([(1, datetime(2024, 3, 9, 22), datetime(2024, 3, 10, 12))], STAY)
    times = [datetime(2024, 3, 10, h, m) for h in range(12) for m in (0, 30)]
    df = events(spark, *times)
    def found():
        binned = rows(assign_bins(df, stay, ["k"], "t", "s", "e"), "t", "bin_index")
        hours = rows(df.selectExpr(f"{truncate_hour('t')} AS h", f"{micros('t')} AS u", f"{days_between('t', plus_hours('t', -30))} AS d"), "h", "u", "d")
        return binned, hours, rows(time_spine(stay, "s", "e"), "bin_start")
    utc = found()
    assert (datetime(2024, 3, 10, 11), 3) in utc[0] and (datetime(2024, 3, 10, 11), 2) not in utc[0]
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert found() == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_carry_previous_limit_is_strict(spark):
    df = spark.createDataFrame(
        [(1, T0, 1.0), (1, at(6), 2.0), (1, at(11, 3599), None), (1, at(12), 4.0)], "k long, t timestamp_ntz, v double")
    found = rows(carry_previous(df, ["k"], "t", ["v"], 6), "t", "prev_v")
    # exactly 6 h: not used; a NULL previous row is not skipped
    assert found == [(T0, None), (at(6), None), (at(11, 3599), 2.0), (at(12), None)]
    skipping = rows(carry_previous(df, ["k"], "t", ["v"], 7, only="v IS NOT NULL"), "t", "prev_v")
    assert skipping == [(T0, None), (at(6), 1.0), (at(11, 3599), 2.0), (at(12), 2.0)]


def test_state_episodes(spark):
    data = [(1, T0, "a"), (1, at(1), "a"), (1, at(2), "b"), (1, at(3), None), (1, at(4), "a"), (1, at(4.5), "a"), (1, at(9), "a"),
            (2, T0, "a"), (3, T0, "a"), (3, at(0.5), "a")]
    df = spark.createDataFrame(data, "k long, t timestamp_ntz, state string")
    found = state_episodes(df, ["k"], "t", "state")
    # single rows, runs under an hour and rows without state are out; a run ends at the next row
    assert rows(found, "k", "state", "starttime", "endtime") == [(1, "a", T0, at(2)), (1, "a", at(4), at(9))]
    gapped = state_episodes(df, ["k"], "t", "state", max_gap_hours=2)
    # the silence opens a new run, so the first one ends where the next row starts
    assert rows(gapped, "starttime", "endtime") == [(T0, at(2)), (at(4), at(9))]


def test_episode_features(spark):
    data = [(1, T0, at(2), None), (1, at(5), at(6), at(5)), (2, T0, at(1.5), None)]
    df = spark.createDataFrame(data, "k long, starttime timestamp_ntz, endtime timestamp_ntz, m timestamp_ntz")
    found = episode_features(df, ["k"], marker="m")
    assert rows(found, "k", "num_event", "ventduration", "end_mech_vent", "time_no_mech_vent", "is_tracheo") == [
        (1, 1, 2.0, at(6), 3.0, 1), (1, 2, 1.0, at(6), None, 1), (2, 1, 2.0, at(1.5), None, 0)]


def test_full_outer_distinct(spark):
    left = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k long, a string")
    right = spark.createDataFrame([(1, 10), (3, 30)], "k long, b int")
    assert rows(full_outer_distinct(left, right, ["k"]), "k", "a", "b") == [(1, "x", 10), (2, "y", None), (3, None, 30)]


def test_keep_groups(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 0, 7.0), (2, 1, None), (3, 0, 7.2)], "k long, f int, ph double")
    assert rows(keep_groups(df, "k", "a > 0 AND b IS NOT NULL", ["max(f) AS a", "max(ph) AS b"]), "k", "f") == [(1, 0), (1, 1)]


def test_earliest(spark):
    df = spark.createDataFrame([(1, at(1), "b"), (1, at(1), "a"), (1, at(3), "c"), (2, None, "n"), (2, at(0), "o"), (None, at(2), "p")], "k long, t timestamp_ntz, v string")
    assert rows(earliest_by_time(df, ["k"], "t"), "v") == [("a",), ("b",), ("n",), ("p",)]
    want = rows(dense_rank_by_time(df, ["k"], "t", "r").filter("r = 1"), "v")
    assert rows(earliest_by_time(df, ["k"], "t"), "v") == want


def test_ranks(spark):
    df = spark.createDataFrame([(1, at(1), "b"), (1, at(1), "a"), (1, None, "n"), (1, at(3), "c")], "k long, t timestamp_ntz, v string")
    assert rows(dense_rank_by_time(df, ["k"], "t", "r"), "v", "r") == [("a", 2), ("b", 2), ("c", 3), ("n", 1)]
    assert rows(first_per_key(df, ["k"], "t ASC NULLS LAST, v ASC"), "v") == [("a",)]
    assert rows(first_per_key(df, ["k"], "t ASC NULLS FIRST, v ASC"), "v") == [("n",)]


def test_guarded_pivot_bounds(spark):
    measures = [Measure("hr", (1,), 0, 300), Measure("sat", (2,), 0, 100, closed_high=True),
                Measure("temp", (3,), 70, 120, convert="({v} - 32) / 1.8D"), Measure("temp", (4,), 10, 50)]
    data = [(1, 1, 0.0), (1, 1, 300.0), (1, 1, 299.0), (1, 2, 100.0), (1, 2, 100.1), (1, 3, 104.0), (1, 4, 41.0), (1, 9, 5.0), (2, 1, 300.0)]
    df = spark.createDataFrame(data, "k long, code int, v double")
    assert rows(guarded_pivot(df, ["k"], measures, "code", "v"), "k", "hr", "sat", "temp") == [(1, 299.0, 100.0, 40.5), (2, None, None, None)]


def test_code_flags(spark):
    rules = {"mi": [CodeRule(9, 3, ("410",)), CodeRule(10, 3, ("I21",))], "rng": [CodeRule(9, 4, ranges=(("4254", "4259"),))]}
    df = spark.createDataFrame(
        [(1, "41071", 9), (1, "4259X", 9), (2, "410", 10), (2, "I21", 10), (3, "42", 9), (3, None, None)], "k long, c string, v int")
    assert rows(code_flags(df, ["k"], "c", "v", rules), "k", "mi", "rng") == [(1, 1, 1), (2, 1, 0), (3, 0, 0)]


def test_any_number_of_flags_and_any_case(spark):
    rules = {f"f{i}": [CodeRule(None, 3, (f"{i:03}",))] for i in range(130)}
    df = spark.createDataFrame([(1, "0625"), (1, "129"), (2, "000"), (2, "063"), (2, "061")], "k long, c string")
    found = code_flags(df, ["k"], "c", None, rules).collect()
    assert {r.k: [n for n in rules if r[n]] for r in found} == {1: ["f62", "f129"], 2: ["f0", "f61", "f63"]}
    case = {"any": [CodeRule(10, 3, ("J80",), any_case=True)], "exact": [CodeRule(10, 3, ("J80",))], "range": [CodeRule(10, 3, ranges=(("J79", "J81"),), any_case=True)]}
    df = spark.createDataFrame([(1, "j80", 10), (2, "J801", 10), (3, "j82", 10)], "k long, c string, v int")
    assert rows(code_flags(df, ["k"], "c", "v", case), "k", "any", "exact", "range") == [(1, 1, 0, 1), (2, 1, 1, 1), (3, 0, 0, 0)]


def test_equal_rows_get_different_salts(spark):
    big = spark.range(1000).selectExpr("1L AS k", "'same' AS v").coalesce(1)
    joined = salted_join(big, spark.createDataFrame([(1, "x")], "k long, w string"), ["k"], hot_rows=10)
    assert joined.count() == 1000
    assert "monotonically_increasing_id()" in joined._jdf.queryExecution().analyzed().toString()
    assert big.selectExpr("pmod(monotonically_increasing_id(), 100) AS s").distinct().count() > 50


def test_covered_bins_are_linear(spark):
    """Ten thousand equal intervals: two steps each, one row a bin."""
    stay = spark.createDataFrame([(1, T0, at(720))], STAY)
    spans = spark.range(10_000).selectExpr("1L AS k", "TIMESTAMP_NTZ '2024-01-01 11:00:00' AS a", "TIMESTAMP_NTZ '2024-01-28 11:00:00' AS b")
    covered = covered_bins(spans, stay, ["k"], "a", "b", "s", "e", ["k"])
    want = overlapped_bins(spans.limit(1), stay, ["k"], "a", "b", "s", "e").select("k", "bin_index")
    assert same(covered, want)
    text = covered._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(array(" in text and text.index("explode(sequence(") < text.index("Window") < text.index("explode(array(")
    mixed = spark.createDataFrame([(1, at(1), at(3)), (1, at(2), at(30)), (1, at(40), at(41)), (1, at(30), at(20)), (1, at(50), None)], "k long, a timestamp_ntz, b timestamp_ntz")
    same(covered_bins(mixed, stay, ["k"], "a", "b", "s", "e", ["k"]), overlapped_bins(mixed, stay, ["k"], "a", "b", "s", "e").select("k", "bin_index").distinct())


def test_salted_join_types(spark):
    big = spark.createDataFrame([(1, i) for i in range(20)] + [(2, 0), (3, 0)], "k long, i int")
    small = spark.createDataFrame([(1, "a"), (2, "b")], "k long, s string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        same(salted_join(big, small, ["k"], how, hot_rows=4), big.join(small, "k", how))


def test_text_rules(spark):
    rules = [("first", ["copd with", ("sepsis", "shock")]), ("second", ["SHOCK"])]
    df = spark.createDataFrame([("COPD with x",), ("shock after Sepsis",), ("a shock",), ("none",), (None,)], "x string")
    found = [r[0] for r in df.selectExpr(f"{classify_text('x', rules, 'other')} AS c").collect()]
    assert found == ["first", "first", "second", "other", None]
    assert value(spark, matches_any("'Fentanyl Citrate'", ("fentanyl", "morphine")))
    assert value(spark, contains_any("'towards'", ["ARDS"]))
    assert value(spark, first_match([("false", "a")])) is None
    assert value(spark, quote("it's a \\")) == "it's a \\"


def test_scores(spark):
    bands = [("<", 40, 0), ("<", 60, 7), (">=", 60, 9)]
    assert [value(spark, band_score(f"cast({v} AS double)", bands)) for v in ("39.9", "40", "59.9", "60", "NULL")] == [0, 7, 7, 9, None]
    hr = [("min", "<", 40, 11), ("max", ">=", 160, 7), ("min", "<", 70, 2)]

    def pulse(low, high):
        return value(spark, two_sided_score(f"cast({low} AS double)", f"cast({high} AS double)", hr, (70, 120)))

    assert [pulse(39, 170), pulse(50, 160), pulse(50, 100), pulse(80, 100), pulse(80, 130), pulse("NULL", "NULL")] == [11, 7, 2, 0, None, None]
    assert value(spark, score_total(["1", "cast(NULL AS int)", "4"])) == 5
    assert [value(spark, missing_pct(["NULL"] * n + ["1"] * (6 - n))) for n in range(7)] == [0, 16, 33, 50, 66, 83, 100]
    assert value(spark, logistic_risk("0")) == pytest.approx(0.000425, abs=1e-6)
    assert value(spark, safe_ratio("1D", "0D")) is None
    assert value(spark, safe_ratio("1D", "4D", 100.0)) == 25.0


def test_time_arithmetic(spark):
    ts = "TIMESTAMP_NTZ'{}'".format
    assert value(spark, age_at("60", "2150", ts("2150-01-01 00:00:00"))) == 60.0
    assert value(spark, age_at("60", "2150", ts("2150-07-02 00:00:00"))) == pytest.approx(60.5, abs=0.01)
    assert value(spark, days_between(ts("2150-01-02 12:00:00"), ts("2150-01-01 00:00:00"))) == 1.5
    assert value(spark, died_within("DATE'2150-01-29'", ts("2150-01-01 00:00:00"), 28)) == 0
    assert value(spark, died_within("DATE'2150-01-28'", ts("2150-01-01 00:00:00"), 28)) == 1
    assert value(spark, died_within("cast(NULL AS date)", ts("2150-01-01 00:00:00"), 28)) == 0
    assert [value(spark, floor_div(f"{v}L", 4)) for v in (-5, -4, -1, 0, 3, 4)] == [-2, -1, -1, 0, 0, 1]
    assert value(spark, round_half_up("33.994999999999997D")) == 34.0
    assert value(spark, round_half_up("cast('Infinity' AS double)")) is None
