"""Bin arithmetic against the defining range joins, on random rows."""

import random
from datetime import timedelta

import pytest

from tests.helpers import T0, same
from tidespan.operators.asof import asof_backward
from tidespan.operators.bins import assign_bins, lookback_bins, overlapped_bins
from tidespan.operators.spine import time_spine


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)

    def moment(low, high):
        # half of the times on whole hours, so grid lines are hit
        minutes = rng.randint(low * 60, high * 60)
        return T0 + timedelta(minutes=minutes - minutes % 60 if rng.random() < 0.5 else minutes)

    stays = [(k, moment(0, 30), moment(20, 120)) for k in range(12)]
    events = [(i, rng.randrange(14), moment(-10, 130), None if rng.random() < 0.1 else moment(-10, 140)) for i in range(600)]
    return (
        spark.createDataFrame(stays, "k long, s timestamp_ntz, e timestamp_ntz").persist(),
        spark.createDataFrame(events, "i long, k long, t timestamp_ntz, u timestamp_ntz").persist(),
    )


def naive(data, condition):
    stays, events = data
    spine = time_spine(stays, "s", "e")
    return spine.join(events, "k").filter(condition).select("i", "k", "bin_index")


def test_bins(data):
    stays, events = data
    got = assign_bins(events, stays, ["k"], "t", "s", "e").select("i", "k", "bin_index")
    assert same(got, naive(data, "t BETWEEN s AND e AND t BETWEEN bin_start AND bin_start + INTERVAL '4' HOUR"))


@pytest.mark.parametrize("reach", [240, 239])
def test_overlap(data, reach):
    stays, events = data
    got = overlapped_bins(events, stays, ["k"], "t", "u", "s", "e", reach_minutes=reach).select("i", "k", "bin_index")
    assert same(got, naive(data, f"t <= bin_start + INTERVAL '{reach}' MINUTE AND u >= bin_start"))


@pytest.mark.parametrize("active", [None, "coalesce(u, t + INTERVAL '1' HOUR)"])
def test_lookback(data, active):
    stays, events = data
    got = lookback_bins(events, stays, ["k"], "t", "s", "e", active).select("i", "k", "bin_index")
    condition = "t BETWEEN s AND e AND cast(t AS date) >= cast(bin_start AS date) - INTERVAL '1' DAY AND t < bin_start"
    assert same(got, naive(data, condition if active is None else f"{condition} AND {active} >= bin_start"))


def test_asof(data):
    _, events = data
    probes = events.filter("i % 3 = 0").select("i", "k", "t")
    source = events.filter("i % 3 = 1").groupBy("k", "t").agg({"i": "max"}).withColumnRenamed("max(i)", "v")
    got = asof_backward(probes, source.selectExpr("k", "t", "struct(v) AS got"), ["k"], "t", 5)
    brute = (
        probes.alias("p").join(source.alias("r"), "k", "left")
        .selectExpr("i", "p.t AS t", "k", "CASE WHEN r.t <= p.t AND r.t >= p.t - INTERVAL '5' HOUR THEN struct(r.t AS t, v) END AS m")
        .groupBy("i", "k", "t").agg({"m": "max"}).selectExpr("i", "k", "t", "`max(m)`.v AS got")
    )
    same(got, brute)
