"""The paths for heavy keys give the same rows as the plain ones."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import same
from tidespan.operators.asof import asof_backward, carry_previous
from tidespan.operators.bins import overlapped_bins
from tidespan.operators.episodes import state_episodes
from tidespan.operators.outer import keep_groups
from tidespan.operators.ranking import dense_rank_by_time
from tidespan.operators.skew import hot_keys, time_chunks

# a key with more than 20 rows is heavy; its timeline is cut every 6 hours
HEAVY = {"hot_rows": 20, "chunk_seconds": 6 * 3600}


@pytest.fixture(scope="module")
def events(spark, tiny):
    """Third of all rows on user 0, with equal times and long runs of one type."""
    df = spark.read.parquet(f"{tiny}/events.parquet").selectExpr(
        "event_id", "CASE WHEN event_id % 3 = 0 THEN 0L ELSE user_id END AS user_id",
        "cast(date_trunc('hour', ts) AS timestamp_ntz) AS ts",
        "CASE WHEN event_id % 5 = 0 THEN 'click' ELSE 'view' END AS kind", "value")
    return df.persist()


def test_heavy_keys_are_found(events):
    assert hot_keys(events, ["user_id"], 300).count() == 1
    every, heavy = time_chunks(events, ["user_id"], "ts", 300, 3600)
    assert heavy.select("user_id").distinct().count() == 1
    assert heavy.groupBy("_chunk").count().agg({"count": "max"}).first()[0] < 10
    assert every.count() == events.count()
    assert every.filter("_chunk = 0").count() == events.count() - heavy.count()


def test_asof(events):
    probes = events.filter("event_id % 4 = 1")
    sources = events.groupBy("user_id", "ts").agg(*[
        F.expr(f"CASE WHEN count_if(kind = '{k}') > 0 THEN named_struct('v', avg(CASE WHEN kind = '{k}' THEN value END)) END AS {k}") for k in ("view", "click")])
    got = same(asof_backward(probes, sources, ["user_id"], "ts", 30, **HEAVY), asof_backward(probes, sources, ["user_id"], "ts", 30))
    assert len(got) == probes.count()


@pytest.mark.parametrize("only", [None, "kind = 'view'"])
def test_carry(events, only):
    args = (events, ["user_id"], "ts", ["value", "kind"], 40)
    same(carry_previous(*args, tie=["event_id"], only=only, **HEAVY), carry_previous(*args, tie=["event_id"], only=only))


@pytest.mark.parametrize("gap", [None, 5])
def test_episodes(events, gap):
    args = (events, ["user_id"], "ts", "kind")
    got = same(state_episodes(*args, max_gap_hours=gap, earliest=["event_id"], **HEAVY),
               state_episodes(*args, max_gap_hours=gap, earliest=["event_id"]))
    assert any(r for r in got)


def test_episode_longer_than_many_chunks(spark):
    from tests.helpers import at

    data = [(1, at(h), "a" if h < 70 or h > 75 else "b") for h in range(0, 100)]
    df = spark.createDataFrame(data, "user_id long, ts timestamp_ntz, kind string")
    got = same(state_episodes(df, ["user_id"], "ts", "kind", hot_rows=5, chunk_seconds=7200), state_episodes(df, ["user_id"], "ts", "kind"))
    assert len(got) == 3


def test_dense_rank(events):
    window = "dense_rank() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST)"
    same(dense_rank_by_time(events, ["user_id"], "ts", "rank"), events.selectExpr("*", f"cast({window} AS bigint) AS rank"))


def test_overlap_and_groups(events):
    stays = events.groupBy("user_id").agg({"ts": "min"}).withColumnRenamed("min(ts)", "s").selectExpr("*", "s + INTERVAL '9' DAY AS e")
    spans = events.selectExpr("user_id", "ts AS a", "ts + INTERVAL '5' HOUR AS b", "event_id")
    args = (spans, stays, ["user_id"], "a", "b", "s", "e")
    same(overlapped_bins(*args, hot_rows=10), overlapped_bins(*args))
    groups = ("user_id", "m > 100", ["max(value) AS m"])
    same(keep_groups(events, *groups, hot_rows=10), keep_groups(events, *groups))


def test_dealing_goes_by_values_behind_an_exchange(events):
    """A task that runs again meets its rows in another order and has to deal them alike."""
    rows = events.selectExpr("CASE WHEN event_id % 2 = 0 THEN user_id END AS user_id", "ts", "event_id").distinct()
    dealt = [time_chunks(rows.orderBy(way).coalesce(1), ["user_id"], "ts", apart=["event_id"])[0] for way in (F.asc("event_id"), F.desc("event_id"))]
    got = same(*dealt)
    alone = [r for r in got if r[sorted(dealt[0].columns).index("user_id")] is None]
    assert len({r[0] for r in alone}) == len(alone) > 100  # _chunk is the first by name


def test_rows_without_key_in_one_chunk_do_not_meet(events):
    rows = events.selectExpr("CASE WHEN event_id % 2 = 0 THEN user_id END AS user_id", "ts", "event_id", "value")
    lone = {"apart": ["1"]}  # all of them in one chunk
    carried = carry_previous(rows, ["user_id"], "ts", ["value"], 40, tie=["event_id"], **lone)
    assert carried.filter("user_id IS NULL AND prev_value IS NOT NULL").count() == 0 < carried.filter("prev_value IS NOT NULL").count()
    sources = rows.groupBy("user_id", "ts").agg(F.expr("named_struct('v', max(value)) AS x"))
    found = asof_backward(rows.drop("value"), sources, ["user_id"], "ts", 30, **lone)
    assert found.filter("user_id IS NULL AND x IS NOT NULL").count() == 0 < found.filter("x IS NOT NULL").count()
