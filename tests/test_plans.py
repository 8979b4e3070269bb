"""The physical plans are the ones the operators promise."""

import re

import pytest

import __spark_entry__ as entry
from tests.helpers import same
from tidespan.plans.generic import QUERIES, Generic
from tidespan.plans.pipeline import Pipeline
from tidespan.sources.recast import clinical_sources


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def check(text: str) -> None:
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "ArrowEvalPython", "SinglePartition"):
        assert forbidden not in text, forbidden


@pytest.mark.parametrize("name", [q for q in QUERIES if q not in ("date_key_join", "final_semi_filter")])
def test_no_nested_loop_no_python(spark, tiny, name):
    check(plan(entry.queries()[name](spark, tiny)))


def test_pipeline_plans(spark, tiny):
    p = Pipeline(clinical_sources(spark, tiny))
    for stage in (p.demographics(), p.getalllabvalues(), p.getallvitalsigns(), p.vasopressors()):
        check(plan(stage))


def test_filters_and_columns_reach_the_scan(spark, tiny):
    g = Generic(spark, tiny)
    text = plan(g.code_prefilter_scan())
    assert "PushedFilters: [In(event_type, [error,purchase,view])]" in text
    assert "ReadSchema: struct<event_type:string,value:double>" in text
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in plan(g.dim_label_filter())


def test_aggregates_combine_before_the_exchange(spark, tiny):
    text = plan(Generic(spark, tiny).features())
    assert re.search(r"Exchange hashpartitioning\(user_id#\d+L, bin_index#\d+L.*\n.*HashAggregate.*partial_avg", text)


def test_first_row_is_limited_before_the_exchange(spark, tiny):
    for name in ("priority_row_number", "first_service", "distinct_on_first"):
        text = plan(getattr(Generic(spark, tiny), name)())
        assert text.count("WindowGroupLimit") == 2, name
        assert re.search(r"Exchange.*\n.*WindowGroupLimit.*Partial", text), name


def exchanges(df) -> int:
    """Hash exchanges of the initial plan, each counted once however often it is reused."""
    return len(re.findall(r"Exchange hashpartitioning", plan(df).split("+- == Initial Plan ==")[0]))


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ranks_do_not_double_the_plan(spark, tiny):
    assert exchanges(Generic(spark, tiny).cohort_first_stay()) <= 6
    assert exchanges(Pipeline(clinical_sources(spark, tiny)).cohort()) <= 10


def test_wide_table_is_pruned_early(spark, tiny, no_broadcast):
    p = Pipeline(clinical_sources(spark, tiny))
    text = plan(p.overalltable1())
    assert len(re.findall("Exchange hashpartitioning", text)) <= 69  # 139 before
    assert "LeftSemi" in text


def test_one_scan_for_both_gases(spark, tiny):
    p = Pipeline(clinical_sources(spark, tiny))
    text = p.getalllabvalues()._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("named_struct(v, ") <= 2 * text.count("count_if") + 4
    raw = plan(p.getallvitalsigns())
    assert len(re.findall(r"Exchange hashpartitioning\(subject_id#\d+L, hadm_id#\d+L, stay_id#\d+L, charttime#\d+", raw)) == 2  # the rows, and again for heavy keys


def test_binned_frames_share_their_partitioning(spark, tiny):
    """Spine and feature frames meet on (user_id, bin_index) without a second exchange of the features."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(Generic(spark, tiny).binned())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    on_bin = re.findall(r"Exchange hashpartitioning\(user_id#\d+L, bin_index#\d+L, \d+\)", text)
    # spine, point features, interval features
    assert len(on_bin) == 3


def test_episodes_use_one_exchange_for_all_windows(spark, tiny):
    text = plan(Generic(spark, tiny).state_episodes())
    main = re.findall(r"Exchange hashpartitioning\(user_id#\d+L, _chunk#\d+L, _sub#\d+, \d+\)", text)
    # the rows once, and the summaries of heavy keys
    assert len(main) <= 3


def test_refresh_leaves_the_whole_last_table(spark, tiny):
    g = Generic(spark, tiny)
    got = g.sink_refresh()
    rows = same(got, g.stays())
    assert {r[sorted(got.columns).index("user_id")] % 2 for r in rows} == {0, 1}
    assert not any("year=" in f for f in got.inputFiles())


@pytest.mark.parametrize("name", ["interval_overlap_flag", "interval_overlap_flag_heavy", "episode_bin_overlap", "episode_bin_overlap_heavy",
                                  "wide_bin_table", "stage_opioids", "stage_prova_intubation", "stage_getallvitalsigns", "stage_getalllabvalues"])
def test_rows_behind_an_exchange_are_not_dealt_by_place(spark, tiny, name):
    assert "monotonically_increasing_id" not in entry.queries()[name](spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
