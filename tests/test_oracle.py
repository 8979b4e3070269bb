"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import connect, differences
from tidespan.plans.generic import HEAVY, QUERIES
from tidespan.plans.pipeline import STAGES, Pipeline
from tidespan.sources.recast import clinical_sources

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(tiny):
    return connect(tiny)


@pytest.fixture(scope="module")
def pipeline(spark, tiny):
    return Pipeline(clinical_sources(spark, tiny))


def test_registry():
    own = {*QUERIES, *(f"{q}_heavy" for q in HEAVY), *(f"stage_{s}" for s in STAGES)}
    more = set(entry.llm.queries()) if entry.llm else set()
    assert set(entry.queries()) == own | more
    assert own <= set(SQL) <= own | more


@pytest.mark.parametrize("name", [*QUERIES, *(f"{q}_heavy" for q in HEAVY)])
def test_generic(spark, con, tiny, name):
    assert differences(entry.queries()[name](spark, tiny), con, SQL[name]) == []


@pytest.mark.parametrize("name", STAGES)
def test_stage(pipeline, con, name):
    # one pipeline for all stages, so the shared tables are written once
    assert differences(entry.rounded(getattr(pipeline, name)()), con, SQL[f"stage_{name}"]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["user_id", "n_events"] and df.count() > 0
