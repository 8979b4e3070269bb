"""Clustered snapshots: the same rows, most files left unread."""

import os

import pytest

from tests.helpers import rows, same
from tidespan.sources.clustered import clustered
from tidespan.sources.snapshots import read_snapshot, read_where, vacuum, write_snapshot

BY = ["code", "stay", "at"]


@pytest.fixture(scope="module")
def table(spark):
    """A code with a third of all rows, NULLs in each column, and copies of one row."""
    return spark.range(12_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 101 = 0 THEN NULL ELSE concat('code-', lpad(cast(id * 37 % 60 AS string), 3, '0')) END AS code",
        "CASE WHEN id % 97 <> 0 THEN id * 7919 % 500 END AS stay",
        "CASE WHEN id % 89 <> 0 THEN timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 104729 % 90000) END AS at",
        "cast(id AS double) AS value", "CASE WHEN id % 2 = 0 THEN 'x' END AS `odd name`").persist()


@pytest.fixture(scope="module")
def path(spark, table, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('clustered')}/t"
    same(write_snapshot(table, path, cluster_by=BY, rows_per_file=40).select(*BY, "value"), table.select(*BY, "value"))
    return path


@pytest.mark.parametrize("where,condition,share", [
    ({"code": ["code-007", "code-033"]}, "code IN ('code-007', 'code-033')", 1 / 3),
    ({"code": ["hot"], "stay": (100, 130)}, "code = 'hot' AND stay BETWEEN 100 AND 130", 1 / 3),
    ({"stay": (490, None)}, "stay >= 490", 1 / 3),
    ({"stay": [3], "value": (None, 3000.0)}, "stay = 3 AND value <= 3000", 1 / 3),
    ({"value": (5.0, 9.0)}, "value BETWEEN 5 AND 9", 1.0),
    ({"code": ["none", "zz"]}, "false", 0.1),
    ({"code": []}, "false", 0.0),
])
def test_reads_few_files_and_all_rows(spark, table, path, where, condition, share):
    got = read_where(spark, path, where)
    same(got.select(*BY, "value"), table.where(condition).select(*BY, "value"))
    whole = read_snapshot(spark, path)
    size = lambda df: sum(os.path.getsize(f.removeprefix("file://").removeprefix("file:")) for f in df.inputFiles())
    assert len(whole.inputFiles()) >= 250 and size(got) <= share * size(whole)


def test_hot_code_is_divided(spark, path):
    sizes = [r[0] for r in read_snapshot(spark, path).groupBy("_metadata.file_name").count().select("count").collect()]
    assert max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]


def test_empty_one_column_and_older_version(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    assert write_snapshot(table.limit(0), path, cluster_by=BY).count() == 0
    assert read_where(spark, path, {"code": ["hot"]}).count() == 0
    write_snapshot(spark.range(100), path, cluster_by=["id"], rows_per_file=10)
    assert rows(read_where(spark, path, {"id": (20, 24)})) == [(i,) for i in range(20, 25)]
    assert read_where(spark, path, {"code": ["hot"]}, version=1).columns == table.columns
    write_snapshot(spark.range(5), path)  # not clustered
    assert rows(read_where(spark, path, {"id": [3]})) == [(3,)]
    vacuum(spark, path, 0)
    assert len([n for n in os.listdir(path) if n.startswith("snapshot-")]) == 1
    with pytest.raises(ValueError):
        write_snapshot(spark.range(5), path, ["id"], cluster_by=["id"])


def test_wide_rows_make_smaller_files(spark):
    wide = spark.range(3_000).selectExpr("id", "repeat('x', 1000) AS text", "array(id, NULL) AS list", "cast(NULL AS string) AS none")
    laid = clustered(wide, ["id"], file_bytes=100_000)
    sizes = laid.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect()
    assert sum(sizes) == 3_000 and max(sizes) <= 200 and laid.columns == wide.columns
    assert clustered(wide, ["id"]).rdd.getNumPartitions() == 1
