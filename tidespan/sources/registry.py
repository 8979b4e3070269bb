"""Where tables come from and where results go."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidespan.sources.contracts import CLINICAL, conform
from tidespan.sources.snapshots import read_snapshot, versions

CHECKPOINT_DIR = "spark.checkpoint.dir"


class Sources:
    """Named tables: Parquet files ``<root>/<name>.parquet``, refreshed tables ``<snapshots>/<name>``, catalogue tables or given DataFrames."""

    def __init__(self, spark: SparkSession, root: str | None = None, catalog: dict[str, str] | None = None,
                 frames: dict[str, DataFrame] | None = None, snapshots: str | None = None):
        self.spark = spark
        self.root = root
        self.snapshots = snapshots
        self.catalog = catalog or {}
        self.frames = frames or {}
        self._open: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """The table, opened once per registry (opening reads the Parquet footer)."""
        if name not in self._open:
            self._open[name] = self._find(name)
        return self._open[name]

    def _find(self, name: str) -> DataFrame:
        if name in self.frames:
            df = self.frames[name]
        elif name in self.catalog:
            df = self.spark.table(self.catalog[name])
        elif self.snapshots is not None and versions(self.spark, f"{self.snapshots}/{name}"):
            df = read_snapshot(self.spark, f"{self.snapshots}/{name}")
        elif self.root is not None:
            df = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        else:
            raise KeyError(f"no source for table {name}")
        return conform(df, name) if name in CLINICAL else df

    __call__ = table


def remove_table(spark: SparkSession, path: str) -> None:
    """Delete a written table through the file system that holds it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Have the driver collect its garbage.

    The plans of a finished job go, the heap shrinks, and Spark deletes the job's shuffle files, which it otherwise does
    when the driver happens to collect.
    """
    gc.collect()  # what Python holds in the JVM
    spark.sparkContext._jvm.System.gc()


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, for tables that cut lineage.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may do without: all its tasks run
    on this machine, so a temporary folder will do.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), f"tidespan-{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str, made: list[str] | None = None) -> DataFrame:
    """Write an intermediate table once and read it back; its path goes to ``made``.

    Used where several later steps read the same frame: it is computed once, its lineage is cut, and unlike
    a cache it survives the loss of executors. Readers still prune columns and push filters down.
    """
    folder = f"{shared_folder(df.sparkSession)}/tidespan/{name}-{uuid.uuid4().hex}"
    if made is not None:
        made.append(folder)
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
