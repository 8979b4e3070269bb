"""What the operators share on the Spark side: intermediate tables, input columns, Arrow batch sizes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch at most. Long texts: a batch is also cut by bytes where Spark can.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which all executors see; a folder of its own for a local session without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return _own_folder(spark.sparkContext.applicationId)


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"tidespan-{application}-")


def written(df: DataFrame, name: str, partitions: Iterable[str] = ()) -> DataFrame:
    """The same rows, read back from a Parquet table in the shared folder: lineage ends there."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key with more than this part of all rows is frequent; there are fewer such keys.
FREQUENT = 1000


def spread_join(big: DataFrame, small: DataFrame, key: str, copies: str, rows: int, apart: Sequence[str] = ()) -> DataFrame:
    """``big`` with the columns of ``small``, which has one row a key (left join), and no task with all rows of a frequent key.

    ``copies``: how many rows of ``big`` have the key, ``rows`` how many there are. Keys with more than one row in ``FREQUENT`` are fewer than that
    and come by a broadcast; these rows and those without key are then dealt evenly past the exchange of the others: by their place, if ``big`` is
    read from a table, else by the hash of columns that tell them apart (the place of a row behind an exchange may change when a task runs again).
    """
    others = [c for c in small.columns if c not in (key, copies)]
    found = small.select(key, F.struct(*others).alias("_found"), (F.col(copies) * FREQUENT > rows).alias("_frequent"))
    frequent = found.where("_frequent").select(key, F.col("_found").alias("_known"))
    first = big.join(F.broadcast(frequent), key, "left")
    open_ = F.when(F.col("_known").isNull(), F.col(key))
    place = F.xxhash64(*apart) if apart else F.monotonically_increasing_id()
    turn = F.when(open_.isNull(), place).otherwise(F.lit(-1))
    # one column: of two, an exchange may take the key alone, which leaves all rows without one in a task
    first = first.withColumn("_asked", F.struct(open_.alias("key"), turn.alias("turn")))
    rest = found.where("NOT _frequent").select(F.struct(F.col(key).alias("key"), F.lit(-1).cast("long").alias("turn")).alias("_asked"), "_found")
    joined = first.join(rest, "_asked", "left").withColumn("_found", F.coalesce("_known", "_found"))
    return joined.select(*big.columns, *[F.col("_found").getField(c).alias(c) for c in others])


def prepared(spark: SparkSession) -> SparkSession:
    """Bounds the Arrow batches that Python workers get; long texts would make large ones."""
    for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if spark.conf.get(key, None) != str(value):
            spark.conf.set(key, str(value))
    return spark


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id`` (long) and ``text`` (null: empty) alone, whatever else the input holds."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def total_bytes(docs: DataFrame, column: str | Column = "text") -> int:
    column = F.col(column) if isinstance(column, str) else column
    return int(docs.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0)


def arrow(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array) else columns[f.name].cast(f.type) for f in schema], schema=schema)
