"""Compare a Spark result with the SQL oracle: row count, column types and values."""

from __future__ import annotations

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def rows(table: pa.Table, names: list[str]) -> list[tuple]:
    columns = [table.column(n).to_pylist() for n in names]
    norm = [[None if v is None or v != v else (v + 0.0 if isinstance(v, float) else v) for v in c] for c in columns]
    return sorted(zip(*norm), key=repr)


def differences(spark_df, con, sql: str, tol: float = 0.0) -> list[str]:
    got, want = spark_df.toArrow(), con.sql(sql).to_arrow_table()
    problems = []
    names = sorted(got.column_names)
    if names != sorted(want.column_names):
        return [f"columns {names} != {sorted(want.column_names)}"]
    for n in names:
        a, b = kind(got.schema.field(n).type), kind(want.schema.field(n).type)
        if a != b:
            problems.append(f"type of {n}: {a} != {b}")
    if got.num_rows != want.num_rows:
        problems.append(f"rows {got.num_rows} != {want.num_rows}")
    a, b = rows(got, names), rows(want, names)
    if a != b:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        problems.append(f"{len(sa - sb)} rows only in Spark, {len(sb - sa)} only in SQL; names {names}")
        problems += [f"  spark {r}" for r in sorted(sa - sb)[:3]] + [f"  sql   {r}" for r in sorted(sb - sa)[:3]]
    return problems
