"""Ranks and first-row-per-key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The first row of every key in the given order (SQL, with explicit null placement).

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle as well, so a heavy
    key reaches its final task as one row per input partition.
    """
    ranked = df.selectExpr("*", f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}) AS _rn")
    return ranked.filter("_rn = 1").drop("_rn")


def dense_rank_by_time(df: DataFrame, keys: Sequence[str], time: str, name: str) -> DataFrame:
    """``dense_rank`` of ``time`` within ``keys`` (NULL times first; rows without key are one group, as in SQL).

    Only the distinct times of a key are ranked; they are combined before the exchange, and the rank is joined back.
    """
    keys = list(keys)
    times = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(time).alias("_t")).distinct()
    own = [f"_k{i}" for i in range(len(keys))]
    ranks = times.selectExpr("*", f"cast(dense_rank() OVER (PARTITION BY {', '.join(own)} ORDER BY _t NULLS FIRST) AS bigint) AS {name}")
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip([*keys, time], [*own, "_t"])]
    return df.join(ranks, reduce(and_, same)).select(*[c for c in df.columns], name)


def smallest_time(time: str) -> str:
    """Aggregate: the smallest time, NULL being smaller than any."""
    return f"CASE WHEN bool_or({time} IS NULL) THEN NULL ELSE min({time}) END"


def earliest_by_time(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """The rows with rank 1: those at the smallest time of their key (NULL times first)."""
    keys = list(keys)
    own = [f"_k{i}" for i in range(len(keys))]
    first = df.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own)]).agg(
        F.expr(f"{smallest_time(time)} AS _t"))
    same = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip([*keys, time], [*own, "_t"])]
    return df.join(first, reduce(and_, same), "left_semi")
