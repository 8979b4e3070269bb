"""Full outer join with duplicate removal, and the semi-join filter on a group condition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.operators.skew import HOT_ROWS, hot_keys, salted_join


def full_outer_distinct(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of either side matched on ``keys``; identical result rows are kept once.

    Copies are removed from both sides first, which does not change the result and keeps a group of equal
    rows from reaching the join. Spark splits a heavy key of a left and of an anti join, but not of a full one, so
    the two parts are joined apart.
    """
    keys = list(keys)
    one, other = left.distinct(), right.distinct()
    matched = one.join(other, keys, "left")
    rest = other.join(one.select(*keys), keys, "left_anti")
    return matched.unionByName(rest, allowMissingColumns=True).distinct()


def grid_sides(left: DataFrame, right: DataFrame, keys: Sequence[str], cell_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with the cell ``_r, _c`` of each row; rows of one key meet in exactly one cell.

    A key with n rows on the left and m on the right gets ceil(n / cell_rows) x ceil(m / cell_rows) cells: a left row is dealt to one row
    of the grid and repeated along it, a right one to a column. Rows are dealt by the hash of all their columns, so they must be distinct.
    """
    keys = list(keys)
    many = [hot_keys(x, keys, cell_rows).selectExpr(*keys, f"cast(ceil(_hot_n / {cell_rows}D) AS int) AS {n}") for x, n in ((left, "_rs"), (right, "_cs"))]
    cells = F.broadcast(many[0].join(many[1], keys, "full_outer"))

    def dealt(df: DataFrame, of: str, mine: str, along: str, other: str) -> DataFrame:
        values = ", ".join(f"`{c}`" for c in df.columns)
        return df.join(cells, keys, "left").selectExpr(
            *[f"`{c}`" for c in df.columns], f"cast(pmod(xxhash64({values}), coalesce({of}, 1)) AS int) AS {mine}",
            f"explode(sequence(0, coalesce({along}, 1) - 1)) AS {other}")

    return dealt(left, "_rs", "_r", "_cs", "_c"), dealt(right, "_cs", "_c", "_rs", "_r")


def full_outer_grid(left: DataFrame, right: DataFrame, keys: Sequence[str], cell_rows: int = HOT_ROWS) -> DataFrame:
    """``full_outer_distinct`` for keys that may be heavy on both sides at once.

    Matches are made in a grid of cells of at most about ``cell_rows`` rows a side, whatever adaptive execution makes of the sizes.
    Whether a row has a match depends on its key alone, so the unmatched rows come from anti joins with the distinct keys of the other side.
    Matched rows can't be equal to each other or to unmatched ones; only the latter need a second look for copies (those of a NULL key).
    """
    keys = list(keys)
    one, other = left.distinct(), right.distinct()
    a, b = grid_sides(one, other, keys, cell_rows)
    matched = a.join(b, [*keys, "_r", "_c"]).drop("_r", "_c")
    alone = [salted_join(x, y.select(*keys).distinct(), keys, "left_anti", cell_rows, apart=[f"`{c}`" for c in x.columns]) for x, y in ((one, other), (other, one))]
    rest = alone[0].unionByName(alone[1], allowMissingColumns=True).distinct()
    return matched.unionByName(rest)


def keep_groups(df: DataFrame, key: str, having: str, aggs: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows whose group satisfies ``having`` over the aliased ``aggs`` (``IN (… HAVING …)``)."""
    groups = df.groupBy(key).agg(*[F.expr(a) for a in aggs]).filter(having).select(key)
    return salted_join(df, groups, [key], "left_semi", hot_rows)
