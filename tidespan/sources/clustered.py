"""Layout of a table's files along a space-filling curve, and the statistics that let readers skip files.

Each clustering column is cut at 255 quantiles of a sample, and the bits of the eight-bit ranks are interleaved (a Morton
curve), so a file holds a small box in all of these columns at once: a list of codes, a range of stays and a span of time
each rule out most files. The column named first leads by two bits, as the code does in most questions. A quantile cut follows the rows, so a code with a third of all of them is divided by the other columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidespan.functions.search import rank_in

BITS = 8
#: Bits of the first column ahead of the interleaved ones.
LEAD = 2
#: Sampled rows at most (about), of which the quantiles of a column are taken.
SAMPLE = 20_000
ROWS_PER_FILE = 5_000_000
#: Bytes of the rows of a file, about: one task sorts them, so wide rows make smaller files.
FILE_BYTES = 128 << 20
#: What is looked for: listed values, or a closed range with None for an open end.
Wanted = dict[str, "list | tuple"]


def _row_bytes(df: DataFrame) -> str:
    """About how many bytes a row takes while it is sorted: a word for each column, place and tie, and what its texts and lists hold."""
    sizes = [f"coalesce(octet_length({f'`{f.name}`' if kind in ('string', 'binary') else f'cast(`{f.name}` AS string)'}), 0)"
             for f in df.schema if (kind := f.dataType.simpleString()) in ("string", "binary") or "<" in kind]
    return " + ".join([str(8 * (len(df.columns) + 4)), *sizes])


def _cuts(df: DataFrame, columns: Sequence[str], rows: int) -> tuple[list[list], float]:
    """For each column its quantiles in the sample: less than 2^BITS values, frequent ones several times, so that ranks follow the rows.
    And the mean size of a row."""
    drawn = df.sample(min(1.0, SAMPLE / max(rows, 1)), seed=7).selectExpr(*[f"`{c}`" for c in columns], f"{_row_bytes(df)} AS _bytes")
    n = 1 << BITS
    picked = [f"transform(sequence(1, {n - 1}), i -> get(_all{j}, cast(i * size(_all{j}) / {n} AS int))) AS cuts{j}" for j in range(len(columns))]
    lists = drawn.agg(*[F.array_sort(F.collect_list(c)).alias(f"_all{j}") for j, c in enumerate(columns)], F.avg("_bytes").alias("_bytes"))
    *found, size = lists.selectExpr(*picked, "_bytes").first()
    return [[v for v in cuts if v is not None] for cuts in found], size or 1.0


def clustered(df: DataFrame, columns: Sequence[str], rows_per_file: int = ROWS_PER_FILE, file_bytes: int = FILE_BYTES) -> DataFrame:
    """The rows of ``df`` in range partitions along the curve (of at most seven columns), one for each file to write: at most about
    ``rows_per_file`` rows and ``file_bytes`` bytes each, whatever the size of the table.

    Reads ``df`` four times (count, sample, sample of the range partitioning, rows), so it should be a table. A NULL counts as below all values. Rows
    that agree in all clustering columns are divided by a hash of the row; rows equal in everything stay together.
    """
    if not 0 < len(columns) <= 63 // BITS:
        raise ValueError(f"{len(columns)} clustering columns")
    rows = df.count()
    cuts, row_bytes = _cuts(df, columns, rows)
    rows_per_file = max(1, min(rows_per_file, int(file_bytes / row_bytes)))
    ranks = []
    for c, values in zip(columns, cuts):
        kind = df.schema[c].dataType.simpleString()
        literals = F.array(*[F.lit(v).cast(kind) for v in values]) if values else F.expr(f"cast(array() AS array<{kind}>)")
        ranks.append(literals)
    placed = df.select("*", *[x.alias(f"_cuts{j}") for j, x in enumerate(ranks)])
    placed = placed.selectExpr(*[f"`{c}`" for c in df.columns], *[f"{rank_in(f'_cuts{j}', f'`{c}`', len(cuts[j]))} AS _rank{j}" for j, c in enumerate(columns)])
    # (column, bit) from the highest place of the curve to the lowest
    places = [(0, BITS - 1 - i) for i in range(LEAD)]
    places += [(j, b) for i in range(BITS) for j in range(len(columns)) if (b := BITS - 1 - i - (LEAD if j == 0 else 0)) >= 0]
    z = " | ".join(f"shiftleft(cast(shiftright(_rank{j}, {b}) & 1 AS long), {len(places) - 1 - i})" for i, (j, b) in enumerate(places))
    hashed = [f"`{f.name}`" for f in df.schema if "map<" not in f.dataType.simpleString()]
    order = ["_z", *columns, "_tie"]
    laid = placed.selectExpr(*[f"`{c}`" for c in df.columns], f"{z} AS _z", f"xxhash64({', '.join(hashed)}) AS _tie")
    return laid.repartitionByRange(max(1, -(-rows // rows_per_file)), *order).sortWithinPartitions(*order).drop("_z", "_tie")


def file_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Least and greatest value of each column in every file that ``df`` reads."""
    spans = [F.struct(F.min(c).alias("low"), F.max(c).alias("high")).alias(f"c{j}") for j, c in enumerate(columns)]
    return df.groupBy(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_file")).agg(*spans).drop("_path")


def holds(column: Column, wanted: list | tuple) -> Column:
    """The rows that are looked for."""
    if isinstance(wanted, list):
        return column.isin(wanted)
    low, high = wanted
    return (F.lit(True) if low is None else column >= low) & (F.lit(True) if high is None else column <= high) & column.isNotNull()


def may_hold(columns: Sequence[str], where: Wanted) -> Column:
    """The files whose statistics don't rule out such rows; conditions on other columns rule out none."""
    found = F.lit(True)
    for j, c in enumerate(columns):
        if c in where:
            low, high, wanted = F.col(f"c{j}.low"), F.col(f"c{j}.high"), where[c]
            if isinstance(wanted, list):
                some = F.lit(False)
                if wanted:
                    some = F.exists(F.array(*[F.lit(v) for v in wanted]), lambda v: (v >= low) & (v <= high))  # noqa: B023
                found = found & some
            else:
                found = found & (low.isNotNull() if wanted[0] is None else high >= wanted[0]) & (low.isNotNull() if wanted[1] is None else low <= wanted[1])
    return found
