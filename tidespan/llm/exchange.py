"""Packed exchange of hashes between units of documents and slices of the hash range.

Documents are dealt to units (by a hash, so of even size); a unit sends every hash of its texts once, however often
it occurs there, packed with the others of the same slice: four bytes a hash. A slice sees who holds a hash
and answers the units. So a frequent window costs one number a unit, never one row an occurrence, and no task holds
more than a slice. Units and slices grow in number with the bytes of text, not in size. The part of a hash that tells
a slice and the 30 bits sent within it grow together, so chance agreements stay at a fixed rate at any size;
they may only cost work, never change a result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.llm.texts import U64

UNIT_BYTES = 6_000_000
SLICE_BYTES = 16_000_000
KEY_BITS = 30
SENT = "slice int, unit int, keys binary"


def count_of(total: int, each: int) -> int:
    return max(1, -(-total // each))


def with_units(docs: DataFrame, total: int) -> DataFrame:
    """``unit`` for every row of (doc_id, text, …); equal rows share one."""
    return docs.withColumn("unit", F.pmod(F.xxhash64("doc_id", "text"), F.lit(count_of(total, UNIT_BYTES))).cast("int"))


def codes(h: np.ndarray, slices: int) -> np.ndarray:
    """slice << 30 | key: the slice by the upper half of the hash, the key from the lower one."""
    at = (h >> U64(32)) * U64(slices) >> U64(32)
    return at << U64(KEY_BITS) | h & U64((1 << KEY_BITS) - 1)


def sent(unit: int, code: np.ndarray, flags: np.ndarray) -> pa.Table:
    """Rows for the slices, from sorted distinct codes with two bits of flags each."""
    at = (code >> U64(KEY_BITS)).astype(np.int32)
    keys = ((code & U64((1 << KEY_BITS) - 1)) << U64(2) | flags.astype(U64)).astype("<u4")
    starts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(at))
    return pa.table({
        "slice": pa.array(at[starts], pa.int32()), "unit": pa.array(np.full(len(starts), unit, np.int32)),
        "keys": pa.array([keys[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
    })


def received(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, unit, flags) of all rows of a slice in order of key, and where each key begins."""
    lists = [np.frombuffer(x.as_py(), "<u4") for x in table.column("keys")]
    units = np.repeat(table.column("unit").to_numpy(), [len(x) for x in lists])
    raw = np.concatenate(lists) if lists else np.empty(0, np.uint32)
    both = np.sort((raw >> 2).astype(U64) << U64(34) | units.astype(U64) << U64(2) | (raw & 3).astype(U64))
    key = (both >> U64(34)).astype(np.uint32)
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.empty(0, np.int64)
    return key, (both >> U64(2) & U64((1 << 32) - 1)).astype(np.int64), (both & U64(3)).astype(np.uint8), starts


def answered(slice_: int, key: np.ndarray, unit: np.ndarray, grade: np.ndarray) -> pa.Table:
    """Rows for the units: the codes that are told to them, with a grade each."""
    order = np.argsort(unit, kind="stable")
    key, unit, grade = key[order], unit[order], grade[order]
    starts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])) if len(unit) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(unit))
    return pa.table({
        "unit": pa.array(unit[starts], pa.int32()), "slice": pa.array(np.full(len(starts), slice_, np.int32)),
        "keys": pa.array([key[a:b].astype("<u4").tobytes() for a, b in zip(starts, ends)], pa.binary()),
        "grades": pa.array([grade[a:b].astype(np.uint8).tobytes() for a, b in zip(starts, ends)], pa.binary()),
    })


ANSWERED = "unit int, slice int, keys binary, grades binary"


class Told:
    """The answers to a unit: grade of a hash, 0 if nothing was said of it."""

    def __init__(self, table: pa.Table, slices: int):
        self.slices = slices
        lists = [np.frombuffer(k.as_py(), "<u4").astype(U64) | U64(s.as_py()) << U64(KEY_BITS) for s, k in zip(table.column("slice"), table.column("keys"))]
        grades = [np.frombuffer(g.as_py(), np.uint8) for g in table.column("grades")]
        code = np.concatenate(lists) if lists else np.empty(0, U64)
        order = np.argsort(code)
        self.code = code[order]
        self.grade = np.concatenate(grades)[order] if grades else np.empty(0, np.uint8)

    def grades(self, h: np.ndarray) -> np.ndarray:
        if not len(self.code):
            return np.zeros(len(h), np.uint8)
        code = codes(h, self.slices)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.grade[at], 0).astype(np.uint8)


def runs_of(starts: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
    return zip(starts.tolist(), [*starts[1:].tolist(), n])
