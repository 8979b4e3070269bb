"""Removal of repeated passages, by fixed-block anchors.

A window of ``window`` words holds, wherever it stands in a text, a whole block of ``window // 2`` words that begins at
a multiple of that number. So the blocks of all texts are the reference index, and every rolling run of as many
words probes it. A hit that occurs elsewhere too anchors a possible repeat: the words around it, as far as a window with that anchor
reaches, are compared by window, which extends the anchors to maximal repeats of ``window`` words or more.
A window is removed if its word sequence starts earlier: in a smaller doc_id, or before in the same document.

Three passes over the documents of a unit, and two exchanges (see ``exchange``): probes with the index, then the
windows around anchors with the place of their first occurrence in the unit. Windows agree by 64-bit hashes of their words.

Defined results: null text: none, as an empty one; texts shorter than a window lose nothing; rows of one doc_id count as
one document and go by start, then by text; null doc_ids come before all others; an equal row loses all that its first copy keeps; an empty
table gives none; other columns are carried along and may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidespan.llm.exchange import ANSWERED, SENT, SLICE_BYTES, Told, answered, codes, count_of, received, sent, with_units
from tidespan.llm.tables import prepared, total_bytes
from tidespan.llm.texts import U64, Words, rolling, text_parts

FIRST = -(1 << 63)
PLACES = "slice int, unit int, hashes binary, docs binary, starts binary"


class Unit:
    """The texts of a unit in order of doc_id and text: hashes of rolling runs of words, with their text."""

    def __init__(self, table: pa.Table):
        order = pa.compute.sort_indices(table, sort_keys=[("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")
        self.table = table.take(order)
        self.doc_ids = self.table.column("doc_id").fill_null(FIRST).to_numpy()
        self.parts = list(text_parts(self.table.column("text")))

    def windows(self, k: int, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text, start) of all runs of k words inside one text."""
        hashes, rows, starts = [], [], []
        for at, data, offsets in self.parts:
            words = Words(data, offsets)
            h = rolling(words.hash, k, salt)
            sizes = np.diff(words.bounds)
            row = np.repeat(np.arange(len(sizes)), sizes)
            start = np.arange(len(row)) - words.bounds[row]
            ok = np.flatnonzero(start + k <= sizes[row])
            hashes.append(h[ok])
            rows.append(row[ok] + at)
            starts.append(start[ok])
        return np.concatenate(hashes), np.concatenate(rows), np.concatenate(starts)


def probes(unit: int, table: pa.Table, block: int, slices: int) -> pa.Table:
    h, _, start = Unit(table).windows(block, 1)
    code = np.sort(codes(h, slices) << U64(1) | (start % block == 0).astype(U64))
    last = np.append(code[1:] >> U64(1) != code[:-1] >> U64(1), True) if len(code) else np.empty(0, bool)
    first = np.append(True, last[:-1])[:len(code)]
    many = ~(first & last)[last] if len(code) else last
    code = code[last]  # an anchor sorts behind other occurrences of the same run
    return sent(unit, code >> U64(1), (code & U64(1)).astype(np.uint8) << 1 | many)


def anchors(slice_: int, table: pa.Table) -> pa.Table:
    key, unit, flags, starts = received(table)
    if not len(key):
        return answered(slice_, key, unit, flags)
    sizes = np.diff(np.append(starts, len(key)))
    often = np.add.reduceat(1 + (flags & 1).astype(np.int64), starts) > 1
    hit = np.repeat(often & (np.maximum.reduceat(flags, starts) >= 2), sizes)
    return answered(slice_, key[hit], unit[hit], np.ones(int(hit.sum()), np.uint8))


def candidates(unit: int, texts: pa.Table, told: pa.Table, window: int, block: int, slices: int) -> pa.Table:
    """First occurrence in the unit of every window that holds an anchor."""
    u, hits = Unit(texts), Told(told, slices)
    h, row, start = u.windows(block, 1)
    hit = np.concatenate([[0], np.cumsum(hits.grades(h) > 0)])
    # runs of one text are consecutive, so a window holds those from its own place to window - block behind it
    wide, wide_row, wide_start = u.windows(window, 2)
    first_of = np.searchsorted(row, np.arange(u.table.num_rows))
    at = first_of[wide_row] + wide_start
    near = hit[at + window - block + 1] > hit[at]
    wide, wide_row, wide_start = wide[near], wide_row[near], wide_start[near]
    order = np.lexsort((wide_start, u.doc_ids[wide_row], wide))
    wide, wide_row, wide_start = wide[order], wide_row[order], wide_start[order]
    first = np.append(True, wide[1:] != wide[:-1])[:len(wide)]
    wide, docs, wide_start = wide[first], u.doc_ids[wide_row[first]], wide_start[first]
    at = ((wide >> U64(32)) * U64(slices) >> U64(32)).astype(np.int32)
    cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(at))
    return pa.table({
        "slice": pa.array(at[cuts], pa.int32()), "unit": pa.array(np.full(len(cuts), unit, np.int32)),
        "hashes": pa.array([wide[a:b].astype("<u8").tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        "docs": pa.array([docs[a:b].astype("<i8").tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        "starts": pa.array([wide_start[a:b].astype("<i8").tobytes() for a, b in zip(cuts, ends)], pa.binary()),
    })


def earlier(table: pa.Table) -> pa.Table:
    """For each unit the windows of a slice that start earlier in another unit."""
    def column(name: str, kind: str) -> np.ndarray:
        return np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)]) if table.num_rows else np.empty(0, kind)

    h, doc, start = column("hashes", "<u8"), column("docs", "<i8"), column("starts", "<i8")
    unit = np.repeat(table.column("unit").to_numpy(), [len(x.as_py()) // 8 for x in table.column("hashes")])
    order = np.lexsort((unit, start, doc, h))
    late = ~np.append(True, h[order][1:] != h[order][:-1])[:len(h)]
    h, unit = h[order][late], unit[order][late]
    order = np.argsort(unit, kind="stable")
    h, unit = h[order], unit[order]
    cuts = np.flatnonzero(np.append(True, unit[1:] != unit[:-1])) if len(unit) else np.empty(0, np.int64)
    ends = np.append(cuts[1:], len(unit))
    return pa.table({"unit": pa.array(unit[cuts], pa.int32()), "hashes": pa.array([h[a:b].astype("<u8").tobytes() for a, b in zip(cuts, ends)], pa.binary())})


def covered(u: Unit, told: pa.Table, window: int) -> list[np.ndarray]:
    """For each part of the unit a flag a word: inside a window that starts earlier."""
    h, row, start = u.windows(window, 2)
    foreign = np.unique(np.concatenate([np.empty(0, U64), *(np.frombuffer(x.as_py(), "<u8") for x in told.column("hashes"))]))
    removed = np.zeros(len(h), bool)
    if len(foreign):
        at = np.minimum(np.searchsorted(foreign, h), len(foreign) - 1)
        removed = foreign[at] == h
    # within the unit: all but the first by (doc_id, start); of rows with one doc_id and start, all but the first row
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    again = np.zeros(len(h), bool)
    if same.any():
        runs = np.flatnonzero(np.append(same, False) | np.append(False, same))
        members = order[runs]
        members = members[np.lexsort((row[members], start[members], u.doc_ids[row[members]], h[members]))]
        again[members[1:][h[members[1:]] == h[members[:-1]]]] = True
    removed |= again
    out, first_row = [], 0
    for at, data, offsets in u.parts:
        words = Words(data, offsets)
        n = len(offsets) - 1
        mine = removed & (row >= at) & (row < at + n)
        begin = words.bounds[row[mine] - at] + start[mine]
        edge = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + window, -1)
        out.append(np.cumsum(edge)[:-1] > 0)
        first_row += n
    return out


def kept_text(words: Words, i: int, gone: np.ndarray) -> str:
    """The text with the removed words and the white space after each cut out; as it was if none is."""
    s = words.of(i)
    starts, ends, out = words.starts[s], words.ends[s], gone[s]
    keep = np.flatnonzero(~out)
    raw = words.data
    stops = np.append(starts[1:], ends[-1:])
    return b"".join(raw[a:b].tobytes() for a, b in zip(starts[keep], stops[keep])).decode().rstrip(" \t\n\v\f\r")


def without_repeats(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text", joined: bool = True) -> DataFrame:
    """All rows: columns of the input in ``row`` (a struct), ``n_words``, ``n_removed`` and ``kept``: the kept words
    joined by one space, or with ``joined=False`` the text with the repeats cut out (untouched where none are)."""
    prepared(docs.sparkSession)
    block = window // 2
    others = [c for c in docs.columns if c not in (id_col, text_col)]
    rest = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("none"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(text_col).isNull().alias("no_text"), rest.alias("rest"))
    total = total_bytes(docs, text_col)
    slices = count_of(total, SLICE_BYTES)
    units = with_units(rows, total)

    def probe(key, table):
        return probes(key[0].as_py(), table, block, slices)

    def anchor(key, table):
        return anchors(key[0].as_py(), table)

    def candidate(key, texts, told):
        if not texts.num_rows or not told.num_rows:
            return pa.table({"slice": pa.array([], pa.int32()), "unit": pa.array([], pa.int32()), **{c: pa.array([], pa.binary()) for c in ("hashes", "docs", "starts")}})
        return candidates(key[0].as_py(), texts, told, window, block, slices)

    def remove(key, texts, told):
        u = Unit(texts)
        n_words, n_removed, kept = [], [], []
        for (at, data, offsets), gone in zip(u.parts, covered(u, told, window)):
            words = Words(data, offsets)
            lost = np.concatenate([[0], np.cumsum(gone)])
            n_words.append(np.diff(words.bounds))
            n_removed.append(np.diff(lost[words.bounds]))
            if joined:
                kept += joined_words(words, gone)
            else:
                kept += [kept_text(words, i, gone) if n else data[offsets[i]:offsets[i + 1]].tobytes().decode() for i, n in enumerate(n_removed[-1].tolist())]
        t = u.table
        empty = np.empty(0, np.int64)
        return pa.table({
            "doc_id": t.column("doc_id"), "no_text": t.column("no_text"), "rest": t.column("rest"), "n_words": pa.array(np.concatenate([empty, *n_words])),
            "n_removed": pa.array(np.concatenate([empty, *n_removed])), "kept": pa.array(kept, pa.string()),
        })

    hits = units.groupBy("unit").applyInArrow(probe, SENT).groupBy("slice").applyInArrow(anchor, ANSWERED)
    texts = units.groupBy("unit")
    places = texts.cogroup(hits.groupBy("unit")).applyInArrow(candidate, PLACES)
    late = places.groupBy("slice").applyInArrow(lambda key, table: earlier(table), "unit int, hashes binary")
    schema = StructType([
        StructField("doc_id", LongType()), StructField("no_text", BooleanType()), StructField("rest", units.schema["rest"].dataType),
        StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType()),
    ])
    return units.groupBy("unit").cogroup(late.groupBy("unit")).applyInArrow(remove, schema)


def joined_words(words: Words, gone: np.ndarray) -> list[str]:
    """Kept words of every text, joined by one space."""
    lengths = words.ends - words.starts
    keep = ~gone
    sizes = np.where(keep, lengths + 1, 0)
    before = np.concatenate([[0], np.cumsum(sizes)])
    starts, lengths = words.starts[keep], lengths[keep]
    places = np.arange(int(lengths.sum())) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    out = np.full(int(before[-1]), 0x20, np.uint8)
    to = np.arange(len(places)) + np.repeat(np.arange(len(lengths)), lengths)
    out[to] = words.data[places]
    raw, at = out.tobytes(), before[words.bounds].tolist()
    return [raw[a:max(a, b - 1)].decode() for a, b in zip(at, at[1:])]


def deduplicated(docs: DataFrame, window: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input's columns, with the repeats cut out of the text; a null text stays null."""
    found = without_repeats(docs, window, id_col, text_col, joined=False)
    others = {c: F.col("rest").getField(c) for c in docs.columns if c not in (id_col, text_col)}
    text = F.when(~F.col("no_text"), F.col("kept"))
    return found.select(*[F.col("doc_id").alias(c) if c == id_col else text.alias(c) if c == text_col else others[c].alias(c) for c in docs.columns])
