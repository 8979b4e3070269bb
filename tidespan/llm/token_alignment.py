"""Alignment of two tokenizers over the same bytes, by pointer jumping, and corpus-wide statistics of aligned ids.

Tokens of both vocabularies are ranges of the bytes of a space and the text. Every token points to its farthest-right
overlapping token; squaring that map again and again (``successor[successor]``) leads each token to the terminal one of its
component, which ends where a token of the other vocabulary ends too. Terminals label the groups; tokens of both
sides whose ranges overlap are links.

No token crosses the border of a chunk (white space, then other characters), so components don't either, and a worker aligns
every distinct chunk once, all new chunks of a part together. Documents are counted per pair of linked ids: units of texts
count their own pairs, Spark sums them, finds the largest count of each left id, and joins the counts back to the units.

Defined results: null or empty text, or one that either vocabulary does not give back byte for byte: no tokens, all zeros and
an empty digest; special strings inside texts are plain text; a null doc_id stays null; repeated rows are documents of their own, each
counted; equal counts all are the best; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.llm.bpe_files import byte_letters
from tidespan.llm.memo import Memo, decimals, holding, joinable, split_together
from tidespan.llm.piece_model import NORMALIZER, _field
from tidespan.llm.tables import prepared, texts_of, written
from tidespan.llm.texts import Chunks, ragged, text_parts

#: Bytes of text whose pairs are counted together before they are sent.
UNIT_BYTES = 8_000_000
HEAD = 4
BAD = 1 << 31
AFTER = np.frombuffer(b",|;", np.uint8)
UNITS = "unit long, doc_id array<long>, counts binary, digests binary, held binary, at binary, times binary, pairs binary, pair_docs binary"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def groups_of(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the group of every left and every right token, from the places where they end (ascending, the same last one)."""
    n = len(a_end)
    over_a, over_b = np.searchsorted(b_end, a_end), np.searchsorted(a_end, b_end)  # the other token over each last byte
    # a left token ends at that right token's end or before it, so it points there; a right one that ends with a left one is terminal
    successor = np.concatenate([n + over_a, np.where(a_end[over_b] > b_end, over_b, n + np.arange(len(b_end)))]) if n else np.empty(0, np.int64)
    while True:
        further = successor[successor]
        if (further == successor).all():
            break
        successor = further
    terminal = np.zeros(len(successor), bool)
    terminal[successor] = True
    group = (np.cumsum(terminal) - 1)[successor]
    return group[:n], group[n:]


def links_of(a_end: np.ndarray, a_size: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(left token, right token) of all pairs whose ranges overlap."""
    first, last = np.searchsorted(b_end, a_end - a_size, "right"), np.searchsorted(b_end, a_end)
    n = last - first + 1
    return np.repeat(np.arange(len(a_end)), n), ragged(first, n)


class Vocabulary:
    """Ids of chunks by one tokenizer, and the bytes of every id."""

    uncut = b""

    def __init__(self, tokens: list[bytes]):
        if len(tokens) > 1 << 16:
            raise ValueError("a vocabulary of more than 16 bits")
        self.sizes = np.array(list(map(len, tokens)))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def encode(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def whole(self, ids: np.ndarray, n: np.ndarray, raw: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Chunks whose tokens give back their bytes."""
        size = self.sizes[ids]
        before = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
        good = np.diff(before) == lengths
        said, ends = self.bytes[ragged(self.starts[ids], size)], np.cumsum(lengths)
        which = np.flatnonzero(good)
        unlike = said[ragged(before[which], lengths[which])] != raw[ragged((ends - lengths)[which], lengths[which])]
        good[which[np.searchsorted(np.cumsum(lengths[which]), np.flatnonzero(unlike), "right")]] = False
        return good


class ByteLevel(Vocabulary):
    """Byte-level BPE from a tokenizers file whose merges are in the order of their ids."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, byte_of = spec["model"], {c: b for b, c in byte_letters().items()}
        special = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(map(byte_of.get, t)): i for t, i in model["vocab"].items() if t not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if model["type"] != "BPE" or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["normalizer"] or [model["vocab"][a + b] for a, b in merges] != list(range(256, 256 + len(merges))):
            raise ValueError(f"{path}: not a byte-level BPE file of the kind read here")
        super().__init__([t for t, _ in sorted(ranks.items(), key=lambda x: x[1])])
        self.known = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, raw, lengths):
        return split_together(raw, lengths, joinable(raw, lengths), self.sizes, lambda t: np.array(self.known.encode_ordinary(t), np.int64), self.known.encode_ordinary)


class Pieces(Vocabulary):
    """A sentencepiece model whose dummy prefix is switched off: the space before the text is given to it instead."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = f.read()
        self.known = sentencepiece.SentencePieceProcessor(model_proto=model + _field(NORMALIZER, _field(3, 0)))  # a later field wins
        names = [self.known.id_to_piece(i) for i in range(self.known.vocab_size())]
        spaced = [n.replace("▁", " ") for n in names]
        inner = {b for n in spaced for a, b in zip(n, n[1:]) if b.isspace() and not a.isspace()}
        if any(ord(c) > 32 for c in inner):
            raise ValueError(f"{path}: pieces hold white space behind other characters")
        self.uncut = "".join(inner).encode()  # no text is cut before these
        super().__init__([bytes([int(n[3:5], 16)]) if self.known.is_byte(i) else s.encode() for i, (n, s) in enumerate(zip(names, spaced))])

    def encode(self, raw, lengths):
        joins = joinable(raw, lengths) & ~holding(raw, lengths, b"\xe2\x96")  # U+2581 comes back as a space, so bytes can't be counted
        return split_together(raw, lengths, joins, self.sizes, lambda t: np.array(self.known.encode(t), np.int64), self.known.encode, 1 << 14)


class Aligner:
    """Runs of numbers for distinct chunks: left and right tokens, groups, links (the highest bit: not given back),
    then the linked pairs (left id << 16 | right id), then all tokens group by group, left ones first (id, and what stands behind it << 16)."""

    def __init__(self, left: Vocabulary, right: Vocabulary):
        self.left, self.right, self.memo = left, right, Memo(self.align)
        self.uncut = left.uncut + right.uncut

    def align(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        (a, n_a), (b, n_b) = self.left.encode(raw, lengths), self.right.encode(raw, lengths)
        bad = ~(self.left.whole(a, n_a, raw, lengths) & self.right.whole(b, n_b, raw, lengths))
        a, b = a[np.repeat(~bad, n_a)], b[np.repeat(~bad, n_b)]
        n_a, n_b = np.where(bad, 0, n_a), np.where(bad, 0, n_b)
        a_size = self.left.sizes[a]
        a_end, b_end = np.cumsum(a_size), np.cumsum(self.right.sizes[b])
        group_a, group_b = groups_of(a_end, b_end)
        from_a, to_b = links_of(a_end, a_size, b_end)
        rows = np.arange(len(lengths))
        row_a, row_b = np.repeat(rows, n_a), np.repeat(rows, n_b)
        n_links = np.bincount(row_a[from_a], minlength=len(rows))
        last = np.append(group_b[1:] != group_b[:-1], True)[:len(group_b)]
        n_groups = np.bincount(row_b[last], minlength=len(rows))
        side = np.concatenate([2 * group_a, 2 * group_b + 1])
        order = np.argsort(side, kind="stable")
        ends = np.append(side[order][1:] != side[order][:-1], True)[:len(side)]
        tokens = np.concatenate([a, b])[order] | np.where(ends, 1 + (side[order] & 1), 0) << 16
        sizes = HEAD + n_links + n_a + n_b
        out = np.empty(int(sizes.sum()), np.uint32)
        at = np.cumsum(sizes) - sizes
        for k, x in enumerate((n_a, n_b, n_groups, n_links | bad * BAD)):
            out[at + k] = x
        out[ragged(at + HEAD, n_links)] = a[from_a] << 16 | b[to_b]
        out[ragged(at + HEAD + n_links, n_a + n_b)] = tokens
        return out, sizes


@functools.cache
def aligner(left: str, pattern: str, right: str) -> Aligner:
    return Aligner(ByteLevel(left, pattern), Pieces(right))


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[bounds])


class Part:
    """The texts of a part: their counts and digests, and the distinct linked pairs of each with how often it has them."""

    def __init__(self, names: pa.Array, data: np.ndarray, offsets: np.ndarray, known: Aligner):
        full = np.flatnonzero(np.diff(offsets) > 0)
        data = np.insert(data, offsets[full], 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(np.diff(offsets) > 0)])
        chunks = Chunks(data, offsets, known.uncut)
        flat, before = known.memo.of(chunks)
        at, bounds = before[:-1], chunks.bounds
        n_a, n_b, n_groups, n_links = (flat[at + k].astype(np.int64) for k in range(HEAD))
        lost = _sums(n_links >= BAD, bounds) > 0  # no token of such a text counts
        n_links &= BAD - 1
        of_text = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
        for x in (n_a, n_b, n_groups, n_links):
            x[lost[of_text]] = 0
        start = at + HEAD + (flat[at + 3] & np.uint32(BAD - 1)).astype(np.int64)
        self.names = names
        self.counts = np.stack([_sums(x, bounds) for x in (n_a, n_b, n_groups, n_links)])
        tokens = flat[ragged(start, n_a + n_b)]
        said, places = decimals(tokens & np.uint32(0xFFFF), AFTER[tokens >> np.uint32(16)])
        cuts = places[np.concatenate([[0], np.cumsum(self.counts[0] + self.counts[1])])].tolist()
        self.digests = b"".join([hashlib.sha256(said[a:b - 1]).digest() if b > a else bytes(32) for a, b in zip(cuts, cuts[1:])])
        keys = np.sort(np.repeat(of_text, n_links).astype(np.uint64) << np.uint64(32) | flat[ragged(at + HEAD, n_links)])
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        self.pairs = keys[first].astype(np.uint32)
        self.times = np.diff(np.append(first, len(keys)))
        self.held = np.bincount((keys[first] >> np.uint64(32)).astype(np.int64), minlength=len(offsets) - 1)


def _planes(x: np.ndarray) -> bytes:
    """32-bit numbers as four planes of bytes; the upper ones are mostly zeros, which Parquet and the exchange pack."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def closed(unit: int, parts: list[Part]) -> pa.RecordBatch:
    """A unit: a row for each part, the pairs of all its texts and how many texts hold each on the first row."""
    every = np.concatenate([p.pairs for p in parts])
    pairs, at = np.unique(every, return_inverse=True)
    docs = np.bincount(at, minlength=len(pairs))
    rows, done = [], 0
    for p in parts:
        mine = at[done:done + len(p.pairs)]
        done += len(p.pairs)
        heads = (np.cumsum(p.held) - p.held)[p.held > 0]
        gaps = np.diff(mine, prepend=0)  # pairs of a text ascend; its first one is given as it is
        gaps[heads] = mine[heads]
        rows.append((p.names.to_pylist(), p.counts.astype("<i8").tobytes(), p.digests, _planes(p.held), _planes(gaps), _planes(p.times)))
    none = [None] * (len(rows) - 1)
    kinds = [pa.list_(pa.int64()), *[pa.binary()] * 5]
    columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(
        [pa.array([unit] * len(rows)), *columns, pa.array([pairs.astype("<u4").tobytes(), *none], pa.binary()), pa.array([docs.astype("<u4").tobytes(), *none], pa.binary())],
        names=["unit", "doc_id", "counts", "digests", "held", "at", "times", "pairs", "pair_docs"])


def aligned_units(docs: DataFrame, left: str, pattern: str, right: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of units. A unit's number holds that of its task, so it is unique; write the rows before they are joined."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = aligner(left, pattern, right)
        parts: list[Part] = []
        size = done = 0
        first = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, data, offsets in text_parts(batch.column(1)):
                parts.append(Part(batch.column(0).slice(at, len(offsets) - 1), data, offsets, known))
                size += len(data)
                if size >= UNIT_BYTES:
                    yield closed(first | done, parts)
                    parts, size, done = [], 0, done + 1
        if parts:
            yield closed(first | done, parts)

    return texts_of(docs, id_col, text_col).mapInArrow(run, UNITS)


def pair_rows(units: DataFrame) -> DataFrame:
    """(unit, pair, n): how many texts of the unit hold the pair linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for unit, pairs, docs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                pair, n = (np.frombuffer(x.as_py(), "<u4").astype(np.int64) for x in (pairs, docs))
                for a in range(0, len(pair), 1 << 16):
                    some = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair[some]), unit)), pa.array(pair[some]), pa.array(n[some])], names=["unit", "pair", "n"])

    return units.where("pairs IS NOT NULL").select("unit", "pairs", "pair_docs").mapInArrow(run, "unit long, pair long, n long")


def pair_counts(rows: DataFrame) -> DataFrame:
    """Corpus-wide: pair, ``count`` of the documents that hold it linked, and whether no pair of its left id has more."""
    counts = rows.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", 16))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def scored(units: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a unit with the sums over their links."""
    order = np.argsort(counts.column("pair").to_numpy())
    count, best = counts.column("count").to_numpy()[order], counts.column("best").to_numpy(zero_copy_only=False)[order]
    out: dict[str, list] = {c: [] for c in ("doc_id", "counts", "n_best", "count_sum", "groups_sha256")}
    for row in units.select(["doc_id", "counts", "digests", "held", "at", "times"]).to_pylist():
        tokens = np.frombuffer(row["counts"], "<i8").reshape(4, -1)
        held, gaps, times = _unplaned(row["held"]), _unplaned(row["at"]), _unplaned(row["times"])
        bounds = np.concatenate([[0], np.cumsum(held)])
        run = np.cumsum(gaps)
        heads = bounds[:-1][held > 0]
        run -= np.repeat(run[heads] - gaps[heads], held[held > 0])
        out["doc_id"].append(pa.array(row["doc_id"], pa.int64()))
        out["counts"].append(tokens)
        out["n_best"].append(_sums(times * best[run], bounds))
        out["count_sum"].append(_sums(times * count[run], bounds))
        has = (tokens[0] > 0).tolist()
        out["groups_sha256"] += [row["digests"][32 * i:32 * i + 32].hex() if x else "" for i, x in enumerate(has)]
    n_a, n_b, n_groups, n_links = np.concatenate(out["counts"], axis=1)
    return pa.table({
        "doc_id": pa.chunked_array(out["doc_id"]), "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links,
        "n_best": np.concatenate(out["n_best"]), "count_sum": np.concatenate(out["count_sum"]), "groups_sha256": pa.array(out["groups_sha256"], pa.string()),
    })


def aligned_documents(docs: DataFrame, left: str, pattern: str, right: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row a document: tokens of both sides, groups and links; how many links are the most frequent of their left id; the sum
    of the counts of all links; and the digest of the groups' ids."""
    units = written(aligned_units(docs, left, pattern, right, id_col, text_col), "aligned")
    rows = pair_rows(units)
    told = rows.select("unit", "pair").join(pair_counts(rows), "pair").select("unit", "pair", "count", "best")
    return units.drop("pairs", "pair_docs").groupBy("unit").cogroup(told.groupBy("unit")).applyInArrow(scored, ALIGNED)
