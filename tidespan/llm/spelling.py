"""Groups of spelling variants: words that differ by one code point from a much more frequent one.

The vocabulary is counted over all texts. Two words one error apart agree in the first or in the last half of either, so
each word is dealt to the groups of its halves, and a block of groups gets a bidirectional FM-index (``fm_index``): from either
half, matched exactly, the search runs over the other half and allows one error. Its cost follows the letters of a word and
the alphabet, not the words of a group; a group beyond ``GROUP`` words is dealt to several blocks which each of its words
visits. A word's form is its near word of the largest count if that is ``ratio`` times its own or more; forms are
followed to their end by joins of the table with itself, which double the way each time.

Defined results: null or empty text: no words; a null doc_id: an empty one in the hash; repeated rows count as often as
they occur; of near words with equal counts the smallest in code-point order is the form; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.llm.fm_index import STOP, Vocabulary
from tidespan.llm.tables import prepared, written
from tidespan.llm.texts import LOWER, _hashes, distinct, ragged, text_parts

#: Words of a block, and of a group that stays in one block.
BLOCK, GROUP = 100_000, 50_000
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
LEAD = 0xC3  # with one byte behind it U+00C0 to U+00FF, as the contract's words hold them

_CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    _CRC = np.where(_CRC & 1, _CRC >> 1 ^ np.uint32(0xEDB88320), _CRC >> 1)


class Runs:
    """Maximal runs of letters A-Z, a-z and U+00C0 to U+00FF with ``least`` code points or more; A-Z are lower-cased."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, least: int):
        lead = data == LEAD
        inside = LETTER[data] | lead
        inside[1:] |= lead[:-1]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        heads, tails = offsets[:-1][full], offsets[1:][full] - 1
        first[heads], last[tails] = inside[heads], inside[tails]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        points = ends - starts
        points -= np.diff(np.concatenate([[0], np.cumsum(lead)])[np.stack([starts, ends])], axis=0)[0]
        long = points >= least
        self.data = LOWER[data]
        self.starts, self.ends, self.points = starts[long], ends[long], points[long]
        n = self.ends - self.starts
        self.hash = _hashes(self.data[ragged(self.starts, n)], np.cumsum(n) - n, n)
        self.row = np.searchsorted(offsets, self.starts, "right") - 1

    def crc32(self, before: np.ndarray) -> np.ndarray:
        """Checksum of what stands before each text's words (as its own checksum) and the word; byte by byte for all words at once."""
        lengths = self.ends - self.starts
        order = np.argsort(-lengths, kind="stable")
        lengths, starts = lengths[order], self.starts[order]
        state = ~before[self.row[order]]
        for k in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -k, "left"))  # those with more than k bytes
            state[:n] = _CRC[(state[:n] ^ self.data[starts[:n] + k]) & np.uint32(255)] ^ state[:n] >> np.uint32(8)
        out = np.empty_like(state)
        out[order] = ~state
        return out


def counted(names: list[int | None], data: np.ndarray, offsets: np.ndarray, least: int, slip: int | None) -> pa.RecordBatch:
    """(word, n) of a part. With ``slip`` a word whose hash it divides loses one code point first."""
    runs = Runs(data, offsets, least)
    kept, more = np.ones(len(runs.starts), bool), Counter()
    if slip and len(runs.starts):
        before = np.array([zlib.crc32(b"%d:" % d if d is not None else b":") for d in names], np.uint32)
        h = runs.crc32(before)
        kept = h % np.uint32(slip) != 0
        for i in np.flatnonzero(~kept & (runs.points > least)).tolist():
            word = runs.data[runs.starts[i]:runs.ends[i]].tobytes().decode()
            at = int(h[i]) % len(word)
            more[word[:at] + word[at + 1:]] += 1
    codes, first = distinct(runs)
    n = np.bincount(codes[kept], minlength=len(first))
    seen = np.flatnonzero(n)
    first, n = first[seen], n[seen]
    size = runs.ends[first] - runs.starts[first]
    raw = runs.data[ragged(runs.starts[first], size)]
    words = pa.StringArray.from_buffers(len(first), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(raw))
    return pa.RecordBatch.from_arrays([pa.concat_arrays([words, pa.array(list(more), pa.string())]), pa.array(np.append(n, list(more.values())).astype(np.int64))], names=["word", "n"])


def word_counts(docs: DataFrame, least_points: int = 6, least_count: int = 5, slip: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n over all texts."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            for at, data, offsets in text_parts(batch.column(1)):
                yield counted(names[at:at + len(offsets) - 1], data, offsets, least_points, slip)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def halves(words: DataFrame) -> DataFrame:
    """A row for each group a word belongs to: ``half`` (which one and its text), ``block`` of a large group, whether the
    word stands in the index of that block (``held``) and whether it is searched for there (``asks``).

    A word of m code points is searched for from its first m // 2 and from its last m - m // 2; near words have
    one code point more or less, so each stands in the groups of the halves of those lengths too.
    """
    m = F.char_length("word")
    lengths = F.array_distinct(F.array((m - 1).cast("int"), m.cast("int"), (m + 1).cast("int")))
    keys = F.array_distinct(F.concat(
        F.transform(lengths, lambda x: F.concat(F.lit("<"), F.substring("word", F.lit(1), F.floor(x / 2).cast("int")))),
        F.transform(lengths, lambda x: F.concat(F.lit(">"), F.expr("reverse(word)").substr(F.lit(1), F.ceil(x / 2).cast("int"))))))
    asked = F.array(F.concat(F.lit("<"), F.col("word").substr(F.lit(1), F.floor(m / 2).cast("int"))), F.concat(F.lit(">"), F.expr("reverse(word)").substr(F.lit(1), F.ceil(m / 2).cast("int"))))
    rows = words.select("word", "n", F.explode(keys).alias("half"), asked.alias("asked")).withColumn("asks", F.array_contains("asked", F.col("half"))).drop("asked")
    large = rows.groupBy("half").count().where(F.col("count") > GROUP).select("half", F.ceil(F.col("count") / GROUP).cast("int").alias("blocks"))
    rows = rows.join(large, "half", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.expr("pmod(xxhash64(word), blocks)").cast("int"))
    rows = rows.withColumn("block", F.explode(F.when(F.col("asks"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("own"))))
    return rows.select("half", "block", "word", "n", (F.col("block") == F.col("own")).alias("held"), "asks")


def searched(table: pa.Table) -> pa.RecordBatch:
    """For every word searched for in the block: word, how many near words its groups hold, the largest of their counts
    negated and, of those, the smallest word."""
    held, asks = (table.column(c).to_numpy(zero_copy_only=False) for c in ("held", "asks"))
    words = table.column("word").combine_chunks().dictionary_encode()
    word, spelled = words.indices.to_numpy(), np.array(words.dictionary.to_pylist(), object)
    half = table.column("half").combine_chunks().dictionary_encode()
    group = half.indices.to_numpy().astype(np.int64) << 32 | table.column("block").to_numpy()
    _, group = np.unique(group, return_inverse=True)
    back = np.array([h[0] == ">" for h in half.dictionary.to_pylist()], bool)[half.indices.to_numpy()]
    count = np.zeros(len(spelled), np.int64)
    count[word] = table.column("n").to_numpy()

    text = np.frombuffer("".join(spelled).encode("utf-32-le"), "<u4")
    lengths = np.fromiter(map(len, spelled), np.int64, len(spelled))
    letters, symbols = np.unique(text, return_inverse=True)
    if len(letters) > 250:
        raise ValueError("an alphabet of more than 250 letters")
    symbols = (symbols + STOP + 1).astype(np.uint8)
    starts = np.cumsum(lengths) - lengths
    index = Vocabulary(symbols, lengths)
    mirrored = symbols[np.repeat(2 * starts + lengths - 1, lengths) - np.arange(len(symbols))]  # every word from its end

    members = np.sort(group[held] << 32 | word[held])
    found: list[np.ndarray] = []
    for column, turned, some in ((index.right, symbols, np.flatnonzero(asks & ~back)), (index.left, mirrored, np.flatnonzero(asks & back))):
        who = word[some]
        m = lengths[who]
        n = m // 2 if column is index.right else m - m // 2
        groups, first, of = np.unique(group[some], return_index=True, return_inverse=True)  # the words of a group share the half
        half_at = index.exact(column, turned[ragged(starts[who[first]], n[first])], n[first])
        rest = turned[ragged(starts[who] + n, m - n)]
        q, near = index.one_error(column, half_at.take(of), rest, m - n)
        pairs = np.unique(q << 32 | near)
        q, near = pairs >> 32, pairs & 0xFFFFFFFF
        key = group[some[q]] << 32 | near
        mine = members[np.minimum(np.searchsorted(members, key), len(members) - 1)] == key if len(members) else np.zeros(len(key), bool)
        if column is index.left:  # a near word that shares the first half too was found from there
            mine &= ~np.array([spelled[b].startswith(spelled[a][:len(spelled[a]) // 2]) for a, b in zip(who[q].tolist(), near.tolist())], bool)
        found.append(np.stack([who[q[mine]], near[mine]]))
    q, near = np.concatenate(found, axis=1)
    place = np.empty(len(spelled), np.int64)
    place[np.argsort(spelled.astype(str), kind="stable")] = np.arange(len(spelled))  # by code points
    order = np.lexsort((place[near], -count[near], q))
    q, near = q[order], near[order]
    head = np.flatnonzero(np.append(True, q[1:] != q[:-1])) if len(q) else np.empty(0, np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(spelled[q[head]], pa.string()), pa.array(np.diff(np.append(head, len(q)))), pa.array(-count[near[head]]), pa.array(spelled[near[head]], pa.string())],
        names=["word", "n_near", "less", "near"])


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, ``less`` (the largest count of its near words, negated), ``near`` (the first near word of that count);
    one row for each block in which a word has near words."""
    prepared(words.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, last = 0, None
        for batch in batches:
            ends = _group_ends(batch)
            if last is not None and batch.num_rows and _key(batch, 0) != last and size >= BLOCK:
                yield searched(pa.Table.from_batches(held))
                held, size = [], 0
            at = 0
            for end in ends:
                if size + end - at >= BLOCK:
                    held.append(batch.slice(at, end - at))
                    yield searched(pa.Table.from_batches(held))
                    held, size, at = [], 0, end
            if at < batch.num_rows:
                held.append(batch.slice(at))
                size += batch.num_rows - at
            last = _key(batch, batch.num_rows - 1) if batch.num_rows else last
        if size:
            yield searched(pa.Table.from_batches(held))

    rows = halves(words).repartition("half", "block").sortWithinPartitions("half", "block")
    return rows.mapInArrow(run, "word string, n_near long, less long, near string")


def _key(batch: pa.RecordBatch, i: int) -> tuple:
    return batch.column(0)[i].as_py(), batch.column(1)[i].as_py()


def _group_ends(batch: pa.RecordBatch) -> list[int]:
    """Rows behind which another group begins inside the batch."""
    half, block = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
    return (np.flatnonzero((half[1:] != half[:-1]) | (block[1:] != block[:-1])) + 1).tolist()


def variant_groups(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, n, n_near, form, form_n, root for a table of distinct words with their counts (read several times: hand in a written one)."""
    none = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("less"), F.lit(None).cast("string").alias("near"))
    found = near_words(words).select("word", F.lit(None).cast("long").alias("n"), "n_near", "less", "near")
    best = none.union(found).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min(F.when(F.col("less").isNotNull(), F.struct("less", "near"))).alias("b"))
    strong = -F.col("b.less") >= ratio * F.col("n")
    best = written(best.select("word", "n", "n_near", F.when(strong, F.col("b.near")).alias("form"), F.when(strong, -F.col("b.less")).alias("form_n")), "near-words")
    return _rooted(best)


def _rooted(best: DataFrame) -> DataFrame:
    """``root``: counts grow along forms, so their chains end; the way is doubled until no word has further to go."""
    forms = best.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = written(forms.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        forms = joined.select("word", "root")
        if joined.where("moved").isEmpty():
            break
    return best.join(forms, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, least_points: int = 6, least_count: int = 5, ratio: int = 5, slip: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``variant_groups`` of the words of all texts."""
    return variant_groups(written(word_counts(docs, least_points, least_count, slip, id_col, text_col), "vocabulary"), ratio)
