"""Token counts: byte-pair merging with a heap of adjacent pairs and a linked list of symbols.

The lowest-rank pair is merged again and again (leftmost first among equals); the count is the number of
initial symbols less the number of merges. No identifier is looked up. A word is counted once per worker and
remembered, whole texts are worked on in parts of bounded size, and there is no shuffle.

Defined results: null or empty text: 0 bytes, 0 tokens; a null doc_id stays null; repeated rows give repeated rows;
an empty table gives none; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidespan.llm.bpe_files import word_bpe
from tidespan.llm.memo import Memo, one_by_one
from tidespan.llm.tables import prepared, texts_of
from tidespan.llm.texts import Words, text_parts

COUNTED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def merged_count(symbols: list[str], ranks: dict[tuple[str, str], int]) -> int:
    """Symbols left when no adjacent pair has a rank."""
    n = len(symbols)
    after, before, sym = list(range(1, n + 1)), list(range(-1, n - 1)), list(symbols)
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((sym[i], sym[i + 1]))) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        rank, i = heapq.heappop(heap)
        j = after[i]
        if sym[i] is None or j == n or ranks.get((sym[i], sym[j])) != rank:
            continue  # one side has been merged meanwhile
        sym[i] += sym[j]
        sym[j] = None
        left -= 1
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get((sym[i], sym[k]))) is not None:
                heapq.heappush(heap, (r, i))
        if (h := before[i]) >= 0 and (r := ranks.get((sym[h], sym[i]))) is not None:
            heapq.heappush(heap, (r, h))
    return left


@functools.cache
def _counter(path: str) -> Memo:
    bpe = word_bpe(path)
    words: dict[str, int] = {}

    def of_word(word: str) -> int:
        if (n := words.get(word)) is None:
            if len(words) > 200_000:
                words.clear()
            n = words[word] = merged_count(bpe.symbols(word), bpe.ranks)
        return n

    return Memo(one_by_one(lambda chunk: [sum(1 if special else of_word(w) for special, w in bpe.pieces(chunk))]))


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every whole text, by the word-level BPE file at ``path``."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in batches:
            ids = batch.column(0)
            for at, data, offsets in text_parts(batch.column(1)):
                words = Words(data, offsets)
                counts, _ = counter.of(words)  # one number a word
                sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                rows = len(offsets) - 1
                yield pa.RecordBatch.from_arrays([ids.slice(at, rows), pa.array(np.diff(offsets)), pa.array(np.diff(sums[words.bounds]))], schema=COUNTED)

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")


def over_limit(counts: DataFrame, limit: int = 2048) -> DataFrame:
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
