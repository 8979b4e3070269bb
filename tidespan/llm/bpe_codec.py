"""BPE encoding and decoding by forced boundaries.

A pair of neighbouring bytes that stands inside no vocabulary token can never be merged over, so it marks a
certain cut. Every word is split at all such pairs, the fragments are encoded independently and the ids
concatenated. The table of pairs comes from the vocabulary alone (256 x 256 flags).

Defined results: null or empty text: no ids, and the empty text decoded; a null doc_id stays null; repeated rows
give repeated rows; an empty table gives none; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidespan.llm.bpe_files import WordBpe, word_bpe
from tidespan.llm.memo import Memo, one_by_one
from tidespan.llm.tables import prepared, texts_of
from tidespan.llm.texts import Words, text_parts

FRAGMENTS = 200_000


class Codec:
    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        byte_of = {c: b for b, c in bpe.letters.items()}
        #: joined[a, b]: byte b follows byte a inside some token
        self.joined = np.zeros((256, 256), bool)
        for token in bpe.vocab:
            whole = token.removesuffix(bpe.suffix) if token != bpe.suffix else token
            raw = [byte_of[c] for c in whole if c in byte_of]
            self.joined[raw[:-1], raw[1:]] = True
        self._pairs = {(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(self.joined)))}
        self._known: dict[tuple[bytes, bool], tuple[int, ...]] = {}

    def fragments(self, word: bytes) -> list[bytes]:
        cuts = [0, *(i for i in range(1, len(word)) if (word[i - 1], word[i]) not in self._pairs), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def _merge(self, fragment: bytes, last: bool) -> tuple[int, ...]:
        letters, ranks, vocab = self.bpe.letters, self.bpe.ranks, self.bpe.vocab
        sym = [letters[b] for b in fragment]
        if last:
            sym[-1] += self.bpe.suffix
        if len(sym) > 64:
            return self._merge_long(sym)
        while len(sym) > 1:
            found = [(r, i) for i, pair in enumerate(zip(sym, sym[1:])) if (r := ranks.get(pair)) is not None]
            if not found:
                break
            i = min(found)[1]
            sym[i:i + 2] = [sym[i] + sym[i + 1]]
        return tuple(vocab[s] for s in sym)

    def _merge_long(self, sym: list[str]) -> tuple[int, ...]:
        """All places of the lowest rank in one pass: long fragments stay near linear in each pass."""
        ranks = self.bpe.ranks
        while True:
            best = min((ranks.get(pair, 1 << 60) for pair in zip(sym, sym[1:])), default=1 << 60)
            if best == 1 << 60:
                return tuple(self.bpe.vocab[s] for s in sym)
            out, i = [], 0
            while i < len(sym):
                if i + 1 < len(sym) and ranks.get((sym[i], sym[i + 1])) == best:
                    out.append(sym[i] + sym[i + 1])
                    i += 2
                else:
                    out.append(sym[i])
                    i += 1
            sym = out

    def encode_word(self, word: bytes) -> list[int]:
        out: list[int] = []
        parts = self.fragments(word)
        for i, fragment in enumerate(parts):
            key = (fragment, i == len(parts) - 1)
            if (ids := self._known.get(key)) is None:
                if len(self._known) > FRAGMENTS:
                    self._known.clear()
                ids = self._known[key] = self._merge(*key)
            out += ids
        return out

    def encode_chunk(self, chunk: bytes) -> list[int]:
        out: list[int] = []
        for special, word in self.bpe.pieces(chunk):
            out += [self.bpe.special[word]] if special else self.encode_word(word.encode())
        return out

    def decode(self, ids: list[int]) -> str:
        """The file has no decoder, so its library joins the names of the ids with spaces."""
        names = self.bpe.names
        return " ".join([names[i] for i in ids])


@functools.cache
def codec(path: str) -> Codec:
    return Codec(word_bpe(path))


@functools.cache
def _remembered(path: str) -> Memo:
    return Memo(one_by_one(codec(path).encode_chunk))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids``, those of every whole text without begin or end."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _remembered(path)
        for batch in batches:
            for at, data, offsets in text_parts(batch.column(1)):
                words = Words(data, offsets)
                ids, before = table.of(words)
                lists = pa.ListArray.from_arrays(pa.array(before[words.bounds], pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(offsets) - 1), lists], names=["doc_id", "ids"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """The same rows with ``decoded``, the text of the ids, special ones included."""
    prepared(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = codec(path).bpe.names
        table = np.array([names.get(i, "") for i in range(max(names) + 1)], object)
        for batch in batches:
            lists = batch.column(1)
            flat, offsets = table[np.asarray(lists.values)], lists.offsets.to_numpy()
            texts = [" ".join(flat[a:b].tolist()) for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded string")
