"""Byte-level BPE by a sentencepiece model that is serialised directly from the vocabulary.

Every token of a rank file becomes a piece: its bytes mapped to printable letters, its score the negative rank. With a
normalisation that changes nothing, no dummy prefix and no escaped white space, sentencepiece then merges the adjacent
pair of the lowest rank first, leftmost among equals, which is the rule of the rank file. Texts are cut by the pattern, pre-tokens
mapped and encoded, ids decoded by the inverse mapping. Each distinct chunk of a text is encoded once per worker.

Defined results: null or empty text: no ids, and no decoded bytes; special strings inside texts are plain text; a null doc_id stays null;
repeated rows give repeated rows; an empty table gives none; other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tidespan.llm.bpe_files import byte_letters, rank_file
from tidespan.llm.memo import Memo, decimals, joinable
from tidespan.llm.tables import prepared, texts_of
from tidespan.llm.texts import Chunks, ragged, text_parts

# fixed values of the model file format: field numbers, kinds of pieces, kind of model
PIECE, TRAINER, NORMALIZER = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
BPE = 2


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: bytes | int) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    return _field(PIECE, _field(1, text.encode()) + _varint(2 << 3 | 5) + struct.pack("<f", score) + _field(3, kind))


def serialised(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model file of the vocabulary; the id of a piece is its rank, the unknown piece comes behind all."""
    if sorted(ranks.values()) != list(range(len(ranks))) or len(ranks) >= 1 << 24:
        raise ValueError("ranks must run from 0 on without a gap, below what a score holds exactly")
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("every single byte must be a token")
    letters = byte_letters()
    order = sorted(ranks, key=ranks.get)
    pieces = b"".join(_piece("".join(map(letters.get, t)), -float(r), NORMAL) for r, t in enumerate(order))
    trainer = _field(3, BPE) + _field(4, len(ranks) + 1) + _field(40, len(ranks))  # kind of model, size, id of the unknown piece
    normalizer = _field(1, b"identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)  # no prefix, nothing removed, nothing escaped
    return pieces + _piece("<unk>", 0.0, UNKNOWN) + _field(TRAINER, trainer) + _field(NORMALIZER, normalizer)


class PieceCodec:
    """Encodes chunks of texts with the serialised model, decodes ids with the inverse mapping of its pieces."""

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised(rank_file(path)))
        self.letters = byte_letters()
        byte_of = {c: b for b, c in self.letters.items()}
        tokens = [bytes(map(byte_of.get, self.model.id_to_piece(i))) for i in range(self.model.vocab_size() - 1)]
        self.sizes = np.array(list(map(len, tokens)))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.find = regex.compile(pattern).findall
        self.memo = Memo(self.encode)

    def encode(self, raw: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks: pre-tokens by the pattern, each encoded by itself."""
        ends = np.cumsum(lengths)
        whole, side = raw.tobytes(), joinable(raw, lengths)
        cut: list[str] = []
        upto = np.zeros(len(lengths), np.int64)  # pre-tokens up to the end of each chunk
        # chunks next to each other whose borders no match crosses are cut by one search
        breaks = np.flatnonzero(~(side[1:] & side[:-1])) + 1
        for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), len(lengths)]):
            found = self.find(whole[ends[a] - lengths[a]:ends[b - 1]].decode())
            if b - a > 1:
                sizes = np.cumsum([len(x) if x.isascii() else len(x.encode()) for x in found])
                upto[a:b] = len(cut) + np.searchsorted(sizes, ends[a:b] - ends[a] + lengths[a]) + 1
            else:
                upto[a] = len(cut) + len(found)
            cut += found
        number = {x: i for i, x in enumerate(dict.fromkeys(cut))}
        mapped = "".join(number).encode().decode("latin-1").translate(self.letters)  # a letter for each byte
        stops = np.cumsum([len(x) if x.isascii() else len(x.encode()) for x in number]).tolist()
        ids = self.model.encode([mapped[a:b] for a, b in zip([0, *stops], stops)], num_threads=1)
        which = np.fromiter(map(number.__getitem__, cut), np.int64, len(cut))
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.uint32, int(size.sum()))
        before = np.concatenate([[0], np.cumsum(size[which])])[np.concatenate([[0], upto])]
        return flat[ragged((np.cumsum(size) - size)[which], size[which])], np.diff(before)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
        """(bytes of all texts one after the other, where each begins and the last ends); ``bounds`` are those of ids."""
        size = self.sizes[ids]
        return self.bytes[ragged(self.starts[ids], size)].tobytes(), np.concatenate([[0], np.cumsum(size)])[bounds]


@functools.cache
def codec(path: str, pattern: str) -> PieceCodec:
    return PieceCodec(path, pattern)


def _encoded(batches: Iterator[pa.RecordBatch], known: PieceCodec) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """(doc_id, ids, bounds of each text's ids) by parts."""
    for batch in batches:
        for at, data, offsets in text_parts(batch.column(1)):
            chunks = Chunks(data, offsets)
            ids, before = known.memo.of(chunks)
            yield batch.column(0).slice(at, len(offsets) - 1), ids, before[chunks.bounds]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and ``ids`` of every whole text, by the rank file at ``path``."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, ids, bounds in _encoded(batches, codec(path, pattern)):
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([names, lists], names=["doc_id", "ids"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ``decoded``, the bytes that the ids stand for."""
    prepared(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            offsets = lists.offsets.to_numpy()
            raw, at = codec(path, pattern).decode(np.asarray(lists.values)[offsets[0]:offsets[-1]], offsets - offsets[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([raw[a:b] for a, b in zip(at.tolist(), at[1:].tolist())], pa.binary())], names=["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def round_trips(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and digests of the ids (decimal, joined by spaces) and of the bytes decoded from them."""
    prepared(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = codec(path, pattern)
        for names, ids, bounds in _encoded(batches, known):
            said, places = decimals(ids, np.full(len(ids), 0x20, np.uint8))
            decoded, ends = known.decode(ids, bounds)
            at = places[bounds].tolist()
            digest = [hashlib.sha256(said[a:max(a, b - 1)]).hexdigest() for a, b in zip(at, at[1:])]
            back = [hashlib.sha256(decoded[a:b]).hexdigest() for a, b in zip(ends.tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([names, pa.array(np.diff(bounds)), pa.array(digest, pa.string()), pa.array(back, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
