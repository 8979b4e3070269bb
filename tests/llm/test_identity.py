"""Words built so that polynomial hashes agree on them: no operator may take one for the other."""

from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tests.llm import brute
from tests.llm.conftest import make
from tidespan.llm import bpe_codec, ngram_join, packing, quality, substring_dedup, token_count, wavelet
from tidespan.llm.queries import BYTE_BPE, BYTE_RANKS, BYTE_SPECIAL, WORD_BPE


def twins(n, letters):
    """The Thue-Morse word of n letters and its complement."""
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


@pytest.fixture(scope="module")
def rows():
    out = []
    for k, (n, letters) in enumerate(((1024, "aq"), (4096, "ae"), (1024, "xy"))):
        a, b = twins(n, letters)
        common = " ".join(f"w{k}x{i}" for i in range(19))
        out += [(10 * k + 1, a), (10 * k + 2, b), (10 * k + 3, f"{a}s"), (10 * k + 4, f"{b}s"), (10 * k + 5, f"{common} {a}"), (10 * k + 6, f"{common} {b}"), (10 * k + 7, f"{a}\n{b}\n{a}")]
    return out


def test_tokens(spark, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(WORD_BPE)
    words, df = Tokenizer.from_file(path), make(spark, rows)
    ids = {d: words.encode(t, add_special_tokens=False).ids for d, t in rows}
    assert {r.doc_id: r.n_tokens for r in token_count.token_counts(df, path).collect()} == {d: len(x) for d, x in ids.items()}
    assert {r.doc_id: list(r.ids) for r in bpe_codec.encode_documents(df, path).collect()} == ids
    values = [wavelet.from_file(bytes(r.payload)) for r in wavelet.shards(df, path, 2).orderBy("first_doc_id", "shard").collect()]
    assert np.concatenate([m.values() for _, _, m in values]).tolist() == [i for d, _ in sorted(rows) for i in [*ids[d], 2]]


def test_pieces(spark, rows):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))
    pieces = packing.token_pieces(make(spark, rows), public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, BYTE_SPECIAL).collect()
    got = defaultdict(bytes)
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.piece)):
        got[r.doc_id] += bytes(r.ids)
    assert got == {d: np.array([*known.encode(t, add_special_tokens=False).ids, 0], "<u4").tobytes() for d, t in rows}


def test_links_repeats_and_counts(spark, rows):
    df = make(spark, rows)
    assert Counter(map(tuple, ngram_join.linked_documents(df, 4, (85, 100)).collect())) == Counter(brute.components(rows, 4, 85, 100))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring_dedup.without_repeats(df, 20).collect()}
    assert got == {d: (len(w), len(w) - len(k), " ".join(k)) for d, w, k in brute.repeats(rows, 20)}
    assert {r.doc_id: tuple(r)[1:6] for r in quality.judged(df, None).collect()} == {d: brute.counts(t) for d, t in rows}
