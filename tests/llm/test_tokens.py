"""Token counts, encoding and decoding, packing and wavelet shards against the tokenizers library and brute force."""

import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tests.llm import brute
from tidespan.llm import bpe_codec, packing, token_count, wavelet
from tidespan.llm.queries import BYTE_BPE, BYTE_RANKS, BYTE_SPECIAL, WORD_BPE

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
WORDS = public_tokenizers.path(WORD_BPE)


@pytest.fixture(scope="module")
def by_words():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def by_bytes():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(BYTE_BPE))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_counts(odd, odd_rows, by_words):
    got = Counter(map(tuple, token_count.token_counts(odd, WORDS).collect()))
    assert got == Counter((d, len((t or "").encode()), len(ids_of(by_words, t))) for d, t in odd_rows)


def test_heap_merges_leftmost_of_equal_ranks():
    assert token_count.merged_count(list("aaa"), {("a", "a"): 0, ("aa", "a"): 1}) == 1
    assert token_count.merged_count(list("abc"), {("b", "c"): 0, ("a", "b"): 1}) == 2
    assert token_count.merged_count(["a"], {}) == 1


def test_codec(odd, odd_rows, by_words):
    rows = bpe_codec.decode_documents(bpe_codec.encode_documents(odd, WORDS), WORDS).collect()
    want = Counter((d, tuple(x := ids_of(by_words, t)), by_words.decode(x, skip_special_tokens=False)) for d, t in odd_rows)
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in rows) == want


def test_forced_boundaries(by_words):
    codec = bpe_codec.codec(WORDS)
    cut = codec.fragments("naïve中文x".encode())
    assert b"".join(cut) == "naïve中文x".encode() and len(cut) > 1
    long = "tak" * 500
    assert codec.encode_word(long.encode()) == ids_of(by_words, long)


@pytest.mark.parametrize("seed", range(6))
def test_best_fit_is_the_plain_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 2048])
    sizes = [rng.randint(1, capacity if seed % 2 else capacity // 2) for _ in range(400)]
    runs = packing.best_fit_decreasing(Counter(sizes), capacity)
    filled, placed = defaultdict(list), Counter()
    for size, rank, per, first, offset, n in runs_of(runs, Counter(sizes)):
        for j in range(n):
            filled[first + j // per].append((offset + j % per * size, size))
            placed[size] += 1
    assert placed == Counter(sizes)
    for parts in filled.values():
        at = 0
        for o, s in sorted(parts):
            assert o == at
            at += s
        assert at <= capacity
    count, rooms = brute.best_fit(sizes, capacity)
    assert (len(filled), sorted(capacity - sum(s for _, s in p) for p in filled.values())) == (count, rooms)


def runs_of(runs, counts):
    rows = sorted(zip(*(runs[c].tolist() for c in ("size", "rank", "per", "sequence", "offset"))))
    for i, r in enumerate(rows):
        end = rows[i + 1][1] if i + 1 < len(rows) and rows[i + 1][0] == r[0] else counts[r[0]]
        yield (*r, end - r[1])


def test_segment_tree():
    tree = packing.Capacities(100)
    for room in (3, 64, 65, 100):
        tree.set(room, True)
    assert [tree.tightest(s) for s in (1, 3, 4, 64, 65, 66, 100)] == [3, 3, 64, 64, 65, 100, 100]
    tree.set(100, False)
    assert tree.tightest(66) is None


def test_packed_pieces(spark, odd, odd_rows, by_bytes):
    args = (public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN, BYTE_SPECIAL, 0, 256)
    pieces = packing.token_pieces(odd, *args)
    rows = packing.packed(pieces, 256)
    found = rows.collect()
    want = Counter()
    for d, t in odd_rows:
        ids = ids_of(by_bytes, t) + [0]
        first = len(ids) % 256 or 256
        cuts = [0, *range(first, len(ids) + 1, 256)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            raw = np.array(ids[a:b], "<u4").tobytes()
            want[d, k, a, b - a, zlib.crc32(raw), raw] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found) == want
    whole = {r.sequence_id: bytes(r.ids) for r in packing.sequences(rows).collect()}
    for r in found:
        assert whole[r.sequence_id][4 * r.offset:4 * (r.offset + r.length)] == bytes(r.ids)
    assert sum(map(len, whole.values())) == 4 * sum(r.length for r in found) and max(map(len, whole.values())) <= 4 * 256
    assert len(whole) == brute.best_fit([r.length for r in found], 256)[0]


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    values = rng.choice([0, 1, 2, 7, 300, 49407, 65535], 3000).astype(np.uint16)
    for part in (values, values[:1], values[:0], values[:512]):
        _, _, m = wavelet.from_file(wavelet.to_file([], np.empty(0, np.int64), wavelet.WaveletMatrix.build(part, 16)))
        assert (m.values() == part).all()
        for i in range(0, len(part), 97):
            assert m.access(i) == part[i]
            assert m.rank(int(part[i]), i) == int((part[:i] == part[i]).sum())
        for v in {*part.tolist()} | {5}:
            places = np.flatnonzero(part == v)
            assert m.rank(v) == len(places) and [m.select(v, n) for n in range(0, len(places), 41)] == places[::41].tolist()
            with pytest.raises(IndexError):
                m.select(v, len(places))


def test_only_touched_frames_are_unpacked(monkeypatch):
    monkeypatch.setattr(wavelet, "FRAME", 512)
    values = np.random.default_rng(2).integers(0, 40, 20_000).astype(np.uint16)
    payload = wavelet.to_file([1], np.array([20_000]), wavelet.WaveletMatrix.build(values, 6))
    opened = lambda m: max(len(p.opened) for p in m.planes)
    for ask, want, limit in ((lambda m: m.access(12_345), values[12_345], 1), (lambda m: m.rank(7, 15_000), (values[:15_000] == 7).sum(), 2),
                             (lambda m: m.select(7, 200), np.flatnonzero(values == 7)[200], 4)):
        _, _, m = wavelet.from_file(payload)
        assert opened(m) == 0 and ask(m) == want and opened(m) <= limit
    assert (m.values() == values).all() and opened(m) == 40


def test_wavelet_files(spark, odd, odd_rows, by_words, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_IDS", 500)
    wavelet.write_shards(odd, WORDS, f"{tmp_path}/w")
    files = spark.read.parquet(f"{tmp_path}/w")
    rows = wavelet.read_shards(files).collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = Counter(), 0
    for d, t in order:
        ids = ids_of(by_words, t) + [2]
        want[d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
        start += len(ids)
    assert Counter(map(tuple, rows)) == want


def test_empty_and_clashing(none, renamed, odd):
    assert token_count.token_counts(none, WORDS).count() == bpe_codec.encode_documents(none, WORDS).count() == 0
    args = (public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN)
    assert packing.packed(packing.token_pieces(none, *args)).count() == 0
    assert wavelet.shards(none, WORDS).count() == 0
    same = lambda a, b: Counter(map(str, a.collect())) == Counter(map(str, b.collect()))
    assert same(token_count.token_counts(renamed, WORDS, "name", "body"), token_count.token_counts(odd, WORDS))
    assert same(packing.token_pieces(renamed, *args, id_col="name", text_col="body"), packing.token_pieces(odd, *args))


