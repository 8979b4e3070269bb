"""Spelling variants, the serialised piece model and the alignment of tokenizers against brute force and their libraries."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tests.llm.conftest import make
from tidespan.llm import fm_index, memo, piece_model, spelling, token_alignment
from tidespan.llm.bpe_files import byte_letters
from tidespan.llm.queries import BYTE_BPE, BYTE_RANKS, PIECES
from tidespan.llm.texts import Chunks, ragged, text_parts

RANKS, PATTERN = public_tokenizers.path(BYTE_RANKS), public_tokenizers.PATTERN
LEFT, RIGHT = public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECES)
ODD = ["\x1c\x1d a\x85b   c", "'S y's 's", "a\n\n  b", "foo\r\n\r\n bar; {\r\n};\r x", "x\x00y", "中文 中　文", "a​b   c", "ok ▁ok", "<s> <unk> <0x0A>", "a<|endoftext|>b"]


def odd_texts(n=400):
    rng = random.Random(1)
    letters = " \n\t\r  　ab'sé中1.\x1c\x85​▁́;)"
    return ODD + ["".join(rng.choice(letters if i % 2 else letters.replace("▁", "")) for _ in range(rng.randint(1, 40))) for i in range(n)]


@pytest.fixture(scope="module")
def more(spark, odd_rows):
    rows = odd_rows + [(1000 + i, t) for i, t in enumerate(odd_texts())]
    return make(spark, rows), rows


def renamed(df):
    clash = ["word", "n", "half", "block", "unit", "pair", "count", "best", "near", "root", "ids", "rows", "held", "asks", "text_"]
    return df.selectExpr("doc_id AS name", "text AS body", *[f"{i} AS {c}" for i, c in enumerate(clash)])


# --- spelling variants ------------------------------------------------------------------------------
def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def grouped(counts, ratio):
    by_gap = defaultdict(set)  # near words share a spelling with one letter left out, or one is that spelling
    for w in counts:
        for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))}:
            by_gap[x].add(w)
    form, found = {}, {}
    for w, n in counts.items():
        close = {v for x in {w} | {w[:i] + w[i + 1:] for i in range(len(w))} for v in by_gap[x] if near(w, v)}
        best = min(close, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        found[w] = len(close)
    out = Counter()
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w, form[w], root, n, found[w], counts[form[w]] if form[w] else None] += 1
    return out


def counted(rows, least, times, slip):
    seen = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            seen[run] += 1
    return {w: n for w, n in seen.items() if len(w) >= least and n >= times}


def test_index_finds_every_word_one_error_apart():
    rng = random.Random(3)
    for _ in range(25):
        letters = "abcde"[:rng.choice([2, 3, 5])]
        words = sorted({"".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(1, 120))})
        symbols, lengths = np.array([ord(c) - 95 for w in words for c in w], np.uint8), np.array(list(map(len, words)))
        index, half = fm_index.Vocabulary(symbols, lengths), lengths // 2
        starts = np.cumsum(lengths) - lengths
        x = index.exact(index.right, symbols[ragged(starts, half)], half)
        assert x.size.tolist() == [sum(v.startswith(w[:len(w) // 2]) for v in words) for w in words]
        q, at = index.one_error(index.right, x, symbols[ragged(starts + half, lengths - half)], lengths - half)
        mirror = np.concatenate([symbols[a:a + n][::-1] for a, n in zip(starts, lengths)])
        y = index.exact(index.left, mirror[ragged(starts, lengths - half)], lengths - half)
        p, to = index.one_error(index.left, y, mirror[ragged(starts + lengths - half, half)], half)
        got = {(words[a], words[b]) for a, b in [*zip(q, at), *zip(p, to)]}
        assert got == {(a, b) for a in words for b in words if near(a, b)}


def test_suffix_array():
    rng = random.Random(6)
    for text in ([1, 0], [0], [2] * 300 + [1, 0], [rng.randint(1, 3) for _ in range(500)] + [0]):
        got = fm_index.suffix_array(np.array(text, np.uint8), 2)
        assert got.tolist() == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("block, group", [(100_000, 50_000), (7, 2)])
def test_spelling(spark, odd, odd_rows, none, monkeypatch, block, group):
    monkeypatch.setattr(spelling, "BLOCK", block)
    monkeypatch.setattr(spelling, "GROUP", group)
    rng = random.Random(9)
    words = ["abcdef", "abcdeg", "abcdefg", "bcdefg", "abdef", "ÄÉíõüñ", "äéíõüñ", "×÷abcdé", "hammer", "hammmer", "hamer", "aaaaaa", "aaaaaaa", "aaaaaaaa", "ababab", "bababa"]
    rows = [(i, " ".join(rng.choices(words, weights=[60, 8, 9, 2, 3, 20, 4, 8, 200, 30, 5, 90, 15, 2, 9, 40], k=rng.randint(0, 40)))) for i in range(60)]
    rows += odd_rows + [(7, "Hammer-hammer_HAMMER 5hammers" * 20), (8, "ß" * 400 + " " + "x" * 300), (None, "hammer " * 5)]
    want = grouped(counted(rows, 4, 3, 7), 5)
    df = make(spark, rows)
    assert Counter(map(tuple, spelling.spelling_groups(df, 4, 3, 5, 7).collect())) == want
    if block == 7:
        return
    assert Counter(map(tuple, spelling.spelling_groups(renamed(df), 4, 3, 5, 7, "name", "body").collect())) == want
    assert Counter(map(tuple, spelling.spelling_groups(odd).collect())) == grouped(counted(odd_rows, 6, 5, None), 5)
    assert spelling.spelling_groups(none).count() == 0


def test_chains_of_forms(spark):
    words = [("a" * i, 2 * 5 ** (i - 6)) for i in range(6, 18)] + [("zzzzzz", 1), ("zzzzzy", 5), ("zzzzzx", 5)]
    got = spelling.variant_groups(spark.createDataFrame(words, "word string, n long")).collect()
    assert Counter(map(tuple, got)) == grouped(dict(words), 5)
    assert {r.root for r in got if r.word[0] == "a"} == {"a" * 17} and [r.form for r in got if r.word == "zzzzzz"] == ["zzzzzx"]


def test_spelling_on_documents(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = grouped(counted(rows, 6, 5, 199), 5)
    assert Counter(map(tuple, spelling.spelling_groups(docs, 6, 5, 5, 199).collect())) == want


# --- serialised piece model -------------------------------------------------------------------------
@pytest.fixture(scope="module")
def ranked():
    import tiktoken

    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_piece_model(spark, more, ranked, none):
    df, rows = more
    want, digests = Counter(), Counter()
    for d, t in rows:
        ids = ranked.encode_ordinary(t or "")
        want[d, tuple(ids)] += 1
        digests[d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    encoded = piece_model.encode_documents(df, RANKS, PATTERN)
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
    back = piece_model.decode_documents(encoded, RANKS, PATTERN)
    assert Counter((r.doc_id, bytes(r.decoded)) for r in back.collect()) == Counter((d, (t or "").encode()) for d, t in rows)
    assert Counter(map(tuple, piece_model.round_trips(df, RANKS, PATTERN).collect())) == digests
    assert Counter(map(tuple, piece_model.round_trips(renamed(df), RANKS, PATTERN, "name", "body").collect())) == digests
    assert piece_model.round_trips(none, RANKS, PATTERN).count() == piece_model.encode_documents(none, RANKS, PATTERN).count() == 0


def test_every_token_is_its_own_encoding(ranked):
    known = piece_model.codec(RANKS, PATTERN)
    tokens = [ranked.decode_single_token_bytes(i) for i in range(ranked.n_vocab)]
    assert known.model.encode([t.decode("latin-1").translate(known.letters) for t in tokens]) == [[i] for i in range(len(tokens))]


def test_vocabularies_that_cannot_be_serialised():
    whole = {bytes([b]): b for b in range(256)}
    piece_model.serialised(whole)
    for bad in ({**whole, b"ab": 300}, {k: v for k, v in whole.items() if v < 255}):
        with pytest.raises(ValueError):
            piece_model.serialised(bad)


# --- alignment --------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def sides():
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=RIGHT)
    byte_of = {c: b for b, c in byte_letters().items()}
    names = {i: bytes(map(byte_of.get, t)) for t, i in left.get_vocab().items() if t != "<|endoftext|>"}
    piece = lambda i: bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i) else right.id_to_piece(i).replace("▁", " ").encode()
    return lambda t: [(i, names[i]) for i in left.encode(" " + t, add_special_tokens=False).ids], lambda t: [(i, piece(i)) for i in right.encode(t)]


def aligned(text, sides):
    """(left tokens, right tokens, groups' text, links)"""
    a, b = (side(text) for side in sides) if text else ((), ())
    whole = (" " + (text or "")).encode()
    if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return 0, 0, None, []
    spans = []
    for tokens in (a, b):
        at, out = 0, []
        for i, x in tokens:
            out.append((at, at + len(x), i))
            at += len(x)
        spans.append(out)
    cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
    said, begin = [], 0
    for c in cuts:
        said.append("|".join(",".join(str(i) for s, e, i in side if begin <= s and e <= c) for side in spans))
        begin = c
    links = [(i, j) for s, e, i in spans[0] for u, v, j in spans[1] if s < v and u < e]
    return len(a), len(b), said, links


def test_alignment(spark, more, sides, none, monkeypatch):
    df, rows = more
    rows = [(d, t and t[:1500]) for d, t in rows]
    df = make(spark, rows)
    found = [aligned(t, sides) for _, t in rows]
    docs = Counter(p for *_, links in found for p in set(links))
    most = defaultdict(int)
    for (a, _), n in docs.items():
        most[a] = max(most[a], n)
    want = Counter()
    for (d, _), (n_a, n_b, said, links) in zip(rows, found):
        digest = hashlib.sha256(";".join(said).encode()).hexdigest() if said else ""
        want[d, n_a, n_b, len(said or ()), len(links), sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links), digest] += 1
    args = (LEFT, PATTERN, RIGHT)
    assert Counter(map(tuple, token_alignment.aligned_documents(df, *args).collect())) == want
    monkeypatch.setattr(token_alignment, "UNIT_BYTES", 500)  # a unit for nearly every batch
    parts = renamed(df).repartition(11)
    assert Counter(map(tuple, token_alignment.aligned_documents(parts, *args, "name", "body").collect())) == want
    assert token_alignment.aligned_documents(none, *args).count() == 0
    empty = make(spark, [(1, None), (2, ""), (None, "")])
    assert Counter(map(tuple, token_alignment.aligned_documents(empty, *args).collect())) == Counter((d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2, None))


def test_pointers_reach_the_end_of_their_component():
    # left tokens end at 2 4 6 8 9, right ones at 1 3 5 7 8 9: one chain up to 8, then a group of one token each
    a, b = token_alignment.groups_of(np.array([2, 4, 6, 8, 9]), np.array([1, 3, 5, 7, 8, 9]))
    assert a.tolist() == [0, 0, 0, 0, 1] and b.tolist() == [0, 0, 0, 0, 0, 1]
    chain = 2 * np.arange(1, 100_001)
    a, b = token_alignment.groups_of(np.append(chain, 200_001), np.append(chain - 1, 200_001))
    assert {*a.tolist(), *b.tolist()} == {0}


# --- remembered pieces ------------------------------------------------------------------------------
def test_pieces_of_one_hash_are_told_apart():
    met = []

    def encode(raw, lengths):
        met.append(len(lengths))
        ends = np.cumsum(lengths)
        return np.concatenate([[int(n), int(raw[e - 1])] for n, e in zip(lengths, ends)]).astype(np.uint32), np.full(len(lengths), 2)

    known = memo.Memo(encode)
    for _ in range(2):
        for _, data, offsets in text_parts(pa.array([" one two", " two one six", " one"], pa.string())):
            chunks = Chunks(data, offsets)
            chunks.hash = np.zeros(len(chunks.hash), np.uint64)
            flat, before = known.of(chunks)
            assert flat.reshape(-1, 2).tolist() == [[4, ord(c)] for c in "eooexe"] and before.tolist() == list(range(0, 13, 2))
    assert met[0] == 3
