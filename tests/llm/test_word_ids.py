"""Word ids of op10: pieces cut and looked up as arrays, against the tokenizers library."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidespan.llm import wavelet
from tidespan.llm.queries import WORD_BPE
from tidespan.llm.texts import text_parts

PATH = public_tokenizers.path(WORD_BPE)
ATOMS = [
    "a", "B", "word", "The", "0", "12", " ", "  ", "\n", "\t", "!?", "...", "-" * 20, "'", "'s", "'LL", "<|", "<|endoftext|>", "<|EndOfText|>", "<", ">", "|", "=",
    "\x00", "\x1c", "\x7f", "é", "É", "Þ", "ß", "ÿ", "×", "÷", "a" * 15, "b" * 16, "c" * 17, "É" * 8, "é" * 9, "\u0301", "\u0327", "\u0338", "\u00a0", "\u0085",
    "\u2009", "\u200b", "中", "Σ", "İ", "ª", "²", "ſ", "\u212a", "ﬁ",
]


def ids_of(known, texts, part_bytes=2_000_000):
    out = []
    for _, data, offsets in text_parts(pa.array(texts, pa.string()), part_bytes):
        flat, ends = known.of(data, offsets)
        out += [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]
    return out


@pytest.fixture(scope="module")
def library():
    known = Tokenizer.from_file(PATH)
    return lambda texts: [known.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_like_the_library(library, monkeypatch):
    rng, known = random.Random(3), wavelet.WordIds(PATH)
    monkeypatch.setattr(wavelet, "BLOCK", 64)
    monkeypatch.setattr(wavelet, "SHORT_WORDS", 150)  # forgotten now and then
    for part_bytes in (1, 50, 2000, 2_000_000):
        texts = ["".join(rng.choice(ATOMS) for _ in range(rng.choice([0, 1, 2, 5, 30, 300]))) for _ in range(200)] + [None, ""]
        assert ids_of(known, texts, part_bytes) == library(texts)


def test_plain_words_are_found_as_arrays(library, monkeypatch):
    """Western text makes no string a piece, and each word goes to the library once, whatever its case and the marks beside it."""
    known, sent = wavelet.WordIds(PATH), []
    monkeypatch.setattr(known.bpe, "lines", lambda text: pytest.fail("pieces searched as strings"))
    encoded = known.encoded
    monkeypatch.setattr(known, "encoded", lambda text: sent.append(text.decode().split()) or encoded(text))
    texts = ["Haan haan, HAAN. (haan) 12 été ÉTÉ, Été!", "haan: été?", "Straße; 2001"]
    assert ids_of(known, texts) == library(texts) and ids_of(known, texts, 1) == library(texts)
    words = [w for s in sent for w in s]
    assert sorted(words) == sorted(set(words)) and {"haan", "été", "straße", "1", "2", "0"} < set(words)


def test_many_words(library):
    """The table grows; words that want one place in it keep apart."""
    rng, known = np.random.default_rng(4), wavelet.WordIds(PATH)
    texts = [" ".join("".join(map(chr, rng.integers(97, 123, n))) for n in rng.integers(1, 17, 3000)) for _ in range(8)]
    assert ids_of(known, texts, 20_000) == library(texts) == ids_of(known, texts)
    n = len(known.short.sizes)
    assert n > 20_000 and 2 * n <= len(known.table) and np.count_nonzero(known.table) == n - 1
    assert (np.sort(known.numbers(*known.keys[:, 1:n])) == np.arange(1, n)).all() and len(known.short.sizes) == n
    # three words, all wanting the last place
    known.clear()
    known.places = lambda a, b: np.full(len(a), len(known.table) - 1)
    assert ids_of(known, ["one two one", "three two one"]) == library(["one two one", "three two one"])


def test_planes_are_read_in_blocks(monkeypatch):
    values = np.random.default_rng(5).choice([0, 1, 2, 300, 49407, 65535], 3000).astype(np.uint16)
    for near in (1, 64, 3000):
        monkeypatch.setattr(wavelet, "NEAR", near)
        for part in (values, values[:65], values[:1], values[:0]):
            assert (wavelet.WaveletMatrix.build(part, 16).values() == part).all()
