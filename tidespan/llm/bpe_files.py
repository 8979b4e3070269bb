"""Readers of public tokenizer files."""

from __future__ import annotations

import base64
import functools
import json
import unicodedata

import numpy as np
import regex

from tidespan.llm.memo import Memo, holding, joinable, split_together


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordBpe:
    """A byte-pair vocabulary with word ends: NFC, lower case, a pattern that finds words, merges inside a word."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, steps = spec["model"], [x["type"] for x in spec["normalizer"]["normalizers"]]
        if steps != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or spec["decoder"] is not None:
            raise ValueError(f"{path}: not a word-level BPE file of the kind read here")
        self.vocab: dict[str, int] = dict(model["vocab"])
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.special).items()}
        self.letters = byte_letters()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self._find, self._find_lines = regex.compile(pattern).findall, regex.compile(f"{pattern}|\n").findall
        self._cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split

    def pieces(self, chunk: bytes) -> list[tuple[bool, str]]:
        """(special or not, text) for a run of characters without white space: normalized words as UTF-8 letters."""
        text = chunk.decode()
        if "<|" not in text:
            return [(False, w) for w in self.words(text)]
        out = []
        for part in self._cut(text):
            if part in self.special:
                out.append((True, part))
            elif part:
                out += [(False, w) for w in self.words(part)]
        return out

    def words(self, part: str) -> list[str]:
        """Words of a text without white space and special strings."""
        part = part if part.isascii() else unicodedata.normalize("NFC", part)
        part = part.lower() if "Σ" not in part else "".join(map(str.lower, part))
        # letters alone, or with a stop behind them, need no search
        if part.isalpha():
            return [part]
        if part[-1] in ".," and part[:-1].isalpha():
            return [part[:-1], part[-1]]
        return self._find(part)

    def lines(self, text: str) -> list[str]:
        """Words of many chunks without white space and special strings, each with a line feed behind it, which stays."""
        text = text if text.isascii() else unicodedata.normalize("NFC", text)
        return self._find_lines(text.lower() if "Σ" not in text else "".join(map(str.lower, text)))

    def symbols(self, word: str) -> list[str]:
        """One letter a byte; the last one carries the word end."""
        out = [self.letters[b] for b in word.encode()]
        out[-1] += self.suffix
        return out


@functools.cache
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@functools.cache
def byte_bpe(path: str, special: tuple[tuple[str, int], ...], pattern: str) -> Memo:
    """Ids of chunks by a byte-level vocabulary from a rank file. Special strings inside texts are special."""
    import tiktoken

    ranks = rank_file(path)
    known = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    lengths[list(ranks.values())] = list(map(len, ranks))

    def alone(text: str) -> list[int]:
        return known.encode(text, allowed_special="all")

    def together(text: str) -> np.ndarray:
        return np.array(known.encode_ordinary(text), np.int64)

    return Memo(lambda raw, n: split_together(raw, n, joinable(raw, n) & ~holding(raw, n, b"<|"), lengths, together, alone))
