"""Public tokenizers, and word-wise encoding that gives a whole text's ids.

A word's ids are kept, so that a word is encoded once per worker and not once
per occurrence.  That is exact only where the tokenizer cuts a text at its
spaces whatever surrounds them; ``cuts`` reads from the file whether it does.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

MEMO_WORDS = 400_000
# words of Latin-1 letters: composed already, a piece of their own, and lower-cased letter by letter alike everywhere
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+")
_PLAIN = re.compile(r"[0-9A-Za-zÀ-ÖØ-öø-ÿ]")
LONG_WORD = 64


def byte_alphabet() -> dict[int, str]:
    """Byte-level tokenizers spell a byte as itself where it prints in Latin-1, else as the next character from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)}


_SPELL = byte_alphabet()


def spelled(word: str) -> str:
    return word if word.isascii() else "".join(map(_SPELL.__getitem__, word.encode()))
_ODD = re.compile(r"[^\S \n]|[ \n][ \n]|\A[ \n]|[ \n]\Z")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=None)
def load(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(path)


def cuts(path: str) -> str:
    """How the tokenizer of a .json file treats spaces.

    "dropped": white space only separates, words are encoded by themselves.
    "leading": a single space between two non-space characters starts the
    next word's piece, and a single line feed is a piece of its own.
    "unknown": no rule; texts are encoded whole.
    """
    with open(path, encoding="utf-8") as f:
        made = json.load(f)
    pre = made.get("pre_tokenizer") or {}
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or re.search(r"\s", t["content"])
           for t in made.get("added_tokens", [])):
        return "unknown"
    if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") \
            and not made.get("normalizer"):
        return "leading"
    if pre.get("type") == "Sequence":
        steps = pre.get("pretokenizers", [])
        norm = (made.get("normalizer") or {}).get("normalizers", [])
        if ([s.get("type") for s in steps] == ["Split", "ByteLevel"] and steps[0].get("behavior") == "Removed"
                and steps[0].get("invert") and r"[^\s\p{L}\p{N}]+" in (steps[0].get("pattern") or {}).get("Regex", "")
                and not steps[1].get("add_prefix_space") and not steps[1].get("use_regex", True)
                and [n.get("type") for n in norm] == ["NFC", "Replace", "Lowercase"]):
            return "dropped"
    return "unknown"


class WordIds:
    """Ids of texts for a tokenizer that drops white space: bytes of little-endian unsigned integers."""

    def __init__(self, path: str, dtype: str):
        self.tokenizer, self.dtype, self.memo, self.tails = load(path), np.dtype(dtype), {}, {}
        self.split = cuts(path) == "dropped"
        self._forget()

    def _forget(self) -> None:
        self.tails = dict(zip(".,", self._encode([".", ","])))
        self.memo = {"": b"", **self.tails}

    def _bytes(self, ids: list[int]) -> bytes:
        own = array("H" if self.dtype.itemsize == 2 else "I", ids)
        if sys.byteorder == "big":
            own.byteswap()
        return own.tobytes()

    def _encode(self, words: list[str]) -> list[bytes]:
        return [self._bytes(e.ids) for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _learn(self, words: set[str]) -> None:
        # a comma or full stop is a piece of its own after a Latin letter or digit, which no normalization takes apart
        # (others may end in a mark that goes with what follows); a word of Latin letters is one piece in lower case,
        # which the library's model takes without its normalizer and pre-tokenizer
        memo, tails, tokenize, whole, cut = self.memo, self.tails, self.tokenizer.model.tokenize, [], {}
        for w in words:
            tail = tails.get(w[-1])
            bare = w[:-1] if tail else w
            if _LETTERS.fullmatch(bare):
                bare = bare.lower()
                ids = memo.get(bare)
                if ids is None:
                    ids = memo[bare] = self._bytes([t.id for t in tokenize(spelled(bare))])
                memo[w] = ids + tail if tail else ids
            elif tail and _PLAIN.fullmatch(bare[-1]):
                cut[w] = bare
                whole.append(bare)
            else:
                whole.append(w)
        memo.update(zip(whole, self._encode(whole)))
        for w, bare in cut.items():
            memo[w] = memo[bare] + tails[w[-1]]

    def encode(self, texts: list[str]) -> list[bytes]:
        if not self.split:
            return self._encode(texts)
        parts = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.memo) > MEMO_WORDS:
            self._forget()
        new = set().union(*parts) - self.memo.keys()
        self._learn(new)
        get = self.memo.__getitem__
        out = [b"".join(map(get, p)) for p in parts]
        for w in new:
            if len(w) > LONG_WORD:  # a blob is learnt for its batch alone: the memo holds words
                for key in (w, w[:-1], w.lower(), w[:-1].lower()):
                    self.memo.pop(key, None)
        return out


class WordCounts:
    """Numbers of tokens of texts for a tokenizer that puts a space before its word."""

    def __init__(self, path: str):
        self.tokenizer, self.memo = load(path), {}
        self.split = cuts(path) == "leading"

    def whole(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []

    def _learn(self, pieces: set[str]) -> None:
        memo, model, odd, parts = self.memo, self.tokenizer.model, [], {}
        for p in pieces:
            if p in memo:
                continue
            tail = len(p) > 1 and p[-1] in ".," and p[-2].isalnum()
            bare = p[:-1] if tail else p
            if bare not in memo:
                if _LETTERS.fullmatch(bare, 1 if bare[0] == " " else 0):
                    memo[bare] = len(model.tokenize(_SPELL[32] + spelled(bare[1:]) if bare[0] == " " else spelled(bare)))
                else:
                    odd.append(bare)
            parts[p] = (bare, p[-1] if tail else "")
        odd = [p for p in {*odd, ".", ",", "\n", ""} if p not in memo]
        memo.update(zip(odd, self.whole(odd)))
        for p, (bare, tail) in parts.items():
            memo[p] = memo[bare] + memo[tail]

    def count(self, texts: list[str]) -> list[int]:
        """Texts whose only white space is single spaces and line feeds between words are counted by words, all
        others whole."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        out, pieces, plain, odd = [0] * len(texts), [], [], []
        for i, t in enumerate(texts):
            if not t:
                continue
            if not self.split or _ODD.search(t):
                odd.append(i)
                continue
            own = []
            for line in t.split("\n"):
                first, *rest = line.split(" ")
                own.append(first)
                own.extend([" " + w for w in rest])
            plain.append((i, t.count("\n")))
            pieces.append(own)
        for i, n in zip(odd, self.whole([texts[i] for i in odd])):
            out[i] = n
        if pieces:
            self._learn(set().union(*pieces))
        get = self.memo.__getitem__
        for (i, feeds), own in zip(plain, pieces):
            out[i] = sum(map(get, own)) + feeds * self.memo["\n"]
        return out
