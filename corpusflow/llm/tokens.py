"""Tokenizers of public vocabulary files, loaded once a Python worker."""

from __future__ import annotations

import os
import re
import unicodedata
from functools import lru_cache

import numpy as np

#: Words that a worker remembers; the memory is emptied when it is full (about 100 bytes each).
CACHE_WORDS = 600_000
#: Longer words are encoded anew each time.
CACHE_BYTES = 48
#: Texts with this are not lower-cased first: it begins the strings of special tokens.
SPECIAL = b"<|"
MARKS = b".,;:!?"


def _byte_chars() -> dict[int, str]:
    """Byte-level vocabularies write printable bytes as themselves and the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHARS = _byte_chars()


@lru_cache(4)
def word_tokenizer(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(4)
def rank_tokenizer(path: str, pattern: str):
    import base64

    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


class WordIds:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, by way of ASCII-space-separated words.

    The vocabulary drops white space and splits at it before anything else, so a text's ids are those
    of its words in a row; each distinct word goes through the library once while it is remembered.
    A word of letters alone is one unit, and goes straight to the library's model; one with punctuation
    after its letters is two; all others go through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer, self.known = word_tokenizer(path), {}
        self.bytes_of = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]

    def encode(self, raw: list) -> list[bytes]:
        split = [(b if SPECIAL in b else b.lower()).split() if b else [] for b in raw]
        wanted = set().union(*split)
        if len(self.known) > CACHE_WORDS:
            self.known = {w: self.known[w] for w in wanted.intersection(self.known)}
        miss = wanted.difference(self.known)
        self._learn(miss)
        out = [b"".join(map(self.known.__getitem__, words)) for words in split]
        for w in miss:
            if len(w) > CACHE_BYTES:
                del self.known[w]
        return out

    def _learn(self, miss: set[bytes]) -> None:
        plain, other, joined = set(), [], []
        for w in miss:
            stem = w.rstrip(MARKS)
            if not _letters(stem):
                other.append(w)
            elif len(stem) == len(w):
                plain.add(w)
            else:
                joined.append((w, stem, w[len(stem) :]))
                plain.add(stem)
        known, tokenize, bytes_of = self.known, self.tokenizer.model.tokenize, self.bytes_of
        for w in plain:
            if w not in known:
                known[w] = b"".join([bytes_of[t.id] for t in tokenize(w.decode("latin-1").translate(BYTE_CHARS))])
        other += {m for _, _, m in joined if m not in known}
        for i in range(0, len(other), 2000):
            part = other[i : i + 2000]
            for w, e in zip(part, self.tokenizer.encode_batch([w.decode() for w in part], add_special_tokens=False), strict=True):
                known[w] = np.array(e.ids, "<u4").tobytes()
        for w, stem, mark in joined:
            known[w] = known[stem] + known[mark]


def _letters(w: bytes) -> bool:
    """Letters alone, which neither normalising nor lower-casing changes in number or kind."""
    if w.isascii():
        return w.isalpha()
    s = w.decode()
    return s.isalpha() and s == s.lower() and unicodedata.is_normalized("NFC", s)


@lru_cache(4)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


#: White space that is no ASCII space, tab or line end, and the two marks among the letters of Latin-1; texts with any are encoded whole.
RARE = re.compile(rb"[\x0b\x0c\x1c-\x1f]|\xc2[\x85\xa0]|\xc3[\x97\xb7]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f-\xaf]|\xe3\x80\x80|\xef\xbb\xbf")
#: What such texts hold; looked for first, since plain searches are fast.
RARE_HINTS = (b"\xc2\x85", b"\xc2\xa0", b"\xc3\x97", b"\xc3\xb7", b"\xe1\x9a\x80", b"\xe1\xa0\x8e", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80\x80", b"\xef\xbb\xbf")
RARE_CONTROLS = (b"\x0b", b"\x0c", b"\x1c", b"\x1d", b"\x1e", b"\x1f")
#: A word of Latin letters (U+00C0 to U+027F beyond ASCII) before a punctuation mark, with the white space before it; or white space and
#: what follows it.
UNIT = re.compile(rb"[ \t\n\r]*+(?:[A-Za-z\xc3-\xc9\x80-\xbf]++(?:(?=[.,;:!? \n])|[^ \t\n\r]*+)|[^ \t\n\r]++)|[ \t\n\r]++")
#: One space at most, and Latin letters: one piece of the vocabulary's pattern.
PLAIN = re.compile(rb" ?[A-Za-z\xc3-\xc9\x80-\xbf]+")
#: Fixed: the vocabulary's pattern, here for ASCII alone.
ASCII_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


class ByteUnitIds(dict):
    """Ids of whole texts by a byte-level vocabulary, as little-endian unsigned 32-bit bytes.

    Its pattern never takes a character and white space after it together, nor a letter and a mark after it, so a text's ids
    are those of its units in a row.  Each distinct unit goes through the library once while it is remembered, piece by piece
    of the pattern straight to the library's model if it is ASCII or a word of Latin letters; texts with other white
    space than the common four go through the library whole.
    """

    def __init__(self, path: str) -> None:
        super().__init__()
        self.tokenizer = word_tokenizer(path)
        self.bytes_of = [i.to_bytes(4, "little") for i in range(max(self.tokenizer.get_vocab().values()) + 1)]
        self.tokenize = self.tokenizer.model.tokenize

    def __missing__(self, unit: bytes) -> bytes:
        if PLAIN.fullmatch(unit):
            ids = self._piece(unit)
        elif unit.isascii() and SPECIAL not in unit:
            parts = ASCII_PATTERN.findall(unit.decode())
            ids = b"".join([self[p.encode()] for p in parts]) if len(parts) > 1 else self._piece(unit)
        else:
            ids = self._whole(unit)
        if len(unit) <= CACHE_BYTES:
            self[unit] = ids
        return ids

    def _piece(self, piece: bytes) -> bytes:
        bytes_of = self.bytes_of
        return b"".join([bytes_of[t.id] for t in self.tokenize(piece.decode("latin-1").translate(BYTE_CHARS))])

    def _whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, raw: list) -> list[bytes]:
        """A null text has no ids."""
        if len(self) > CACHE_WORDS:
            self.clear()
        known = self.__getitem__
        return [b"" if not b else self._whole(b) if _rare(b) else b"".join(map(known, UNIT.findall(b))) for b in raw]


def _rare(text: bytes) -> bool:
    if any(c in text for c in RARE_CONTROLS):
        return True
    return not text.isascii() and any(c in text for c in RARE_HINTS) and RARE.search(text) is not None


@lru_cache(4)
def byte_unit_ids(path: str) -> ByteUnitIds:
    return ByteUnitIds(path)
