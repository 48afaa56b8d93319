"""Token ids of whole texts by a public word-end BPE vocabulary, with each distinct unit encoded once."""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa

from .common import LOWER, SPACE, split_words, text_bytes

LETTER = np.zeros(256, bool)
LETTER[97:123] = True
#: ASCII punctuation that starts a new unit after a letter a-z; the vocabulary's own pattern cuts there as well.
AFTER = np.zeros(256, bool)
AFTER[[ord(c) for c in '.,!?;:&$#%*|"']] = True
ASCII_WORD = re.compile(r"[a-z]+")
LATIN_WORD = re.compile(r"[a-zß-öø-ÿ]+")
CACHE_UNITS = 800_000


def byte_chars() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordBpe:
    """ids of texts, equal to tokenizers' encode(text, add_special_tokens=False).ids.

    White space separates tokens in this vocabulary, so a text's ids are those of its units after one another.
    Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str, cache_units: int = CACHE_UNITS) -> None:
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.model, self.chars, self.cache_units = self.tok.model, byte_chars(), cache_units
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.flat, self.end = array("H"), array("q", [0])

    def trim(self) -> None:
        """Keeps the quarter that came first: mostly the frequent units."""
        n = self.cache_units // 4
        self.place = {u: k for u, k in self.place.items() if k < n}
        del self.end[n + 1 :]
        del self.flat[self.end[n] :]

    def _add(self, unit: str) -> int:
        if ASCII_WORD.fullmatch(unit):
            ids = [t.id for t in self.model.tokenize(unit)]
        elif LATIN_WORD.fullmatch(unit):
            ids = [t.id for t in self.model.tokenize("".join(map(self.chars.__getitem__, unit.encode())))]
        else:
            ids = self.tok.encode(unit, add_special_tokens=False).ids
        self.flat.extend(ids)
        self.end.append(len(self.flat))
        self.place[unit] = k = len(self.end) - 2
        return k

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts after one another (uint16), and where each text's ids begin."""
        raw, off = text_bytes(texts)
        raw = LOWER[raw]
        keep = ~SPACE[raw]
        cut = np.zeros(len(raw), bool)
        cut[1:] = AFTER[raw[1:]] & LETTER[raw[:-1]]
        w = split_words(raw, off, keep, cut)
        if len(self.place) > self.cache_units:
            self.trim()
        get, add = self.place.get, self._add
        places = np.fromiter((k if (k := get(u)) is not None else add(u) for u in w.unique.to_pylist()), np.int64, len(w.unique))
        end, flat = np.frombuffer(self.end, np.int64).copy(), np.frombuffer(self.flat, np.uint16).copy()
        at = places[w.codes]
        begin, size = end[at], end[at + 1] - end[at]
        total = np.concatenate([[0], np.cumsum(size)])
        ids = flat[np.repeat(begin - total[:-1], size) + np.arange(total[-1])] if total[-1] else np.zeros(0, np.uint16)
        return ids, total[w.first]
