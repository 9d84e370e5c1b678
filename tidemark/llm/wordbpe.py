"""Fast ids of the lower-casing word-end BPE tokenizer, identical to the library's.

The library spends most of its time on offsets and normalisation. For texts made
only of characters whose treatment is known, the same pre-tokens come from one
regular expression, and each distinct blank-separated word is encoded once by the
library's own BPE model. Any other text goes to the library whole.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

# Characters that NFC leaves alone, that lower-case one to one, and
# whose letter, digit and space classes are the same in every Unicode version.
_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-įı-ňŊ-ž"
_OTHER = "¡-©«-±´¶-¸»¿×÷‐-‧‰-›€™"
_UNKNOWN = re.compile(f"[^\\t-\\r\\x20-\\x7e{_LETTERS}{_OTHER}]")
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\t-\\r\\x20{_LETTERS}0-9]+")


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


class WordBpe(dict):
    """Packs the ids of a text as little-endian unsigned 32-bit integers.

    As a mapping it remembers the packed ids of every blank-separated word, which
    pre-tokens never cross; ``keep`` bounds it, so memory stays flat.
    """

    def __init__(self, path: str, keep: int = 700_000):
        super().__init__()
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.alphabet = dict(enumerate(byte_alphabet()))
        self.words = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.keep = keep

    def __missing__(self, word: str) -> bytes:
        tokenize, words, found = self.library.model.tokenize, self.words, []
        for piece in _PIECES.findall(word):
            mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
            found += [words[t.id] for t in tokenize(mapped)]
        if len(self) >= self.keep:
            self.clear()
        packed = self[word] = b"".join(found)
        return packed

    def pack(self, text: str) -> bytes:
        if _UNKNOWN.search(text) or ("<|" in text and any(s in text for s in self.special)):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.__getitem__, text.lower().split()))


@lru_cache(2)
def packer_of(path: str) -> WordBpe:
    """One packer per worker process, so that later tasks find its words."""
    return WordBpe(path)
