"""Exact token counts of every prefix of a text (operator 1).

A byte-level BPE encoding is the only split of the bytes into tokens in which each
token stands for itself and every two neighbours stay two when encoded together. So
for every end position exactly one vocabulary token continues an earlier prefix, and
dynamic programming over the prefixes gives the count at each of them in one pass.
Pre-tokens are independent, so a text's counts are those of its pre-tokens in a row,
each computed once per worker.

Stored as one signed step per character, the counts answer how many tokens any
prefix has, and where to cut for a budget, without encoding again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.wordbpe import byte_alphabet

# The pre-token pattern of byte-level BPE, and characters whose classes
# are the same in every Unicode version. Texts with others are split by the library.
_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_UNKNOWN = regex.compile(r"[^\x00-\x1b\x20-\x7f\xa1-\xac\xae-ſ‐-‧‰-›€™]")
_BLANKS = regex.compile(r"\s\s")


class PrefixCounter(dict):
    """Steps of the token count per character, as ``narrow`` stores them; as a mapping, those of one pre-token."""

    def __init__(self, path: str, keep: int = 400_000):
        super().__init__()
        self.words: dict[str, bytes] = {}
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.alphabet = byte_alphabet()
        self.special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        vocab = [t for t in self.library.get_vocab() if t not in self.special]
        #: A number from 1 for tokens that stand for themselves, 0 for other beginnings of tokens.
        self.begins = {t[:n]: 0 for t in vocab for n in range(1, len(t))}
        alone = [t for t in vocab if len(self.model.tokenize(t)) == 1]
        self.begins |= {t: k for k, t in enumerate(alone, 1)}
        self.tokens = ["", *alone]
        self.longest = max(map(len, alone))
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.keep = keep
        self.stays: dict[int, bool] = {}
        self._forget()

    def _two(self, left: int, right: int) -> bool:
        """Whether two tokens in a row are encoded as these two."""
        if len(self.stays) >= 4 * self.keep:
            self.stays.clear()
        pair = [self.tokens[left], self.tokens[right]]
        found = self.stays[left << 20 | right] = [t.value for t in self.model.tokenize("".join(pair))] == pair
        return found

    def _forget(self) -> None:
        """Drops the tree of prefixes: a child of (node, byte), each node's last token and count."""
        self.child: dict[int, int] = {}
        self.last, self.number = [0], [0]

    def counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of a pre-token, by character, each encoded as one pre-token.

        A prefix's state doesn't depend on what follows, so pre-tokens share a tree.
        """
        if len(self.last) >= 3 * self.keep:
            self._forget()
        if piece.isascii() and piece.isprintable():
            mapped, ends = piece.replace(" ", self.alphabet[32]), None
        else:
            raw = piece.encode()
            mapped = "".join([self.alphabet[b] for b in raw])
            ends = [k for k, b in enumerate(raw) if b & 192 != 128][1:] + [len(raw)]  # before each next character
        child, last, number = self.child, self.last, self.number
        begins, stays, longest = self.begins.get, self.stays.get, self.longest
        node, path = 0, [0]
        for end, byte in enumerate(map(ord, mapped), 1):
            key = node << 9 | byte
            node = child.get(key, 0)
            if not node:
                # Exactly one token both ends here and stays beside what it follows.
                for start in range(end - 1, max(-1, end - 1 - longest), -1):
                    token = begins(mapped[start:end])
                    if token:
                        before = last[path[start]]
                        stay = stays(before << 20 | token) if start else True
                        if self._two(before, token) if stay is None else stay:
                            break
                node = child[key] = len(last)
                last.append(token)
                number.append(number[path[start]] + 1)
            path.append(node)
        found = [number[n] for n in path[1:]]
        return [found[e - 1] for e in ends] if ends else found

    def _pieces(self, text: str) -> list[str]:
        if not text.isascii() and _UNKNOWN.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return _PATTERN.findall(text)

    def _of_piece(self, piece: str) -> list[int]:
        if piece in ("'re", "'ve", "'ll"):
            # Cut short, the apostrophe and the letter are two pre-tokens.
            return [1, 1 + self.counts(piece[1])[-1], self.counts(piece)[-1]]
        return self.counts(piece)

    def _blank_steps(self, text: str) -> bytes:
        """The stored steps of a text without special strings in which blanks may follow blanks."""
        steps: list[int] = []
        pieces = self._pieces(text)
        total = 0  # tokens of the finished pre-tokens
        shown = 0  # the count at the last prefix
        for n, piece in enumerate(pieces):
            counts = [*self._of_piece(piece)]
            after = total + counts[-1]
            if n and piece[0].isspace() and pieces[n - 1].isspace():
                # A prefix that ends here ends in the whole blank run, which is then one pre-token.
                counts[0] = self.counts(pieces[n - 1] + piece[0])[-1] - (total - before)
            before = total
            for count in counts:
                steps.append(total + count - shown)
                shown = total + count
            total = after
        return narrow(np.array(steps, dtype=np.int64))

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.keep:
            self.clear()
        counts = self._of_piece(piece)
        steps = self[piece] = narrow(np.diff(counts, prepend=0)) if len(counts) > 60 else _narrow([b - a for a, b in zip([0, *counts], counts)])
        return steps

    def _of_word(self, word: str) -> bytes:
        """The stored steps of a blank and the word after it: those of its pre-tokens in a row."""
        words = self.words
        if len(words) >= self.keep:
            words.clear()
        found = words[word] = b"".join(map(self.__getitem__, _PATTERN.findall(" " + word)))
        return found

    def _plain(self, text: str) -> bytes:
        if _BLANKS.search(text) or not text.isascii() and _UNKNOWN.search(text):
            return self._blank_steps(text)
        head, *rest = text.split(" ")
        get, missing = self.words.get, self._of_word
        return b"".join([*map(self.__getitem__, _PATTERN.findall(head)), *[get(word) or missing(word) for word in rest]])

    def stored(self, text: str) -> bytes:
        """The change of the token count with each character as ``narrow`` stores it, special strings included."""
        parts = self.split_special.split(text) if self.split_special and "<|" in text else [text]
        if len(parts) == 1:
            return self._plain(text)
        found: list[bytes] = []
        for part, special in zip(parts[::2], [*parts[1::2], ""], strict=True):
            plain = self._plain(part)
            found.append(plain)
            if special:
                # Up to its last character the special string is ordinary text.
                ends = [int(prefix_counts(plain)[-1]) if plain else 0]
                ends += [len(self.library.encode(part + special[:k], add_special_tokens=False).ids) for k in range(1, len(special))]
                found.append(narrow(np.diff([*ends, ends[0] + 1])))
        return b"".join(found)

    def steps(self, text: str) -> np.ndarray:
        """The change of the token count with each character."""
        return np.diff(prefix_counts(self.stored(text)), prepend=0)


@lru_cache(2)
def counter_of(path: str) -> PrefixCounter:
    """One counter per worker process, so that later tasks find its words."""
    return PrefixCounter(path)


def _narrow(steps: list[int]) -> bytes:
    if min(steps) > -128 and max(steps) < 128:
        return bytes([s & 255 for s in steps])
    return b"".join(bytes([s & 255]) if -128 < s < 128 else b"\x80" + s.to_bytes(4, "little", signed=True) for s in steps)


def narrow(steps: np.ndarray) -> bytes:
    """One byte a step; where a step needs more, the byte -128 and four bytes of it. Stretches of steps may be joined."""
    if not len(steps) or (steps.min() > -128 and steps.max() < 128):
        return steps.astype("i1").tobytes()
    return _narrow(steps.tolist())


def prefix_counts(stored: bytes) -> np.ndarray:
    """Tokens of the prefixes of 1, 2, ... characters, from the stored steps."""
    if b"\x80" not in stored:
        return np.cumsum(np.frombuffer(stored, dtype="i1"), dtype=np.int64)
    steps, at = [], 0
    while at < len(stored):
        wide = stored[at] == 128
        steps.append(int.from_bytes(stored[at + 1 : at + 5] if wide else stored[at : at + 1], "little", signed=True))
        at += 5 if wide else 1
    return np.cumsum(steps, dtype=np.int64)


def longest_prefix(counts: np.ndarray, budget: int) -> int:
    """Characters of the longest prefix of at most ``budget`` tokens."""
    within = np.flatnonzero(counts <= budget)
    return int(within[-1]) + 1 if len(within) else 0


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars, prefix_steps) of every document.

    ``fit_chars`` is the length of the longest prefix of at most ``limit`` tokens and
    ``prefix_steps`` holds the count at every prefix (see ``prefix_counts``). A null or
    empty text has no bytes, tokens or steps. Repeated rows are counted each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(tokenizer)
        for batch in batches:
            size, tokens, fit, stored = [], [], [], []
            for text in batch.column(1).to_pylist():
                steps = counter.stored(text or "")
                counts = prefix_counts(steps)
                size.append(len((text or "").encode()))
                tokens.append(int(counts[-1]) if len(counts) else 0)
                fit.append(len(counts) if tokens[-1] <= limit else longest_prefix(counts, limit))
                stored.append(steps)
            over = [n > limit for n in tokens]
            arrays = [batch.column(0), pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array(over, pa.bool_()), pa.array(fit, pa.int64()), pa.array(stored, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_chars", "prefix_steps"])

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_chars long, prefix_steps binary"
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, schema)
