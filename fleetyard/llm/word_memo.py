"""Encode texts through a tokenizer word by word, each distinct word once.

Valid for tokenizers whose pieces never cross the borders between words (each
operator states why they don't). The tokenizer sees every distinct word of a
chunk that the memo does not hold; the ids of whole texts are then gathered
with array indexing. The memo is a hash table in arrays and is bounded: when
it holds ``max_words`` words or ``max_ids`` ids it starts afresh.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from fleetyard.llm.words import U64, Chunk, factorize

# Words handed to the tokenizer at once.
ENCODE_WORDS = 2000


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the concatenated ranges [start, start + length)."""
    total = int(lengths.sum())
    if total == 0:
        return np.zeros(0, dtype=np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class HashTable:
    """64-bit keys to row numbers 0, 1, ...; all lookups and inserts are by array."""

    def __init__(self, max_keys: int):
        self.mask = U64((1 << max(4, (2 * max_keys - 1).bit_length())) - 1)
        self.keys = np.zeros(int(self.mask) + 1, dtype=np.uint64)   # 0: free
        self.rows = np.zeros(int(self.mask) + 1, dtype=np.int32)
        self.n = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of every key, -1 for those not there."""
        keys = np.maximum(keys, U64(1))
        out = np.full(len(keys), -1, dtype=np.int64)
        todo, at = np.arange(len(keys)), keys & self.mask
        while len(todo):
            held = self.keys[at]
            hit = held == keys[todo]
            out[todo[hit]] = self.rows[at[hit]]
            go_on = ~hit & (held != 0)
            todo, at = todo[go_on], (at[go_on] + U64(1)) & self.mask
        return out

    def add(self, keys: np.ndarray) -> None:
        """Give the next rows to distinct keys that are not there."""
        keys = np.maximum(keys, U64(1))
        rows = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        self.n += len(keys)
        todo, at = np.arange(len(keys)), keys & self.mask
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[todo[free]]      # of several for one place, the last stays
            mine = free & (self.keys[at] == keys[todo])
            self.rows[at[mine]] = rows[todo[mine]]
            todo, at = todo[~mine], (at[~mine] + U64(1)) & self.mask


class WordMemo:
    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]],
                 max_words: int = 1 << 20, max_ids: int = 1 << 23):
        self.encode, self.max_words, self.max_ids = encode, max_words, max_ids
        self._reset()

    def _reset(self) -> None:
        self.table = HashTable(1 << 12)               # all grow with the words that come
        self.first = np.zeros(1 << 12, dtype=np.int32)
        self.count = np.zeros(1 << 12, dtype=np.int32)
        self.ids = np.zeros(1 << 14, dtype=np.int32)
        self.n_ids = 0

    def _add(self, keys: np.ndarray, words: list[str]) -> None:
        found = [ids for at in range(0, len(words), ENCODE_WORDS)
                 for ids in self.encode(words[at:at + ENCODE_WORDS])]
        counts = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        total, n = int(counts.sum()), self.table.n
        if self.n_ids + total > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.n_ids], np.zeros(self.n_ids + 2 * total, np.int32)])
        if n + len(keys) > len(self.first):
            extra = np.zeros(n + 2 * len(keys), np.int32)
            self.first, self.count = np.concatenate([self.first, extra]), np.concatenate([self.count, extra])
        self.ids[self.n_ids:self.n_ids + total] = [i for ids in found for i in ids]
        self.first[n:n + len(keys)] = self.n_ids + np.cumsum(counts) - counts
        self.count[n:n + len(keys)] = counts
        if 2 * (n + len(keys)) > len(self.table.keys):
            bigger = HashTable(2 * (n + len(keys)))
            held = np.flatnonzero(self.table.keys)
            bigger.add(self.table.keys[held][np.argsort(self.table.rows[held])])
            self.table = bigger
        self.table.add(keys)
        self.n_ids += total

    def texts(self, chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words of the chunk, and the n_texts + 1 offsets of its texts."""
        if self.table.n > 0.9 * self.max_words or self.n_ids > self.max_ids:
            self._reset()
        codes, keys = factorize(chunk.hashes)
        at = self.table.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            where = np.empty(len(keys), dtype=np.int64)
            where[codes[::-1]] = np.arange(len(codes))[::-1]
            text = [chunk.word(i).decode("utf-8", "replace") for i in where[new].tolist()]
            at[new] = np.arange(self.table.n, self.table.n + len(new))
            self._add(keys[new], text)
        at = at[codes]
        lengths = self.count[at].astype(np.int64)
        ids = self.ids[ragged(self.first[at].astype(np.int64), lengths)]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ids, ends[chunk.word_bounds]
