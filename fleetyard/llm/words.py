"""Vectorised word and n-gram hashing over whole texts.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D`` in
the UTF-8 text (the same as the code-point class ``[^\\x20\\x09-\\x0D]+``).
Texts are handled many at a time as one byte buffer with text boundaries;
the hash of a word is a polynomial over random 64-bit letter values with a
final mix, so equal words have equal hashes in every task and run, and two
different words collide with a probability of about 2**-60. All arithmetic
is modulo 2**64 on unsigned integers.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
_RNG = np.random.default_rng(20240607)
_LETTER = _RNG.integers(1, 1 << 63, size=256, dtype=np.uint64) * U64(2) + U64(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = _LETTER.copy()
_LOWER[65:91] = _LETTER[97:123]
_BASE = int(0x9E3779B97F4A7C15)
_UNBASE = pow(_BASE, -1, 1 << 64)
# Work is done on about this many bytes at a time, so that the arrays stay in
# cache; one longer text makes a chunk of its own.
CHUNK_BYTES = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POW = {"up": _powers(_BASE, CHUNK_BYTES + 1), "down": _powers(_UNBASE, CHUNK_BYTES + 1)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POW["up"]) < n:
        if n > 1 << 22:                      # one very long text: not kept
            return _powers(_BASE, n), _powers(_UNBASE, n)
        _POW["up"], _POW["down"] = _powers(_BASE, n + n // 2), _powers(_UNBASE, n + n // 2)
    return _POW["up"], _POW["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Chunk:
    """Some texts of a batch: rows ``first .. first + n_texts - 1``."""

    first: int
    buf: np.ndarray          # bytes of the texts, one after the other
    bounds: np.ndarray       # n_texts + 1 byte offsets into buf
    starts: np.ndarray       # byte offset of every word
    ends: np.ndarray         # exclusive
    hashes: np.ndarray       # uint64 hash of every word
    word_bounds: np.ndarray  # n_texts + 1 offsets into the words

    @property
    def n_texts(self) -> int:
        return len(self.bounds) - 1

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_texts), np.diff(self.word_bounds))

    def word(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and offsets of a string or binary column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type)
                                  or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    off = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    off = off[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    buf = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf, off


def split_words(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words and the word offsets of the texts."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(bounds), dtype=np.int64)
    inside = ~_SPACE[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, bounds, side="left")


# Byte classes for split_tokens: 0 space, 1 letter, digit or any non-ASCII byte, 2 other sign.
_CLASS = np.full(256, 2, dtype=np.uint8)
_CLASS[_SPACE] = 0
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def split_tokens(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As split_words, but runs of letters and digits and runs of signs are tokens of their own."""
    n = len(buf)
    if n == 0:
        return split_words(buf, bounds)
    kind = _CLASS[buf]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    edge[[0, n]] = True
    edge[1:n] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(edge[:n] & (kind > 0))
    ends = np.flatnonzero(edge[1:] & (kind > 0)) + 1
    return starts, ends, np.searchsorted(starts, bounds, side="left")


# Byte classes for split_pieces: 1 letters and digits of ASCII and Latin-1, 2 ASCII
# signs but the apostrophe, 3 anything else.
_PIECE = np.full(256, 3, dtype=np.uint8)
_PIECE[_SPACE] = 0
_PIECE[33:127] = 2
_PIECE[39] = 3
_PIECE[[*range(48, 58), *range(65, 91), *range(97, 123)]] = 1


def split_pieces(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As split_words, and also cut between a letter or digit and an ASCII sign.

    For tokenizers that split letters from signs themselves. Only clear cases
    are cut: never next to an apostrophe or to a character beyond Latin-1.
    """
    n = len(buf)
    if n == 0:
        return split_words(buf, bounds)
    kind = _PIECE[buf]
    lead = np.flatnonzero(buf[:-1] == 0xC3)
    lead = lead[(buf[lead + 1] != 0x97) & (buf[lead + 1] != 0xB7)]
    kind[lead] = 1
    kind[lead + 1] = 1
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    edge[[0, n]] = True
    edge[1:n] |= (kind[1:] == 0) | (kind[:-1] == 0) | (kind[1:] + kind[:-1] == 3) & (kind[1:] < 3) & (kind[:-1] < 3)
    starts = np.flatnonzero(edge[:n] & (kind > 0))
    ends = np.flatnonzero(edge[1:] & (kind > 0)) + 1
    return starts, ends, np.searchsorted(starts, bounds, side="left")


def factorize(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each value's kind, the kinds). Workers do without pandas, whose
    import alone takes 18 MB of each."""
    kinds, codes = np.unique(values, return_inverse=True)
    return codes, kinds


def hash_words(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               lower: bool = False) -> np.ndarray:
    """64-bit hashes of the words; ``lower`` hashes A-Z as a-z."""
    if len(starts) == 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _LETTER)[buf] * up[:len(buf)], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64) * U64(0xD6E8FEB86659FD93))


def chunks(column: pa.Array, lower: bool = False, split=split_words) -> Iterator[Chunk]:
    """The texts of a column in chunks of about CHUNK_BYTES, words found by ``split``."""
    buf, off = byte_column(column)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + CHUNK_BYTES, side="right")) - 1)
        j = min(j, n)
        part = buf[off[i]:off[j]]
        bounds = off[i:j + 1] - off[i]
        starts, ends, wb = split(part, bounds)
        yield Chunk(i, part, bounds, starts, ends, hash_words(part, starts, ends, lower), wb)
        i = j


def ngrams(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Hash of the k words from each position; len - k + 1 values (none when shorter).

    The order of the words counts. Positions near a text's end run into the
    next text: callers mask them with ``within``.
    """
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    mult = _powers(_BASE ^ (2 * seed * 0x632BE59BD9B4E019 & ((1 << 64) - 1)), k)
    out = hashes[:m] * mult[k - 1]
    for j in range(1, k):
        out += hashes[j:j + m] * mult[k - 1 - j]
    return mix(out ^ U64(k * 0x9E3779B97F4A7C15 + seed & ((1 << 64) - 1)))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """As ``ngrams`` for long windows: one pass whatever k is (other values than ngrams)."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power_tables(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:len(hashes)], out=total[1:])
    return mix((total[k:] - total[:m]) * down[:m] + U64(k))


def within(word_bounds: np.ndarray, k: int) -> np.ndarray:
    """Mask over positions: the k words from it lie in one text."""
    n = int(word_bounds[-1])
    ok = np.ones(max(0, n - k + 1), dtype=bool)
    for j in range(1, k):
        cut = word_bounds[1:-1] - j
        cut = cut[(cut >= 0) & (cut < len(ok))]
        ok[cut] = False
    return ok
