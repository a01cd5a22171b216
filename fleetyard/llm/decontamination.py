"""Benchmark decontamination: SimHash of item-sized windows, then exact similarity.

For an item of L words every window of L successive words of a document (the
whole document where it has fewer) is a candidate occurrence. A window's
64-bit SimHash is summed over its K-word shingles, each weighted by how often
the window has it. Fingerprints within RADIUS bits of an item's agree within
RADIUS // BLOCKS bits in at least one of BLOCKS blocks, so tables by block
value find all of them; candidates are then verified by the exact weighted
Jaccard similarity of the shingle multisets, at least MIN_SIMILARITY.

Windows that hold none of an item's shingles have similarity 0 and are not
fingerprinted: one lookup of each document shingle finds where windows are
needed. An item of fewer than K words has its whole word sequence as only
shingle: its windows are as long, and are found by that shingle alone.

The items go to the executors in blocks of at most ITEM_BYTES of text (a pass
over the documents for each block), so what is broadcast is bounded however
large the benchmark is. Words are runs of non-space characters, A-Z as a-z.
Null or empty documents and items match nothing; repeated rows match each on
its own; items with equal ids are told apart by nothing but their place and
give a row each, the best one first.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetyard.llm.frames import column, give_back, map_batches, texts
from fleetyard.llm.words import U64, Chunk, chunks, ngrams, within

K, MIN_SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 20, 8
ITEM_BYTES = 64 << 20
_FILTER_BITS = 22


def shingles(hashes: np.ndarray, k: int = K) -> np.ndarray:
    """Shingle hashes in order; a shorter text is one shingle."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    return ngrams(hashes, min(k, len(hashes)))


def fingerprints(grams: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of grams[s : s + size] for every start s."""
    bits = np.unpackbits(grams.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(grams) + 1, 64), dtype=np.int32)
    np.cumsum(bits, axis=0, dtype=np.int32, out=total[1:])
    ones = total[starts + size] - total[starts]
    return np.packbits(2 * ones > size, axis=1, bitorder="little").view("<u8").reshape(-1)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard similarity of two shingle multisets."""
    if not len(a) or not len(b):
        return 0.0
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = int(np.minimum(n[i], m[j]).sum())
    return both / (len(a) + len(b) - both)


@dataclass
class LengthIndex:
    """The items of one length: their numbers, fingerprints and block tables."""

    items: np.ndarray
    prints: np.ndarray
    tables: np.ndarray      # (BLOCKS, 256, items): may be within the radius

    @staticmethod
    def of(items: np.ndarray, prints: np.ndarray, radius: int, blocks: int) -> LengthIndex:
        own = prints.astype("<u8").view(np.uint8).reshape(-1, 8)         # a block is a byte
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None, None] ^ own[None]) <= radius // blocks
        return LengthIndex(items, prints, np.moveaxis(near, 2, 0).copy())

    def within(self, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item place) of all pairs within the radius."""
        value = prints.astype("<u8").view(np.uint8).reshape(-1, 8)
        maybe = np.zeros((len(prints), len(self.items)), dtype=bool)
        for b in range(len(self.tables)):
            maybe |= self.tables[b][value[:, b]]
        w, i = np.nonzero(maybe)
        ok = np.bitwise_count(prints[w] ^ self.prints[i]) <= radius
        return w[ok], i[ok]


class ItemIndex:
    """Items of one block, searchable."""

    def __init__(self, ids: list, item_texts: list, k: int = K, radius: int = RADIUS):
        self.k, self.radius = k, radius
        self.ids, self.grams, self.n_words = [], [], []
        for c in chunks(pa.array(item_texts, type=pa.binary()), lower=True):
            for t in range(c.n_texts):
                a, b = c.word_bounds[t], c.word_bounds[t + 1]
                if b > a:
                    self.ids.append(ids[c.first + t])
                    self.grams.append(shingles(c.hashes[a:b], k))
                    self.n_words.append(int(b - a))
        self.n_words = np.array(self.n_words, dtype=np.int64)
        # items of one shingle by its length: shingles in order, and their items
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in sorted(set(self.n_words[self.n_words < k].tolist())):
            own = np.flatnonzero(self.n_words == size)
            grams = np.array([self.grams[n][0] for n in own.tolist()], dtype=np.uint64)
            order = np.argsort(grams, kind="stable")
            self.short[size] = grams[order], own[order]
        pairs = [(int(g), n) for n, gs in enumerate(self.grams) if self.n_words[n] >= k for g in set(gs.tolist())]
        pairs.sort()
        self.gram = np.array([g for g, _ in pairs], dtype=np.uint64)
        self.gram_item = np.array([n for _, n in pairs], dtype=np.int64)
        self.known = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.known[(self.gram >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True
        self.by_length: dict[int, LengthIndex] = {}
        prints = np.array([fingerprints(g, np.array([0]), len(g))[0] for g in self.grams], dtype=np.uint64)
        for size in np.unique(self.n_words[self.n_words >= k]).tolist():
            own = np.flatnonzero(self.n_words == size)
            self.by_length[size] = LengthIndex.of(own, prints[own], radius, BLOCKS)

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Places of grams that some item has."""
        maybe = np.flatnonzero(self.known[(grams >> U64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(maybe) or not len(self.gram):
            return maybe[:0]
        at = np.minimum(np.searchsorted(self.gram, grams[maybe]), len(self.gram) - 1)
        return maybe[self.gram[at] == grams[maybe]]

    def matches(self, hashes: np.ndarray, places: np.ndarray) -> dict[int, tuple[float, int]]:
        """Items in one document: {item: (similarity, first word)}; ``places``: its hits."""
        n = len(hashes)
        grams = shingles(hashes, self.k)
        a = np.searchsorted(self.gram, grams[places], side="left")
        b = np.searchsorted(self.gram, grams[places], side="right")
        needed: dict[int, list[tuple[int, int]]] = {}
        for place, x, y in zip(places.tolist(), a.tolist(), b.tolist()):
            for size in set(self.n_words[self.gram_item[x:y]].tolist()):
                needed.setdefault(size, []).append(place)
        found: dict[int, tuple[float, int]] = {}
        for size, at in needed.items():
            if n <= size:
                starts, m = np.array([0]), len(grams)
            else:
                m = size - self.k + 1
                reach = np.zeros(n - size + 2, dtype=np.int64)     # starts of windows that hold a hit
                at = np.array(at)
                np.add.at(reach, np.clip(at - m + 1, 0, n - size + 1), 1)
                np.add.at(reach, np.clip(at + 1, 0, n - size + 1), -1)
                starts = np.flatnonzero(np.cumsum(reach[:-1]) > 0)
                if not len(starts):
                    continue
            index = self.by_length[size]
            for piece in range(0, len(starts), 4096):
                s = starts[piece:piece + 4096]
                low, high = int(s[0]), int(s[-1]) + m
                w, i = index.within(fingerprints(grams[low:high], s - low, m), self.radius)
                for x, y in zip(s[w].tolist(), index.items[i].tolist()):
                    sim = similarity(grams[x:x + m], self.grams[y])
                    if sim >= MIN_SIMILARITY and (sim, -x) > (found.get(y, (0.0, 0))[0], -found.get(y, (0.0, 0))[1]):
                        found[y] = (sim, x)
        return found

    def scan(self, texts_: pa.Array):
        """(row, item number, similarity, first word) of all matches in a column of texts."""
        if not len(self.n_words):
            return
        for c in chunks(texts_, lower=True):
            found: dict[tuple[int, int], tuple[float, int]] = {}
            if len(c.hashes) >= self.k:
                at = self.hits(ngrams(c.hashes, self.k))
                at = at[within(c.word_bounds, self.k)[at]]
                text = np.searchsorted(c.word_bounds, at, side="right") - 1
                for t in np.unique(text).tolist():
                    own = c.hashes[c.word_bounds[t]:c.word_bounds[t + 1]]
                    found |= {(t, item): m for item, m in self.matches(own, at[text == t] - c.word_bounds[t]).items()}
            for size in self.short:
                found |= self.short_matches(c, size)
            for (t, item), (sim, start) in sorted(found.items()):
                yield c.first + t, item, sim, start

    def short_matches(self, c: Chunk, size: int) -> dict[tuple[int, int], tuple[float, int]]:
        """Items of ``size`` words, fewer than K, in a chunk: {(text, item): (1, first word)}."""
        grams, items = self.short[size]
        own = ngrams(c.hashes, size)
        if not len(own):
            return {}
        a, b = (np.searchsorted(grams, own, side=s) for s in ("left", "right"))
        at = np.flatnonzero((b > a) & within(c.word_bounds, size))
        text = np.searchsorted(c.word_bounds, at, side="right") - 1
        out: dict[tuple[int, int], tuple[float, int]] = {}
        for place, t in zip(at.tolist(), text.tolist()):
            for item in items[a[place]:b[place]].tolist():
                out.setdefault((t, item), (1.0, place - int(c.word_bounds[t])))
        return out


def item_blocks(benchmark: DataFrame, most: int = ITEM_BYTES):
    """The items as lists (ids, texts) of at most ``most`` bytes of text (or one item)."""
    t = texts(benchmark, "item_id").withColumnRenamed("doc_id", "item_id").filter("length(text) > 0")
    total = t.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-2 * int(total) // most)) if total > most else 1
    for block in range(n if total else 0):
        rows = t.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == block).orderBy("item_id", "text").collect()
        yield [r["item_id"] for r in rows], [bytes(r["text"]) for r in rows]


def find_leaks(docs: DataFrame, benchmark: DataFrame, k: int = K, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, similarity, start): for every document row and item that
    occurs in it the most similar window (the first of equal ones) and its first word."""
    spark, out = docs.sparkSession, None
    schema = "doc_id long, item_id long, similarity double, start int"
    for ids, item_texts in item_blocks(benchmark):
        shared = spark.sparkContext.broadcast(ItemIndex(ids, item_texts, k, radius))   # at most ITEM_BYTES of items

        def run(batch: pa.RecordBatch, shared=shared):
            index = shared.value
            found = list(index.scan(column(batch, "text")))
            if not found:
                return None
            row, item, sim, start = zip(*found)
            return pa.RecordBatch.from_arrays(
                [column(batch, "doc_id").take(pa.array(row)), pa.array([index.ids[i] for i in item], pa.int64()),
                 pa.array(sim, pa.float64()), pa.array(start, pa.int32())],
                names=["doc_id", "item_id", "similarity", "start"])

        part = map_batches(texts(docs), run, schema)
        out = part if out is None else out.union(part)
    return spark.createDataFrame([], schema) if out is None else out


def leaks_any(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> Column:
    """Condition: the row's text holds an item (never null)."""
    spark, cond = docs.sparkSession, F.lit(False)

    def condition(shared) -> Column:
        @F.arrow_udf("boolean")
        def leaks(text: pa.Array) -> pa.Array:
            give_back()
            out = np.zeros(len(text), dtype=bool)
            for row, _, _, _ in shared.value.scan(text):
                out[row] = True
            return pa.array(out)

        return leaks(docs[text_col])

    for ids, item_texts in item_blocks(benchmark):
        cond = cond | condition(spark.sparkContext.broadcast(ItemIndex(ids, item_texts)))
    return cond
