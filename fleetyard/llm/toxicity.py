"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams
(MIN_GRAM to MAX_GRAM code points of ``<word>``, hashed to ROWS rows) and of
the whole word, so unseen spellings share most of their vectors with known
ones. The vectors of WINDOW successive words are averaged and go through a
linear softmax over the two labels; a document's score is the softmax of the
mean logit of its TOP_WINDOWS most toxic windows, so a long document is not
diluted and a single odd word is not enough. Embeddings and softmax
are trained jointly in numpy by gradient steps on documents: first on the mean
of all words, then on the most toxic windows of every document (for clean
documents these are the hard negatives).

Training uses at most TRAIN_TOXIC and TRAIN_CLEAN labelled documents, those
with the smallest hash of the id, never one that is held out. Only the text is
an input. Null and empty texts have no words and get the score of an empty
average; repeated rows each have their own result; a null id is not held out;
a null label is no label, and of several labels of one id the largest counts.
Without both classes among the labels every score is 0.5 or below.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.llm.frames import column, map_stream, texts
from fleetyard.llm.word_memo import HashTable, ragged
from fleetyard.llm.words import U64, Chunk, chunks, factorize, mix, split_pieces

MIN_GRAM, MAX_GRAM = 3, 6
ROWS, DIM = 1 << 17, 8
WINDOW, TOP_WINDOWS = 4, 2
TRAIN_TOXIC, TRAIN_CLEAN = 1500, 3000
TOXIC_AT = 0.7

_GRAM = [int(x) for x in np.random.default_rng(99).integers(1, 1 << 62, size=MAX_GRAM + 1) * 2 + 1]


def word_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the words' n-grams, and how many each word has."""
    marked = "".join(f"<{w}>" for w in words)
    points = np.frombuffer(marked.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    lengths = np.array([len(w) + 2 for w in words], dtype=np.int64)
    of = np.repeat(np.arange(len(words)), lengths)
    starts = np.cumsum(lengths) - lengths
    rows, owner = [], []
    for n in range(MIN_GRAM, MAX_GRAM + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        h = np.full(m, n, dtype=np.uint64)
        for j in range(n):
            h = (h + points[j:j + m]) * U64(_GRAM[j])
        ok = np.flatnonzero(of[:m] == of[n - 1:])
        rows.append(mix(h[ok]) & U64(ROWS - 1))
        owner.append(of[ok])
    weights = np.arange(len(points)).astype(np.uint64) - np.repeat(starts, lengths).astype(np.uint64)
    whole = np.add.reduceat(mix(points * U64(_GRAM[0]) + weights * U64(_GRAM[1])), starts) if len(words) else np.zeros(0, U64)
    rows.append(mix(whole) & U64(ROWS - 1))
    owner.append(np.arange(len(words)))
    rows, owner = np.concatenate(rows).astype(np.int32), np.concatenate(owner).astype(np.int32)
    order = np.argsort(owner, kind="stable")
    return rows[order], np.bincount(owner, minlength=len(words))


def _segment_sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values)])
    return np.diff(total[np.concatenate([[0], ends])])


class ToxicModel:
    """emb (ROWS, DIM), softmax weights (DIM, 2) and bias (2)."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.emb = r.uniform(-1 / DIM, 1 / DIM, (ROWS, DIM))
        self.out = r.normal(0, 0.5, (DIM, 2))
        self.bias = np.array([1.0, -1.0])

    def direction(self) -> tuple[np.ndarray, float]:
        """The softmax over two labels as one logit: u, c."""
        return self.out[:, 1] - self.out[:, 0], float(self.bias[1] - self.bias[0])

    def word_logits(self, words: list[str]) -> np.ndarray:
        """Each word's share of a window's logit (the average of these, plus bias)."""
        if not words:
            return np.zeros(0)
        rows, n = word_rows(words)
        return _segment_sums((self.emb @ self.direction()[0])[rows], np.cumsum(n)) / n


def top_windows(z: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every text the mean of its TOP_WINDOWS most toxic windows (fewer in a
    short text, 0 without words), and all those windows: text and first word.

    A text's windows are its words from the first on, WINDOW at a time; the
    last is filled up with zero vectors.
    """
    n = np.diff(bounds)
    windows = -(-n // WINDOW)
    starts = np.repeat(bounds[:-1], windows) + WINDOW * (ragged(np.zeros_like(windows), windows))
    of = np.repeat(np.arange(len(n)), windows)
    if not len(starts):
        return np.zeros(len(n)), of, starts
    means = np.add.reduceat(z, starts) / WINDOW
    some = np.flatnonzero(windows)
    first = np.cumsum(windows)[some] - windows[some]
    total, count, texts_, places = np.zeros(len(n)), np.zeros(len(n)), [], []
    for _ in range(TOP_WINDOWS):
        best = np.full(len(n), -np.inf)
        best[some] = np.maximum.reduceat(means, first)
        hit = np.flatnonzero((means == best[of]) & np.isfinite(means))
        docs, index = np.unique(of[hit], return_index=True)
        total[docs] += best[docs]
        count[docs] += 1
        texts_.append(docs)
        places.append(starts[hit[index]])
        means[hit[index]] = -np.inf
    return total / np.maximum(1, count), np.concatenate(texts_), np.concatenate(places)


def fit(documents: list[list[str]], toxic: np.ndarray, **settings) -> ToxicModel:
    """Train on documents given as lists of lower-case words."""
    import pandas as pd                      # on the driver; workers do without it
    codes, words = pd.factorize(np.array([w for d in documents for w in d], dtype=object))
    return fit_coded(list(words), codes, np.array([len(d) for d in documents], dtype=np.int64), toxic, **settings)


def fit_coded(words: list[str], codes: np.ndarray, lengths: np.ndarray, toxic: np.ndarray, warm: int = 60,
              steps: int = 60, rate: float = 0.3, seed: int = 3) -> ToxicModel:
    """Train on documents given as codes into a list of distinct words, one
    after the other, and their lengths."""
    model = ToxicModel(seed)
    y = np.asarray(toxic, dtype=float)
    if not len(y) or y.min() == y.max():
        model.emb[:] = 0.0
        model.bias[:] = [0.0, 0.0] if not len(y) or y.max() else [1.0, -1.0]
        return model
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    doc_of = np.repeat(np.arange(len(y)), lengths)
    parts = [word_rows(words[a:a + 10_000]) for a in range(0, len(words), 10_000)]
    rows, grams = np.concatenate([r for r, _ in parts]), np.concatenate([n for _, n in parts])
    del parts
    ends = np.cumsum(grams)
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    moment = {k: np.zeros_like(getattr(model, k)) for k in ("emb", "out", "bias")}
    for step in range(1, warm + steps + 1):
        u, c = model.direction()
        z_word = np.add.reduceat((model.emb @ u)[rows], ends - grams) / grams
        if step <= warm:
            logit = _segment_sums(z_word[codes], bounds[1:]) / np.maximum(1, lengths) * 4 + c
            scale, at, of = 4 / np.maximum(1, lengths), np.arange(len(codes)), doc_of
        else:
            best, of, places = top_windows(z_word[codes], bounds)
            logit = best + c
            width = np.minimum(bounds[of + 1] - places, WINDOW)
            scale = 1 / (WINDOW * np.maximum(1, np.bincount(of, minlength=len(y))))
            at, of = ragged(places, width), np.repeat(of, width)
        p = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        d_logit = (p - y) * weight
        d_word = np.bincount(codes[at], weights=(d_logit * scale)[of], minlength=len(words)) / grams
        live = np.flatnonzero(d_word)
        row = rows if len(live) == len(words) else rows[ragged(ends[live] - grams[live], grams[live])]
        d_row = np.bincount(row, weights=np.repeat(d_word[live], grams[live]), minlength=ROWS)
        d_u = model.emb.T @ d_row
        grad = {"emb": d_row[:, None] * u + 1e-7 * model.emb, "out": np.stack([-d_u, d_u], 1),
                "bias": np.array([-1.0, 1.0]) * d_logit.sum()}
        # One step size for all rows, so that n-grams which many documents share
        # move most and those of a single document hardly at all.
        for k, g in grad.items():
            moment[k] = 0.8 * moment[k] + g
            largest = np.abs(moment[k]).max()
            if largest > 0:
                getattr(model, k)[...] -= rate * (1 - 0.8 * step / (warm + steps)) * moment[k] / largest
    return model


def text_words(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pieces that are not signs, and the texts' bounds in them."""
    first = c.buf[c.starts] if len(c.starts) else np.zeros(0, np.uint8)
    sign = (first < 48) | (first > 57) & (first < 65) | (first > 90) & (first < 97) | (first > 122) & (first < 128)
    keep = np.flatnonzero(~sign)
    return keep, np.searchsorted(keep, c.word_bounds)


def _lower(c: Chunk, i: int) -> str:
    return c.word(i).decode("utf-8", "replace").lower()


def training_rows(docs: DataFrame, labels: DataFrame, max_toxic: int,
                  max_clean: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The bounded training sample: distinct words, codes, lengths, labels."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("toxic").alias("toxic"))
             .filter(F.crc32(F.col("label_id").cast("string")) % 3 != 1))
    t = texts(docs)
    rows = []
    for value, limit in ((1, max_toxic), (0, max_clean)):
        ids = (known.filter(F.col("toxic") == value)
               .orderBy(F.xxhash64("label_id"), "label_id").limit(limit).select("label_id"))
        # at most `limit` ids, and of repeated rows of an id the first text: at most `limit` rows
        rows += [(bytes(r["text"] or b""), value) for r in
                 t.join(F.broadcast(ids), t["doc_id"] == ids["label_id"]).groupBy("label_id").agg(F.min("text").alias("text"))
                 .select("text").collect()]
    rows.sort()
    keys, lengths, known_words = [], [], {}
    for c in chunks(pa.array([r[0] for r in rows], type=pa.binary()), lower=True, split=split_pieces):
        keep, bounds = text_words(c)
        own = c.hashes[keep]
        _, first = np.unique(own, return_index=True)
        for k, i in zip(own[first].tolist(), keep[first].tolist()):
            if k not in known_words:
                known_words[k] = _lower(c, i)
        keys.append(own)
        lengths.append(np.diff(bounds))
    import pandas as pd                      # on the driver; workers do without it
    codes, distinct = pd.factorize(np.concatenate(keys)) if keys else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
    return ([known_words[k] for k in distinct.tolist()], codes,
            np.concatenate(lengths) if lengths else np.zeros(0, np.int64), np.array([r[1] for r in rows]))


class _Logits:
    """Memo of words' logits by hash; bounded."""

    def __init__(self, model: ToxicModel, max_words: int = 1 << 19):
        self.model, self.max_words = model, max_words
        self.table, self.z = HashTable(max_words), np.zeros(0)

    def of(self, c: Chunk, keep: np.ndarray) -> np.ndarray:
        codes, keys = factorize(c.hashes[keep])
        at = self.table.find(keys)
        new = np.flatnonzero(at < 0)
        if self.table.n + len(new) > self.max_words:
            self.table, self.z = HashTable(max(self.max_words, len(keys))), np.zeros(0)
            at[:] = -1
            new = np.arange(len(keys))
        if len(new):
            where = np.empty(len(keys), dtype=np.int64)
            where[codes[::-1]] = keep[::-1]
            at[new] = np.arange(self.table.n, self.table.n + len(new))
            z = [self.model.word_logits([_lower(c, i) for i in where[new[a:a + 4000]].tolist()])
                 for a in range(0, len(new), 4000)]
            self.table.add(keys[new])
            self.z = np.concatenate([self.z, *z])
        return self.z[at[codes]]


def score(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """doc_id, score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((model.emb.astype(np.float32), model.out, model.bias))

    def run(batches):
        m = ToxicModel.__new__(ToxicModel)
        m.emb, m.out, m.bias = shared.value
        memo, c0 = _Logits(m), m.direction()[1]
        for b in batches:
            doc = column(b, "doc_id")
            for c in chunks(column(b, "text"), lower=True, split=split_pieces):
                keep, bounds = text_words(c)
                best, _, _ = top_windows(memo.of(c, keep), bounds)
                yield pa.RecordBatch.from_arrays(
                    [doc.slice(c.first, c.n_texts), pa.array(1 / (1 + np.exp(-np.clip(best + c0, -50, 50))))],
                    names=["doc_id", "score"])

    return texts(docs).transform(map_stream, run, "doc_id long, score double")


def toxicity(docs: DataFrame, labels: DataFrame, max_toxic: int = TRAIN_TOXIC,
             max_clean: int = TRAIN_CLEAN) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = fit_coded(*training_rows(docs, labels, max_toxic, max_clean))
    return score(docs, model).select(
        "doc_id", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"))
