"""Quality classifier: hierarchical empirical Bayes over documents, paths and hosts.

Evidence of a document is the log likelihood ratio of a logistic model over
hashed unigrams and bigrams of tokens (runs of letters and digits, runs of
signs; relative frequencies) and over the text's shape (repeated words and
lines, capitals, signs, length), trained in numpy on at most TRAIN_EACH labelled
documents of each class, those with the smallest hash of the id.

Every document's probability under the global prior is summed by path (host
and path) and by host, in grouped aggregations over all documents. A host's
rate is shrunk toward the global rate, a path's toward its host's:
(sum + strength * parent) / (n + strength). The two strengths (in documents)
come from the spread of the rates between sites, by the method of moments, so
a sparse site takes its parent's rate and a well-filled one keeps its own. A
document's score is its evidence on top of its path's rate without itself.

Null hosts or paths are sites of their own name (empty). Null and empty texts
have no evidence: their site's rate is their score. Null labels are none; of
several labels of one id the largest counts. With labels of one class only,
there is no evidence anywhere and every score is the global prior. Repeated
rows count as often as they occur. No row is dropped.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetyard.llm.frames import column, map_stream, texts, written
from fleetyard.llm.quality_rules import _sums, _tokens, base_counts, gram_buckets
from fleetyard.llm.words import Chunk, chunks

BUCKETS = 1 << 14
TRAIN_EACH = 2500
KEEP_AT = 0.5
# Evidence of one document is at most this (log odds), so that no text outweighs any site.
MOST = 12.0
# Strengths lie between these (documents).
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1e6


def training_rows(docs: DataFrame, labels: DataFrame, each: int) -> list[tuple[bytes, int]]:
    known = (labels.filter("quality is not null and doc_id is not null")
             .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max("quality").alias("quality")))
    t, rows = texts(docs), []
    for value in (0, 1):
        ids = known.filter(F.col("quality") == value).orderBy(F.xxhash64("label_id"), "label_id").limit(each).select("label_id")
        # at most `each` ids, and of repeated rows of an id the first text: at most `each` rows
        rows += [(bytes(r["text"] or b""), value) for r in
                 t.join(F.broadcast(ids), t["doc_id"] == ids["label_id"]).groupBy("label_id").agg(F.min("text").alias("text"))
                 .select("text").collect()]
    return sorted(r for r in rows if r[0])


SHAPES = 4
LENGTHS = 24
SIZE = BUCKETS + SHAPES + LENGTHS
_CAPITAL = np.zeros(256, dtype=np.int64)
_CAPITAL[65:91] = 1
_LETTER = np.zeros(256, dtype=np.int64)
_LETTER[[*range(65, 91), *range(97, 123)]] = 1


def _shape(c: Chunk) -> np.ndarray:
    """(texts, SHAPES): shares of repeated words, repeated lines, capitals and signs."""
    n = base_counts(c)
    words = np.maximum(1, n["n_words"])
    lines = np.maximum(1, _sums((c.buf == 10).astype(np.int64), c.bounds) + 1)
    letters = np.maximum(1, _sums(_LETTER[c.buf], c.bounds))
    return np.stack([n["n_repeat_words"] / words, n["n_dup_lines"] / lines, _sums(_CAPITAL[c.buf], c.bounds) / letters,
                     np.minimum(1.0, n["n_symbols"] / words)], axis=1)


def _features(column_: pa.Array):
    """For every chunk: the chunk, and the features of its texts as (feature, text, value)."""
    for c in chunks(column_):
        h, bounds = _tokens(c)
        one, two, at = gram_buckets(h, bounds, BUCKETS)
        n = np.diff(bounds)
        of = np.repeat(np.arange(c.n_texts), n)
        share = 1 / np.maximum(1, 2 * n - 1)
        some = np.flatnonzero(n)
        words = np.diff(c.word_bounds)[some]
        length = np.minimum(LENGTHS - 1, np.log2(np.maximum(1, words)).astype(np.int64))
        shape = _shape(c)[some]
        feature = np.concatenate([one, two, BUCKETS + np.tile(np.arange(SHAPES), len(some)), BUCKETS + SHAPES + length])
        text = np.concatenate([of, of[at], np.repeat(some, SHAPES), some])
        value = np.concatenate([share[of], share[of[at]], shape.reshape(-1), np.full(len(some), 0.2)])
        yield c, feature, text, value


def fit(rows: list[tuple[bytes, int]], epochs: int = 400, rate: float = 1.5, decay: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights by feature and offset of the evidence; zeros without both classes."""
    y = np.array([v for _, v in rows], dtype=float)
    if not len(y) or y.min() == y.max():
        return np.zeros(SIZE), 0.0
    bucket, owner, value = [], [], []
    for c, feature, text, x in _features(pa.array([r[0] for r in rows], pa.binary())):
        key, inverse = np.unique(text * SIZE + feature, return_inverse=True)
        owner.append(key // SIZE + c.first)
        bucket.append(key % SIZE)
        value.append(np.bincount(inverse, weights=x))
    bucket, owner, value = np.concatenate(bucket), np.concatenate(owner), np.concatenate(value)
    # both classes weigh the same: the logit is then a log likelihood ratio
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    # One step size for all weights: what many documents share moves most, so
    # shape and frequent n-grams explain a label before rare n-grams do.
    w, b = np.zeros(SIZE), 0.0
    speed, speed_b = np.zeros(SIZE), 0.0
    for step in range(1, epochs + 1):
        z = np.bincount(owner, weights=w[bucket] * value, minlength=len(y)) + b
        err = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * weight
        g = np.bincount(bucket, weights=err[owner] * value, minlength=SIZE) + decay * w
        speed, speed_b = 0.9 * speed + g, 0.9 * speed_b + err.sum()
        largest = max(np.abs(speed).max(), abs(speed_b), 1e-12)
        w -= rate * (1 - step / (epochs + 1)) * speed / largest
        b -= rate * (1 - step / (epochs + 1)) * speed_b / largest
    return w, float(b)


def evidence(docs: DataFrame, weights: np.ndarray, offset: float, host: Column, path: Column) -> DataFrame:
    """(doc_id, host, path, evidence) of every row."""
    table = docs.sparkSession.sparkContext.broadcast((weights, offset))

    def run(batches):
        w, b = table.value
        for batch in batches:
            for c, feature, text, value in _features(column(batch, "text")):
                z = np.bincount(text, weights=w[feature] * value, minlength=c.n_texts)
                z = np.where(np.bincount(text, minlength=c.n_texts) > 0, z + b, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [column(batch, x).slice(c.first, c.n_texts) for x in ("doc_id", "host", "path")]
                    + [pa.array(np.clip(z, -MOST, MOST))], names=["doc_id", "host", "path", "evidence"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.encode(docs["text"], "UTF-8").alias("text"),
                       F.coalesce(host.cast("string"), F.lit("")).alias("host"),
                       F.coalesce(path.cast("string"), F.lit("")).alias("path"))
    return rows.transform(map_stream, run, "doc_id long, host string, path string, evidence double")


def strength(groups: DataFrame, parent: Column) -> float:
    """Documents that the parent's rate counts as, by the method of moments.

    ``groups``: total (sum of probabilities), n; one row a group. The spread of
    group rates around the parent's, beyond what n draws give by themselves.
    """
    n, rate = F.col("n").cast("double"), F.col("total") / F.col("n")
    row = groups.agg(F.sum(n * (rate - parent) * (rate - parent)).alias("between"), F.sum(n).alias("n"),
                     F.sum(parent * (1 - parent)).alias("draws"), F.sum(n * parent * (1 - parent)).alias("spread")).first()
    if not row["n"] or not row["spread"]:
        return MOST_STRENGTH
    variance = max(0.0, (row["between"] - row["draws"]) / row["n"])
    if variance <= 0:
        return MOST_STRENGTH
    return float(min(MOST_STRENGTH, max(LEAST_STRENGTH, row["spread"] / row["n"] / variance - 1)))


def posteriors(scored: DataFrame, prior_odds: float | None = None) -> DataFrame:
    """doc_id, host, path, evidence, probability, site_rate, score of all rows of ``evidence``.

    Three grouped aggregations (paths, hosts from paths, all from hosts), each
    combined in the tasks before it is shuffled.
    """
    p = 1 / (1 + F.exp(-(F.col("evidence") + F.lit(float(prior_odds or 0.0)))))
    rows = scored.withColumn("probability", p)
    paths = written(rows.groupBy("host", "path").agg(F.sum("probability").alias("total"), F.count("*").alias("n")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    all_rows = hosts.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).first()
    mean = all_rows["total"] / all_rows["n"] if all_rows["n"] else 0.5
    host_strength = strength(hosts, F.lit(mean))
    hosts = hosts.select("host", ((F.col("total") + host_strength * mean) / (F.col("n") + host_strength)).alias("host_rate"))
    paths = paths.join(hosts, "host")
    path_strength = strength(paths, F.col("host_rate"))
    rate = ((F.col("total") - F.col("probability") + path_strength * F.col("host_rate"))
            / (F.col("n") - 1 + path_strength))
    rows = rows.join(paths, ["host", "path"]).withColumn("site_rate", F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), rate)))
    odds = F.col("evidence") + F.log(F.col("site_rate") / (1 - F.col("site_rate")))
    return rows.withColumn("score", 1 / (1 + F.exp(-odds))).select(
        "doc_id", "host", "path", "evidence", "probability", "site_rate", "score")


def quality(docs: DataFrame, labels: DataFrame, host: Column, path: Column, each: int = TRAIN_EACH) -> DataFrame:
    """One row per row of ``docs``: doc_id, evidence, site_rate, score, kept."""
    weights, offset = fit(training_rows(docs, labels, each))
    scored = written(evidence(docs, weights, offset, host, path), "evidence")
    # prior odds of quality among the labels
    known = labels.filter("quality is not null").agg(F.avg((F.col("quality") > 0).cast("int")).alias("rate")).first()["rate"]
    rate = min(0.99, max(0.01, known if known is not None else 0.5))
    return posteriors(scored, float(np.log(rate / (1 - rate)))).select(
        "doc_id", "evidence", "site_rate", "score", (F.col("score") >= KEEP_AT).alias("kept"))
