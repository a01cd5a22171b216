"""Quality rules: repetition and length rules, and an n-gram likelihood ratio.

The method fits two multinomials over hashed unigrams and bigrams of tokens
(runs of letters and digits, and runs of signs; A-Z as a-z): one over the
trusted documents, one over the raw corpus. A document's score is the mean of
log(trusted / raw) over its n-grams, so its length does not count; a document
is kept when the score is at least MIN_SCORE. The threshold is fixed: the
verdict on a document is a function of its text and the two tables of counts.

Counts cover every document (and every trusted one); a table has BUCKETS
numbers, whatever the corpus's size. With no trusted document the ratio is 0
everywhere and the method keeps everything. Null and empty texts have no words
and fail the base rules; a null label is not trusted; repeated rows count as
often as they occur, and each has its own result.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.llm.frames import column, give_back, map_batches, map_stream, texts
from fleetyard.llm.words import U64, Chunk, chunks, factorize, hash_words, mix, ngrams, split_tokens, within

BUCKETS = 1 << 14
# Mean log ratio a kept document needs (nats per n-gram).
MIN_SCORE = -0.5
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

_SIGN = np.zeros(256, dtype=np.int64)
_SIGN[list(b"#*$%&|<>")] = 1
_FIRST_BYTE = np.ones(256, dtype=np.int64)     # of a code point
_FIRST_BYTE[0x80:0xC0] = 0


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values between successive bounds."""
    total = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def repeated_words(c: Chunk, k: int = 3) -> np.ndarray:
    """Per text: words covered by k-word windows that the text has twice or more."""
    grams = ngrams(c.hashes, k)
    covered = np.zeros(len(c.hashes), dtype=np.int64)
    if len(grams):
        ok = np.flatnonzero(within(c.word_bounds, k))
        key = mix(grams[ok] + U64(0x9E3779B97F4A7C15) * c.text_of_word()[ok].astype(np.uint64))
        codes, _ = factorize(key)
        often = ok[np.bincount(codes)[codes] > 1] if len(codes) else ok
        for j in range(k):
            covered[often + j] = 1
    return _sums(covered, c.word_bounds)


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def base_counts(c: Chunk) -> dict[str, np.ndarray]:
    points = np.zeros(len(c.buf) + 1, dtype=np.int64)
    np.cumsum(_FIRST_BYTE[c.buf], out=points[1:])
    in_word = points[c.ends] - points[c.starts]
    return {
        "n_words": np.diff(c.word_bounds),
        "word_chars": _sums(in_word, c.word_bounds),
        "n_symbols": _sums(_SIGN[c.buf], c.bounds),
        "n_dup_lines": np.array([repeated_lines(c.buf[a:b].tobytes()) for a, b in
                                 zip(c.bounds[:-1].tolist(), c.bounds[1:].tolist())], dtype=np.int64),
        "n_repeat_words": repeated_words(c),
    }


def _tokens(c: Chunk) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, bounds = split_tokens(c.buf, c.bounds)
    return hash_words(c.buf, starts, ends, lower=True), bounds


def gram_buckets(hashes: np.ndarray, bounds: np.ndarray, buckets: int) -> tuple[np.ndarray, ...]:
    """Buckets of unigrams and bigrams, and the token position each starts at."""
    one = (hashes >> U64(20)) % U64(buckets)
    ok = np.flatnonzero(within(bounds, 2))
    two = (ngrams(hashes, 2)[ok] >> U64(20)) % U64(buckets) if len(ok) else np.zeros(0, np.uint64)
    return one.astype(np.int64), two.astype(np.int64), ok


def count_grams(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(trusted, raw) counts by bucket over all documents.

    ``labels``: doc_id, quality; trusted documents have quality 1. A document
    with several labels is trusted if any says so, and counts once.
    """
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("good_id")).distinct()
    t = texts(docs)
    # the raw counts need no join; of the join's texts, Spark's runtime filter
    # keeps large corpora's untrusted ones from the shuffle
    trusted = t.join(good.hint("merge"), t["doc_id"] == good["good_id"], "left_semi")

    def count(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for b in batches:
            for c in chunks(column(b, "text")):
                one, two, _ = gram_buckets(*_tokens(c), buckets)
                total += np.bincount(one, minlength=buckets) + np.bincount(two, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    def counts(rows: DataFrame) -> np.ndarray:
        out = np.zeros(buckets)
        for r in (rows.select("text").transform(map_stream, count, "bucket long, n long").groupBy("bucket")
                  .agg(F.sum("n").alias("n")).collect()):
            out[r["bucket"]] = r["n"]
        return out

    return counts(trusted), counts(t)


def log_ratio(trusted: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(trusted / raw) by bucket, add-one smoothed; 0 with nothing trusted."""
    if trusted.sum() == 0:
        return np.zeros(len(raw))
    p = (trusted + 1) / (trusted.sum() + len(raw))
    q = (raw + 1) / (raw.sum() + len(raw))
    return np.log(p / q)


def ratio_scores(c: Chunk, weights: np.ndarray) -> np.ndarray:
    """Mean log ratio of every text's n-grams; 0 for a text without tokens."""
    h, bounds = _tokens(c)
    one, two, at = gram_buckets(h, bounds, len(weights))
    value = weights[one]
    value[at] += weights[two]
    n = np.diff(bounds)
    return _sums(value, bounds) / np.maximum(1, 2 * n - 1)


SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, score double")


def judge(docs: DataFrame, weights: np.ndarray, min_score: float = MIN_SCORE) -> DataFrame:
    """One row per row of ``docs``: counts, verdict of the rules, verdict, score."""
    table = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batch: pa.RecordBatch):
        doc = column(batch, "doc_id")
        for c in chunks(column(batch, "text")):
            n = base_counts(c)
            failed = (n["n_words"] < MIN_WORDS) | (100 * n["n_repeat_words"] > MAX_REPEATED_PERCENT * n["n_words"])
            score = ratio_scores(c, table.value)
            yield pa.RecordBatch.from_arrays(
                [doc.slice(c.first, c.n_texts)] + [pa.array(v) for v in n.values()]
                + [pa.array(failed), pa.array(~failed & (score >= min_score)), pa.array(score)],
                names=["doc_id", *n, "base_failed", "kept", "score"])

    return map_batches(texts(docs), run, SCHEMA)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit the ratio on ``docs`` and ``labels`` and judge every row of ``docs``."""
    return judge(docs, log_ratio(*count_grams(docs, labels)))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns as they are."""
    table = docs.sparkSession.sparkContext.broadcast(log_ratio(*count_grams(docs, labels)))

    @F.arrow_udf("boolean")
    def passes(text: pa.Array) -> pa.Array:
        give_back()
        out = []
        for c in chunks(text):
            n = base_counts(c)
            out.append((n["n_words"] >= MIN_WORDS)
                       & (100 * n["n_repeat_words"] <= MAX_REPEATED_PERCENT * n["n_words"])
                       & (ratio_scores(c, table.value) >= MIN_SCORE))
        return pa.array(np.concatenate(out) if out else np.zeros(0, bool))

    return docs.filter(passes(docs["text"]))
