"""Substring dedup: repeated windows of WINDOW words, by prefix-partitioned suffix subtrees.

Only suffixes that can start a shared passage are indexed. A window of WINDOW
words is owned by the smallest (by hash, then place) of the PREFIX-word grams
in it, so equal windows have equal owners at equal offsets. The suffixes that
start at owners form the sparse suffix tree; it is partitioned by their first
PREFIX words: all windows of one owner travel as one row to the group of its
prefix. A prefix with more rows than a fair share of a partition is
lengthened, up to the whole window, so that every group fits in memory
whatever the corpus holds ("variable-length prefixes"). Within a group the
suffixes are sorted by path (prefix, offset, window); runs of equal paths are
the internal nodes of depth WINDOW or more, and every leaf of a node but the
first occurrence is a repeat. Successive repeats in a document join to its
maximal repeated passages.

Before the shuffle each task does the same for its own segment of documents
and sends on only the first occurrence of each window, so a passage or a copy
that a third of the corpus shares arrives once from each segment.

Order is by doc_id, then start; a window is a repeat if an equal one starts
strictly earlier in that order. Rows with a null id come after all others, at
the same place in the order (equal windows at equal starts do not make each
other repeats; the same holds for repeated rows with the same id). Null and
empty texts have no words. Words are compared by hash: 64 bits of the prefix
and 48 more of the window.
"""
from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetyard.llm.frames import column, map_batches, map_stream, texts
from fleetyard.llm.word_memo import ragged
from fleetyard.llm.words import U64, byte_column, chunks, factorize, mix, split_words, window_hashes, within

WINDOW, PREFIX = 20, 8
# Words that a task combines before sending.
SEGMENT_WORDS = 1 << 20
NULL_ID = (1 << 63) - 1
# A group is lengthened when its rows are more than this part of a partition.
FAIR_SHARE = 0.25


def owners(grams: np.ndarray, reach: int) -> np.ndarray:
    """Place of the smallest of grams[i : i + reach], the first of equal ones, for every i."""
    m = len(grams) - reach + 1
    value, place, size = grams, np.arange(len(grams)), 1
    while size < reach:
        step = min(size, reach - size)
        n = len(value) - step
        right = value[step:] < value[:n]
        value = np.where(right, value[step:], value[:n])
        place = np.where(right, place[step:], place[:n])
        size += step
    return place[:m]


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Mask: a new run starts here (some key differs from the place before)."""
    out = np.ones(len(keys[0]), dtype=bool)
    if len(out) > 1:
        out[1:] = False
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def repeats(path: tuple[np.ndarray, ...], doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Mask of the leaves that are not the first (doc, start) of their node.

    ``path``: arrays that together name the node of each leaf.
    """
    order = np.lexsort((start, doc, *path))
    head = _runs(*[p[order] for p in path])
    first = np.flatnonzero(head)
    of = np.cumsum(head) - 1
    d, s = doc[order], start[order]
    later = (d != d[first][of]) | (s != s[first][of])
    out = np.zeros(len(doc), dtype=bool)
    out[order] = later
    return out


class Segment:
    """Words of some documents with all their windows."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray, doc: np.ndarray, mark: np.ndarray):
        at = np.flatnonzero(within(bounds, WINDOW)) if len(hashes) >= WINDOW else np.zeros(0, np.int64)
        text = np.searchsorted(bounds, at, side="right") - 1
        self.doc, self.mark, self.start = doc[text], mark[text], at - bounds[text]
        if len(at):
            grams = window_hashes(hashes, PREFIX)
            own = owners(grams, WINDOW - PREFIX + 1)[at]
            self.key, self.offset, self.window = grams[own], own - at, window_hashes(hashes, WINDOW)[at]
            self.own = own
        else:
            self.key = self.window = np.zeros(0, np.uint64)
            self.offset = self.own = at
        codes, _ = factorize(self.window)
        often = np.flatnonzero(np.bincount(codes)[codes] > 1) if len(codes) else at
        self.repeat = np.zeros(len(at), dtype=bool)
        self.repeat[often] = repeats((codes[often],), self.doc[often], self.start[often])


def segments(batches):
    """Segments of a task's rows (doc_id, text), each of about SEGMENT_WORDS words."""
    held: list[tuple] = []
    words = 0

    def flush():
        hashes = np.concatenate([h[0] for h in held])
        counts = np.concatenate([np.diff(h[1]) for h in held])
        return Segment(hashes, np.concatenate([[0], np.cumsum(counts)]),
                       np.concatenate([h[2] for h in held]), np.concatenate([h[3] for h in held]))

    for b in batches:
        doc = column(b, "doc_id").fill_null(NULL_ID).to_numpy()
        for c in chunks(column(b, "text")):
            mark = np.array([zlib.crc32(c.buf[x:y]) for x, y in zip(c.bounds[:-1].tolist(), c.bounds[1:].tolist())],
                            dtype=np.int64)
            held.append((c.hashes, c.word_bounds, doc[c.first:c.first + c.n_texts], mark))
            words += len(c.hashes)
            if words >= SEGMENT_WORDS:
                yield flush()
                held, words = [], 0
    if held:
        yield flush()


ROW = pa.schema([("route", pa.int64()), ("doc", pa.int64()), ("mark", pa.int64()), ("start", pa.int32()),
                 ("offset", pa.int32()), ("n", pa.int32()), ("windows", pa.binary())])
ROW_SQL = "route long, doc long, mark long, start int, offset int, n int, windows binary"
_SIX = 6


def _six_bytes(values: np.ndarray) -> np.ndarray:
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :_SIX]


def _batch(route, doc, mark, start, offset, n, data: np.ndarray | None) -> pa.RecordBatch:
    """Rows; ``data`` has the windows' bytes of all rows one after the other (None: repeats)."""
    ends = np.concatenate([[0], np.cumsum(n)]) * _SIX if data is not None else np.zeros(len(n) + 1, np.int64)
    windows = pa.Array.from_buffers(pa.binary(), len(n), [
        None, pa.py_buffer(ends.astype(np.int32).tobytes()),
        pa.py_buffer(data.tobytes() if data is not None else b"")])
    ints = lambda v, t: pa.array(np.ascontiguousarray(v), t)
    return pa.RecordBatch.from_arrays(
        [ints(route.astype(np.uint64).view(np.int64), pa.int64()), ints(doc, pa.int64()), ints(mark, pa.int64()),
         ints(start.astype(np.int32), pa.int32()), ints(offset.astype(np.int32), pa.int32()),
         ints(n.astype(np.int32), pa.int32()), windows], schema=ROW)


def _repeat_rows(doc, mark, start) -> pa.RecordBatch:
    """Repeated windows, successive ones in one row."""
    order = np.lexsort((start, mark, doc))
    doc, mark, start = doc[order], mark[order], start[order]
    head = np.flatnonzero(_runs(doc, mark, start - np.arange(len(start))))
    n = np.diff(np.append(head, len(start)))
    return _batch(mix(doc[head].astype(np.uint64)), doc[head], mark[head], start[head], np.full(len(head), -1), n, None)


def _bundles(s: Segment, long_keys: np.ndarray):
    """Rows of a segment for the groups: windows in order, those of one owner together."""
    if s.repeat.any():
        yield _repeat_rows(s.doc[s.repeat], s.mark[s.repeat], s.start[s.repeat])
    go = np.flatnonzero(~s.repeat)
    if not len(go):
        return
    long = np.isin(s.key[go], long_keys) if len(long_keys) else np.zeros(len(go), dtype=bool)
    one = go[long]
    if len(one):          # lengthened prefix: the whole window
        yield _batch(mix(s.window[one] ^ U64(WINDOW)), s.doc[one], s.mark[one], s.start[one], s.offset[one],
                     np.ones(len(one), np.int64), _six_bytes(s.window[one]))
    go = go[~long]
    if len(go):
        head = np.flatnonzero(_runs(s.own[go], go - np.arange(len(go)), s.doc[go]))
        n = np.diff(np.append(head, len(go)))
        h = go[head]
        data = _six_bytes(s.window[go])
        ends = np.concatenate([[0], np.cumsum(n)])
        for a in range(0, len(h), 200_000):
            z = min(a + 200_000, len(h))
            yield _batch(s.key[h[a:z]], s.doc[h[a:z]], s.mark[h[a:z]], s.start[h[a:z]], s.offset[h[a:z]], n[a:z],
                         data[ends[a]:ends[z]])


def _group_repeats(table: pa.Table):
    """Repeats among the rows of whole groups (sorted by route)."""
    route = table["route"].to_numpy()
    head = _runs(route)
    size = np.diff(np.append(np.flatnonzero(head), len(route)))
    rows = np.flatnonzero(np.repeat(size, size) > 1)
    if not len(rows):
        return None
    t = table.take(pa.array(rows))
    n = t["n"].to_numpy().astype(np.int64)
    raw, off = byte_column(t["windows"].combine_chunks())
    six = raw[off[0]:off[-1]].reshape(-1, _SIX)
    window = np.zeros((len(six), 8), dtype=np.uint8)
    window[:, :_SIX] = six
    window = window.view("<u8").reshape(-1)
    of = np.repeat(np.arange(len(n)), n)
    step = ragged(np.zeros(len(n), np.int64), n)
    start, offset = t["start"].to_numpy()[of] + step, t["offset"].to_numpy()[of] - step
    doc, mark = t["doc"].to_numpy()[of], t["mark"].to_numpy()[of]
    found = repeats((offset, window, route[rows][of]), doc, start)
    return _repeat_rows(doc[found], mark[found], start[found]) if found.any() else None


def _whole_groups(batches):
    """Tables of whole groups from batches sorted by route."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        route = column(b, "route").to_numpy()
        last = int(np.flatnonzero(_runs(route))[-1])
        if last == 0 and held and column(held[0], "route")[0].as_py() == int(route[0]):
            held.append(b)
            continue
        if held and column(held[0], "route")[0].as_py() != int(route[0]) and last == 0:
            yield pa.Table.from_batches(held)
            held = [b]
            continue
        if held or last:
            yield pa.Table.from_batches([*held, b.slice(0, last)])
            held = [b.slice(last)]
        else:
            held = [b]
    if held:
        yield pa.Table.from_batches(held)


def long_prefixes(docs: DataFrame) -> np.ndarray:
    """Prefixes whose groups would be more than a fair share of a partition.

    At most partitions / FAIR_SHARE of them. They only spread work: results do
    not depend on them.
    """

    def count(batches):
        for s in segments(batches):
            go = ~s.repeat
            heads = np.flatnonzero(_runs(s.own[go], s.doc[go]))
            codes, keys = factorize(s.key[go][heads])
            n = np.bincount(codes, minlength=len(keys)) if len(codes) else np.zeros(0, np.int64)
            often = np.flatnonzero(n > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(keys[often].view(np.int64), 0)), pa.array(np.append(n[often], len(heads))),
                 pa.array(np.append(np.zeros(len(often), bool), True))], names=["key", "n", "all"])

    spark = docs.sparkSession
    counts = (texts(docs).transform(map_stream, count, "key long, n long, all boolean")
              .groupBy("all", "key").agg(F.sum("n").alias("n")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    top = counts.orderBy(F.desc("all"), F.desc("n")).limit(int(parts / FAIR_SHARE) + 1).collect()
    total = next((r["n"] for r in top if r["all"]), 0)
    return np.array([r["key"] for r in top if not r["all"] and r["n"] > max(200, FAIR_SHARE * total / parts)],
                    dtype=np.int64).view(np.uint64)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc, mark, start, n): windows start .. start + n - 1 of a document are repeats.

    ``doc`` is the id (NULL_ID for null) and ``mark`` a checksum of the text.
    """
    long_keys = long_prefixes(docs)
    spread = docs.sparkSession.sparkContext.broadcast(long_keys)      # at most partitions / FAIR_SHARE

    def send(batches):
        for s in segments(batches):
            yield from _bundles(s, spread.value)

    def judge(batches):
        def suffixes():
            for b in batches:
                offset = column(b, "offset").to_numpy()
                done = offset < 0
                if done.any():
                    yield None, b.filter(pa.array(done))
                if not done.all():
                    yield b.filter(pa.array(~done)), None

        passed: list = []

        def only_suffixes():
            for rows, repeats_ in suffixes():
                if repeats_ is not None:
                    passed.append(repeats_)
                else:
                    yield rows

        pick = ["doc", "mark", "start", "n"]
        for table in _whole_groups(only_suffixes()):
            while passed:
                yield passed.pop().select(pick)
            found = _group_repeats(table)
            if found is not None:
                yield found.select(pick)
        while passed:
            yield passed.pop().select(pick)

    return (texts(docs).transform(map_stream, send, ROW_SQL).repartition("route").sortWithinPartitions("route")
            .transform(map_stream, judge, "doc long, mark long, start int, n int"))


SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: word counts, digest of the kept words, and
    (``with_text``) the kept words themselves, joined by one space."""
    found = (repeated_windows(docs).groupBy("doc", "mark")
             .agg(F.collect_list(F.struct("start", "n")).alias("found")))
    t = texts(docs)
    t = t.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), F.crc32("text").alias("mark"), "doc_id", "text")
    t = t.withColumn("mark", F.coalesce("mark", F.lit(0)))
    rows = t.join(found, ["doc", "mark"], "left").select("doc_id", "text", "found")

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        buf, off = byte_column(column(batch, "text"))
        n_words, n_removed, sha, kept = [], [], [], []
        for a, b, runs in zip(off[:-1].tolist(), off[1:].tolist(), column(batch, "found").to_pylist()):
            raw = buf[a:b]
            starts, _, _ = split_words(raw, np.array([0, b - a]))
            n = len(starts)
            if runs:
                step = np.zeros(n + 1, dtype=np.int64)
                np.add.at(step, [r["start"] for r in runs], 1)
                np.add.at(step, [r["start"] + r["n"] - 1 + WINDOW for r in runs], -1)
                gone = np.cumsum(step[:n]) > 0
                words = raw.tobytes().split()
                left = b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])
                n_removed.append(int(gone.sum()))
            else:
                left = b" ".join(raw.tobytes().split())
                n_removed.append(0)
            n_words.append(n)
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode("utf-8", "replace") if with_text else None)
        return pa.RecordBatch.from_arrays(
            [column(batch, "doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
             pa.array(sha, pa.string()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return map_batches(rows, keep, SCHEMA)


def substring_digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every row."""
    return without_repeats(docs, with_text=False).drop("kept")
