"""Phrase collocation mining with vertically partitioned, depth-truncated suffix subtrees.

A piece is a stretch of text between punctuation or line ends, a phrase some
of its words in a row. The suffix of a word is the word and up to DEPTH - 1
after it in its piece; all suffixes with their counts form a tree whose nodes
are the phrases, and a node's leaf total is the phrase's count. The tree is
built in three passes over the texts:

1. words: counts of every word of every group (language);
2. prefixes: counts of two words in a row, both frequent. Frequent pairs in
   key order are cut into groups whose suffixes keep within a budget of rows
   (a word with too many suffixes is split by the words after it, so prefixes
   have variable length);
3. subtrees: suffixes, cut where a pair is not frequent (a phrase is at most
   as frequent as the pairs in it), go to their prefix's group. A task reads a
   group's suffixes in path order, closes a node when the path leaves it and
   keeps it if its total is large enough: a path and its totals are all that it
   holds of unfinished nodes.

Every task counts words, pairs and suffixes of SEGMENT words before it sends
them, so a passage, pair or word that a third of the corpus has arrives once a
segment. Which words and pairs are frequent is told to tasks by bit tables of a
size between BITS; a bit set by another word costs a row, never a result. Counts
of first parts and rests of phrases are joined to the phrases as tables. Words
travel as 64-bit hashes of group and word; their texts stay in the table of
frequent words and are joined to the phrases that are returned.

Odd input: a null text has no words, a null group is ``und``; an empty table
has no phrases; repeated rows count each; ties are ordered by count, then by
the phrase's bytes; other columns are ignored; texts are read whole.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetyard.llm.frames import column, map_batches, map_stream, remove, written
from fleetyard.llm.word_memo import ragged
from fleetyard.llm.words import CHUNK_BYTES, U64, byte_column, hash_words, mix

DEPTH = 4
# Words that a task combines before sending, and texts' bytes handled at a time.
SEGMENT, CHUNK = 1 << 20, CHUNK_BYTES
# Suffixes in a prefix group: at least this many, and at most about GROUPS groups.
GROUP_ROWS, GROUPS = 1 << 16, 1 << 18
# Bits in a bit table: 16 for each frequent item, within these bounds (4 KB to 16 MB).
BITS = (1 << 15, 1 << 27)
SCALE = 2_000_000
SHARES = 16

_KIND = np.ones(256, dtype=np.uint8)              # 0 space, 1 word, 2 end of a piece
_KIND[[0x20, 0x09]] = 0
_KIND[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _group_seed(name: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(name.encode(), digest_size=8).digest(), dtype=np.uint64)[0]


class Words:
    """Words of some texts: hashes by group, whether the next word is in the same
    piece, and where they lie."""

    def __init__(self, buf: np.ndarray, bounds: np.ndarray, groups: list[str]):
        kind = _KIND[buf]
        edge = np.zeros(len(buf) + 1, dtype=bool)
        edge[bounds] = True
        inside = kind == 1
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | edge[1:-1]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | edge[1:-1]
        self.buf, self.starts, self.ends = buf, np.flatnonzero(begin), np.flatnonzero(stop) + 1
        text = np.searchsorted(bounds, self.starts, side="right") - 1
        names = sorted(set(groups))
        code = {g: i for i, g in enumerate(names)}
        self.names, self.group = names, np.array([code[g] for g in groups], dtype=np.int64)[text]
        seeds = np.array([_group_seed(g) for g in names], dtype=np.uint64)
        h = mix(hash_words(buf, self.starts, self.ends, lower=True) ^ seeds[self.group])
        self.hash = np.where(h == 0, U64(1), h)
        piece = np.cumsum(kind == 2)[self.starts]
        self.joined = np.zeros(len(h), dtype=bool)
        self.joined[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])


def _chunks(batch: pa.RecordBatch) -> Iterator[Words]:
    buf, off = byte_column(column(batch, "text"))
    groups = column(batch, "g").to_pylist()
    i, n = 0, len(off) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(off, off[i] + CHUNK, side="right")) - 1))
        if off[j] > off[i]:
            yield Words(buf[off[i]:off[j]], off[i:j + 1] - off[i], groups[i:j])
        i = j


def _segments(docs: DataFrame, pick: Callable[[Words], tuple], combine: Callable[[list[tuple]], pa.RecordBatch],
              schema: str) -> DataFrame:
    """What ``pick`` takes of the words, combined over about SEGMENT words of a task at a time."""

    def run(batches):
        held, words = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                for w in _chunks(batch.slice(at, 2000)):
                    held.append(pick(w))
                    words += len(w.hash)
                    if words >= SEGMENT:
                        yield combine(held)
                        held, words = [], 0
        if held:
            yield combine(held)

    return docs.transform(map_stream, run, schema)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({k: pa.array(v.view(np.int64) if v.dtype == np.uint64 else v)
                                       if isinstance(v, np.ndarray) else v for k, v in columns.items()})


# ---- words

def _words_of(w: Words) -> tuple:
    """Distinct words of a chunk: hash, count, group and lower-cased bytes."""
    h, first, n = np.unique(w.hash, return_index=True, return_counts=True)
    starts, sizes = w.starts[first], (w.ends - w.starts)[first]
    return h, n, [w.names[i] for i in w.group[first]], _LOWER[w.buf[ragged(starts, sizes)]].tobytes(), sizes


def _combine_words(held: list[tuple]) -> pa.RecordBatch:
    h = np.concatenate([x[0] for x in held])
    u, first, back = np.unique(h, return_index=True, return_inverse=True)
    n = np.bincount(back, weights=np.concatenate([x[1] for x in held])).astype(np.int64)
    sizes = np.concatenate([x[4] for x in held])
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    word = pa.Array.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(ends), pa.py_buffer(b"".join(x[3] for x in held))])
    group = pa.array([g for x in held for g in x[2]], pa.string())
    take = pa.array(first)
    return _batch(w1=u, g=group.take(take), word=word.take(take), n=n)


def word_counts(docs: DataFrame) -> DataFrame:
    """(g, w1, word, n): every word of every group, lower-cased; w1 is its hash."""
    local = _segments(docs, _words_of, _combine_words, "w1 long, g string, word binary, n long")
    return local.groupBy("g", "w1", "word").agg(F.sum("n").alias("n"))


# ---- bit tables

def _bits_for(count: int) -> int:
    want = 1 << max(1, int(16 * count - 1).bit_length())
    return min(max(want, BITS[0]), BITS[1])


class Bits:
    """A table of hashes: a hash that was put in is found, few others are."""

    def __init__(self, hashes: DataFrame, name: str, count: int):
        """Built by Spark in pieces of 4 KB, at most BITS[1] / 8 bytes in all."""
        self.mask = U64(_bits_for(count) - 1)
        place = F.col(name).bitwiseAND(F.lit(int(self.mask)))
        pieces = (hashes.select(place.alias("p")).groupBy(F.shiftright("p", 15).alias("at"))
                  .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits")))
        table = np.zeros(((int(self.mask) + 1) >> 15, 4096), dtype=np.uint8)
        for at, bits in pieces.collect():
            table[at, :len(bits)] = np.frombuffer(bytes(bits), dtype=np.uint8)
        self.table = hashes.sparkSession.sparkContext.broadcast(table.ravel())

    def has(self, h: np.ndarray) -> np.ndarray:
        p = h & self.mask
        return (self.table.value[p >> U64(3)] >> (p & U64(7)).astype(np.uint8)) & 1 > 0


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * U64(0x9E3779B97F4A7C15) + b)


# ---- prefixes

def _sum_rows(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Rows with equal keys added up."""
    h = keys[0]
    for k in keys[1:]:
        h = _pair_hash(h, k)
    _, first, back = np.unique(h, return_index=True, return_inverse=True)
    if any((k != k[first][back]).any() for k in keys):      # two paths of one hash
        _, first, back = np.unique(np.stack(keys, 1), axis=0, return_index=True, return_inverse=True)
    return [k[first] for k in keys], np.bincount(back.ravel(), weights=n, minlength=len(first)).astype(np.int64)


def pair_counts(docs: DataFrame, words: Bits) -> DataFrame:
    """(w1, w2, n): two words in a row, both perhaps frequent."""

    def pick(w: Words):
        often = words.has(w.hash)
        at = np.flatnonzero(w.joined[:-1] & often[:-1] & often[1:])
        return w.hash[at], w.hash[at + 1]

    def combine(held):
        pair = [np.concatenate([x[i] for x in held]) for i in range(2)]
        (a, b), n = _sum_rows(pair, np.ones(len(pair[0]), dtype=np.int64))
        return _batch(w1=a, w2=b, n=n)

    local = _segments(docs, pick, combine, "w1 long, w2 long, n long")
    return local.groupBy("w1", "w2").agg(F.sum("n").alias("n"))


def _prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Place of a pair in the order of prefixes: by its first word, then its second."""
    return ((a >> U64(24) << U64(24)) | (b >> U64(40))).view(np.int64)


def _keyed(pairs: DataFrame) -> DataFrame:
    """Pairs with their place in the order of prefixes and their hash."""

    def run(batch):
        a, b = (column(batch, c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("w1", "w2"))
        return _batch(prefix=_prefix(a, b), pair=_pair_hash(a, b), n=column(batch, "n").to_numpy(zero_copy_only=False))

    return map_batches(pairs, run, "prefix long, pair long, n long")


def prefix_groups(keyed: DataFrame, total: int) -> np.ndarray:
    """Where each group of prefixes begins: pairs in order, cut by their counts.

    At most GROUPS numbers more than there are partitions, whatever the corpus.
    """
    budget = max(GROUP_ROWS, total // GROUPS)

    def cuts(batches):
        filled, last = 0, -1
        for batch in batches:
            prefix, n = (column(batch, c).to_numpy(zero_copy_only=False) for c in ("prefix", "n"))
            if len(n):
                group = (filled + np.cumsum(n) - n) // budget
                new = np.diff(group, prepend=last) != 0
                filled, last = filled + int(n.sum()), int(group[-1])
                yield _batch(prefix=prefix[new])

    ordered = keyed.repartitionByRange("prefix").sortWithinPartitions("prefix")
    return np.array(sorted({r.prefix for r in ordered.transform(map_stream, cuts, "prefix long").collect()}), dtype=np.int64)


# ---- subtrees

PATH = [f"w{i + 1}" for i in range(DEPTH)]


def suffixes(docs: DataFrame, words: Bits, pairs: Bits, cuts: Broadcast) -> DataFrame:
    """(grp, w1 .. w4, n): suffixes of two words or more, 0 beyond their end; ``cuts``
    is where prefix groups begin."""

    def pick(w: Words):
        h = w.hash
        often = words.has(h)
        on = w.joined.copy()
        on[:-1] &= often[:-1] & often[1:]
        at = np.flatnonzero(on)
        on[at] = pairs.has(_pair_hash(h[at], h[at + 1]))
        at = np.flatnonzero(on)
        path, going = [h[at]], np.ones(len(at), dtype=bool)
        for d in range(1, DEPTH):
            going = going & on[np.minimum(at + d - 1, len(h) - 1)]
            path.append(np.where(going, h[np.minimum(at + d, len(h) - 1)], U64(0)))
        return path

    def combine(held):
        path = [np.concatenate([x[d] for x in held]) for d in range(DEPTH)]
        path, n = _sum_rows(path, np.ones(len(path[0]), dtype=np.int64))
        group = np.searchsorted(cuts.value, _prefix(path[0], path[1]), side="right").astype(np.int64)
        return _batch(grp=group, **dict(zip(PATH, path)), n=n)

    return _segments(docs, pick, combine, "grp long, " + ", ".join(f"{p} long" for p in PATH) + ", n long")


class Subtree:
    """Totals of the nodes of a stream of paths in order, with totals of ``least`` or more."""

    def __init__(self, least: int):
        self.least, self.path, self.totals = least, None, [0] * (DEPTH + 1)

    def add(self, path: list[np.ndarray], n: np.ndarray) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
        """Paths and totals of the nodes that are finished with these rows."""
        if not len(n):
            return
        same = np.zeros(DEPTH + 1, dtype=bool)              # the open nodes that go on
        if self.path is not None:
            same[1:] = np.logical_and.accumulate([p[0] == q for p, q in zip(path, self.path)])
        changed = np.zeros(len(n), dtype=bool)
        changed[0] = True
        opened = self.path
        self.path = [p[-1] for p in path]
        for d in range(1, DEPTH + 1):
            changed[1:] |= path[d - 1][1:] != path[d - 1][:-1]
            if d < 2:
                continue
            heads = np.flatnonzero(changed)
            totals = np.add.reduceat(n, heads)
            if opened is not None:
                if same[d]:
                    totals[0] += self.totals[d]
                elif opened[d - 1] and self.totals[d] >= self.least:
                    yield [np.array([x if i < d else 0], dtype=np.int64) for i, x in enumerate(opened)], np.array([self.totals[d]])
            self.totals[d] = int(totals[-1])
            heads, totals = heads[:-1], totals[:-1]
            keep = (totals >= self.least) & (path[d - 1][heads] != 0)
            if keep.any():
                at = heads[keep]
                yield [p[at] if i < d else np.zeros(len(at), dtype=np.int64) for i, p in enumerate(path)], totals[keep]

    def close(self):
        for d in range(2, DEPTH + 1):
            if self.path is not None and self.path[d - 1] and self.totals[d] >= self.least:
                yield [np.array([x if i < d else 0], dtype=np.int64) for i, x in enumerate(self.path)], np.array([self.totals[d]])


def phrase_counts(suffixes: DataFrame, least: int) -> DataFrame:
    """(w1 .. w4, n): phrases of two words or more that occur ``least`` times or more."""

    def run(batches):
        tree = Subtree(least)
        for batch in batches:
            path = [column(batch, c).to_numpy(zero_copy_only=False) for c in PATH]
            for nodes, totals in tree.add(path, column(batch, "n").to_numpy(zero_copy_only=False)):
                yield _batch(**dict(zip(PATH, nodes)), n=totals)
        for nodes, totals in tree.close():
            yield _batch(**dict(zip(PATH, nodes)), n=totals)

    ordered = suffixes.repartition("grp").sortWithinPartitions(*PATH)
    return ordered.select(*PATH, "n").transform(map_stream, run, ", ".join(f"{p} long" for p in PATH) + ", n long")


# ---- phrases

def _scored(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """Phrases with a, l, r and score of their lowest-scoring cut."""
    depth = sum((F.col(p) != 0).cast("int") for p in PATH)
    c = phrases.select(*PATH, F.col("n").alias("a"), depth.alias("depth"))
    words = F.array(*PATH)
    cut = c.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("depth") - 1)))
    side = F.explode(F.array(F.struct(F.lit("l").alias("side"), F.slice(words, F.lit(1), F.col("k")).alias("part")),
                             F.struct(F.lit("r").alias("side"), F.slice(words, F.col("k") + 1, F.col("depth") - F.col("k")).alias("part"))))
    parts = cut.withColumn("s", side).select(*PATH, "a", "k", "s.side", *[
        F.coalesce(F.try_element_at("s.part", F.lit(i + 1)), F.lit(0)).alias(f"p{i + 1}") for i in range(DEPTH - 1)])
    known = counts.select(*[F.col(f"w{i + 1}").alias(f"p{i + 1}") for i in range(DEPTH - 1)], F.col("n").alias("f"))
    found = parts.join(known, [f"p{i + 1}" for i in range(DEPTH - 1)])
    both = found.groupBy(*PATH, "a", "k").agg(F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"),
                                              F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    score = F.expr(f"cast({SCALE} * cast(a as decimal(30,0)) div (cast(l as decimal(20,0)) + r) as long)")
    lowest = both.withColumn("score", score).groupBy(*PATH, "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    return lowest.select(*PATH, "a", "x.l", "x.r", "x.score")


def _covered(phrases: DataFrame, percent: int) -> DataFrame:
    """Phrases that lie in a longer one with ``percent`` of their count or more.

    Of longer phrases around one, those with one word more occur most often, so
    they decide.
    """
    at = [F.col(p) for p in PATH]
    zero = F.lit(0).cast("long")
    depth = sum((F.col(p) != 0).cast("int") for p in PATH)
    longer = phrases.select(*PATH, "n", depth.alias("depth")).filter("depth > 2")
    head = F.struct(*[F.when(F.col("depth") > i + 1, at[i]).otherwise(zero).alias(PATH[i]) for i in range(DEPTH)])
    rest = F.struct(*[(at[i + 1] if i + 1 < DEPTH else zero).alias(PATH[i]) for i in range(DEPTH)])
    inner = (longer.select("n", F.explode(F.array(head, rest)).alias("x")).select("n", "x.*").groupBy(*PATH)
             .agg(F.max("n").alias("around")))
    return (phrases.join(inner, PATH)
            .filter(f"100 * cast(around as decimal(30,0)) >= {int(percent)} * cast(n as decimal(30,0))").select(*PATH))


def collocations(docs: DataFrame, group_col: str = "lang", text_col: str = "text", least: int = 30,
                 percent: int = 80, top: int | None = 2000) -> DataFrame:
    """The best ``top`` phrases of every group (all with None), by score, count and phrase.

    Columns: lang, rank, phrase, a (its count), l and r (counts of the two parts
    of its lowest-scoring cut), n (words of the group) and score, which is
    floor(SCALE * a / (l + r)). Phrases that occur in a longer one ``percent`` of
    the time or more are dropped.
    """
    spark = docs.sparkSession
    kept: list[str] = []
    d = docs.select(F.coalesce(docs[group_col].cast("string"), F.lit("und")).alias("g"),
                    F.encode(docs[text_col], "UTF-8").alias("text")).filter("text is not null and length(text) > 0")
    words = word_counts(d)
    words = written(words, "words", kept)
    totals = words.groupBy("g").agg(F.sum("n").alias("total"))
    often = words.filter(F.col("n") >= least)
    word_bits = Bits(often, "w1", often.count())
    pairs = _keyed(pair_counts(d, word_bits).filter(F.col("n") >= least))
    pairs = written(pairs, "pairs", kept)
    size, rows = pairs.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    pair_bits = Bits(pairs, "pair", size)
    cuts = spark.sparkContext.broadcast(prefix_groups(pairs, int(rows)))
    phrases = written(phrase_counts(suffixes(d, word_bits, pair_bits, cuts), least), "phrases", kept)
    zero = F.lit(0).cast("long")
    counts = phrases.select("w1", "w2", "w3", "w4", "n").filter("w4 = 0").union(
        often.select("w1", zero, zero, zero, "n"))
    scored = _scored(phrases.join(_covered(phrases, percent), PATH, "left_anti"), counts)
    scored = scored.join(often.select("w1", "g"), "w1")
    if top is not None:
        # ties are kept: their order needs the texts. First within SHARES shares of a
        # group, so that a group's last ranking reads about SHARES * top rows at any size
        share = F.pmod(F.xxhash64(*PATH), F.lit(SHARES))
        for keys in (["g", share], ["g"]):
            place = F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a")))
            scored = scored.withColumn("place", place).filter(F.col("place") <= top).drop("place")
    scored = written(scored, "scored", kept)
    text = often.select(F.col("w1").alias("w"), "word")
    spelt = (scored.select(*PATH, F.posexplode(F.array(*PATH)).alias("at", "w")).filter("w != 0").join(text, "w")
             .groupBy(*PATH).agg(F.sort_array(F.collect_list(F.struct("at", F.decode("word", "UTF-8").alias("word")))).alias("x"))
             .select(*PATH, F.array_join(F.col("x.word"), " ").alias("phrase")))
    best = scored.join(spelt, PATH).join(totals, "g")
    order = Window.partitionBy("g").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = best.withColumn("rank", F.row_number().over(order))
    if top is not None:
        best = best.filter(F.col("rank") <= top)
    out = written(best.select(F.col("g").alias("lang"), F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                              F.col("total").alias("n"), "score"), "collocations")
    remove(spark, kept)
    return out

