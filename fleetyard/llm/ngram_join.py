"""N-gram Jaccard join: blocked sparse products of document by n-gram incidence.

A document's set is its distinct word K-grams (A-Z as a-z); one of fewer words
is one gram of them all; without words the set is empty and links with
nothing. Documents with equal sets form a class and only classes are compared.

1. Index. In one global order of the n-grams (frequent ones last, else by
   hash) two sets that reach the similarity share an n-gram among the first
   n - ceil(t n) + 1 of each. Those columns of the incidence matrix are
   counted twice over one row of each class. N-grams that crowd under the
   first order go last but for the frequent ones in the second, so that step 2
   needs no stand-ins for them: these would chain unrelated classes, the more
   the larger the corpus. N-grams of one class alone are left out then (by a
   filter of bounded size), and the others are shuffled by n-gram.
2. Candidates. The classes under one n-gram are paired where sizes and places
   in the order still allow the needed overlap; under an n-gram with more than
   PAIR_LIMIT classes each class is linked with one of them instead. Pairs
   whose parity bitmaps differ in more bits than two linked sets may have
   members of their own are discarded: a common member never changes a bit of
   the difference, so no link is lost.
3. Product. Connected candidates form clusters; a cluster's rows are dealt
   into blocks by size, blocks whose sizes can't link are never met, and the
   overlaps of each pair of blocks are accumulated from slices of columns,
   with pairs dropped as soon as what is left can't reach the bound. This
   compares all pairs in a cluster exactly, so no link is lost under step 2's
   stand-ins either.
4. A block reports a spanning forest of its links and the number of linked
   documents of each class; components of the forests are the answer.

The lists of frequent and crowded n-grams only order the columns (any order is
exact) and have at most FREQUENT_MAX and CROWDED_MAX entries. Sets are compared
by 64-bit hashes of their members and of the whole set; what is shuffled of a
set is its text, compressed, of the classes that have candidates.
"""
from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetyard.llm.components import components
from fleetyard.llm.frames import BATCH_BYTES, column, free_names, map_stream, release, remove, texts, written
from fleetyard.llm.key_filter import bit_maps, filter_bits, key_filter, may_have, with_bit
from fleetyard.llm.substring_dedup import _runs
from fleetyard.llm.words import U64, Chunk, chunks, mix, ngrams, within

K, PERCENT = 4, 85
# Stands for a null id where rows are told apart by id and checksum of the text.
LAST_ID = (1 << 63) - 1
# An n-gram is frequent when task segments report it more often than this.
FREQUENT, FREQUENT_MAX = 32, 1 << 19
# An n-gram is crowded when more classes than this have it in their index.
CROWDED, CROWDED_MAX = 32, 1 << 21
PAIR_LIMIT = 128
# Index rows that a task holds before it pairs them, and rows of one n-gram before it cuts them.
HELD_ROWS, CUT_ROWS = 50_000, 400_000
SEGMENT_WORDS = 1 << 20
BLOCK_ROWS, BLOCK_MEMBERS = 512, 1 << 21
COLUMNS = 4096


def needed(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Smallest overlap with 100 * overlap >= percent * union, for sizes n and m."""
    return -(-(percent * (n + m)) // (100 + percent))


def gram_sets(c: Chunk, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-grams of every text of the chunk, and their bounds."""
    n = np.diff(c.word_bounds)
    ok = np.flatnonzero(within(c.word_bounds, k)) if len(c.hashes) >= k else np.zeros(0, np.int64)
    grams = [ngrams(c.hashes, k)[ok]] if len(ok) else []
    owner = [np.searchsorted(c.word_bounds, ok, side="right") - 1]
    for short in range(1, k):
        t = np.flatnonzero(n == short)
        if len(t):
            grams.append(ngrams(c.hashes, short)[c.word_bounds[t]])
            owner.append(t)
    g = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
    o = np.concatenate(owner).astype(np.int32)
    order = np.argsort(g, kind="stable")
    order = order[np.argsort(o[order], kind="stable")]
    g, o = g[order], o[order]
    if len(g):
        keep = _runs(g, o)
        g, o = g[keep], o[keep]
    return g, np.searchsorted(o, np.arange(c.n_texts + 1))


def set_hashes(g: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit hash of every set, whatever the order of members; 0 for an empty one."""
    n = np.diff(bounds)
    out = np.zeros(len(n), dtype=np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        out[some] = np.add.reduceat(mix(g ^ U64(0x5851F42D4C957F2D)), bounds[:-1][some])
        out[some] = np.maximum(U64(1), mix(out[some] + n[some].astype(np.uint64)))
    return out


def parity_bitmaps(g: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """A bit for each of 2**j places (at least the set's size): odd number of members there."""
    n = np.diff(bounds)
    size = (1 << np.maximum(6, np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64))).astype(np.int64)
    first = np.cumsum(size) - size
    bit = ((g >> U64(24)) & (np.repeat(size, n) - 1).astype(np.uint64)).astype(np.int64) + np.repeat(first, n)
    odd = np.bincount(bit, minlength=int(size.sum())) & 1
    packed = np.packbits(odd.astype(np.uint8), bitorder="little")
    return [packed[a // 8:(a + s) // 8].tobytes() for a, s in zip(first.tolist(), size.tolist())]


def bitmap_difference(a: bytes, b: bytes) -> int:
    """A lower bound on the members that only one of two sets has."""
    if len(a) < len(b):
        a, b = b, a
    x, y = int.from_bytes(a, "little"), int.from_bytes(b, "little")
    size = len(a)
    while size > len(b):
        size //= 2
        x = (x >> (8 * size)) ^ (x & ((1 << (8 * size)) - 1))
    return (x ^ y).bit_count()


# --- 1. sets, classes, index -----------------------------------------------

def row_key(row_id, mark) -> Column:
    """Hash of a row's id (LAST_ID for a null) and checksum."""
    return F.xxhash64(row_id, mark)


def keyed_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, id, mark, at): ``texts`` with the id that stands for a null, the checksum and :func:`row_key`."""
    t = texts(docs).withColumns({"id": F.coalesce("doc_id", F.lit(LAST_ID)), "mark": F.coalesce(F.crc32("text"), F.lit(0))})
    return t.withColumn("at", row_key("id", "mark"))


def kept_rows(batches, bits: np.ndarray):
    """The rows whose key the filter has."""
    for b in batches:
        yield b.filter(pa.array(may_have(bits, column(b, "at").to_numpy()), pa.bool_()))


def _set_chunks(batches, k: int):
    """(row ids, text checksums, sets, bounds, set hashes) of a task's texts."""
    for b in batches:
        doc = column(b, "doc_id")
        for c in chunks(column(b, "text"), lower=True):
            g, bounds = gram_sets(c, k)
            mark = [zlib.crc32(c.buf[x:y]) for x, y in zip(c.bounds[:-1].tolist(), c.bounds[1:].tolist())]
            yield doc.slice(c.first, c.n_texts), mark, g, bounds, set_hashes(g, bounds)


def document_sets(docs: DataFrame, k: int) -> DataFrame:
    """A row per document (doc_id, checksum of the text, cls, n, bitmap), and rows of n-grams that a
    task's segment of documents has more than once (gram, count)."""

    def run(batches):
        seen: set[int] = set()
        held, words = [], 0

        def counts():
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = n > 1
            m = int(often.sum())
            return pa.RecordBatch.from_arrays(
                [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int32()),
                 pa.nulls(m, pa.binary()), pa.array(values[often].view(np.int64)), pa.array(n[often].astype(np.int64))], names=names)

        names = ["doc_id", "mark", "cls", "n", "bitmap", "gram", "count"]
        for doc, mark, g, bounds, cls in _set_chunks(batches, k):
            n = np.diff(bounds)
            rows = len(n)
            yield pa.RecordBatch.from_arrays(
                [doc, pa.array(mark, pa.int64()), pa.array(cls.view(np.int64)), pa.array(n.astype(np.int32)),
                 pa.array(parity_bitmaps(g, bounds), pa.binary()), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())],
                names=names)
            for i in range(rows):
                if (x := int(cls[i])) not in seen:
                    seen.add(x)
                    held.append(g[bounds[i]:bounds[i + 1]])
            words += len(g)
            if words >= SEGMENT_WORDS and held:
                yield counts()
                seen, held, words = set(), [], 0
        if held:
            yield counts()

    return texts(docs).transform(map_stream, run, "doc_id long, mark long, cls long, n int, bitmap binary, gram long, count long")


def frequent_grams(sets: DataFrame) -> np.ndarray:
    """Sorted n-grams that come last in the order; at most FREQUENT_MAX."""
    rows = (sets.filter("gram is not null").groupBy("gram").agg(F.sum("count").alias("count"))
            .filter(F.col("count") > FREQUENT).orderBy(F.desc("count"), "gram").limit(FREQUENT_MAX).select("gram"))
    return np.sort(rows.toArrow().column("gram").to_numpy().astype(np.int64).view(np.uint64))


def prefix_columns(g: np.ndarray, bounds: np.ndarray, percent: int, crowded: np.ndarray, frequent: np.ndarray):
    """(positions in ``g``, places in the order) of the indexed columns of sorted sets: early
    n-grams first, then those with a crowded fold, then frequent ones."""
    n = np.diff(bounds)
    of = np.repeat(np.arange(len(n)), n)

    def among(values, x):
        if not len(values):
            return np.zeros(len(x), dtype=bool)
        return values[np.minimum(np.searchsorted(values, x), len(values) - 1)] == x

    late = np.where(among(frequent, g), 2, among(crowded, fold(g)).astype(np.int8))
    order = np.lexsort((late, of))                 # stable: by hash where equally late
    place = np.empty(len(g), dtype=np.int64)
    place[order] = np.arange(len(g)) - bounds[of]
    prefix = n - -(-(percent * n) // 100) + 1
    return np.flatnonzero(place < prefix[of]), place, of


def fold(g: np.ndarray) -> np.ndarray:
    """The n-grams' upper 32 bits as int: what is counted. Two n-grams with one fold count as one."""
    return (g >> U64(32)).astype(np.uint32).view(np.int32)


def index_folds(docs: DataFrame, chosen, frequent, crowded, k: int, percent: int) -> DataFrame:
    """(fold): of every indexed column of the chosen rows."""

    def run(batches):
        seen: set[int] = set()
        for _, _, g, bounds, cls in _set_chunks(kept_rows(batches, chosen.value), k):
            go, _, of = prefix_columns(g, bounds, percent, crowded.value, frequent.value)
            go = go[_fresh(cls, seen)[of[go]]]
            yield pa.RecordBatch.from_arrays([pa.array(fold(g[go]))], names=["fold"])

    return keyed_texts(docs).transform(map_stream, run, "fold int")


def _fresh(cls: np.ndarray, seen: set[int]) -> np.ndarray:
    """Mask of the first set of each class in this segment; empty sets are none."""
    fresh = np.zeros(len(cls), dtype=bool)
    for i, x in enumerate(cls.tolist()):
        if x and x not in seen:
            fresh[i] = True
            seen.add(x)
    if len(seen) > 200_000:
        seen.clear()
    return fresh


def crowded_folds(folds: DataFrame) -> np.ndarray:
    """Sorted folds that more than CROWDED indexed columns have, the CROWDED_MAX most common ones."""
    rows = (folds.groupBy("fold").agg(F.count("*").alias("count")).filter(F.col("count") > CROWDED)
            .orderBy(F.desc("count"), "fold").limit(CROWDED_MAX).select("fold"))
    return np.sort(rows.toArrow().column("fold").to_numpy().astype(np.int32))


def index_rows(docs: DataFrame, classes: DataFrame, frequent: np.ndarray, k: int, percent: int) -> DataFrame:
    """(gram, cls, n, place): the indexed columns of every set that others may have too."""
    spark, kept = docs.sparkSession, []
    sc = spark.sparkContext
    one = row_key("one.id", "one.mark")
    chosen = sc.broadcast(key_filter(classes, one, classes.count()))
    last = sc.broadcast(frequent)                                          # at most FREQUENT_MAX
    crowded = crowded_folds(index_folds(docs, chosen, last, sc.broadcast(np.zeros(0, np.int32)), k, percent))
    release(spark)
    late = sc.broadcast(crowded)                                           # at most CROWDED_MAX
    shared = index_folds(docs, chosen, last, late, k, percent).groupBy("fold").agg(F.count("*").alias("count"))
    shared = written(shared.filter("count > 1").select("fold"), "shared", kept)
    release(spark)
    common = sc.broadcast(key_filter(shared, F.col("fold").cast("long"), shared.count()))
    remove(spark, kept)

    def run(batches):
        seen: set[int] = set()
        for _, _, g, bounds, cls in _set_chunks(kept_rows(batches, chosen.value), k):
            n = np.diff(bounds)
            go, place, of = prefix_columns(g, bounds, percent, late.value, last.value)
            go = go[_fresh(cls, seen)[of[go]]]
            go = go[may_have(common.value, fold(g[go]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(g[go].view(np.int64)), pa.array(cls[of[go]].view(np.int64)),
                 pa.array(n[of[go]].astype(np.int32)), pa.array(place[go].astype(np.int32))],
                names=["gram", "cls", "n", "place"])

    return keyed_texts(docs).transform(map_stream, run, "gram long, cls long, n int, place int")


# --- 2. candidates ---------------------------------------------------------

def _pairs_of(gram, cls, n, place, percent, cut=None):
    """Candidates among rows sorted by gram, then cls; whole groups. The n-gram ``cut``
    has more rows than these: its group counts as large whatever its size."""
    keep = _runs(gram, cls)
    gram, cls, n, place = gram[keep], cls[keep], n[keep].astype(np.int64), place[keep].astype(np.int64)
    head = np.flatnonzero(_runs(gram))
    size = np.diff(np.append(head, len(gram)))
    of = np.repeat(np.arange(len(head)), size)
    out_a, out_b, out_star = [], [], []
    big = size[of] > PAIR_LIMIT
    if cut is not None:
        big |= gram == cut
    if big.any():
        rows = np.flatnonzero(big)
        hub = cls[head[of[rows]]]
        out_a.append(hub)
        out_b.append(cls[rows])
        out_star.append(np.ones(len(rows), dtype=bool))
    rows = np.flatnonzero(~big & (size[of] > 1))
    if len(rows):
        end = (head + size)[of[rows]]
        for d in range(1, int(size[of[rows]].max())):
            a = rows[rows + d < end]
            if not len(a):
                break
            b = a + d
            o = needed(n[a], n[b], percent)
            ok = ((100 * np.minimum(n[a], n[b]) >= percent * np.maximum(n[a], n[b]))
                  & (n[a] - place[a] >= o) & (n[b] - place[b] >= o))
            out_a.append(cls[a[ok]])
            out_b.append(cls[b[ok]])
            out_star.append(np.zeros(int(ok.sum()), dtype=bool))
            rows, end = a, (head + size)[of[a]]
    if not out_a:
        return None
    a, b, star = np.concatenate(out_a), np.concatenate(out_b), np.concatenate(out_star)
    ok = a != b
    a, b, star = a[ok], b[ok], star[ok]
    low, high = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((star, high, low))
    low, high, star = low[order], high[order], star[order]
    first = np.flatnonzero(_runs(low, high))
    if not len(first) or not len(low):
        return None
    any_star = np.logical_or.reduceat(star, first)
    return pa.RecordBatch.from_arrays([pa.array(low[first]), pa.array(high[first]), pa.array(any_star)],
                                      names=["a", "b", "star"])


def group_pairs(batches, percent: int):
    """Batches of candidates from batches of index rows sorted by gram, then cls."""
    held = []                # batches that may end in an unfinished group
    rows, cut_gram = 0, None

    def columns(t):
        return [t[x].to_numpy() for x in ("gram", "cls", "n", "place")]

    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < HELD_ROWS:
            continue
        t = pa.Table.from_batches(held)
        gram = t["gram"].to_numpy()
        cut = int(np.flatnonzero(_runs(gram))[-1])
        if cut:
            out = _pairs_of(*columns(t.slice(0, cut)), percent, cut_gram)
            if out is not None:
                yield out
            held = t.slice(cut).to_batches()
        elif rows > CUT_ROWS:   # one n-gram: link all so far with its first class, and with that one all to come
            cut_gram = int(gram[0])
            out = _pairs_of(*columns(t), percent, cut_gram)
            if out is not None:
                yield out
            held = t.slice(0, 1).to_batches()
        rows = sum(x.num_rows for x in held)
    if held:
        out = _pairs_of(*columns(pa.Table.from_batches(held)), percent, cut_gram)
        if out is not None:
            yield out


def candidate_pairs(index: DataFrame, percent: int) -> DataFrame:
    """(a, b, star) with a < b: pairs to be tried; star: stands for a large group."""

    def run(batches):
        return group_pairs(batches, percent)

    return (index.repartition("gram").sortWithinPartitions("gram", "cls").transform(map_stream, run, "a long, b long, star boolean")
            .groupBy("a", "b").agg(F.max("star").alias("star")))


def likely_pairs(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs that the sets' bitmaps don't rule out, and all star pairs."""
    side = lambda x: classes.select(F.col("cls").alias(x), F.col("n").alias(f"n_{x}"), F.col("bitmap").alias(f"bits_{x}"))
    rows = pairs.filter("not star").join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for t in batches:
            n, m = (column(t, x).to_numpy().astype(np.int64) for x in ("n_a", "n_b"))
            most = n + m - 2 * needed(n, m, percent)
            ok = [bitmap_difference(x, y) <= d for x, y, d in
                  zip(column(t, "bits_a").to_pylist(), column(t, "bits_b").to_pylist(), most.tolist())]
            yield pa.RecordBatch.from_arrays([column(t, "a"), column(t, "b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return rows.transform(map_stream, run, "a long, b long").union(pairs.filter("star").select("a", "b"))


# --- 3. blocked products ---------------------------------------------------

def overlaps(sets: list[np.ndarray], other: list[np.ndarray] | None, possible: np.ndarray,
             bound: np.ndarray) -> np.ndarray:
    """Overlap counts of sets with sets (``other``, or themselves), over slices of columns.

    ``possible`` is a mask of the pairs to be counted; pairs that can no longer
    reach ``bound`` are dropped from it on the way.
    """
    rows = sets if other is None else sets + other
    lengths = np.array([len(s) for s in rows], dtype=np.int64)
    values = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(rows)), lengths)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    head = _runs(values) if len(values) else np.zeros(0, bool)
    size = np.diff(np.append(np.flatnonzero(head), len(values)))
    shared = np.repeat(size, size) > 1                 # columns with one member add nothing
    col = (np.cumsum(head) - 1)[shared]
    owner = owner[shared]
    col = np.cumsum(_runs(col)) - 1 if len(col) else col
    n_left = len(sets)
    counts = np.zeros((n_left, len(rows) - n_left if other is not None else n_left), dtype=np.float32)
    left = np.bincount(owner, minlength=len(rows)).astype(np.int64)
    total = int(col[-1]) + 1 if len(col) else 0
    for at in range(0, total, COLUMNS):
        a, b = np.searchsorted(col, [at, at + COLUMNS])
        x = np.zeros((len(rows), min(COLUMNS, total - at)), dtype=np.float32)
        x[owner[a:b], col[a:b] - at] = 1
        counts += x[:n_left] @ (x[:n_left] if other is None else x[n_left:]).T
        left -= np.bincount(owner[a:b], minlength=len(rows))
        more = np.minimum(left[:n_left, None], left[None, n_left:] if other is not None else left[None, :n_left])
        possible &= counts + more >= bound
        if not possible.any():
            break
    return counts


def block_links(cls: np.ndarray, copies: np.ndarray, part: np.ndarray, sets: list[np.ndarray], percent: int):
    """Links within a block (part 2) or between its two parts (0 and 1): for every
    linked class its tree's root in the block, and its linked documents."""
    within_one = bool((part == 2).any())
    first, second = np.flatnonzero(part == (2 if within_one else 0)), np.flatnonzero(part == 1)
    n = np.array([len(s) for s in sets], dtype=np.int64)
    if not within_one and not (len(first) and len(second)):
        return None
    right = first if within_one else second
    bound = needed(n[first][:, None], n[right][None, :], percent)
    possible = 100 * np.minimum(n[first][:, None], n[right]) >= percent * np.maximum(n[first][:, None], n[right])
    if within_one:
        np.fill_diagonal(possible, False)
    if not possible.any():
        return None
    counts = overlaps([sets[i] for i in first], None if within_one else [sets[i] for i in second], possible, bound)
    a, b = np.nonzero(possible & (counts >= bound))
    if not len(a):
        return None
    links = np.zeros(len(cls), dtype=np.int64)
    np.add.at(links, first[a], copies[right[b]])
    if not within_one:
        np.add.at(links, right[b], copies[first[a]])
    root = np.arange(len(cls))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for x, y in zip(first[a].tolist(), right[b].tolist()):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    some = np.flatnonzero(links)
    return cls[some], cls[[find(i) for i in some.tolist()]], links[some]


def block_plan(members: DataFrame, percent: int) -> DataFrame:
    """(block, part, cls, copies, one): the members of clusters dealt into blocks.

    A cluster is cut by size into bins a ratio of percent apart, so that links
    are within a bin or between neighbours, and a bin by hash into parts of
    about BLOCK_ROWS rows or BLOCK_MEMBERS set members. A block is a part with
    itself or two parts of the same or neighbouring bins.
    """
    ratio = -math.log(percent / 100)
    m = members.withColumn("bin", F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio) + F.lit(1e-9)).cast("int"))
    small = m.groupBy("cluster").agg(F.count("*").alias("c_rows"), F.sum(F.col("n").cast("long")).alias("c_members"))
    small = small.select("cluster", ((F.col("c_rows") <= BLOCK_ROWS) & (F.col("c_members") <= BLOCK_MEMBERS)).alias("small"))
    m = m.join(small, "cluster").withColumn("bin", F.when(F.col("small"), F.lit(0)).otherwise(F.col("bin")))
    bins = (m.groupBy("cluster", "bin").agg(F.first("small").alias("small"), F.count("*").alias("rows"),
                                            F.sum(F.col("n").cast("long")).alias("size"))
            .select("cluster", "bin", F.when(F.col("small"), F.lit(1)).otherwise(F.greatest(
                F.ceil(F.col("rows") / F.lit(BLOCK_ROWS)), F.ceil(F.col("size") / F.lit(BLOCK_MEMBERS)))).cast("int").alias("parts")))
    near = lambda d, name: bins.select("cluster", (F.col("bin") - d).alias("bin"), F.col("parts").alias(name))
    m = (m.join(bins, ["cluster", "bin"]).join(near(1, "above"), ["cluster", "bin"], "left")
         .join(near(-1, "below"), ["cluster", "bin"], "left")
         .withColumn("p", F.pmod(F.xxhash64(F.lit("part"), "cls"), F.col("parts")).cast("int")))
    key = lambda b1, p1, b2, p2: F.concat_ws("/", "cluster", b1, p1, b2, p2)
    span = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.expr("array()").cast("array<int>"))
    p, b = F.col("p"), F.col("bin")
    one = lambda k, part: F.struct(k.alias("block"), part.alias("part"))
    places = F.concat(
        F.transform(span(F.col("parts")), lambda q: one(
            key(b, F.least(p, q), b, F.greatest(p, q)), F.when(p == q, F.lit(2)).when(p < q, F.lit(0)).otherwise(F.lit(1)))),
        F.transform(span(F.coalesce("above", F.lit(0))), lambda q: one(key(b, p, b + 1, q), F.lit(0))),
        F.transform(span(F.coalesce("below", F.lit(0))), lambda q: one(key(b - 1, q, b, p), F.lit(1))))
    return m.select("cls", "copies", "one", F.explode(places).alias("at")).select(
        F.xxhash64("at.block").alias("block"), "at.part", "cls", "copies", "one")


def packed_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, mark, body): the texts of the rows that ``wanted`` (id, mark) has, and a few others,
    compressed; equal rows once for each segment of a task."""
    bits = docs.sparkSession.sparkContext.broadcast(key_filter(wanted, row_key("id", "mark"), wanted.count()))

    def run(batches):
        seen: set[bytes] = set()
        codec = pa.Codec("zstd")
        for b in kept_rows(batches, bits.value):
            fresh, body = [], []
            for i, x in zip(column(b, "id").to_pylist(), column(b, "text")):
                raw = x.as_buffer() if x.is_valid else b""
                h = hashlib.blake2b(raw, digest_size=16, key=i.to_bytes(8, "little", signed=True)).digest()
                fresh.append(h not in seen)
                if h not in seen:
                    seen.add(h)
                    body.append(len(raw).to_bytes(4, "little") + codec.compress(raw, asbytes=True))
            if len(seen) > 200_000:
                seen = set()
            b = b.filter(pa.array(fresh, pa.bool_()))
            yield pa.RecordBatch.from_arrays([column(b, "id"), column(b, "mark"), pa.array(body, pa.binary())],
                                             names=["id", "mark", "body"])

    return keyed_texts(docs).transform(map_stream, run, "id long, mark long, body binary")


def unpacked_texts(bodies: list[bytes], codec: pa.Codec):
    """The texts of ``bodies`` in order, in arrays of about BATCH_BYTES or one longer text."""
    part, size = [], 0
    for x in bodies:
        n = int.from_bytes(x[:4], "little")
        if part and size + n > BATCH_BYTES:
            yield pa.array(part, pa.large_binary())
            part, size = [], 0
        part.append(codec.decompress(x[4:], n, asbytes=True))
        size += n
    if part:
        yield pa.array(part, pa.large_binary())


def once_a_task(rows: DataFrame) -> DataFrame:
    """Rows of a block and class with the same text once for each segment of a task: rows with one
    id may be repeated any number of times."""

    def run(batches):
        seen: set[tuple] = set()
        for b in batches:
            fresh = []
            for block, cls, body in zip(column(b, "block").to_pylist(), column(b, "cls").to_pylist(), column(b, "body")):
                h = (block, cls, hashlib.blake2b(body.as_buffer(), digest_size=8).digest())
                fresh.append(h not in seen)
                seen.add(h)
            if len(seen) > 200_000:
                seen = set()
            yield b.filter(pa.array(fresh, pa.bool_()))

    return rows.transform(map_stream, run, rows.schema)


def links(docs: DataFrame, plan: DataFrame, k: int, percent: int) -> DataFrame:
    """(cls, root, n_links) from every block that has links.

    A null id is as good as any: rows are told apart by id and checksum, and of
    those with equal ones the row whose set has the class's hash counts.
    """
    plan = plan.select("block", "part", "cls", "copies", "one.id", "one.mark")
    bodies = packed_texts(docs, plan.select("id", "mark").distinct())
    placed = plan.join(bodies, ["id", "mark"]).select("block", "cls", "part", "copies", "body")

    def run(batches):
        held, key = [], None
        codec = pa.Codec("zstd")

        def flush():
            cls = np.array([h[1] for h in held], dtype=np.int64)
            seen, keep = set(), []
            for i, h in enumerate(held):
                if (h[1], h[2]) not in seen:
                    seen.add((h[1], h[2]))
                    keep.append(i)
            out = block_links(cls[keep], np.array([held[i][3] for i in keep], dtype=np.int64),
                              np.array([held[i][2] for i in keep]), [held[i][4] for i in keep], percent) if len(keep) > 1 else None
            return None if out is None else pa.RecordBatch.from_arrays([pa.array(x) for x in out], names=["cls", "root", "n_links"])

        for b in batches:
            rows = list(zip(*(column(b, x).to_pylist() for x in ("block", "cls", "part", "copies", "body"))))
            for part in unpacked_texts([r[4] for r in rows], codec):
                for c in chunks(part, lower=True):
                    g, bounds = gram_sets(c, k)
                    for i, x in enumerate(set_hashes(g, bounds).view(np.int64).tolist()):
                        row = rows[i]
                        if row[0] != key and held:
                            if (out := flush()) is not None:
                                yield out
                            held = []
                        key = row[0]
                        if x == row[1]:
                            held.append((*row[:4], g[bounds[i]:bounds[i + 1]].copy()))
                    rows = rows[c.n_texts:]
        if held and (out := flush()) is not None:
            yield out

    return (once_a_task(placed).repartition("block").sortWithinPartitions("block")
            .transform(map_stream, run, "cls long, root long, n_links long"))


# --- 4. the join -----------------------------------------------------------

def linked_rows(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, mark (checksum of the text), n, tree, component_id, n_links of every
    row; ``tree`` is null for empty sets, else equal for all that links connect."""
    sets = written(document_sets(docs, k), "sets")
    rows = sets.filter("gram is null").select("doc_id", "mark", "cls", "n")
    classes = written(sets.filter("gram is null and n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.first("n").alias("n"),
        F.min(F.struct(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "mark")).alias("one"),
        F.first("bitmap").alias("bitmap")), "classes")
    kept: list[str] = []
    frequent = frequent_grams(sets)
    pairs = written(candidate_pairs(index_rows(docs, classes, frequent, k, percent), percent), "pairs", kept)
    release(docs.sparkSession)
    clusters = components(likely_pairs(pairs, classes, percent))
    members = clusters.join(classes, clusters["node"] == classes["cls"]).select(
        "cls", F.col("component").alias("cluster"), "n", "copies", "one")
    plan = written(block_plan(members, percent), "blocks", kept)
    linked = written(links(docs, plan, k, percent), "links")
    remove(docs.sparkSession, kept)
    release(docs.sparkSession)
    trees = components(linked.select("cls", "root"))
    found = classes.select("cls", "doc", "copies").join(trees, classes["cls"] == trees["node"], "left").select(
        "cls", "doc", "copies", F.coalesce("component", "cls").alias("tree"))
    found = found.join(linked.groupBy("cls").agg(F.sum("n_links").alias("n_links")), "cls", "left")
    least = found.groupBy("tree").agg(F.min("doc").alias("component_id"))
    found = found.join(least, "tree").select(
        "cls", "tree", "component_id", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return rows.join(found, "cls", "left").select(
        "doc_id", "mark", "n", "tree",
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_join(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_links.

    component_id is the smallest doc_id that links reach, itself included
    (null only where all of these are null); n_links counts the other rows with
    the same set and all rows of linked sets. Repeated rows are linked like any
    copies; null and empty texts have no n-grams and no links.
    """
    return linked_rows(docs, k, percent).select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "n_links")


def one_of_each(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The rows of ``docs``, with all their columns, without near copies: of all rows
    that links connect the one with the smallest id stays (a null id comes last;
    among equal ids the smallest checksum of the text; among equal rows any one).
    Rows with an empty set all stay."""
    rows = linked_rows(docs, k, percent).select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("id"), "mark", "n", "tree")
    rows = written(rows, "linked")
    release(docs.sparkSession)
    keep = rows.filter("tree is not null").groupBy("tree").agg(F.min(F.struct("id", "mark")).alias("first")).select("first.*")
    keep = keep.withColumn("once", F.lit(True)).union(
        rows.filter("tree is null").select("id", "mark").distinct().withColumn("once", F.lit(False)))
    keep = written(keep, "keep")
    # keys of rows that go, and of equal rows of which one stays
    several = (rows.groupBy("id", "mark").agg(F.count("*").alias("rows"))
               .join(keep.groupBy("id", "mark").agg(F.max("once").alias("once")), ["id", "mark"], "left")
               .filter(F.col("once").isNull() | (F.col("once") & (F.col("rows") > 1))).select("id", "mark"))
    # The filters say of most rows what becomes of them; the few that both may have are joined by key.
    bits = filter_bits(rows.count())
    stays, goes = (bit_maps(x, row_key("id", "mark"), bits) for x in (keep, several))
    d_id, d_mark, once, k_id, k_mark, nth, key, may_stay, may_go = free_names(
        docs, "id", "mark", "once", "keep_id", "keep_mark", "nth", "key", "may_stay", "may_go")
    keep = keep.toDF(k_id, k_mark, once)
    marked = docs.withColumns({d_id: F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID)),
                               d_mark: F.coalesce(F.crc32(F.encode(docs["text"], "UTF-8")), F.lit(0))})
    marked = marked.withColumn(key, row_key(d_id, d_mark))
    marked = with_bit(with_bit(marked, stays, F.col(key), bits, may_stay), goes, F.col(key), bits, may_go).filter(F.col(may_stay))
    surely = marked.filter(~F.col(may_go))
    kept = marked.filter(F.col(may_go)).join(keep, (F.col(d_id) == F.col(k_id)) & (F.col(d_mark) == F.col(k_mark)))
    same = Window.partitionBy(d_id, d_mark).orderBy(F.lit(0))
    kept = kept.withColumn(nth, F.row_number().over(same)).filter(~F.col(once) | (F.col(nth) == 1))
    return surely.select(*docs.columns).union(kept.select(*docs.columns))
