"""N-gram Jaccard join and substring dedup against brute force."""
import random

import pytest

from fleetyard.llm import ngram_join, substring_dedup
from tests.llm import brute
from tests.llm.conftest import frame, make_rows, multiset


def expected_join(rows, k, percent):
    found, _ = brute.jaccard_components(rows, k, percent)
    return sorted(((d, *f) for (d, _), f in zip(rows, found)), key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_join(docs, rows, monkeypatch, small):
    if small:      # all special paths: star links, frequent n-grams, many blocks, small segments
        for name, value in (("PAIR_LIMIT", 2), ("FREQUENT", 1), ("BLOCK_ROWS", 2), ("SEGMENT_WORDS", 500), ("COLUMNS", 7)):
            monkeypatch.setattr(ngram_join, name, value)
    got = multiset(ngram_join.jaccard_join(docs, 4, 85), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == expected_join(rows, 4, 85)


@pytest.mark.parametrize("k,percent", [(5, 80), (2, 50)])
def test_jaccard_join_other_parameters(spark, k, percent):
    rows = make_rows(7)
    got = multiset(ngram_join.jaccard_join(frame(spark, rows), k, percent), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == expected_join(rows, k, percent)


def test_null_ids_are_linked_like_others(spark):
    r = random.Random(9)
    v = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(300)]
    line = lambda n: " ".join(r.choice(v) for _ in range(n))
    base, other = line(150), line(150)
    rows = [(7, base), (None, base + " end"), (None, other), (None, other + " end"), (None, other + " end"), (None, line(90))]
    rows += [(None if i % 3 == 0 else d, t) for i, (d, t) in enumerate(make_rows(5))]
    docs = frame(spark, rows)
    got = multiset(ngram_join.jaccard_join(docs, 4, 85), "doc_id", "n_shingles", "component_id", "n_links")
    assert got == expected_join(rows, 4, 85) and (None, 148, 7, 1) in got
    _, group = brute.jaccard_components(rows, 5, 80)
    left = [(x["doc_id"], x["text"]) for x in ngram_join.one_of_each(docs, 5, 80).collect()]
    assert len(left) == len(set(group)) and (None, base + " end") not in left
    assert sum((None, other + x) in left for x in ("", " end")) == 1


def test_jaccard_join_empty(empty):
    df = ngram_join.jaccard_join(empty)
    assert df.columns == ["doc_id", "n_shingles", "component_id", "n_links"] and df.count() == 0


def test_one_of_each(docs, rows):
    kept = ngram_join.one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns
    _, group = brute.jaccard_components(rows, 5, 80)
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    sets = {i: brute.grams(t, 5) for i, (_, t) in enumerate(rows)}
    for g in set(group):
        members = [rows[i] for i in range(len(rows)) if group[i] == g and sets[i]]
        if members:
            here = [x for x in left if x in members]
            ids = [d for d, _ in members if d is not None]
            assert len(here) == 1 and here[0][0] == (min(ids) if ids else None)
    assert sum(1 for _, t in left if not brute.words(t)) == sum(1 for _, t in rows if not brute.words(t))


@pytest.mark.parametrize("tail", [0, 1, 3, 60, 400])
def test_a_cut_group_stays_one_cluster(monkeypatch, tail):
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "HELD_ROWS", 100)
    monkeypatch.setattr(ngram_join, "CUT_ROWS", 500)
    # the first class comes from many tasks and has another size than the others
    cls = [1] * 300 + list(range(2, 302 + tail))
    rows = [(5, 900, 50, 0)] + [(7, c, 10 if c == 1 else 100, 0) for c in cls] + [(8, 900, 50, 0), (8, 901, 50, 0)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[i:i + 37])], names=["gram", "cls", "n", "place"])
               for i in range(0, len(rows), 37)]
    pairs = [p for out in ngram_join.group_pairs(iter(batches), 85) for p in out.to_pylist()]
    root = {c: c for c in [*cls, 900, 901]}

    def find(c):
        while root[c] != c:
            c = root[c]
        return c

    for p in pairs:
        a, b = sorted((find(p["a"]), find(p["b"])))
        root[b] = a
    assert {find(c) for c in cls} == {1} and find(901) == 900
    assert len(pairs) <= len(set(cls)) + 1


def test_overlaps_drop_only_hopeless_pairs():
    import numpy as np

    r = random.Random(2)
    sets = [np.unique(np.array([r.randrange(90) for _ in range(r.randint(1, 80))], dtype=np.uint64)) for _ in range(20)]
    n = np.array([len(s) for s in sets])
    bound = ngram_join.needed(n[:, None], n[None, :], 60)
    possible = np.ones((20, 20), dtype=bool)
    counts = ngram_join.overlaps(sets, None, possible, bound)
    for i in range(20):
        for j in range(20):
            both = len(np.intersect1d(sets[i], sets[j]))
            assert (both >= bound[i, j]) == bool(possible[i, j] and counts[i, j] >= bound[i, j])


def test_bitmap_difference_is_a_lower_bound():
    import numpy as np

    r = np.random.default_rng(4)
    for _ in range(60):
        a = np.unique(r.integers(0, 1 << 62, r.integers(1, 300), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: len(a) // 2], r.integers(0, 1 << 62, r.integers(1, 300), dtype=np.uint64)]))
        x, y = (ngram_join.parity_bitmaps(s, np.array([0, len(s)]))[0] for s in (a, b))
        assert ngram_join.bitmap_difference(x, y) <= len(np.setxor1d(a, b))


@pytest.mark.parametrize("small", [False, True])
def test_substring_dedup(spark, docs, rows, monkeypatch, small):
    if small:
        monkeypatch.setattr(substring_dedup, "SEGMENT_WORDS", 300)
    expected = sorted(((d, n, gone, kept) for (d, _), (n, gone, kept) in zip(rows, brute.substring_rows(rows))), key=repr)
    got = multiset(substring_dedup.without_repeats(docs), "doc_id", "n_words", "n_removed", "kept")
    assert got == expected


def test_substring_dedup_lengthened_prefixes(docs, rows, monkeypatch):
    """Every prefix counts as hot: all suffixes travel by their whole window."""
    import numpy as np

    monkeypatch.setattr(substring_dedup, "SEGMENT_WORDS", 300)
    every = np.concatenate([s.key for s in substring_dedup.segments(iter(substring_dedup.texts(docs).toArrow().to_batches()))])
    monkeypatch.setattr(substring_dedup, "long_prefixes", lambda d: np.unique(every))
    expected = sorted(((d, n, gone) for (d, _), (n, gone, _) in zip(rows, brute.substring_rows(rows))), key=repr)
    assert multiset(substring_dedup.substring_digest(docs), "doc_id", "n_words", "n_removed") == expected


def test_long_prefixes_are_bounded(docs):
    assert len(substring_dedup.long_prefixes(docs)) <= 8 / substring_dedup.FAIR_SHARE


def test_substring_dedup_empty(empty):
    assert substring_dedup.substring_digest(empty).count() == 0


def test_owners():
    import numpy as np

    g = np.random.default_rng(1).integers(0, 9, 200).astype(np.uint64)
    got = substring_dedup.owners(g, 13)
    assert got.tolist() == [i + int(np.argmin(g[i:i + 13])) for i in range(len(g) - 12)]


def test_phrases_that_no_task_sees_twice_go_last_in_the_index(spark):
    """Under hash order alone a phrase of many documents would be an index column of most of them."""
    import numpy as np

    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(8))
    phrase = " ".join(word() for _ in range(9))
    docs = frame(spark, [(i, phrase + " " + " ".join(word() for _ in range(12))) for i in range(120)]).coalesce(4)
    none = np.zeros(0, np.uint64)
    classes = ngram_join.document_sets(docs, 2).filter("gram is null").selectExpr(
        "cls", "struct(doc_id as id, mark) as one").cache()
    every = spark.sparkContext.broadcast(np.full(4096, 255, np.uint8))
    empty = spark.sparkContext.broadcast(none)
    folds = ngram_join.index_folds(docs, every, empty, spark.sparkContext.broadcast(np.zeros(0, np.int32)), 2, 60)
    assert len(ngram_join.crowded_folds(folds)) >= 1
    sizes = [x["count"] for x in ngram_join.index_rows(docs, classes, none, 2, 60).groupBy("gram").count().collect()]
    assert max(sizes, default=0) <= ngram_join.CROWDED


def test_rows_that_a_filter_is_made_of_pass_it(spark):
    import numpy as np

    from fleetyard.llm import key_filter as kf

    keys = spark.range(5000).selectExpr("xxhash64(id) as k")
    bits = kf.key_filter(keys, keys["k"], 5000)
    has = np.array([r["k"] for r in keys.collect()])
    other = np.array([r["k"] for r in spark.range(5000, 25000).selectExpr("xxhash64(id) as k").collect()])
    assert kf.may_have(bits, has).all() and kf.may_have(bits, other).mean() < 0.1
    n = kf.filter_bits(5000)
    both = spark.range(25000).selectExpr("id", "xxhash64(id) as k")
    got = kf.with_bit(both, kf.bit_maps(keys, keys["k"], n), both["k"], n, "has").collect()
    assert [r["has"] for r in sorted(got)] == kf.may_have(bits, np.concatenate([has, other])).tolist()
