import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from fleetyard.llm import collocations as co
from fleetyard.llm.collocations import collocations

LOW = {i: i + 32 for i in range(65, 91)}


def plain(rows, least, percent=80, top=2000):
    """rows: (lang, text)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        g = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            w = re.findall("[^ \t]+", piece)
            n[g] += len(w)
            f.update((g, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {x: v for x, v in f.items() if v >= least and len(x[1]) > 1}
    covered = {(g, w[i:j]) for (g, w), v in found.items() for i in range(len(w)) for j in range(i + 2, len(w) + 1)
               if j - i < len(w) and 100 * v >= percent * f[g, w[i:j]]}
    best = defaultdict(list)
    for (g, w), a in found.items():
        if (g, w) not in covered:
            score, k = min((2000000 * a // (f[g, w[:k]] + f[g, w[k:]]), k) for k in range(1, len(w)))
            best[g].append((-score, -a, " ".join(w).encode(), f[g, w[:k]], f[g, w[k:]]))
    return sorted((g, i, p.decode(), -a, left, right, n[g], -score) for g, x in best.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(x)[:top], 1))


def frame(spark, rows):
    full = [(*x, "a", 1, 2, i) for i, x in enumerate(rows)]
    return spark.createDataFrame(full, "lang string, text string, word string, w1 long, n long, g long").repartition(4)


def odd_rows():
    r = random.Random(4)
    v = ["Zoë", "of", "THE", "the", "é", " x", "中文", "\U0001f600", "a", "b", "c", "it's", "x-y", "&"]
    line = lambda n: "".join(r.choice(v) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n"]) for _ in range(n))
    rows = [(r.choice(["en", "en", "de", None, "und", ""]), line(r.randint(0, 120))) for _ in range(120)]
    rows += [("en", "one hot pair of words. " * 3)] * 50 + [("en", None), (None, None), ("fr", ""), ("fr", " \n\t "), ("fr", "...")]
    rows += [("en", "loop " * 3000), ("it", "x" * 50000), ("it", line(20000))]
    return rows


@pytest.mark.parametrize("least,top", [(30, 2000), (5, 7), (2, None)])
def test_matches_brute_force(spark, least, top):
    rows = odd_rows()
    got = sorted(map(tuple, collocations(frame(spark, rows), least=least, top=top).collect()))
    assert got == plain(rows, least, top=top or 10**9)


def test_small_segments_and_groups_change_nothing(spark, monkeypatch):
    rows = odd_rows()
    want = plain(rows, 5)
    monkeypatch.setattr(co, "SEGMENT", 200)
    monkeypatch.setattr(co, "CHUNK", 500)
    monkeypatch.setattr(co, "GROUP_ROWS", 50)
    monkeypatch.setattr(co, "BITS", (1 << 15, 1 << 15))
    cuts = []
    plainly = co.prefix_groups
    monkeypatch.setattr(co, "prefix_groups", lambda *a: cuts.append(plainly(*a)) or cuts[-1])
    assert sorted(map(tuple, collocations(frame(spark, rows), least=5).collect())) == want
    assert len(cuts[0]) > 20


def test_subtree_totals_over_any_batches():
    r = np.random.default_rng(2)
    rows = r.integers(1, 4, (600, 4)) * (np.cumprod(r.random((600, 4)) < 0.8, axis=1) | (np.arange(4) < 2))
    rows = rows[np.lexsort(rows.T[::-1])]
    n = r.integers(1, 5, len(rows))
    want = Counter()
    for x, c in zip(rows.tolist(), n.tolist()):
        for d in range(2, 5):
            if x[d - 1]:
                want[tuple(x[:d] + [0] * (4 - d))] += c
    for sizes in ([600], [1] * 600, [7] * 86):
        tree, got, at = co.Subtree(10), Counter(), 0
        for s in sizes:
            for nodes, totals in tree.add(list(rows[at:at + s].T), n[at:at + s]):
                for path, t in zip(zip(*[x.tolist() for x in nodes]), totals.tolist()):
                    assert path not in got
                    got[path] = t
            at += s
        for nodes, totals in tree.close():
            got[tuple(int(x[0]) for x in nodes)] = int(totals[0])
        assert got == {p: c for p, c in want.items() if c >= 10}


def test_exact_beyond_64_bits(spark):
    row = lambda *p, n: (*p, *[0] * (4 - len(p)), n)
    big = 10**13
    schema = "w1 long, w2 long, w3 long, w4 long, n long"
    phrases = spark.createDataFrame([row(1, 2, n=big - 1), row(1, 2, 3, n=(big - 1) * 8 // 10)], schema)
    counts = spark.createDataFrame([row(1, n=big), row(2, n=big + 3), row(3, n=big), row(2, 3, n=big), row(1, 2, n=big - 1)], schema)
    got = {x.w3: (x.a, x.l, x.r, x.score) for x in co._scored(phrases, counts).collect()}
    assert got[0] == (big - 1, big, big + 3, 2000000 * (big - 1) // (2 * big + 3))
    a = (big - 1) * 8 // 10
    assert got[3] == (a, big, big, 2000000 * a // (2 * big))
    assert co._covered(phrases, 80).collect() == []                    # just below 80 of 100
    assert len(co._covered(phrases, 79).collect()) == 1


def test_empty_table(spark):
    assert collocations(frame(spark, [("en", "x")]).limit(0)).collect() == []
    assert collocations(frame(spark, [(None, None), ("en", "few words")])).collect() == []


def test_query_matches_its_sql(spark):
    import duckdb

    from fleetyard.llm.queries import ORACLE_SQL, QUERIES
    d = "/root/testdata/sf0.001"
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    out = QUERIES["op13_collocations"](spark, d)
    want = duckdb.sql(ORACLE_SQL["op13_collocations"])
    assert sorted(map(tuple, out.select(*want.columns).collect())) == sorted(want.fetchall())
