"""Quality classifier, toxicity, components and the pipeline."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetyard.llm import quality_classifier, toxicity
from fleetyard.llm.components import components
from tests.llm import brute
from tests.llm.conftest import SF, frame, make_rows

SF01 = "/root/testdata/sf0.1"


def test_posteriors_against_plain_arithmetic(spark):
    r = np.random.default_rng(3)
    rows = [(int(i), f"h{i % 5}", f"p{r.integers(0, 4)}", float(r.normal(i % 5 - 2, 1))) for i in range(400)]
    rows += [(900, "", "", 0.0), (901, "lone", "x", 3.0)]
    got = {x["doc_id"]: x for x in quality_classifier.posteriors(
        spark.createDataFrame(rows, "doc_id long, host string, path string, evidence double"), 0.4).collect()}
    p = {d: 1 / (1 + np.exp(-(z + 0.4))) for d, _, _, z in rows}

    def groups(key):
        out = {}
        for row in rows:
            s, n = out.get(key(row), (0.0, 0))
            out[key(row)] = (s + p[row[0]], n + 1)
        return out

    def strength(gs, parent):
        n = sum(c for _, c in gs.values())
        between = sum(c * (s / c - parent(k)) ** 2 for k, (s, c) in gs.items())
        draws = sum(parent(k) * (1 - parent(k)) for k in gs)
        spread = sum(c * parent(k) * (1 - parent(k)) for k, (_, c) in gs.items())
        v = max(0.0, (between - draws) / n)
        return 1e6 if v <= 0 else min(1e6, max(1.0, spread / n / v - 1))

    hosts, paths = groups(lambda x: x[1]), groups(lambda x: (x[1], x[2]))
    mean = sum(p.values()) / len(p)
    hs = strength(hosts, lambda k: mean)
    host_rate = {k: (s + hs * mean) / (c + hs) for k, (s, c) in hosts.items()}
    ps = strength(paths, lambda k: host_rate[k[0]])
    assert hs < 1e6          # the hosts of this input do differ
    for d, h, q, z in rows:
        s, c = paths[h, q]
        rate = (s - p[d] + ps * host_rate[h]) / (c - 1 + ps)
        score = 1 / (1 + np.exp(-(z + np.log(rate / (1 - rate)))))
        assert got[d]["site_rate"] == pytest.approx(rate, rel=1e-6)
        assert got[d]["score"] == pytest.approx(score, rel=1e-6)


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    train = labels.filter("doc_id % 3 != 1")
    out = quality_classifier.quality(docs, train, docs["source"], docs["lang"])
    j = out.join(labels.filter("doc_id % 3 = 1"), "doc_id")
    right = j.filter("(quality = 1) = kept").count()
    assert out.count() == docs.count() and right >= 0.97 * j.count()


def test_quality_odd_input(docs, rows, labels, no_labels, empty):
    out = quality_classifier.quality(docs, labels, docs["source"], docs["lang"])
    assert out.count() == len(rows) and out.filter("score is null or kept is null").count() == 0
    flat = quality_classifier.quality(docs, no_labels, docs["source"], docs["lang"])
    assert flat.count() == len(rows) and flat.filter("evidence != 0").count() == 0
    assert quality_classifier.quality(empty, labels, empty["source"], empty["lang"]).count() == 0


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.toxicity(docs, labels)
    assert out.count() == docs.count()
    rows = out.join(labels, "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    toxic = [r for r in held if r["toxic"] == 1]
    clean = [r for r in held if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.8 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    order = sorted(held, key=lambda r: r["score"])
    rank = {r["doc_id"]: i for i, r in enumerate(order)}
    auc = (sum(rank[r["doc_id"]] for r in toxic) - len(toxic) * (len(toxic) - 1) / 2) / (len(toxic) * len(clean))
    assert auc > 0.95


def test_toxicity_shares_subwords():
    clean = ["one two three four five six seven".split(), "some other words in here".split()] * 20
    bad = ["you are a moronic person".split(), "what an idiotic thing moronic".split()] * 20
    m = toxicity.fit(clean + bad, np.array([0] * len(clean) + [1] * len(bad)))
    known, misspelt, plain = m.word_logits(["moronic", "mooronic", "seven"])
    assert known > misspelt > plain


def test_toxicity_odd_input(docs, rows, labels, no_labels, empty):
    for lab in (labels, no_labels):
        out = toxicity.toxicity(docs, lab)
        assert out.count() == len(rows)
        assert out.filter("score is null or score < 0 or score > 1 or predicted != cast(score >= 0.7 as int)").count() == 0
        assert out.filter("doc_id is null and held_out").count() == 0
    assert toxicity.toxicity(empty, labels).count() == 0


def test_top_windows():
    z = np.array([1.0, 2, 3, 4, 5, 0, 0, 0, 9, 7.0])
    best, of, at = toxicity.top_windows(z, np.array([0, 9, 9, 10]))
    assert best.tolist() == [(10 / 4 + 9 / 4) / 2, 0.0, 7 / 4]
    assert sorted(zip(of.tolist(), at.tolist())) == [(0, 0), (0, 8), (2, 9)]


def test_word_rows_depend_on_the_word_alone():
    rows, n = toxicity.word_rows(["abc", "x", "abcdefgh", "abc"])
    ends = np.cumsum(n)
    assert rows[:ends[0]].tolist() == rows[ends[2]:].tolist()
    alone, m = toxicity.word_rows(["abcdefgh"])
    assert sorted(alone.tolist()) == sorted(rows[ends[1]:ends[2]].tolist()) and m.tolist() == [n[2]]


def test_components(spark):
    import random

    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(r.randrange(60), r.randrange(60)) for _ in range(40)] + [(500, 500), (7, 7)]
    edges += [(1000, 1000 + i) for i in range(1, 80)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_pipeline_against_brute_force(spark, tmp_path):
    """Every stage on what its predecessor kept, compared with the plain version."""
    import corpus_pipeline as P
    from fleetyard.llm import quality_rules
    from fleetyard.llm.frames import read, written

    bench = [(r["item_id"], r["text"]) for r in read(spark, SF, "benchmark").collect()]
    rows = make_rows(11) + [(700 + i, f"{t} and " + " ".join(f"w{i}x{j}" for j in range(60))) for i, (_, t) in enumerate(bench[:4])]
    rows += [(800, " ".join(f"q{j}" for j in range(70)) + " mail jo.x@mail.example.com now")]
    before = frame(spark, rows)
    labels = read(spark, SF, "labels")
    stages = dict(P.STAGES)
    assert [n for n, _ in P.STAGES] == ["quality_rules", "ngram_jaccard", "decontamination", "pii", "sentence_pieces"]

    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    one = written(stages["quality_rules"](spark, before, SF), "t1")
    w = quality_rules.log_ratio(*quality_rules.count_grams(before, labels))
    judged = quality_rules.judge(before, w).filter("score >= -0.5").count()
    assert one.columns == before.columns and judged >= one.count()
    assert all(not brute.base_failed(t) for _, t in pairs(one))

    two = written(stages["ngram_jaccard"](spark, one, SF), "t2")
    here = pairs(one)
    _, group = brute.jaccard_components(here, 5, 80)
    assert two.count() == len(set(group)) and two.columns == one.columns

    three = written(stages["decontamination"](spark, two, SF), "t3")
    here = pairs(two)
    found = {r for r, _ in brute.leaks(here, bench)}
    assert pairs(three) == [x for i, x in enumerate(here) if i not in found]

    four = written(stages["pii"](spark, three, SF), "t4")
    assert four.columns == three.columns and four.count() == three.count()
    assert not any(brute.pii_spans(t) for _, t in pairs(four))
    assert four.filter("n_chars != length(text)").count() == 0
    plain = [x for x in pairs(three) if not any(c.isdigit() or c == "@" for c in x[1])]
    assert plain and set(plain) <= set(pairs(four))

    five = stages["sentence_pieces"](spark, four, SF)
    assert five.count() == four.count() and five.filter(F.size("ids") != F.col("n_tokens")).count() == 0


def test_pipeline_runs_on_a_table(spark):
    import corpus_pipeline as P

    out = P.run(spark, SF)
    assert out.count() > 0 and set(out.columns) == {"doc_id", "n_tokens", "ids"}


def test_pipeline_on_an_empty_table(spark, empty):
    import corpus_pipeline as P

    docs = empty
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_queries_are_registered():
    import __spark_entry__ as e

    names = e.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
