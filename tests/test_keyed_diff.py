import random

import pytest
from pyspark.sql import functions as F

from fleetyard.operators.keyed_diff import change_counts, keyed_diff


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, n int, a string, b double")


def test_matches_brute_force(spark):
    r = random.Random(2)

    def rows():
        out = [(k, n, r.choice(["x", "y", None]), r.choice([1.0, None])) for k in ["p", "q", None] for n in [1, 2, 3, None] if r.random() < 0.8]
        return out + r.sample(out, 2)

    for _ in range(5):
        old, new = rows(), rows()
        got = {(x["k"], x["n"]): (x["op"], list(x["changed"])) for x in keyed_diff(frame(spark, old), frame(spark, new), ["k", "n"]).collect()}
        want = {}
        for key in {x[:2] for x in old + new}:
            a, b = [x for x in old if x[:2] == key], [x for x in new if x[:2] == key]
            if len(a) > 1 or len(b) > 1:
                want[key] = ("repeated", [])
            elif not a or not b:
                want[key] = ("delete" if a else "insert", [])
            else:
                changed = [c for c, i in (("a", 2), ("b", 3)) if a[0][i] != b[0][i]]
                want[key] = ("update" if changed else "same", changed)
        assert got == want


def test_one_shuffle_and_counts(spark):
    old = frame(spark, [("p", 1, "x", 1.0), ("p", 2, None, None), ("q", 1, "z", 2.0)])
    new = frame(spark, [("p", 1, "y", 3.0), ("p", 2, None, None), ("s", 1, None, None)])
    diff = keyed_diff(old, new, ["k", "n"])
    plan = diff._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    got = {r["what"]: r["n"] for r in change_counts(diff, ["a", "b"]).collect()}
    assert got == {"insert": 1, "delete": 1, "update": 1, "same": 1, "repeated": 0, "column a": 1, "column b": 1}
    row = diff.filter("op = 'insert'").first()
    assert row["old"] is None and row["new"].a is None and row["k"] == "s"


def test_types_must_agree(spark):
    with pytest.raises(TypeError):
        keyed_diff(frame(spark, []), frame(spark, []).withColumn("a", F.lit(1)), ["k"])


def test_no_rows(spark):
    none = frame(spark, [])
    assert keyed_diff(none, none, ["k"]).collect() == []
    assert {r["n"] for r in change_counts(keyed_diff(none, none, ["k"]), ["a"]).collect()} == {0}
