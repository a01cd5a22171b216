"""Maintained winners, parts kept by slices, and mergeable profiles."""
import datetime as dt
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetyard.operators import profiles
from fleetyard.operators.keyed import latest_by
from fleetyard.operators.maintained import refreshed_latest
from fleetyard.plans.parts import parts_history
from fleetyard.plans.parts_state import PartsState

SCHEMA = "id int, k string, s string, day string"


def order():
    return [F.col("day").desc_nulls_first(), F.col("id").desc_nulls_first()]


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_ten_change_sets(spark):
    r = random.Random(12)

    def new(i):
        return (i, r.choice(["a", "b", "c", "d", None]), r.choice(["x", "y"]), r.choice([None, *[f"2024-01-{d:02d}" for d in range(1, 20)]]))

    table = {i: new(i) for i in range(120)}
    winners = spark.createDataFrame(latest_by(spark.createDataFrame(list(table.values()), SCHEMA), ["k", "s"], order()).collect(), SCHEMA)
    lost = 0
    for _ in range(10):
        top = {w["id"] for w in winners.collect()}
        gone = set(r.sample(sorted(table), 5)) | set(r.sample(sorted(top), 2))
        lost += len(gone & top)
        for i in gone:
            del table[i]
        changed = {i: new(i) for i in r.sample(sorted(table), 6)}
        changed |= {i: new(i) for i in range(max(table) + 1, max(table) + 8)}
        table |= changed
        now = spark.createDataFrame(list(table.values()), SCHEMA)
        got = refreshed_latest(winners, spark.createDataFrame(list(changed.values()), SCHEMA),
                               spark.createDataFrame([(i,) for i in gone], "id int"), now, ["k", "s"], ["id"], order())
        kept = got.collect()
        assert sorted(map(tuple, kept), key=repr) == rows_of(latest_by(now, ["k", "s"], order()))
        winners = spark.createDataFrame(kept, SCHEMA)
    assert lost >= 10
    none = spark.createDataFrame([], SCHEMA)
    assert rows_of(refreshed_latest(winners, none, none.select("id"), now, ["k", "s"], ["id"], order())) == rows_of(winners)


# ------------------------------------------------------------------ parts by slices
def test_merged_slices_are_the_window(spark, small_src):
    state = PartsState(spark, tempfile.mkdtemp(prefix="parts-"), days=45)
    for as_of, ini, fim in (("2025-06-30", 365, 0), ("2025-07-20", 365, 0), ("2025-07-20", 400, 17), ("2025-07-20", 30, 0), ("2030-01-01", 3650, 0)):
        want = parts_history(small_src, as_of, ini, fim)
        got = state.history(small_src, as_of, ini, fim).select(*want.columns)
        assert rows_of(got) == rows_of(want), (as_of, ini, fim)


def test_slices_are_computed_once(spark, small_src, monkeypatch):
    from fleetyard.plans import parts_state
    asked = []
    plain = parts_state.consumption
    monkeypatch.setattr(parts_state, "consumption", lambda *a: asked.append(a[2:]) or plain(*a))
    state = PartsState(spark, tempfile.mkdtemp(prefix="parts-"), days=45)
    first = state.fill(small_src, "2025-06-30", 365, 0)
    assert len(first) == len(state.whole("2025-06-30", 365, 0)) >= 7 and len(asked) == 1
    assert state.fill(small_src, "2025-06-30", 365, 0) == [] and len(asked) == 1
    more = state.fill(small_src, "2025-08-30", 365, 0)
    assert 1 <= len(more) <= 2 and not set(more) & set(first)
    young = PartsState(spark, state.path, 45, settled=60)
    last = young._days(young.whole("2025-06-30", 365, 0)[-1])[1]
    assert last <= dt.date(2025, 6, 30) - dt.timedelta(days=60)


def test_missing_slices_and_ends_take_one_pass(spark, small_src, monkeypatch):
    from fleetyard.plans import parts_state
    asked = []
    plain = parts_state.consumption
    monkeypatch.setattr(parts_state, "consumption", lambda *a: asked.append(a[2:]) or plain(*a))
    for settled in (0, 100):
        state = PartsState(spark, tempfile.mkdtemp(prefix="parts-"), days=45, settled=settled)
        want = rows_of(parts_history(small_src, "2025-06-30", 365, 3))
        asked.clear()
        for again in (False, True):             # the second time from kept slices
            got = state.history(small_src, "2025-06-30", 365, 3)
            if not again:
                assert len(asked) == 1
            assert rows_of(got.select(*parts_history(small_src, "2025-06-30", 365, 3).columns)) == want


# ------------------------------------------------------------------ profiles
def skewed(spark, n=40000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 1, "  ").when(F.col("id") % 13 == 2, F.lit(None))
        .otherwise((F.col("id") % 9000).cast("string")).alias("t"),
        F.when(F.col("id") % 7 != 0, (F.col("id") * F.col("id") % 1000003).cast("decimal(18,3)")).alias("n"),
        F.lit(None).cast("string").alias("none"), (F.col("id") % 4).alias("day"))


def close(got, exact, values, n):
    assert (got["rows"], got["nulls"], got["blanks"]) == (exact["rows"], exact["nulls"], exact["blanks"])
    assert abs(got["distinct"] - exact["distinct"]) <= max(2, 3 * 1.04 / 2 ** (profiles.LG_HLL / 2) * exact["distinct"])
    if got["quantiles"] is not None:
        ordered = sorted(values)
        for q, v in zip(profiles.QUANTILES, got["quantiles"]):
            low = sum(1 for x in ordered if x < v) / len(ordered)
            high = sum(1 for x in ordered if x <= v) / len(ordered)
            assert low - 0.01 <= q <= high + 0.01
    count = Counter(values)
    for x in got["top"]:
        assert 0 <= x["count"] - count[x["item"]] <= n / (0.75 * profiles.TRACKED) + 1 or not isinstance(next(iter(values)), str)


def test_profile_keeps_its_bounds_in_one_pass_and_merged(spark):
    df = skewed(spark)
    parts = profiles.sketches(df, ["day"])
    one = {r["column"]: r for r in profiles.profile(df, ["t", "n", "none"]).collect()}
    four = {r["column"]: r for r in profiles.report(profiles.merged(parts)).collect()}
    exact = {r["column"]: r for r in profiles.exact_profile(df, ["t", "n", "none"]).collect()}
    data = df.collect()
    for got in (one, four):
        assert got.keys() == exact.keys()
        for c in ("t", "n"):
            values = [float(r[c]) if c == "n" else r[c] for r in data if r[c] is not None]
            close(got[c], exact[c], values, len(data))
        assert got["t"]["top"][0]["item"] == "hot" and got["t"]["quantiles"] is None
        assert got["none"]["nulls"] == len(data) and got["none"]["distinct"] == 0 and got["none"]["top"] == []
    plan = profiles.sketches(df, [], ["t", "n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Expand" not in plan


def test_profile_of_nothing(spark):
    none = skewed(spark).limit(0)
    got = {r["column"]: r for r in profiles.profile(none).collect()}
    assert all(r["rows"] == 0 and r["distinct"] == 0 and r["quantiles"] is None for r in got.values())
    with pytest.raises(ValueError):
        profiles.sketches(none, ["t", "n", "none", "day"])
