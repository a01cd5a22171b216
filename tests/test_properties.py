"""Operators against brute force on random small inputs (NULLs, ties, duplicates)."""
import decimal
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetyard.operators.keyed import latest_by
from fleetyard.plans.parts import parts_agg

keys = st.sampled_from([None, "a", "b", "c"])
dates = st.sampled_from([None, "2024-01-01", "2024-01-02", "2024-02-01"])
rows_strategy = st.lists(st.tuples(keys, dates, st.integers(0, 50)), min_size=0, max_size=25,
                         unique_by=lambda r: r[2])


@settings(max_examples=25, deadline=None)
@given(rows_strategy)
def test_latest_by_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, d string, n int")
    got = {tuple(r) for r in latest_by(df, "k", [F.col("d").desc_nulls_first(),
                                                 F.col("n").desc()]).collect()}
    best = {}
    for k, d, n in rows:
        rank = (d is None, d or "", n)     # NULL date first, then newest date, then largest n
        cur = best.get(k)
        if cur is None or (rank[0], rank[1], rank[2]) > (cur[0], cur[1], cur[2]):
            best[k] = (rank[0], rank[1], rank[2], (k, d, n))
    assert got == {v[3] for v in best.values()}


cons_strategy = st.lists(st.tuples(st.sampled_from(["e1", "e2"]), st.sampled_from(["m1", "m2"]),
                                   st.sampled_from(["0001", "0010", "0002"]),
                                   st.sampled_from([None, 1, 2, 5])),
                         min_size=1, max_size=25)
ORDER_DATE = {"0001": "2024-03-01", "0010": "2024-01-01", "0002": "2024-03-01"}


@settings(max_examples=25, deadline=None)
@given(cons_strategy)
def test_parts_agg_matches_brute_force(spark, rows):
    D = decimal.Decimal
    data = [(e, m, o, ORDER_DATE[o], None if q is None else D(q)) for e, m, o, q in rows]
    df = spark.createDataFrame(data, "equnr string, matnr string, aufnr string, erdat string, "
                                     "bdmng decimal(18,3)")
    got = {(r["equnr"], r["matnr"]): (r["qtd_ocorrencias"], r["qtd_total"], r["ultima_data"],
                                      r["__last"]["aufnr"]) for r in parts_agg(df).collect()}
    groups = defaultdict(list)
    for e, m, o, d, q in data:
        groups[(e, m)].append((o, d, q))
    want = {}
    for key, items in groups.items():
        qs = [q for _, _, q in items if q is not None]
        last = max(((d, o) for o, d, _ in items))
        want[key] = (len({o for o, _, _ in items}), sum(qs) if qs else None,
                     max(d for _, d, _ in items), last[1])
    assert got == want
