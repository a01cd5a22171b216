"""Equal-depth key ranges: no gap, no overlap, parts of about equal depth."""
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetyard.sources.key_ranges import below, depths, equal_depth_bounds, from_on, range_predicates
from fleetyard.sources.tables import JdbcTables, KeyRange

SCHEMA = "a string, b string, n int"


def spread(spark, df, columns, bounds):
    """Row counts by part, and rows that are in no part or in several."""
    preds = range_predicates(columns, bounds)
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in preds), F.lit(0))
    assert df.filter(hits != 1).count() == 0
    return {r["part"]: r["rows"] for r in depths(df, columns, bounds).collect()}


def skewed_rows(n=12000, seed=3):
    """A third of the rows on one value, the rest clustered; some without a key."""
    r = random.Random(seed)
    rows = []
    for i in range(n):
        a = "000500" if i % 3 == 0 else f"{min(999999, int(r.paretovariate(0.6))):06d}"
        rows.append((None if i % 50 == 1 else a, None if i % 70 == 2 else f"{r.randint(0, 10**6):06d}", i))
    return rows


def test_skewed_key_is_cut_evenly(spark):
    df = spark.createDataFrame(skewed_rows(), SCHEMA).repartition(5)
    bounds = equal_depth_bounds(df, ["a", "b"], 16)
    assert bounds == sorted(bounds, key=lambda t: (t[0], t[1] is not None, t[1] or ""))
    sizes = spread(spark, df, ["a", "b"], bounds)
    null_part = len(bounds) + 1
    counted = [n for p, n in sizes.items() if p != null_part]
    assert sizes[null_part] == sum(1 for r in skewed_rows() if r[0] is None)
    assert max(counted) < 2 * sum(counted) / 16
    # equal strides over the same key: most rows in one part
    assert sum(counted) > 0


def test_bounds_of_a_sample_hold_for_the_table(spark):
    df = spark.createDataFrame(skewed_rows(40000), SCHEMA)
    bounds = equal_depth_bounds(df.sample(0.1, seed=5), ["a", "b"], 12)
    sizes = spread(spark, df, ["a", "b"], bounds)
    counted = [n for p, n in sizes.items() if p != len(bounds) + 1]
    assert len(counted) == 12 and max(counted) < 2 * sum(counted) / 12


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.sampled_from("abc'd")), st.one_of(st.none(), st.sampled_from("xyz"))), max_size=8),
       bounds=st.lists(st.tuples(st.sampled_from("abc'd"), st.one_of(st.none(), st.sampled_from("xyz"))), max_size=4, unique=True))
def test_every_row_is_in_one_part(rows, bounds):
    """Checked in DuckDB's three-valued logic."""
    import duckdb
    bounds = sorted(bounds, key=lambda t: (t[0], t[1] is not None, t[1] or ""))
    preds = range_predicates(["a", "b"], bounds)
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a VARCHAR, b VARCHAR)")
    if rows:
        con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    counts = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in preds]
    assert sum(counts) == len(rows)
    for b in bounds:
        both = con.execute(f"SELECT count(*) FROM t WHERE ({below(['a', 'b'], b)}) AND ({from_on(['a', 'b'], b)})").fetchone()[0]
        assert both == 0


def test_few_rows_and_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert equal_depth_bounds(none, ["a"], 8) == [] and range_predicates(["a"], []) == ["a IS NOT NULL", "a IS NULL"]
    one = spark.createDataFrame([("k", "1", 1), (None, "2", 2)], SCHEMA)
    assert spread(spark, one, ["a"], equal_depth_bounds(one, ["a"], 8)) == {1: 1, 2: 1}
    assert equal_depth_bounds(one, ["a"], 1) == []


class Replica(JdbcTables):
    """Reads its key samples from a frame instead of a database."""

    def __init__(self, frame, *args, **kw):
        super().__init__(*args, **kw)
        self.frame, self.asked = frame, []

    def _sample(self, name):
        self.asked.append(self.sample_query(name))
        return self.frame.select(*self.keys[name].columns)


def test_read_options(spark):
    df = spark.createDataFrame(skewed_rows(), SCHEMA)
    src = Replica(df, spark, "jdbc:postgresql://h/db", {}, schema="sap", keys={"resb": KeyRange(("a", "b"), 8, percent=2)})
    got = src.options("resb")
    assert src.asked == ["SELECT a, b FROM sap.resb TABLESAMPLE SYSTEM (2)"]
    assert len(got["predicates"]) == 9 and got["predicates"][-1] == "a IS NULL" and "column" not in got
    src.options("resb")
    assert len(src.asked) == 1                                    # bounds are taken once
    assert "predicates" not in src.options("aufk")
    my = JdbcTables(spark, "jdbc:mysql://h/db", {}, keys={"t": KeyRange(("a",), 4, percent=0.5)})
    assert my.sample_query("t") == "SELECT a FROM t WHERE RAND() < 0.005"


def test_text_keys_are_compared_as_bytes_unless_digits(spark):
    words = spark.createDataFrame([(w, "1", 1) for w in ("Ab", "aB", "b", "Ça")] * 20, SCHEMA)
    src = Replica(words, spark, "jdbc:postgresql://h/db", {}, keys={"t": KeyRange(("a",), 3)})
    assert all('a COLLATE "C"' in p for p in src.options("t")["predicates"][:-1])
    digits = spark.createDataFrame(skewed_rows(3000), SCHEMA)
    src = Replica(digits, spark, "jdbc:mysql://h/db", {}, keys={"t": KeyRange(("a",), 3)})
    assert not any("BINARY" in p for p in src.options("t")["predicates"])


def test_one_way_of_cutting_a_table(spark):
    with pytest.raises(ValueError):
        JdbcTables(spark, "jdbc:postgresql://h/db", {}, slices={"t": ["x = 1"]}, keys={"t": KeyRange(("a",), 3)})
