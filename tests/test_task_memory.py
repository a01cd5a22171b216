"""Partitions that follow the size of the input."""
from fleetyard.operators.joins import dealt_by_size
from fleetyard.plans import parts


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_follow_the_input(spark, small_src):
    a = small_src.table("aufk").select("aufnr", "erdat")
    h = small_src.table("afih").select("aufnr", "equnr")
    want = sorted(a.join(h, "aufnr").collect())
    few, many = (dealt_by_size("aufnr", a, h, task_bytes=b) for b in (1 << 40, 1 << 10))
    assert few[0] is a and few[1] is h
    assert many[0].rdd.getNumPartitions() > 8
    assert sorted(many[0].join(many[1], "aufnr").collect()) == want
    unknown = spark.createDataFrame([("1",)], "aufnr string")
    assert dealt_by_size("aufnr", unknown)[0] is unknown


def test_consumption_is_dealt_by_size(small_src, monkeypatch):
    want = sorted(parts.consumption(small_src, "2030-01-01", 3650, 0).collect(), key=str)
    monkeypatch.setattr(parts, "dealt_by_size", lambda on, *f: dealt_by_size(on, *f, task_bytes=1 << 10))
    cut = parts.consumption(small_src, "2030-01-01", 3650, 0)
    assert "REPARTITION_BY_NUM" in plan_of(cut)
    assert sorted(cut.collect(), key=str) == want
