"""Source helpers: slice predicates and the Parquet landing layout."""
from fleetyard.functions.dates import days_back
from fleetyard.sources.tables import JdbcTables, ParquetTables, day_slices, value_slices


def test_value_slices():
    assert value_slices("lgort", ["D005", "D090"]) == ["lgort = 'D005'", "lgort = 'D090'"]


def test_day_slices_cover_window_without_overlap():
    preds = day_slices("erdat", "2030-01-01", 365, 0, 45)
    assert len(preds) == 9
    assert preds[0].startswith(f"erdat BETWEEN '{days_back('2030-01-01', 365)}'")
    assert preds[-1].endswith(f"AND '{days_back('2030-01-01', 0)}'")


def test_slice_bounds_cover_every_day_once():
    from fleetyard.functions.dates import slice_bounds, slice_count
    for ini, fim, size in ((365, 0, 45), (90, 0, 45), (44, 0, 45), (45, 0, 45), (46, 1, 45), (10, 10, 3), (7, 0, 0)):
        days = [d for i in range(slice_count(ini, fim, size))
                for d in range(*[(a, b - 1, -1) for a, b in [slice_bounds(i, ini, fim, size)]][0])]
        assert days == list(range(ini, fim - 1, -1)), (ini, fim, size)


def test_jdbc_source_names_and_slices(spark):
    src = JdbcTables(spark, "jdbc:postgresql://replica/erp", {"user": "u"}, schema="sap",
                     slices={"resb": value_slices("lgort", ["D005"])})
    assert src._name("scwm_aqua") == 'sap."/scwm/aqua"'
    assert src._name("resb") == "sap.resb"
    assert src.slices["resb"] == ["lgort = 'D005'"]


def test_parquet_source_reuses_handles(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    src = ParquetTables(spark, str(tmp_path))
    assert src.table("t") is src.table("t")
    assert src.table("t").count() == 3


def test_cluster_conf_scales_with_input():
    from fleetyard.session import cluster_conf
    small = cluster_conf(10 << 30, 64)
    big = cluster_conf(100 << 40, 8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 128          # two waves of 64 cores
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)    # no cap
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 << 20)


def test_bucketed_order_tables_join_without_shuffle(spark, small_src, tmp_path):
    from fleetyard.sources.landing import land_bucketed
    src = land_bucketed(spark, small_src, ["aufk", "afih"], "fy_test", str(tmp_path / "wh"), 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = src.table("aufk").join(src.table("afih"), "aufnr")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert "Exchange hashpartitioning" not in plan
        assert j.count() == small_src.table("aufk").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_jdbc_url_engine_choice():
    from fleetyard.sources.tables import jdbc_url
    assert jdbc_url("postgresql", "h", "db") == "jdbc:postgresql://h:5432/db"
    assert jdbc_url("mysql", "h", "db").startswith("jdbc:mysql://h:3306/db?")
    assert jdbc_url("postgresql", "h", "db", 3306) == "jdbc:postgresql://h:3306/db"


def test_jdbc_options(spark):
    src = JdbcTables(spark, "jdbc:mysql://h/db", {"user": "u"}, schema="app", schemas={"hourmeter": "telemetry"},
                     slices={"resb": value_slices("lgort", ["D'5"])}, ranges={"hourmeter": ("id", 1, 1000, 8)})
    assert src.options("resb")["predicates"] == ["lgort = 'D''5'"]
    o = src.options("hourmeter")
    assert (o["table"], o["column"], o["numPartitions"]) == ("telemetry.hourmeter", "id", 8)
    assert set(src.options("equi")) == {"url", "table", "properties"}


def test_declared_types_are_asserted(spark, tmp_path):
    import pytest
    spark.sql("select 1 as aufnr, '2024-01-01' as erdat, 'x' as objnr").write.parquet(str(tmp_path / "aufk"))
    with pytest.raises(TypeError, match="aufnr should be string"):
        ParquetTables(spark, str(tmp_path)).table("aufk")


def test_front_end_source_slices_leave_nothing_out(spark):
    from fleetyard.__main__ import open_source
    from fleetyard.sources.dictionaries import PICKING_LOCATIONS
    src = open_source(spark, "jdbc:postgresql://h/db", "sap")
    preds = src.options("resb")["predicates"]
    df = spark.createDataFrame([(x,) for x in [*PICKING_LOCATIONS, "Z1", None]], "lgort string")
    assert sum(df.filter(p).count() for p in preds) == df.count()
