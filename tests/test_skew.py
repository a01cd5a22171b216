"""A key holding a third of all rows: results stay exact and the hot key is
reduced before the shuffle (partial top-1 / partial aggregation)."""
import re

from pyspark.sql import functions as F

from fleetyard.operators.keyed import latest_by
from fleetyard.plans.parts import parts_agg


def skewed(spark, n=30000):
    # key "hot" gets every third row; the rest spread over 2,000 keys
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 2000).cast("string"))
        .alias("k"), F.col("id").alias("n")).repartition(8)


def test_latest_by_hot_key(spark):
    df = skewed(spark)
    got = latest_by(df, "k", [F.col("n").desc()])
    rows = {r["k"]: r["n"] for r in got.collect()}
    want = {r["k"]: r["m"] for r in df.groupBy("k").agg(F.max("n").alias("m")).collect()}
    assert rows == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    # the tree prints top-down: the partial limit appears below (after) the exchange
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit[^\n]*Partial", plan), plan


def test_parts_agg_hot_pair(spark):
    base = skewed(spark)
    cons = base.select(F.col("k").alias("equnr"), F.lit("m").alias("matnr"),
                       (F.col("n") % 97).cast("string").alias("aufnr"),
                       F.lit("2024-01-01").alias("erdat"), F.lit(1).cast("decimal(18,3)").alias("bdmng"))
    got = {r["equnr"]: (r["qtd_ocorrencias"], int(r["qtd_total"]))
           for r in parts_agg(cons).collect()}
    assert got["hot"] == (97, 10000)
    plan = parts_agg(cons)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_") >= 2          # both levels combine map-side


def test_spread_key_balances_missing_keys(spark):
    from fleetyard.operators.joins import spread_key
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(
        (F.col("id") % 50).cast("string")).alias("k"), F.col("id"))
    spread = df.select(spread_key(F.col("k"), F.col("id")).alias("s")).repartition(16, "s")
    sizes = [r["c"] for r in spread.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count("*").alias("c")).collect()]
    assert max(sizes) < 30000 / 3          # the 10,000 missing keys do not share one task


def test_missing_requisitions_do_not_share_a_stand_in(spark):
    """The stand-in of a missing key comes from the row's own key."""
    from fleetyard.operators.joins import spread_key
    df = spark.range(1000).select(F.lit(None).cast("string").alias("banfn"), F.col("id").cast("string").alias("rsnum"),
                                  F.lit("1").alias("rspos"))
    assert df.select(spread_key(F.col("banfn"), F.concat_ws("/", "rsnum", "rspos")).alias("k")).distinct().count() == 1000


def test_malformed_numbers_fail_loudly(spark):
    import pytest
    from fleetyard.plans.reservations import reservation_picking
    from fleetyard.sources.testdata import TestdataTables

    class Broken(TestdataTables):
        def table(self, name):
            df = super().table(name)
            return df.withColumn("rspos", F.lit("12A4")) if name == "resb" else df

    with pytest.raises(Exception, match="CAST_INVALID_INPUT|12A4"):
        reservation_picking(Broken(spark, "/root/testdata/sf0.001")).select("numero_item").collect()
