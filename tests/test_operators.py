"""Operators on tiny frames with NULLs, blanks, padding, ties and duplicates."""
import decimal

from pyspark.sql import functions as F

from fleetyard.operators.joins import anti_restrict, semi_restrict
from fleetyard.operators.keyed import latest_by, latest_then, priority_dedupe, rank_when, text_lookup
from fleetyard.operators.status import (active_system_statuses, active_user_statuses, user_status,
                                        with_statuses)
from fleetyard.plans.parts import parts_agg
from fleetyard.plans.reservations import lot_positions
from fleetyard.sources.delivery import batch_frame, number_rows, to_batches, to_json_rows


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def test_latest_by_one_row_per_key_null_key_groups(spark):
    df = spark.createDataFrame(
        [("a", "2024-01-02", 1), ("a", "2024-01-02", 2), ("a", "2024-01-01", 9),
         (None, "2024-01-01", 3), (None, "2024-01-05", 4), ("b", None, 5), ("b", "2023-01-01", 6)],
        "k string, d string, n int")
    got = latest_by(df, "k", [F.col("d").desc_nulls_first(), F.col("n").desc()])
    assert rows(got) == sorted([("a", "2024-01-02", 2), (None, "2024-01-05", 4), ("b", None, 5)],
                               key=str)
    assert got.count() == df.select("k").distinct().count()


def test_latest_then_filters_after_ranking(spark):
    df = spark.createDataFrame([("x", 1, "Entrada"), ("x", 2, "Saida"), ("y", 1, "Entrada")],
                               "k string, t int, tipo string")
    got = latest_then(df, "k", [F.col("t").desc()], F.col("tipo") == "Entrada")
    assert rows(got, "k") == [("y",)]          # x left the yard: its older entry must not come back


def test_priority_dedupe(spark):
    df = spark.createDataFrame(
        [("o", "m", "reserva", None, "1"), ("o", "m", "compra", None, None),
         ("o", "m", "compra", "45", None), ("o", "n", "reserva", None, "2")],
        "ordem string, mat string, origem string, pedido string, res string")
    got = priority_dedupe(df, ["ordem", "mat"],
                          [rank_when(F.col("origem") == "compra"), rank_when(F.col("pedido").isNotNull()),
                           rank_when(F.col("res").isNotNull())])
    assert rows(got) == [("o", "m", "compra", "45", None), ("o", "n", "reserva", None, "2")]


def test_text_lookup_language_order_and_restrict(spark):
    t = spark.createDataFrame(
        [("0001", "pt", "b"), ("0001", "P", "c"), ("0001", "E", "a"), ("0002", "E", "x"),
         ("0003", "P", "z"), ("0003", "P", "y")], "m string, spras string, txt string")
    keys = spark.createDataFrame([("1",), ("2",)], "k string")
    got = text_lookup(t, F.ltrim("m", F.lit("0")), "txt", lang="spras", langs=["p", "pt"],
                      lang_ci=True, order=[F.col("spras").asc()], key_name="k", restrict=keys)
    assert rows(got) == [("1", "c")]          # 'P' sorts before 'pt'; key 3 not in play; 2 has no PT text
    full = text_lookup(t, "m", "txt", lang="spras", langs=["P"])
    assert rows(full) == [("0001", "c"), ("0003", "y")]   # tie broken by text


def test_semi_and_anti(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    keys = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(semi_restrict(df, keys, "k")) == [("a",)]               # no fan-out
    assert rows(anti_restrict(df, keys, "k")) == sorted([("b",), (None,)], key=str)


def test_status_rollups(spark):
    objs = spark.createDataFrame([("1", "OR1  "), ("2", "OR2")], "aufnr string, objnr string")
    jsto = spark.createDataFrame([("OR1", " P1"), ("OR2", "P1")], "objnr string, stsma string")
    jest = spark.createDataFrame(
        [("OR1 ", "E0002", None), ("OR1", "E0001", ""), ("OR1", "E0003", "X"), ("OR1", "I0001", None),
         ("OR1", "E0004", None), ("OR2", "I0002", None)], "objnr string, stat string, inact string")
    texts = spark.createDataFrame(
        [("P1 ", "E0001", "P", "ZZ"), ("P1", "E0002", "P", "AB"), ("P1", "E0004", "P", "AB"),
         ("P1", "E0001", "E", "EN")], "stsma string, estat string, spras string, txt04 string")
    got = user_status(objs, "aufnr", "objnr", jsto, jest, texts, with_codes=True)
    assert rows(got) == [("1", "AB AB ZZ", "E0001 E0002 E0004")]   # sorted, duplicates kept
    sys_texts = spark.createDataFrame([("I0001", "P", "LIB"), ("I0002", "P", "CONF")],
                                      "istat string, spras string, txt04 string")
    more = objs.union(spark.createDataFrame([("3", None), ("4", "OR9")], "aufnr string, objnr string"))
    got = with_statuses(more, ["aufnr"], "objnr", active_system_statuses(jest, sys_texts), "s")
    assert rows(got) == [("1", "LIB"), ("2", "CONF"), ("3", None), ("4", None)]
    got = with_statuses(more, ["aufnr"], "objnr", active_user_statuses(jsto, jest, texts), "s")
    assert rows(got) == [("1", "AB AB ZZ"), ("2", None), ("3", None), ("4", None)]


def test_lot_positions(spark):
    D = decimal.Decimal
    stock = spark.createDataFrame(
        [("m", "L2", "B1", D(1)), ("m", "L1", "A2", D(2)), ("m", "L1", "A1", D(3)),
         ("m", "L1", "A1", D(4)), ("m", "", "C1", D(5))],
        "material string, lote string, posicao string, quantidade decimal(18,3)")
    got = lot_positions(stock).collect()[0]
    assert got["lotes_com_posicoes"] == "C1 / L1 - A1 | A2 / L2 - B1"
    assert got["saldo_estoque"] == D(15)


def test_parts_agg_counts_distinct_orders(spark):
    D = decimal.Decimal
    cons = spark.createDataFrame(
        [("e", "m", "0002", "2024-01-05", D(1)), ("e", "m", "0002", "2024-01-05", D(2)),
         ("e", "m", "0010", "2024-01-05", D(3)), ("e", "m", "0003", "2024-01-01", None)],
        "equnr string, matnr string, aufnr string, erdat string, bdmng decimal(18,3)")
    r = parts_agg(cons).collect()[0]
    assert (r["qtd_ocorrencias"], r["qtd_total"], r["ultima_data"], r["__last"]["aufnr"]) == \
        (3, D(6), "2024-01-05", "0010")


def test_number_rows_exactly_once(spark):
    df = spark.range(0, 5003).select((F.col("id") * 7 % 5003).alias("k"))
    got = number_rows(df, [F.col("k")], partitions=7)[0].select("k", "__row").collect()
    assert sorted(r["__row"] for r in got) == list(range(5003))
    assert all(r["k"] == r["__row"] for r in got)        # order preserved


def test_batches(spark):
    df = spark.range(0, 4500).select(F.col("id").alias("k"))
    b, _ = batch_frame(df, [F.col("k")], size=2000)
    meta = sorted({(r["batch"], r["row_count"], r["total_rows"], r["total_batches"])
                   for r in b.collect()})
    assert meta == [(1, 2000, 4500, 3), (2, 2000, 4500, 3), (3, 500, 4500, 3)]
    docs = to_batches(df, [F.col("k")], "job", "2030-01-01T00:00:00+00:00", size=2000)[0].collect()
    assert len(docs) == 3
    empty = to_batches(df.filter("k < 0"), [F.col("k")], "job", "s", size=2000)[0].collect()
    assert len(empty) == 1 and '"rows":[]' in empty[0]["json"] and '"total_batches":1' in empty[0]["json"]
    legacy = to_batches(df.filter("k < 0"), [F.col("k")], "job", "s", style="legacy")[0].collect()
    assert '"is_last":true' in legacy[0]["json"]


def test_json_encoding_isoformat(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5, 120),
                                 dt.date(2024, 1, 2), decimal.Decimal("1.500"), None)],
                               "a timestamp_ntz, b timestamp_ntz, c date, d decimal(18,3), e string")
    j = to_json_rows(df).collect()[0]["json"]
    assert j == ('{"a":"2024-01-02T03:04:05+00:00","b":"2024-01-02T03:04:05.000120+00:00",'
                 '"c":"2024-01-02","d":"1.500","e":null}')


def test_spread_key_keeps_left_join_result_and_spreads_missing_keys(spark):
    from fleetyard.operators.joins import spread_key
    left = spark.createDataFrame([(i, None if i % 3 else "k1", ) for i in range(300)],
                                 "id int, k string")
    right = spark.createDataFrame([("k1", "v")], "k string, v string")
    plain = left.join(right, "k", "left").select("id", "v")
    spread = (left.withColumn("__k", spread_key(F.col("k"), F.col("id")))
              .join(right.withColumnRenamed("k", "__k"), "__k", "left").select("id", "v"))
    assert rows(plain) == rows(spread)
    keys = left.select(spread_key(F.col("k"), F.col("id")).alias("s")).filter("k is null")
    assert keys.distinct().count() == keys.count() == 200     # every missing key is distinct


def test_code_table_broadcast_is_size_checked(spark, tmp_path):
    from fleetyard.operators.joins import code_table
    path = str(tmp_path / "codes")
    spark.createDataFrame([("A", "x")], "k string, v string").write.parquet(path)
    small = spark.read.parquet(path)
    fact = spark.range(1000).selectExpr("CAST(id % 2 AS STRING) AS k")
    hinted = fact.join(code_table(small), "k", "left")
    assert "broadcast" in hinted._jdf.queryExecution().optimizedPlan().toString().lower() or \
        "BroadcastHashJoin" in hinted._jdf.queryExecution().executedPlan().toString()
    capped = fact.join(code_table(small, max_bytes=0), "k", "left")
    assert "broadcast" not in capped._jdf.queryExecution().analyzed().toString().lower()


def test_salted_join_keeps_the_left_join_and_spreads_blank_keys(spark):
    from fleetyard.operators.joins import salted_join
    left = spark.createDataFrame([(i, None if i % 5 == 0 else "" if i % 2 else f"k{i % 4}") for i in range(400)],
                                 "id int, k string")
    for right in ([("k0", 1), ("k2", 2), ("", 3)], [("k0", 1)]):
        look = spark.createDataFrame(right, "key string, v int")
        want = left.join(look, left["k"] == look["key"], "left").select("id", "k", "v")
        assert rows(salted_join(left, look, F.col("k"), "key", F.col("id"))) == rows(want)
