"""Steps whose memory or shuffles grew faster than the input."""
import re

import pytest
from pyspark.sql import functions as F

from fleetyard.operators.joins import estimated_bytes
from fleetyard.operators.hot_keys import HotKeys
from fleetyard.plans import reservations, work_orders


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["t353i_t", "t356_t", "t003p", "t024i", "tj30t", "tj02t", "t001l"])
def test_code_tables_have_a_known_size(small_src, name):
    assert estimated_bytes(small_src.table(name)) < 1 << 20


def test_whole_tables_are_not_shuffled_by_a_status_code(spark, small_src):
    p = plan_of(work_orders.work_order_operations(small_src))
    assert not re.search(r"Exchange hashpartitioning\(stat#", p), p


@pytest.mark.parametrize("name", ["ebkn", "ekkn", "eket", "rsadd", "lips", "ztwf_log_wf"])
def test_line_items_are_numbered_once_a_table(small_src, name):
    assert len(re.findall(r"\bWindow \[", plan_of(small_src.table(name)))) == 1


def test_key_filters_leave_the_shuffle_of_line_items_alone(small_src):
    t = small_src.table("resb")

    def below(df):
        return re.sub(r"#\d+L?|plan_id=\d+|[\s:+-]+", "", plan_of(df).split("Exchange hashpartitioning(__order", 1)[1])

    assert below(t) == below(t.filter(F.col("rsnum").isNotNull() & (F.col("rsnum") > "0000000100")))


def test_the_code_of_reservation_stages_is_compiled(spark, small_src):
    """The JVM interprets methods of more than 8,000 bytes: every row of such a stage takes a multiple of the time."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = reservations.reservation_picking(small_src, hot=HotKeys((("1", 2),)))
        code = df._jdf.queryExecution().debug().codegenToSeq()
        sizes = [code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sizes and max(sizes) <= 8000, sorted(sizes)[-3:]


def test_reservation_items_are_shuffled_once_for_all_item_lookups(spark, small_src):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan_of(reservations.reservation_picking(small_src))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    keys = re.findall(r"SortMergeJoin(?:\(skew=true\))? \[([^\]]*)\]", p)
    assert [re.sub(r"#\d+", "", k) for k in keys[:5]] == ["rsnum", "chave_reserva", "chave_reserva", "chave_reserva", "__salted"], keys


def test_equal_keys_of_other_padding_are_other_items(spark):
    base = spark.createDataFrame([("0000000001", "0001")], "rsnum string, rspos string").withColumn(
        "chave_reserva", reservations.reservation_key("rsnum", "rspos"))
    lookup = spark.createDataFrame([("1", "1", "no"), ("0000000001", "0001", "a"), ("0000000001", "0001", "b")],
                                   "rsnum string, rspos string, x string")
    got = base.join(reservations._of_item(lookup), reservations._same_item(), "left")
    assert sorted(r["x"] for r in got.collect()) == ["a", "b"]
    got = base.join(reservations._of_item(lookup.filter("x = 'no'")), reservations._same_item(), "left")
    assert [r["x"] for r in got.collect()] == [None]


def test_wide_columns_of_reservations_are_moved_as_one_text(spark, small_src):
    """Columns that the joins by item and by reservation only carry are not shuffled one by one."""
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = reservations.reservation_picking(small_src)._jdf.queryExecution().executedPlan()
        text = plan.toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert "__item" in text and "__header" in text
    for line in re.findall(r"hashpartitioning\((?:rsnum|chave_reserva)#.*\n.*", text):
        assert not re.search(r"\b(ktext|sgtxt|nome_criador_reserva)#", line.split("array_join(")[0]), line
