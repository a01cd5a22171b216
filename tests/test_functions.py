"""Column helpers on hand-written edge cases (NULL, blank, padding, zero ids)."""
import datetime as dt
import decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetyard.functions import (blank_to_null, branch_of, is_code_in, norm_id, not_blank,
                                 render_decimal_ts, reservation_key, sap_date, strip_zeros)
from fleetyard.functions import labels as L
from fleetyard.functions.dates import day_slice_id, days_back, slice_bounds, slice_count, window_bounds


def _cuts(ini, fim, size):
    return [slice_bounds(i, ini, fim, size) for i in range(slice_count(ini, fim, size))]


def one(spark, rows, schema, *cols):
    df = spark.createDataFrame(rows, schema)
    return [tuple(r) for r in df.select(*cols).collect()]


def test_id_normalisation(spark):
    rows = [(" 000123 ",), ("000",), ("   ",), (None,), ("0A0",)]
    got = one(spark, rows, "x string", strip_zeros("x"), blank_to_null("x"), norm_id("x"),
              not_blank("x"))
    assert got == [("123", "000123", "123", True), ("", "000", None, True),
                   ("", None, None, False), (None, None, None, False), ("A0", "0A0", "A0", True)]


def test_branch_and_codes(spark):
    rows = [("BHZ|MANU", " a"), ("|MANU", None), ("POA", "V")]
    got = one(spark, rows, "c string, t string", branch_of("c"), is_code_in("t", ["A", ""]))
    assert got == [("BHZ", True), ("|MANU", True), ("POA", False)]


def test_reservation_key_pads_and_truncates(spark):
    got = one(spark, [(" 123", "7"), ("12345678901", "12345")], "a string, b string",
              reservation_key("a", "b"))
    assert got == [("00000001230007",), ("12345678901234",)]


def test_dates(spark):
    rows = [("2025-03-04", decimal.Decimal("20250304101500.0000000")),
            ("0000-00-00", decimal.Decimal("0")), ("", None)]
    got = one(spark, rows, "d string, t decimal(21,7)", sap_date("d"), render_decimal_ts("t"))
    assert got == [(dt.datetime(2025, 3, 4), "04-03-2025"), (None, ""), (None, None)]
    assert days_back("2030-01-01", 1) == "2029-12-31"
    assert window_bounds("2030-01-10", 9, 0) == ("2030-01-01", "2030-01-10")


def test_label_waterfalls(spark):
    rows = [("PRP", None), ("X01", "Serviço de OFICINA"), ("X02", "Preparo"), ("INS", None)]
    got = one(spark, rows, "c string, t string", L.maintenance_type("c", "t"),
              L.maintenance_type_by_code("c", other=None))
    assert got == [("Preparação", "Preparação"), ("Oficina", None), ("Preparação", None),
                   ("Outro", None)]
    rows = [(None,), ("",), (" K ",), ("A",), ("Z",)]
    got = one(spark, rows, "k string", L.destination("k"), L.consumption_type("k"))
    assert got == [("estoque", "Estoque"), ("estoque", "Estoque"), ("centro_custo", "Centro de Custo"),
                   ("consumo", "Ativo Fixo (Imobilizado)"), ("consumo", "Outro")]


def test_purchase_status_waterfall(spark):
    schema = ("rec decimal(18,3), q decimal(18,3), fr string, po string, pl string, rl string, "
              "rc string")
    D = decimal.Decimal
    rows = [(D(5), D(5), "X", "1", "", None, "9"),      # received wins over everything
            (D(2), D(5), None, "1", "", None, "9"),     # partial
            (None, D(5), "X", "1", "", None, "9"),      # awaiting approval
            (None, D(5), "", "1", " ", None, "9"),      # order issued
            (None, D(5), "", "1", "L", None, "9"),      # order cancelled
            (None, None, None, None, None, "X", "9"),   # requisition deleted
            (None, None, None, None, None, None, "9"),  # awaiting order
            (None, None, None, None, None, None, None)]
    got = [r[0] for r in one(spark, rows, schema, L.purchase_status("rec", "q", "fr", "po", "pl",
                                                                     "rl", "rc"))]
    assert got == list(L.PURCHASE_STATUS)


def _runner_cuts(ini, fim, size):
    """The source runner's slicing, restated: cuts from ini down to fim."""
    if ini - fim <= size:
        return [(ini, fim)]
    cuts = list(range(ini, fim, -size)) + [fim]
    return [(cuts[i], cuts[i + 1] + (1 if cuts[i + 1] != fim else 0)) for i in range(len(cuts) - 1)]


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 400), st.integers(0, 400), st.sampled_from([1, 7, 45]))
def test_slices_cover_window_once(a, b, size):
    ini, fim = max(a, b), min(a, b)
    cuts = _cuts(ini, fim, size)
    assert cuts == _runner_cuts(ini, fim, size)
    days = [d for hi, lo in cuts for d in range(lo, hi + 1)]
    assert sorted(days) == list(range(fim, ini + 1))   # no gap, no overlap


@pytest.mark.parametrize("ini,fim,size", [(365, 0, 45), (90, 0, 45), (100, 10, 7), (30, 0, 45)])
def test_day_slice_id_matches_cuts(spark, ini, fim, size):
    as_of = "2030-01-01"
    rows = [(days_back(as_of, d),) for d in range(fim, ini + 1)]
    got = one(spark, rows, "d string", "d", day_slice_id("d", as_of, ini, fim, size))
    want = {}
    for i, (hi, lo) in enumerate(_cuts(ini, fim, size)):
        for d in range(lo, hi + 1):
            want[days_back(as_of, d)] = i
    assert {d: s for d, s in got} == want


def test_ltrim_column_first(spark):
    # Column-first 2-arg ltrim strips the characters from the value (the SQL
    # form takes its arguments the other way round).
    assert one(spark, [("00012",)], "x string", F.ltrim("x", F.lit("0"))) == [("12",)]
