"""Adapter tables are identical whether derived by Spark or by the DuckDB oracle."""
import pytest

from duck_oracle import adapters
from duck_oracle.compare import compare

ADAPTERS = [n for n in adapters.TABLES if n not in ("o", "li", "po_li")]


@pytest.mark.parametrize("name", ADAPTERS)
def test_adapter_parity(spark, small_src, duck_small, name):
    df = small_src.table(name)
    res = compare(df, duck_small, adapters.with_tables([name], f"SELECT * FROM {name}"))
    assert res["ok"], res
