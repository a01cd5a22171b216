"""Every registered query equals its independent DuckDB statement (sf0.001 here;
the driver runs the same comparison at sf0.01)."""
import pytest

import __spark_entry__ as entry
from duck_oracle.compare import compare
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
SQL = entry.oracle_sql()


def test_contract_keys():
    assert set(SQL) <= set(QUERIES)
    # JSON text rendering: rows-only checks
    rest = {q for q in set(QUERIES) - set(SQL) if q != "pipeline" and not q.startswith("op")}
    assert rest == {"json_encoding", "yard_payload"}


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "ativo" in df.columns and "status_usuario" in df.columns


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck_small, name):
    res = compare(QUERIES[name](spark, SF_SMALL), duck_small, SQL[name])
    assert res["ok"], res
