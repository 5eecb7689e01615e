import __spark_entry__ as entry


def test_contract_keys_consistent():
    queries, oracle = entry.queries(), entry.oracle_sql()
    assert set(oracle) <= set(queries)
    assert len(queries) >= 60


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "orderkey" in df.columns and "parse_errors" in df.columns
