import pytest
from oracle import assert_same
from textloom import catalog

ORACLES = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert_same(spark, sf_dir, catalog.queries()[name], ORACLES[name])


def test_entry_points():
    import __spark_entry__ as entry

    queries = entry.queries()
    assert set(entry.oracle_sql()) <= set(queries)
    assert catalog.FLAGSHIP in queries
