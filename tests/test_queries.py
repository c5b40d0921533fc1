"""Every query against its SQL in DuckDB, on whole tables; queries without SQL must run and keep their columns."""

import pytest

from specloom.plans import registry
from tests.compare import connection, rows_of_spark, rows_of_sql


@pytest.fixture(scope="module")
def con(sf_dir):
    return connection(sf_dir)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, sf_dir, con, name):
    names, rows = rows_of_spark(registry.QUERIES[name](spark, sf_dir))
    assert names
    if name in registry.ORACLE:
        sql_names, sql_rows = rows_of_sql(con, registry.ORACLE[name])
        assert names == sql_names
        assert rows == sql_rows


def test_no_sql_without_query():
    assert set(registry.ORACLE) <= set(registry.QUERIES)


def test_core_does_not_import_llm():
    import pathlib

    root = pathlib.Path(__file__).parent.parent / "specloom"
    for path in root.rglob("*.py"):
        if "llm" not in path.relative_to(root).parts:
            assert "specloom.llm" not in path.read_text(), path
