"""The queries of the text problems that have SQL, against it, on whole tables."""

import pytest

from specloom.llm import queries
from tests.compare import connection, rows_of_spark, rows_of_sql


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, sf_dir, name):
    names, rows = rows_of_spark(queries.QUERIES[name](spark, sf_dir))
    assert (names, rows) == rows_of_sql(connection(sf_dir), queries.ORACLE[name])
