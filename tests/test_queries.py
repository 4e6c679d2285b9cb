"""Every registered query outside the text operators against its SQL on the smallest tables."""

import pytest

from shelfmark.plans import analytics, loading
from tests.conftest import SF
from tests.oracle import oracle, rows_of

QUERIES = {**loading.QUERIES, **analytics.QUERIES}
SQL = {**loading.SQL, **analytics.SQL}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    cols, rows = rows_of(QUERIES[name](spark, SF))
    if name in SQL:
        assert (cols, rows) == oracle(SQL[name], SF)
    else:
        assert rows


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 2
    assert set(e.oracle_sql()) <= set(e.queries())
