"""Every registered query of the library against DuckDB, over whole tables."""

import pytest
from conftest import SF, rows_of

from tallyweir import plans


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_same_as_sql(spark, duck, name):
    ours = plans.QUERIES[name](spark, SF).toPandas()
    theirs = duck.execute(plans.ORACLE_SQL[name]).df()
    assert rows_of(ours) == rows_of(theirs)


def test_entry_registers_all():
    import __spark_entry__ as entry

    assert set(plans.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
