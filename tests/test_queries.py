"""Every registered query that has an oracle agrees with it; the others give rows."""

import pytest
from conftest import SF, table_of

from gleanery.plans.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert table_of(df.columns, rows) == table_of(want.columns, want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
