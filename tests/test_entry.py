import os
from decimal import Decimal

import pytest

import __spark_entry__
from docketry.plans import registry

SF = "/root/testdata/sf0.001"


def test_names_agree():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(SF):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF}/{file}'")
    got = registry.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(registry.ORACLE_SQL[name])
    assert columns == sorted(x[0] for x in want.description)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({registry.ORACLE_SQL[name]}) x").fetchall()
    assert shown(got.select(*columns).collect()) == shown(want)


def shown(rows):
    """Rows in an order of their own, numbers to 6 places."""
    value = lambda x: repr(round(float(x), 6)) if isinstance(x, (float, Decimal)) else str(list(map(value, x))) if isinstance(x, (list, tuple)) else str(x)
    return sorted(tuple(map(value, row)) for row in rows)
