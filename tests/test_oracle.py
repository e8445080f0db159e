"""Every registered query against its SQL on the smallest driver tables."""
import duckdb
import pytest

import __spark_entry__ as contract
from scorelake.demo.binding import TABLES
from scorelake.demo.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows_of(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names])))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF).toArrow()
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert got.num_rows > 0
        return
    want = duck.execute(sql).to_arrow_table()
    assert rows_of(got) == rows_of(want)
    kinds = {c: (str(got.schema.field(c).type), str(want.schema.field(c).type)) for c in got.column_names}
    assert {c: k for c, k in kinds.items() if k[0] != k[1]} == {}


def test_entry(spark):
    assert contract.entry(spark).count() == 240


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
