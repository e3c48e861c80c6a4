"""Every query against its SQL in DuckDB."""

from pathlib import Path

import duckdb
import pytest

from tidefeed.plans import catalog

SF = "/root/testdata/sf0.001"
SQL = catalog.oracle_sql()


def canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted(columns), sorted(repr([plain(r[i]) for i in order]) for r in rows)


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    rows = got.collect()
    if name in SQL:
        found = duck.execute(SQL[name])
        assert canon(got.columns, rows) == canon([c[0] for c in found.description], found.fetchall())
