import pathlib

import pytest

import __spark_entry__ as entry_point
from check_oracle import TABLES, rows_of
from hemicycle.plans import ORACLES

SMALL = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def alike(x: str, y: str) -> bool:
    """Equal, or numbers that a sum in another order rounds to the neighbouring sixth decimal."""
    if x == y:
        return True
    try:
        return abs(float(x) - float(y)) < 1.5e-6
    except ValueError:
        return False


@pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="tables not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    result = con.execute(entry_point.oracle_sql()[name])
    columns, rows = [c[0] for c in result.description], result.fetchall()
    df = entry_point.queries()[name](spark, SMALL)
    assert sorted(df.columns) == sorted(columns)
    found, wanted = rows_of(df.columns, [tuple(r) for r in df.collect()]), rows_of(columns, rows)
    assert len(found) == len(wanted)
    assert all(alike(x, y) for a, b in zip(found, wanted) for x, y in zip(a, b, strict=True))


@pytest.mark.skipif(not pathlib.Path(SMALL).exists(), reason="tables not present")
def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).columns == ["cluster", "word", "count", "rank"]
