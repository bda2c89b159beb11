"""Every query of the catalogue equals its SQL in DuckDB on the smallest data folder."""

import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from returns_analytics.parity.queries import CATALOG

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))
from check import rows  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(CATALOG))
def test_query(spark, database, name):
    frame = entry.queries()[name](spark, FOLDER)
    names = sorted(frame.columns)
    got = rows(frame.collect(), frame.columns, names)
    result = database.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == names
    assert got == rows(result.fetchall(), columns, names)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
