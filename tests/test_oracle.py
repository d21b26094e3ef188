"""Every registered query against its DuckDB oracle, over whole tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from checks.registry import all_checks

TABLES = "region nation customer supplier part orders lineitem events".split()
CHECKS = all_checks()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(row):
    return tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row)


def _sorted(rows):
    return sorted((_plain(r) for r in rows), key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", list(CHECKS))
def test_same_rows(name, spark, sf_dir, duck):
    df = contract.queries()[name](spark, sf_dir)
    cursor = duck.execute(contract.oracle_sql()[name])
    assert df.columns == [c[0] for c in cursor.description]
    ours, theirs = _sorted(df.collect()), _sorted(cursor.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_query_has_an_oracle():
    """The training-data part says in its own tests which of its queries have SQL."""
    assert {n for n, c in CHECKS.items() if c.oracle is None} == set()
    assert set(CHECKS) <= set(contract.queries()) and set(CHECKS) <= set(contract.oracle_sql())


def test_bench_and_entry_exist():
    root = os.path.dirname(os.path.abspath(contract.__file__))
    assert os.path.exists(f"{root}/bench.py")
