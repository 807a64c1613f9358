"""Every registered query against its SQL on the same files: names, row count, values."""

import decimal
import glob
import os

import duckdb
import pytest

from lakevault.plans.catalogue import CHECKS, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return repr(0.0 if value == 0 else float(f"{value:.12g}"))
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    return repr(value)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


@pytest.mark.parametrize("name", QUERIES)
def test_query(name, spark, sf_dir, con):
    df = QUERIES[name](spark, sf_dir)
    found = con.execute(CHECKS[name])
    names = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    ours = sorted(tuple(_plain(row[c]) for c in order) for row in df.collect())
    theirs = sorted(tuple(_plain(row[names.index(c)]) for c in order) for row in found.fetchall())
    assert len(ours) == len(theirs)
    assert ours == theirs
