"""Every query against the same question asked in SQL of another engine, on the same files."""

import math

import duckdb
import pytest

import __spark_entry__ as project
from oracle import ANSWERS
from sarraf import registry

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return con


def comparable(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return None if math.isnan(value) else float(value)
    return value


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(comparable(r[i]) for i in order) for r in records), key=repr)


def test_every_query_has_an_answer():
    assert set(registry.queries()) == set(ANSWERS)
    assert set(registry.queries()) <= set(project.queries()) and set(ANSWERS) <= set(project.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_answer(spark, duck, name):
    got = project.queries()[name](spark, SF_DIR)
    expected = duck.execute(project.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(names)
    assert table(got.columns, got.collect()) == table(names, expected.fetchall())


def test_entry(spark, duck):
    got = project.entry(spark)
    expected = duck.execute(project.oracle_sql()["serve_atm_by_region"])
    names = [d[0] for d in expected.description]
    assert table(got.columns, got.collect()) == table(names, expected.fetchall())
