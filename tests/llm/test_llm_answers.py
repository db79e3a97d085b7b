"""The text operators against SQL of another engine, on the same files."""

import duckdb
import pytest

import __spark_entry__ as project
from sarraf.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "conversations", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ANSWERS))
def test_answer(spark, duck, name):
    got = queries.QUERIES[name](spark, SF_DIR)
    expected = duck.execute(queries.ANSWERS[name])
    names = [d[0] for d in expected.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == sorted(expected.fetchall(), key=repr)


def test_ten_queries_and_the_pipeline_are_registered():
    names = project.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names
