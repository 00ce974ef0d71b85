"""Registered queries of the operators against their SQL twins; those without SQL have brute-force tests."""

import duckdb
import pytest

import __spark_entry__ as entry
from touchtrail.llm import queries

SF = "/root/testdata/sf0.001"


def plain(rows, columns):
    order = sorted(columns)
    return sorted(tuple(str(row[c]) for c in order) for row in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    found = queries.queries()[name](spark, SF)
    with duckdb.connect() as connection:
        for table in ("documents", "embeddings", "pages"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
        want = connection.execute(queries.oracle_sql()[name])
        columns = [c[0] for c in want.description]
        rows = [dict(zip(columns, r)) for r in want.fetchall()]
    assert sorted(found.columns) == sorted(columns)
    assert plain([r.asDict() for r in found.collect()], columns) == plain(rows, columns)


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
    assert set(queries.queries()) <= set(names)
