"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def results(spark, sf_small):
    return compare(spark, sf_small, verbose=False)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(results, name):
    r = results[name]
    assert "error" not in r, r
    if name in SQL:
        assert r["ok"], r


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "adverse_media_news" in df.columns


SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "array<double>": "DOUBLE[]",
}


def test_column_types_match_oracle(spark, sf_small):
    from tools.oracle_check import duck

    con = duck(sf_small)
    queries = entry.queries()
    mismatches = {}
    for name, sql in SQL.items():
        duck_types = {c[0]: str(c[1]) for c in con.execute(sql).description}
        schema = queries[name](spark, sf_small).schema
        for f in schema.fields:
            t = f.dataType.simpleString()
            if SPARK_TO_DUCK.get(t, t) != duck_types.get(f.name):
                mismatches.setdefault(name, []).append((f.name, t, duck_types.get(f.name)))
    assert not mismatches, mismatches
