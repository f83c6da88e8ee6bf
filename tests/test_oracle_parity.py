"""Every registered query equals its SQL oracle (DuckDB) on the smallest tables."""

import pytest

import __spark_entry__ as E
from small_tables import SF_SMALL
from tools.check_oracle import digest

QUERIES = E.queries()
SQL = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(SQL[name])
    drows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(rel.columns, drows)[0]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "fraud_rate_pct" in df.columns


def _spark_class(t):
    s = t.simpleString()
    if s in ("bigint", "int", "smallint", "tinyint"):
        return "int:" + s
    return "float" if s in ("double", "float") else s


def _duck_class(t):
    t = str(t)
    if t.startswith("DECIMAL"):
        return "decimal" + t[7:].replace(" ", "")
    return {"BIGINT": "int:bigint", "INTEGER": "int:int", "DOUBLE": "float", "FLOAT": "float",
            "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
            "VARCHAR[]": "array<string>"}.get(t, t)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_column_types_match_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(SQL[name])
    ours = {f.name: _spark_class(f.dataType) for f in df.schema.fields}
    theirs = {c: _duck_class(t) for c, t in zip(rel.columns, rel.types)}
    assert ours == theirs
