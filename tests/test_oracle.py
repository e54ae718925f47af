"""Every registered query equals its independent DuckDB statement (sf0.001)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from adlens.plans.catalog import catalog
from tests.conftest import SF_SMALL
from tools.compare_oracle import TABLES, canon

SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog()) <= set(SQL) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cur = con.execute(SQL[name])
    s = canon(sdf.columns, sdf.collect())
    d = canon([x[0] for x in cur.description], cur.fetchall())
    assert s[0] == d[0]
    assert len(s[1]) == len(d[1])
    assert s[1] == d[1]


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 25 and df.columns[:3] == ["campaign_id", "campaign_name", "channel"]


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                 "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def test_column_types_match_the_oracle(spark, con):
    bad = []
    for name in SQL:
        fn = E.queries()[name]
        spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in fn(spark, SF_SMALL).schema.fields}
        rel = con.sql(SQL[name])
        duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
        bad += [(name, c, t, duck_types.get(c)) for c, t in spark_types.items() if duck_types.get(c) != t]
    assert bad == []
