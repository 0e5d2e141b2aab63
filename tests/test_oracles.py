"""Every registered query against its SQL twin on the small tables."""

import duckdb
import pandas as pd
import pytest

from gavelkit.plans.catalogue import all_oracles, all_queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SPARK_TO_SQL = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


def rows_of(df: pd.DataFrame):
    df = df[sorted(df.columns)]
    plain = lambda v: None if not isinstance(v, (list, str)) and pd.isna(v) else v
    num = lambda v: float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    rows = [tuple(num(plain(v)) for v in r) for r in df.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_oracle_has_a_query():
    assert all_oracles().keys() <= all_queries().keys()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(name, spark, sf_dir, con):
    out = all_queries()[name](spark, sf_dir)
    got = out.toPandas()
    sql = all_oracles().get(name)
    if sql is None:
        assert len(got) > 0
        return
    rel = con.sql(sql)
    types = dict(zip(rel.columns, map(str, rel.types)))
    assert {c: SPARK_TO_SQL[t] for c, t in out.dtypes} == types
    assert rows_of(got) == rows_of(rel.df())
