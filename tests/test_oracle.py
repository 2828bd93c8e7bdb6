"""Every registered query against its SQL twin (DuckDB) on the smallest tables."""

import math

import duckdb
import pytest

from paths import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)
    return v


def _rows(records, cols=None):
    return sorted((tuple(_norm(x) for x in r) for r in records), key=repr)


@pytest.fixture(scope="module")
def con():
    import os
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


#: Results of millions of rows: compared inside the SQL engine.
LARGE = ("dense_axis_1s",)


def _same_rows(df, con, sql, path):
    df.write.parquet(path)
    cols = ", ".join('"' + c + '"' for c in df.columns)
    con.sql(f"CREATE OR REPLACE TEMP TABLE want AS SELECT {cols} FROM ({sql})")
    con.sql(f"CREATE OR REPLACE TEMP TABLE got AS SELECT {cols} FROM '{path}/*.parquet'")
    assert con.sql("SELECT COUNT(*) FROM want").fetchall()[0][0] > 0
    for a, b in (("want", "got"), ("got", "want")):
        assert con.sql(f"SELECT COUNT(*) FROM (FROM {a} EXCEPT ALL FROM {b})").fetchall()[0][0] == 0


def _cases():
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    return [(n, qs[n], sql.get(n)) for n in qs]


@pytest.mark.parametrize("name,fn,sql", _cases(), ids=[c[0] for c in _cases()])
def test_query_matches_oracle(spark, con, tmp_path, name, fn, sql):
    df = fn(spark, SF_SMALL)
    if name in LARGE:
        return _same_rows(df, con, sql, str(tmp_path / name))
    got = df.collect()
    if sql is None:
        return
    cols = df.columns
    quoted = ", ".join('"' + c + '"' for c in cols)
    res = con.sql(f"SELECT {quoted} FROM ({sql})")
    assert sorted(res.columns) == sorted(cols)
    duck_types = dict(zip(res.columns, [str(t) for t in res.types]))
    for f in df.schema.fields:
        assert SPARK_TO_DUCK[f.dataType.simpleString()] == duck_types[f.name], f.name
    assert _rows(got) == _rows(res.fetchall())


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["rank", "shop_id", "amt", "tier"]
    assert len(rows) == 5
