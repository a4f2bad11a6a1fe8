"""Compares a query's rows with its SQL in DuckDB, whatever their order."""

import numbers

import duckdb
import numpy as np
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _cell(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
        return None
    if isinstance(v, numbers.Number) and not isinstance(v, (bool, np.bool_)):
        return round(float(v), 6)
    return str(v)


def _rows(df):
    names = sorted(df.columns)
    return names, sorted(str([_cell(v) for v in row]) for row in df[names].itertuples(index=False, name=None))


def assert_same(spark, sf_dir, query, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    names, rows = _rows(query(spark, sf_dir).toPandas())
    wanted_names, wanted = _rows(con.execute(sql).df())
    assert names == wanted_names
    assert len(rows) == len(wanted)
    assert rows == wanted
