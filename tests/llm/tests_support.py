"""A query's rows against its SQL's."""

import glob
import math
import os

import duckdb


def _same(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_same(r[i]) for i in order) for r in found), key=repr)


def compare(spark, sf_dir, query, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = query(spark, sf_dir)
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, map(tuple, df.collect())) == _rows(columns, cursor.fetchall())
