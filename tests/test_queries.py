"""Every query against its SQL over whole tables, as the driver compares them."""

import glob
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from spindrift.plans import queries as plan


@pytest.fixture(scope="module")
def tables(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def same(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(same(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(plan.queries()))
def test_query(spark, sf_dir, tables, name):
    df = plan.queries()[name](spark, sf_dir)
    cursor = tables.execute(plan.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, map(tuple, df.collect())) == rows(columns, cursor.fetchall())


@pytest.mark.parametrize("name", ["plain_text_nested_templates", "plain_text_kept_elements", "template_t39_moments", "extract_contents_records", "article_pipeline"])
def test_rows_of_one_row_group_go_to_python_in_many_tasks(spark, sf_dir, name):
    df = plan.queries()[name](spark, sf_dir)
    per_task = df.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 4
    assert max(r["count"] for r in per_task) < 0.5 * df.count()


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns == ["src", "degree"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
