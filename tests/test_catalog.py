"""Every registered query against its SQL in another engine, on the smallest data."""

import pytest

from wardlake.catalog import ORACLE, QUERIES
from wardlake.sources import testdata as T

DATA = "/root/testdata/sf0.001"
TABLES = ["customer", "orders", "embeddings", "pages", "events"]
DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cursor = duck.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in cursor.description}
    assert types == {c: DUCK_TYPES[t] for c, t in df.dtypes}
    columns = sorted(df.columns)
    order = [list(types).index(c) for c in columns]
    expected = sorted(repr(tuple(r[i] for i in order)) for r in cursor.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == expected
    assert expected


def test_skewed_input(spark, duck, tmp_path):
    """A third of all orders belongs to one customer, and as many rows are copies of one."""
    from pyspark.sql import functions as F

    for name in TABLES:
        T.table(spark, DATA, name).write.parquet(str(tmp_path / f"{name}.parquet"))
    orders = T.table(spark, DATA, "orders")
    n = orders.count()
    hot = orders.withColumn("o_custkey", F.lit(42).cast("long"))
    copies = orders.orderBy("o_orderkey").limit(1).withColumn("_", F.explode(F.array_repeat(F.lit(1), n))).drop("_")
    path = str(tmp_path / "skew.parquet")
    orders.unionByName(hot).unionByName(copies).write.parquet(path)
    import os

    os.rename(tmp_path / "orders.parquet", tmp_path / "orders-plain.parquet")
    os.rename(path, tmp_path / "orders.parquet")
    duck.execute(f"CREATE OR REPLACE VIEW orders AS SELECT * FROM '{tmp_path}/orders.parquet/*.parquet'")
    try:
        for name in ["patient_summary", "clean_admissions", "patient_document_parts", "admissions_flat", "admissions_deep_page", "etl_run"]:
            df = QUERIES[name](spark, str(tmp_path))
            cursor = duck.execute(ORACLE[name])
            found = [d[0] for d in cursor.description]
            columns = sorted(df.columns)
            expected = sorted(repr(tuple(r[found.index(c)] for c in columns)) for r in cursor.fetchall())
            assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == expected, name
    finally:
        duck.execute(f"CREATE OR REPLACE VIEW orders AS SELECT * FROM '{DATA}/orders.parquet'")
