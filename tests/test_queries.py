"""Every registered query against its SQL, over the smallest test tables."""

import duckdb
import pytest

from catalog import QUERIES, SQL
from check import TABLES, rows_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def compare(spark, db, name):
    df = QUERIES[name](spark, SF)
    cur = db.execute(SQL[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cur.fetchall())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    compare(spark, db, name)


SPREAD = ["assign_invoice", "products_and_gifts", "credit_details", "concept_balances", "dup_flag",
          "null_key_join", "payments_received", "collections_bank", "flag_payments",
          "classify_advance", "flag_advances", "bureau_b", "person_table", "monthly_base"]


@pytest.mark.parametrize("name", SPREAD)
def test_query_with_hot_keys_spread(spark, db, spread, name):
    compare(spark, db, name)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
