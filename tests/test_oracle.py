"""Every query with SQL gives DuckDB's rows; every query without runs and keeps its schema."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    ours = sorted((tuple(row[c] for c in columns) for row in df.collect()), key=repr)
    result = duck.execute(ORACLES[name])
    order = [c[0] for c in result.description]
    assert sorted(order) == columns
    theirs = sorted((tuple(row[order.index(c)] for c in columns) for row in result.fetchall()), key=repr)
    assert ours == theirs


# test_learners.py trains the same learners on less data
LEARNERS = {"gbt_matched", "rf_matched", "mlp_matched", "lr_cv", "gbt_cv", "lr_bagged", "gbt_bagged"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - LEARNERS))
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["subject_id", "hadm_id", "readmit_day", "readmit_type", "readmit_days", "label"]
