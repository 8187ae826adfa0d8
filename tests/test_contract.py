import duckdb
import pytest

import __spark_entry__ as contract
from tools.compare import TABLES, frames_differ

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.fixture(scope="module", autouse=True)
def compiled(spark):
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


def test_names_match():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", [n for n in contract.queries() if n in contract.oracle_sql()])
def test_query_equals_sql(spark, db, name):
    got = contract.queries()[name](spark, SF).toPandas()
    assert frames_differ(got, db.execute(contract.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0
