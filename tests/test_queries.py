"""Every registered query against its SQL."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from compare import compare, connect
from tractscope import registry
from tractscope.oracle import ORACLE
from tractscope.registry import QUERIES

SF_DIR = f"/root/testdata/sf{os.environ.get('TEST_SF', '0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    assert compare(result, con, ORACLE[name]) is None


def test_entry(spark):
    result = entry_module.entry(spark)
    assert result.columns == ["city", "activity_year", "level", "census_tract", "count", "rank"]
    assert result.count() == 35


def test_loan_files_of_every_year(spark, con):
    found = QUERIES["loan_files_every_year"](spark, SF_DIR).select("activity_year").distinct()
    wanted = con.execute("SELECT DISTINCT year(o_orderdate) FROM orders").fetchall()
    assert len(wanted) > 3 and {r.activity_year for r in found.collect()} == {y for (y,) in wanted}


@pytest.mark.parametrize("name", ["loan_files", "loan_files_every_year", "src_year_glob"])
def test_year_folders_derive_their_rows_once(spark, monkeypatch, name):
    """One join for each layout, whatever the number of years, and no customers in the driver."""
    real = registry.fx.loans_in_layout

    def noted(*given):
        rows = real(*given)
        counted = F.udf(lambda x: joined_rows.add(1) or x, "string")
        return rows.withColumn("action_taken", counted("action_taken"))

    joined_rows = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(registry.fx, "loans_in_layout", noted)
    QUERIES[name](spark, SF_DIR)
    years = "year(o_orderdate) <= 1997" if name == "src_year_glob" else "true"
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").where(years).count()
    assert joined_rows.value == orders


def test_raw_files_derive_their_loans_once(spark, monkeypatch):
    """As above, for the raw files that ``refresh_tables`` and ``profile_by_changes`` start from."""
    real, derived = registry.fx.loans_in_layout, spark.sparkContext.accumulator(0)

    def noted(*given):
        counted = F.udf(lambda x: derived.add(1) or x, "string")
        return real(*given).withColumn("action_taken", counted("action_taken"))

    monkeypatch.setattr(registry.fx, "loans_in_layout", noted)
    registry._write_raw(spark, SF_DIR)
    assert derived.value == spark.read.parquet(f"{SF_DIR}/orders.parquet").count()


def test_customers_are_not_broadcast(spark):
    for version in ("v1", "v2"):
        rows = registry.fx.loans_in_layout(spark, SF_DIR, version)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
