"""Tables in which one key holds a third of the rows: the same results as SQL.

Broadcast by size is off and the skew limits are tiny, so that joins are shuffled and
adaptive execution splits the hot partitions even of these small tables.
"""

import pytest

import __spark_entry__ as entry_module
from compare import TABLES, compare, connect

SOURCE = "/root/testdata/sf0.01"
HOT = {
    "orders": "if(o_orderkey % 3 = 0, 100, o_custkey) AS o_custkey",
    "lineitem": "if(l_orderkey % 3 = 0, 777, l_partkey) AS l_partkey",
    "customer": "if(c_custkey % 3 = 0, 1, c_nationkey) AS c_nationkey",
}
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "4KB",
    "spark.sql.files.openCostInBytes": "0",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
}
NAMES = [
    "loan_tract_rank", "loan_detail", "tract_info", "incident_tract_join", "incident_tract_month",
    "incident_trend", "incident_rate", "incident_sorted", "period_exists_semi",
    "distinct_coordinates", "city_county_lookup", "area_profile", "sink_incident_partitions",
    "coordinate_tract_shuffled", "incident_tract_join_shuffled",
]


@pytest.fixture(scope="module")
def hot_dir(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    plain = connect(SOURCE)
    for name in TABLES:
        change = f"REPLACE ({HOT[name]})" if name in HOT else ""
        target = f"'{folder}/{name}.parquet' (FORMAT parquet, ROW_GROUP_SIZE 2048)"
        plain.execute(f"COPY (SELECT * {change} FROM {name}) TO {target}")
    return folder


@pytest.fixture(scope="module")
def hot_tables(hot_dir):
    return connect(hot_dir)


@pytest.fixture
def small_limits(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", NAMES)
def test_hot_keys(spark, hot_dir, hot_tables, small_limits, name):
    result = entry_module.queries()[name](spark, hot_dir)
    assert compare(result, hot_tables, entry_module.oracle_sql()[name]) is None


def test_the_loan_join_is_split(spark, hot_dir, small_limits):
    result = entry_module.queries()["loan_level_tract_count"](spark, hot_dir)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan
