import json
import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tractscope.catalog import DEFAULT_CATALOG, Catalog, Versions, default_catalog, dimension
from tractscope.operators.columns import map_columns
from tractscope.plans.incidents import with_day
from tractscope.plans.loans import LOAN_FACTS, city_loans


def test_listed_year_has_its_version_and_others_the_latest(spark):
    city = default_catalog().cities["SF"]
    found = {year: city.incident_version(year) for year in [2007, 2017, 2018, 2019, 2006, 2030]}
    assert found == {2007: "v1", 2017: "v1", 2018: "v2", 2019: "v2", 2006: "v2", 2030: "v2"}
    assert city.incident_version(None) == city.incident_version("") == "v2"
    frame = spark.createDataFrame([(year,) for year in [*found, None]], "y int")
    for version in ["v1", "v2"]:
        mine = city.incident_versions.is_source(version, F.col("y"))
        rows = {row.y: row.mine for row in frame.select("y", mine.alias("mine")).collect()}
        assert rows == {**{year: v == version for year, v in found.items()}, None: True}
    every = Versions({}, "v1").is_source("v1", F.col("y"))
    assert frame.where(every).count() == len(found) + 1
    assert Versions({}, "v1").of_year(2000) == "v1"


def test_a_year_has_one_version():
    with pytest.raises(ValueError, match="two file versions"):
        Versions({"v1": (2007, 2018), "v2": (2018, 2019)}, "v2")


def test_catalog_file(spark, tmp_path):
    path = tmp_path / "catalog.json"
    path.write_text(json.dumps(DEFAULT_CATALOG, indent=1))
    assert Catalog.load(spark, str(path)) == default_catalog()
    assert list(Catalog.load(spark, str(path)).only(["LA"]).cities) == ["LA"]


def test_city_dim(spark):
    rows = {tuple(row) for row in default_catalog().city_dim(spark).collect()}
    assert rows == {
        ("SF", "San Francisco", "CA", "San Francisco county", "06075"),
        ("LA", "Los Angeles", "CA", "Los Angeles county", "06037"),
    }


def test_county_keys_must_be_unique(spark):
    catalog = default_catalog()
    twin = replace(catalog.cities["SF"], key="SF2")
    with pytest.raises(ValueError, match="share"):
        replace(catalog, cities={**catalog.cities, "SF2": twin}).county_dim(spark)


def test_a_dimension_has_rows(spark):
    with pytest.raises(ValueError):
        dimension(spark, ["a"], [])


def test_thousands_of_cities_plan_in_seconds(spark):
    catalog = default_catalog()
    cities = {
        f"C{i}": replace(
            catalog.cities["SF"], key=f"C{i}", county_name=f"county {i}", county_code=f"{i:05d}"
        )
        for i in range(5000)
    }
    many = replace(catalog, cities=cities)
    raw = spark.createDataFrame(
        [("C7", "v2", "2018/3/4", "x", "1", "1"), ("C9", "v1", "3/4/2016", "x", "1", "1")],
        "city string, version string, date string, category string, longitude string, latitude string",
    )
    started = time.perf_counter()
    days = {r.city: str(r.day) for r in with_day(raw, many).select("city", "day").collect()}
    loans = spark.createDataFrame(
        [("v2", "00042", "2018", "1", "00042010100", "7", "1", "1", "1")],
        ["layout", "county_key", *LOAN_FACTS],
    )
    assert [r.city for r in city_loans(loans, many).collect()] == ["C42"]
    assert time.perf_counter() - started < 15
    assert days == {"C7": "2018-03-04", "C9": "2016-03-04"}


def test_map_columns(spark):
    frame = spark.createDataFrame([("d", "c", 1)], "`Incident Date` string, Category string, n int")
    mapped = map_columns(frame, {"date": "Incident Date", "category": "Category"}, keep=["n"])
    assert mapped.columns == ["date", "category", "n"]
    assert tuple(mapped.first()) == ("d", "c", 1)
    assert tuple(map_columns(frame, {"category": "CATEGORY"}).first()) == ("c",)
    with pytest.raises(ValueError, match="Descript"):
        map_columns(frame, {"category": "Descript"})


def test_target_name_may_exist_in_the_source(spark):
    frame = spark.createDataFrame([("old", "new")], "`date` string, `Date OCC` string")
    assert tuple(map_columns(frame, {"date": "Date OCC"}).first()) == ("new",)
