"""Files are written to a fresh folder and read back."""

from dataclasses import replace

import pytest

from tractscope import fixtures as fx
from tractscope.catalog import Versions, default_catalog
from tractscope.sinks.jdbc import jdbc_writer
from tractscope.sinks.tables import read_partitions, replace_partitions, write_incidents
from tractscope.sources.files import (
    read_csv_header,
    read_csv_schema,
    read_delimited,
    read_xml_rows,
    year_paths,
)
from tractscope.sources.incidents import read_incidents
from tractscope.sources.jdbc import jdbc_options
from tractscope.sources.loans import read_loans
from tractscope.sources.schools import SCHOOL_SCHEMA, read_schools


def put(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_csv_header_is_text_and_blank_is_null(spark, tmp_path):
    path = put(tmp_path, "a.csv", 'X,Incident Date,n\n1.50,"a, b",007\n,x,\n')
    frame = read_csv_header(spark, path)
    assert dict(frame.dtypes) == {"X": "string", "Incident Date": "string", "n": "string"}
    assert [tuple(row) for row in frame.collect()] == [("1.50", "a, b", "007"), (None, "x", None)]
    assert read_csv_header(spark, path, ["X", "Incident Date", "n"]).collect() == frame.collect()


def test_declared_columns_must_match_the_header(spark, tmp_path):
    path = put(tmp_path, "a.csv", "b,a\n1,2\n")
    with pytest.raises(Exception):
        read_csv_header(spark, path, ["a", "b"]).collect()


def test_csv_schema_pads_short_rows(spark, tmp_path):
    path = put(tmp_path, "a.csv", "1,x,2.5\n2,y\n3\n")
    rows = read_csv_schema(spark, path, "a int, b string, c double").collect()
    assert [tuple(row) for row in rows] == [(1, "x", 2.5), (2, "y", None), (3, None, None)]


def test_delimited_keeps_leading_zeros(spark, tmp_path):
    path = put(tmp_path, "a.txt", "county_code|income\n06075|12\n06037|NA\n")
    rows = read_delimited(spark, path).collect()
    assert [tuple(row) for row in rows] == [("06075", "12"), ("06037", "NA")]
    other = put(tmp_path, "b.txt", "a;b\n1;2\n")
    assert tuple(read_delimited(spark, other, ";").first()) == ("1", "2")


SCHOOL = """<schools>
 <school><name>A &amp; B</name><enrollment>10</enrollment><gradeRange>K-5</gradeRange>
  <gsRating>7</gsRating><lat>37.71</lat><lon>-122.45</lon><phone>1</phone></school>
 <school><name>C</name><lat>37.72</lat><lon>-122.35</lon></school>
</schools>"""


def test_xml_rows(spark, tmp_path):
    path = put(tmp_path, "s.xml", SCHOOL)
    rows = read_xml_rows(spark, path, "school", SCHOOL_SCHEMA, "schools").collect()
    assert [tuple(row) for row in rows] == [
        ("A & B", 10, "K-5", 7, 37.71, -122.45),
        ("C", None, None, None, 37.72, -122.35),
    ]


def test_schools_of_all_cities(spark, tmp_path):
    put(tmp_path, "schools/SF.xml", SCHOOL)
    put(tmp_path, "schools/LA.xml", SCHOOL)
    rows = read_schools(spark, default_catalog(), f"{tmp_path}/").collect()
    assert sorted((row.city, row.name) for row in rows) == [
        ("LA", "A & B"), ("LA", "C"), ("SF", "A & B"), ("SF", "C"),
    ]


V1 = (
    "as_of_year,loan_amount_000s,census_tract_number,applicant_income_000s,population,"
    "number_of_owner_occupied_units,number_of_1_to_4_family_units,action_taken,loan_purpose,"
    "property_type,county_name\n"
)
V2 = (
    "activity_year|loan_amount|census_tract|income|tract_population|tract_owner_occupied_units|"
    "tract_one_to_four_family_homes|action_taken|loan_purpose|derived_dwelling_category|"
    "county_code\n"
)


def test_loans_of_both_layouts(spark, tmp_path):
    put(tmp_path, "2016/a.csv", V1 + "2016,100,0101.00,50,10,5,6,1,1,1,San Francisco county\n")
    put(tmp_path, "2017/a.csv", V1 + "2017,110,0102.00,60,10,5,6,1,1,2,San Francisco county\n")
    put(tmp_path, "2017/b.csv", V1 + "2017,120,0103.00,NA,10,5,6,1.0,1,1,Los Angeles county\n")
    single = "Single Family (1-4 Units):Site-Built"
    put(tmp_path, "2018/a.txt", V2 + f"2018|130|06075010100|70|10|5|6|1|1|{single}|06075\n")
    put(tmp_path, "2019/a.txt", V2 + f"2019|140|06075010100|70|10|5|6|2|1|{single}|06075\n")
    catalog = default_catalog()
    rows = read_loans(spark, catalog, f"{tmp_path}/", [2016, 2017, 2018, 2019]).collect()
    assert sorted((r.layout, r.county_key, r.census_tract) for r in rows) == [
        ("v1", "Los Angeles county", "0103.00"),
        ("v1", "San Francisco county", "0101.00"),
        ("v2", "06075", "06075010100"),
    ]
    assert read_loans(spark, catalog, f"{tmp_path}/", [2016]).count() == 1
    assert year_paths("x/", [1, 2]) == ["x/1/*", "x/2/*"]


def write_reports(folder):
    """SF versions overlap in 2017 and 2018; LA has one version."""
    head = "Date,Y,X,Category\n"
    put(folder, "incidents/SF_v1.csv", head + "\n".join([
        "12/31/2017 23:00,37.71,-122.45,OLD", "01/01/2018,37.71,-122.45,OLD TWICE",
        "1/5/2016,37.72,,NOWHERE", "garbled,37.73,-122.45,UNDATED",
    ]) + "\n")
    put(folder, "incidents/SF_v2.csv", (
        "Incident Date,Latitude,Longitude,Incident Category,Extra\n"
        "2018/01/01,37.71,-122.45,NEW,x\n2017/12/31,37.71,-122.45,NEW TWICE,x\n"
        "2021/02/03,37.71,-122.45,LATEST,x\n"
    ))
    put(folder, "incidents/LA_v1.csv", (
        "DATE OCC,LAT,LON,Crm Cd Desc\n01/15/2018 12:00:00 AM,37.75,-122.35,LA\n"
    ))


def test_each_year_comes_from_its_version_once(spark, tmp_path):
    write_reports(tmp_path)
    catalog, root = default_catalog(), f"{tmp_path}/"
    found = {(r.city, r.category, r.year) for r in read_incidents(spark, catalog, root).collect()}
    assert found == {
        ("SF", "OLD", 2017), ("SF", "UNDATED", None), ("SF", "NEW", 2018),
        ("SF", "LATEST", 2021), ("LA", "LA", 2018),
    }
    of_2021 = read_incidents(spark, catalog.only(["SF"]), root, 2021).collect()
    assert {(r.category, r.year) for r in of_2021} == {("LATEST", 2021)}
    assert read_incidents(spark, catalog, root, 2017, 12).first().category == "OLD"
    assert read_incidents(spark, catalog.only(["SF"]), root, 2017, 11).count() == 0


def test_versions_without_list(spark, tmp_path):
    write_reports(tmp_path)
    catalog = default_catalog().only(["LA"])
    la = replace(catalog.cities["LA"], incident_versions=Versions({}, "v1"))
    catalog = replace(catalog, cities={"LA": la})
    assert read_incidents(spark, catalog, f"{tmp_path}/").count() == 1


def test_rerun_of_a_period_replaces_it(spark, tmp_path):
    path = str(tmp_path / "table")
    kind = "city string, year int, month int, n int, longitude string, latitude string"
    periods = [("SF", 2018, 1), ("SF", 2018, 2), ("LA", 2018, 1), ("LA", None, None)]
    first = [(*period, n, "a", "b") for n, period in enumerate(periods, start=1)]
    write_incidents(spark.createDataFrame(first, kind), path)
    again = [("SF", 2018, 2, 20, "a", "b"), ("SF", 2018, 2, 21, "a", "b")]
    for _ in range(2):
        write_incidents(spark.createDataFrame(again, kind), path)
    rows = read_partitions(spark, path, kind).collect()
    assert sorted(row.n for row in rows) == [1, 3, 4, 20, 21]
    january = read_partitions(spark, path, kind, year=2018, month=1)
    assert sorted(row.n for row in january.collect()) == [1, 3]
    assert "PartitionFilters: [isnotnull(year" in plan_of(january)


def test_a_large_period_is_written_by_several_tasks(spark, tmp_path):
    path, option = str(tmp_path / "hot"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    hot = spark.range(200_000).selectExpr(
        "'SF' as city", "2018 as year", "if(id % 100 = 0, 2, 1) as month",
        "cast(rand(1) as string) as longitude", "cast(rand(2) as string) as latitude",
    )
    spark.conf.set(option, "256KB")
    try:
        write_incidents(hot, path)
    finally:
        spark.conf.unset(option)
    files = list((tmp_path / "hot" / "city=SF" / "year=2018" / "month=1").glob("*.parquet"))
    assert len(files) > 4
    assert spark.read.parquet(path).count() == 200_000


def test_partition_values_keep_their_type(spark, tmp_path):
    path = str(tmp_path / "codes")
    frame = spark.createDataFrame([("06075", 1)], "code string, n int")
    replace_partitions(frame, path, ["code"])
    assert read_partitions(spark, path, "code string, n int").first().code == "06075"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_jdbc_options():
    """No database is started here: only what is handed to Spark's source is checked."""
    assert jdbc_options("jdbc:x", {"user": "u"}) == {"url": "jdbc:x", "user": "u"}
    split = jdbc_options("jdbc:x", split=("id", 0, 1000, 20))
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "20"
    assert split["lowerBound"] == "0" and split["upperBound"] == "1000"


def test_jdbc_writer_is_lazy(spark):
    assert jdbc_writer(spark.range(1), "jdbc:x", "t", {"user": "u"}) is not None


def test_fixture_layouts(spark):
    for version, layout in fx.fixture_catalog().loan_layouts.items():
        frame = fx.loans_in_layout(spark, "/root/testdata/sf0.001", version)
        assert set(layout.columns.values()) <= set(frame.columns)


def test_files_with_columns_in_another_order(spark, tmp_path):
    put(tmp_path, "y/2017/a.csv", "a,b,c\n1,2,3\n")
    put(tmp_path, "y/2017/b x.csv", "c,a,b\n30,10,20\n")
    put(tmp_path, "y/2018/empty.csv", "")
    put(tmp_path, "y/2018/c.csv", "a,b,c\n100,200,300\n")
    frame = read_csv_header(spark, year_paths(f"{tmp_path}/y/", [2017, 2018]))
    rows = sorted((int(r.a), int(r.b), int(r.c)) for r in frame.collect())
    assert rows == [(1, 2, 3), (10, 20, 30), (100, 200, 300)]
    put(tmp_path, "y/2018/d.csv", "a,b,other\n1,2,3\n")
    with pytest.raises(ValueError, match="d.csv has other columns"):
        read_csv_header(spark, year_paths(f"{tmp_path}/y/", [2018]))


def test_blank_year_is_no_year(spark, tmp_path):
    write_reports(tmp_path)
    every = read_incidents(spark, default_catalog(), f"{tmp_path}/")
    blank = read_incidents(spark, default_catalog(), f"{tmp_path}/", "", "")
    assert sorted(map(tuple, blank.collect()), key=str) == sorted(map(tuple, every.collect()), key=str)
