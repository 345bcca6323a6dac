"""The periodic job over raw files, twice."""

import pytest

from test_locate import boundaries
from test_sources import SCHOOL, V1, V2, put, write_reports
from tractscope.catalog import default_catalog
from tractscope.plans import refresh as job

TRACTS = {
    "06075010100": [[(-122.5, 37.7), (-122.4, 37.7), (-122.4, 37.74), (-122.5, 37.74)]],
    "06037010200": [[(-122.4, 37.74), (-122.3, 37.74), (-122.3, 37.78), (-122.4, 37.78)]],
}


@pytest.fixture
def raw(spark, tmp_path):
    write_reports(tmp_path)
    put(tmp_path, "schools/SF.xml", SCHOOL)
    put(tmp_path, "schools/LA.xml", SCHOOL)
    single = "Single Family (1-4 Units):Site-Built"
    row = "2017,9,0101.00,45,1000,5,6,1,1,1,San Francisco county\n"
    put(tmp_path, "loans/2017/a.csv", V1 + row)
    put(tmp_path, "loans/2018/a.txt", V2 + "\n".join(
        [f"2018|130|06075010100|70|1000|5|6|1|1|{single}|06075"] * 2
        + [f"2018|130|06075010200|70|2000|5|6|1|1|{single}|06075"]
        + [f"2018|130|06037010200|NA|3000|5|6|1|1|{single}|06037"]
    ) + "\n")
    boundaries(spark, TRACTS).write.parquet(f"{tmp_path}/tracts")
    return f"{tmp_path}/"


def tables(spark, out):
    names = ["loans", "tract_info", "loan_detail", "loan_ranks", "incidents", "incident_months"]
    names += ["incident_years", "schools"]
    return {n: sorted(map(str, spark.read.parquet(f"{out}/{n}").collect())) for n in names}


def test_refresh_twice_changes_nothing(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        job.refresh(spark, default_catalog(), raw, out, 2018, 1, with_loans=True)
        found = tables(spark, out)
    assert {name: len(rows) for name, rows in found.items()} == {
        "loans": 4, "tract_info": 3, "loan_detail": 3, "loan_ranks": 2, "incidents": 2,
        "incident_months": 2, "incident_years": 2, "schools": 4,
    }
    ranks = job.read_partitions(spark, f"{out}/loan_ranks", job.RANK_SCHEMA).collect()
    assert sorted((r.census_tract, r["count"], r["rank"], r.level) for r in ranks) == [
        ("06075010100", 2, 1, 4), ("06075010200", 1, 2, 4),
    ]
    years = job.read_partitions(spark, f"{out}/incident_years", job.YEAR_SCHEMA).collect()
    assert sorted((r.city, r.tract, r.year, r.total_count) for r in years) == [
        ("LA", "06037010200", 2018, 1), ("SF", "06075010100", 2018, 1),
    ]


def test_other_months_have_no_loans(spark, raw, tmp_path):
    out = tmp_path / "out"
    job.main(["--source", raw, "--target", str(out), "--year", "2021", "--month", "2"])
    assert not (out / "loans").exists()
    rows = spark.read.parquet(f"{out}/incidents").collect()
    assert [row.category for row in rows] == ["LATEST"]


def test_years_accumulate_and_profile_joins_them(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    job.refresh(spark, default_catalog(), raw, out, 2017, 12, with_loans=True)
    job.refresh(spark, default_catalog(), raw, out, 2018, 1, with_loans=True)
    job.refresh_profile(spark, out)
    rows = {(r.tract, r.year): r for r in spark.read.parquet(f"{out}/area_profile").collect()}
    assert set(rows) == {
        ("06075010100", 2017), ("06075010100", 2018), ("06075010200", 2018), ("06037010200", 2018),
    }
    area = rows["06075010100", 2018]
    assert (area.population, area.incident_count) == (1000, 1)
    assert (area.loan_count, area.best_rank) == (2, 1)
    assert area.crime_rate == 0.001 and area.school_count == 2
    assert rows["06075010200", 2018].incident_count is None


def test_published_tables_have_their_declared_columns(spark, raw, tmp_path, monkeypatch):
    """No database is started: the writer is replaced, and gets every changed table."""
    out, written = str(tmp_path / "out"), {}

    def keep(table, url, name, properties):
        written[name] = (url, table.schema.simpleString(), table.collect())

    monkeypatch.setattr(job, "replace_table", keep)
    job.main(["--source", raw, "--target", out, "--year", "2018", "--month", "1", "--profile",
              "--jdbc-url", "jdbc:x"])
    assert list(written) == job.published_tables(True, True)
    assert job.published_tables(False, False) == ["incident_years", "schools"]
    for name, (url, schema, rows) in written.items():
        stored = spark.read.parquet(f"{out}/{name}")
        assert url == "jdbc:x" and len(rows) == stored.count() > 0
        declared = set(schema[len("struct<") : -1].split(","))
        assert declared == {":".join(column) for column in stored.dtypes}


def test_a_run_for_one_city_keeps_the_others(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    job.refresh(spark, default_catalog(), raw, out, 2018, 1, with_loans=True)
    before = tables(spark, out)
    job.refresh(spark, default_catalog().only(["SF"]), raw, out, 2018, 1, with_loans=True)
    assert tables(spark, out) == before


def test_command_line(spark, raw, tmp_path):
    out = str(tmp_path / "cli")
    job.main(["--source", raw, "--target", out, "--year", "2018", "--month", "1",
              "--cities", "SF", "--profile"])
    assert {row.city for row in spark.read.parquet(f"{out}/incidents").collect()} == {"SF"}
    assert spark.read.parquet(f"{out}/area_profile").count() == 2


def _reports(spark, out, name="incident_years"):
    schema = {"incident_years": job.YEAR_SCHEMA, "incidents": job.INCIDENT_SCHEMA,
              "incident_months": job.MONTH_SCHEMA}[name]
    return job.read_partitions(spark, f"{out}/{name}", schema).collect()


def test_a_period_that_loses_its_rows_leaves_none(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    job.refresh(spark, default_catalog(), raw, out, 2018, None, with_loans=True)
    assert {r.city for r in _reports(spark, out)} == {"SF", "LA"}
    files = {path: path.read_text() for path in (tmp_path / "incidents").glob("*.csv")}
    for path, text in files.items():  # only header lines are left
        path.write_text(text.splitlines()[0] + "\n")
    put(tmp_path, "schools/SF.xml", "<schools></schools>")
    put(tmp_path, "loans/2018/a.txt", V2)
    job.refresh(spark, default_catalog().only(["SF"]), raw, out, 2018, None, with_loans=True)
    for name in ("incidents", "incident_months", "incident_years"):
        assert {r.city for r in _reports(spark, out, name)} == {"LA"}
    left = job.read_partitions(spark, f"{out}/schools", job.SCHOOL_TABLE_SCHEMA).collect()
    assert {r.city for r in left} == {"LA"}
    loans = job.read_partitions(spark, f"{out}/loans", job.LOAN_SCHEMA).collect()
    assert {r.city for r in loans} == {"LA"}
    job.refresh(spark, default_catalog(), raw, out, 2018, 1, with_loans=True)
    assert _reports(spark, out) == [] or {r.year for r in _reports(spark, out)} != {2018}


def test_raw_files_are_landed_once(spark, raw, tmp_path, monkeypatch):
    out, read = str(tmp_path / "out"), []
    real = job.land_incidents

    def landed(*given):
        read.extend(path.rpartition("/")[2] for path in real(*given))

    monkeypatch.setattr(job, "land_incidents", landed)
    job.refresh(spark, default_catalog(), raw, out, 2018, 1, with_loans=False)
    assert sorted(read) == ["LA_v1.csv", "SF_v1.csv", "SF_v2.csv"]
    job.refresh(spark, default_catalog(), raw, out, 2018, 2, with_loans=False)
    assert len(read) == 3
    path = next((tmp_path / "incidents").glob("LA*"))
    path.write_text(path.read_text() + "\n")
    job.refresh(spark, default_catalog(), raw, out, 2018, 1, with_loans=False)
    assert sorted(read) == ["LA_v1.csv", "LA_v1.csv", "SF_v1.csv", "SF_v2.csv"]


def test_profile_without_loans(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    job.main(["--source", raw, "--target", out, "--year", "2018", "--month", "2", "--profile"])
    assert spark.read.parquet(f"{out}/area_profile").where("loan_count is not null").count() == 0


def test_database_properties_come_from_a_file(spark, raw, tmp_path, monkeypatch):
    given = []
    monkeypatch.setattr(job, "replace_table", lambda *found: given.append(found[3]))
    put(tmp_path, "db.json", '{"user": "u", "password": "p"}')
    job.main(["--source", raw, "--target", str(tmp_path / "out"), "--year", "2018", "--month", "2",
              "--jdbc-url", "jdbc:x", "--jdbc-properties", f"{tmp_path}/db.json"])
    assert given and all(found == {"user": "u", "password": "p"} for found in given)


def test_a_month_run_makes_one_year_of_the_profile(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    job.refresh(spark, default_catalog(), raw, out, 2017, 12, with_loans=True)
    assert job.refresh_profile(spark, out) is None
    folder = tmp_path / "out" / "area_profile"
    files = {path: path.stat().st_mtime_ns for path in folder.glob("year=2017/*.parquet")}
    job.refresh(spark, default_catalog(), raw, out, 2018, 1, with_loans=True)
    assert job.refresh_profile(spark, out) == [2018]
    assert {p: p.stat().st_mtime_ns for p in folder.glob("year=2017/*.parquet")} == files
    assert job.refresh_profile(spark, out) == []
    found = sorted(map(str, job.read_partitions(spark, f"{out}/area_profile", job.PROFILE_SCHEMA).collect()))
    job.note_years(spark, out, [None])
    assert job.refresh_profile(spark, out) is None
    whole = job.read_partitions(spark, f"{out}/area_profile", job.PROFILE_SCHEMA).collect()
    assert sorted(map(str, whole)) == found


def test_changed_schools_change_the_years_of_their_tracts(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    job.refresh(spark, default_catalog(), raw, out, 2017, 12, with_loans=True)
    job.refresh(spark, default_catalog(), raw, out, 2018, 1, with_loans=True)
    job.refresh_profile(spark, out)
    put(tmp_path, "schools/SF.xml", SCHOOL.replace("<gsRating>7", "<gsRating>9"))
    job.refresh(spark, default_catalog(), raw, out, 2021, 2, with_loans=False)
    assert job.refresh_profile(spark, out) == [2017, 2018, 2021]
    rows = job.read_partitions(spark, f"{out}/area_profile", job.PROFILE_SCHEMA).collect()
    assert {r.average_rating for r in rows if r.tract == "06075010100"} == {8.0}
