"""Raw files land once, of all cities together, and a failed landing is not seen."""

import time
from dataclasses import replace

import pytest

from test_sources import put, write_reports
from tractscope.catalog import default_catalog
from tractscope import registry
from tractscope.plans import landing
from tractscope.sources.incidents import list_sources, of_their_version, read_incidents

CATALOG = default_catalog()


def landed(spark, out):
    rows = landing.read_landed(spark, out).collect()
    return sorted(((r.city, r.category, r.year) for r in rows), key=str)


def names(paths):
    return [path.rpartition("/")[2] for path in paths]


@pytest.fixture
def raw(tmp_path):
    write_reports(tmp_path)
    return f"{tmp_path}/"


def test_landed_rows_are_those_of_a_plain_read(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    assert names(landing.land_incidents(spark, CATALOG, raw, out)) == [
        "LA_v1.csv", "SF_v1.csv", "SF_v2.csv",
    ]
    plain = read_incidents(spark, CATALOG, raw)
    assert sorted(map(str, landing.read_landed(spark, out).collect())) == sorted(
        map(str, plain.collect())
    )
    assert landing.land_incidents(spark, CATALOG, raw, out) == []


def test_only_the_added_file_is_read(spark, raw, tmp_path):
    """A source may be a folder; a file that is added to it lands alone."""
    (tmp_path / "incidents/LA_v1.csv").unlink()
    head = "DATE OCC,LAT,LON,Crm Cd Desc,\n"
    put(tmp_path, "incidents/LA_v1.csv/a.csv", head + "01/15/2018,37.75,-122.35,ONE,\n")
    out = str(tmp_path / "out")
    landing.land_incidents(spark, CATALOG, raw, out)
    other = "LON,LAT,x,Crm Cd Desc,DATE OCC\n-122.35,37.75,,TWO,01/16/2018\n1,2\n"
    put(tmp_path, "incidents/LA_v1.csv/b [1] {x}.csv", other)
    put(tmp_path, "incidents/of_no_source.csv", "a\n1\n")
    put(tmp_path, "incidents/SF_v2.csv.bak", "a\n1\n")
    assert names(landing.land_incidents(spark, CATALOG, raw, out)) == ["b [1] {x}.csv"]
    assert {c for city, c, _ in landed(spark, out) if city == "LA"} == {"ONE", "TWO", None}
    counts = {r.path.rpartition("/")[2]: (r.landing, r.row_count, r.reject_count)
              for r in landing.landed_counts(spark, out).collect()}
    assert counts["b [1] {x}.csv"] == (2, 2, 1) and counts["a.csv"] == (1, 1, 0)
    (bad,) = landing.rejects(spark, out).collect()
    assert (bad.city, bad.version, bad.line, bad.reason) == ("LA", "v1", "1,2", "short")


def test_changed_and_removed_files(spark, raw, tmp_path):
    out = str(tmp_path / "out")
    landing.land_incidents(spark, CATALOG, raw, out)
    before = landed(spark, out)
    put(tmp_path, "incidents/SF_v2.csv",
        "Incident Date,Latitude,Longitude,Incident Category\n2021/02/03,37.71,-122.45,NOW\n")
    (tmp_path / "incidents/LA_v1.csv").unlink()
    # A run for one city leaves the other's files as they are known.
    assert names(landing.land_incidents(spark, CATALOG.only(["SF"]), raw, out)) == ["SF_v2.csv"]
    changed = [r for r in before if r[1] not in ("NEW", "LATEST")] + [("SF", "NOW", 2021)]
    assert landed(spark, out) == sorted(changed, key=str)
    assert landing.land_incidents(spark, CATALOG, raw, out) == []
    assert {r[0] for r in landed(spark, out)} == {"SF"}
    write_reports(tmp_path)
    assert names(landing.land_incidents(spark, CATALOG, raw, out)) == ["LA_v1.csv", "SF_v1.csv", "SF_v2.csv"]
    assert landed(spark, out) == before


def test_a_landing_that_fails_is_not_seen(spark, raw, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    landing.land_incidents(spark, CATALOG.only(["SF"]), raw, out)
    before = landed(spark, out)
    real = landing._append_rows

    def killed(*given):
        real(*given)
        raise RuntimeError("killed")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(landing, "_append_rows", killed)
        landing.land_incidents(spark, CATALOG, raw, out)
    assert landed(spark, out) == before
    assert landing.rejects(spark, out).count() == 0
    assert names(landing.land_incidents(spark, CATALOG, raw, out)) == ["LA_v1.csv"]
    assert landed(spark, out) == sorted(before + [("LA", "LA", 2018)], key=str)


def test_a_missing_city_does_not_stop_the_others(spark, tmp_path):
    write_reports(tmp_path)
    (tmp_path / "incidents/SF_v1.csv").unlink()
    assert {r.category for r in read_incidents(spark, CATALOG, f"{tmp_path}/").collect()} == {
        "NEW", "LATEST", "LA",
    }
    nowhere = read_incidents(spark, CATALOG, f"{tmp_path}/nowhere/")
    assert nowhere.count() == 0 and "year" in nowhere.columns
    assert landing.land_incidents(spark, CATALOG, f"{tmp_path}/nowhere/", str(tmp_path / "o")) == []


def test_a_missing_column_is_named(spark, raw, tmp_path):
    put(tmp_path, "incidents/LA_v1.csv", "DATE OCC,LAT,Crm Cd Desc\n1,2,3\n")
    with pytest.raises(ValueError, match="LA_v1.csv has no column LON"):
        read_incidents(spark, CATALOG, raw)


def test_two_thousand_cities(spark, tmp_path):
    """One listing, one scan of headers and one of rows for each width of header."""
    layout = CATALOG.cities["LA"].incident_layouts["v1"]
    cities = {}
    for i in range(2000):
        key, file = f"C{i}", f"incidents/{i}.csv"
        own = replace(layout, file=file, columns=layout.columns | {"category": f"kind {i % 50}"})
        cities[key] = replace(CATALOG.cities["LA"], key=key, county_name=key, county_code=key,
                              incident_layouts={"v1": own})
        put(tmp_path, file, f"DATE OCC,LAT,LON,kind {i % 50}\n01/15/2018,37.7,-122.4,c{i}\n")
    catalog = replace(CATALOG, cities=cities)
    started = time.perf_counter()
    rows = read_incidents(spark, catalog, f"{tmp_path}/")
    planned = time.perf_counter() - started
    found = {(r.city, r.category, r.year) for r in rows.collect()}
    assert found == {(f"C{i}", f"c{i}", 2018) for i in range(2000)}
    assert planned < 60
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 100_000


def test_listing(spark, raw):
    rows = list_sources(spark, CATALOG, raw).collect()
    assert sorted((r.city, r.version) for r in rows) == [("LA", "v1"), ("SF", "v1"), ("SF", "v2")]
    assert all(r.length > 0 and r.modified > 10**15 for r in rows)


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_dates_are_parsed_once(spark, raw, tmp_path, monkeypatch):
    """What has been parsed keeps its day, and its file by number."""
    written, real = {}, landing.write_once
    monkeypatch.setattr(
        landing, "write_once", lambda frame, label: written.setdefault(label, real(frame, label))
    )
    landing.land_incidents(spark, CATALOG, raw, str(tmp_path / "out"))
    parsed = written["landing"]
    assert "_file" not in parsed.columns
    assert "regexp_replace" not in plan_of(of_their_version(parsed, CATALOG))
    # Without a kept day: once for each of two patterns.
    assert plan_of(read_incidents(spark, CATALOG, raw)).count("regexp_replace") == 2


def test_reports_of_no_year_fit_every_version(spark, raw, tmp_path):
    put(tmp_path, "incidents/SF_v1.csv", "Date,Y,X,Category\njunk,37.71,-122.45,ODD\n")
    put(tmp_path, "incidents/SF_v2.csv",
        "Incident Date,Latitude,Longitude,Incident Category\n,37.71,-122.45,NONE\n")
    out = str(tmp_path / "out")
    landing.land_incidents(spark, CATALOG, raw, out)
    wanted = [("LA", "LA", 2018), ("SF", "NONE", None), ("SF", "ODD", None)]
    assert landed(spark, out) == wanted
    plain = read_incidents(spark, CATALOG, raw).collect()
    assert sorted(((r.city, r.category, r.year) for r in plain), key=str) == wanted


def test_reports_are_derived_once_for_all_landings(spark, monkeypatch):
    calls, real = [], registry.fx.incidents_raw
    monkeypatch.setattr(
        registry.fx, "incidents_raw", lambda *given: calls.append(given) or real(*given)
    )
    assert registry.QUERIES["incident_landed"](spark, "/root/testdata/sf0.001").count() > 0
    assert len(calls) == 1
