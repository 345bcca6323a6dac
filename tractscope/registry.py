"""Named queries over the given test tables. ``oracle.py`` has the SQL for each."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tractscope import fixtures as fx
from tractscope.functions.income import has_income, income_level as level_of
from tractscope.functions.numbers import parse_int
from tractscope.functions.tracts import normalize_tract
from tractscope.operators.columns import map_columns
from tractscope.operators.locate import attach_tract, distinct_coordinates as distinct_points
from tractscope.operators.lookup import lookup_counties
from tractscope.operators.tract_index import BROADCAST_BYTES, stored_tract_index
from tractscope.plans import incidents, landing, loans, profile, schools
from tractscope.plans.refresh import INCIDENT_SCHEMA, LOAN_SCHEMA, PROFILE_SCHEMA
from tractscope.plans import refresh as job
from tractscope.session import new_table_path, write_once
from tractscope.sinks.tables import read_partitions, write_incidents, write_loans
from tractscope.sources.files import (
    read_csv_header,
    read_csv_schema,
    read_delimited,
    read_delimited_checked,
    year_paths,
)
from tractscope.sources.incidents import read_incidents
from tractscope.sources.loans import read_loans, standard_loans
from tractscope.sources.schools import read_school_file

CATALOG = fx.fixture_catalog()
TOP_K = 3
PERIOD = (1998, 3)

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


# --- shared steps ---------------------------------------------------------------


def _city_loans(spark: SparkSession, sf_dir: str, year=None) -> DataFrame:
    return loans.city_loans(loans.eligible_loans(fx.loans_raw(spark, sf_dir)), CATALOG, year)


def _ranks(city_loans):
    return loans.tract_ranks(loans.level_counts(loans.loan_detail(city_loans)))


def _population(city_loans):
    return loans.tract_population(loans.tract_info(city_loans))


def _clean(spark, sf_dir, year=None, month=None):
    dated = incidents.with_day(fx.incidents_raw(spark, sf_dir), CATALOG)
    return incidents.clean_incidents(dated, F.col("day"), year, month)


def _index(spark, sf_dir, broadcast_bytes=BROADCAST_BYTES):
    return stored_tract_index(fx.tracts(spark, sf_dir), broadcast_bytes=broadcast_bytes)


def _tract_years(spark, sf_dir):
    return incidents.tract_years(_clean(spark, sf_dir), _index(spark, sf_dir))


# --- loans ----------------------------------------------------------------------


@query
def loan_tract_rank(spark, sf_dir):
    return _ranks(_city_loans(spark, sf_dir))


@query
def top_tracts_per_level(spark, sf_dir):
    return loans.top_tracts(_ranks(_city_loans(spark, sf_dir)), TOP_K)


@query
def loan_level_tract_count(spark, sf_dir):
    return loans.level_counts(loans.loan_detail(_city_loans(spark, sf_dir)))


@query
def loan_detail(spark, sf_dir):
    return loans.loan_detail(_city_loans(spark, sf_dir))


@query
def tract_info(spark, sf_dir):
    return loans.tract_info(_city_loans(spark, sf_dir))


@query
def loan_year(spark, sf_dir):
    return _city_loans(spark, sf_dir, year=1997)


@query
def loan_filter_v1(spark, sf_dir):
    raw = fx.loans_in_layout(spark, sf_dir, "v1")
    return raw.where(loans.eligible_v1())


@query
def loan_filter_v2(spark, sf_dir):
    raw = fx.loans_in_layout(spark, sf_dir, "v2")
    return raw.where(loans.eligible_v2())


@query
def map_columns_v1(spark, sf_dir):
    raw = fx.loans_in_layout(spark, sf_dir, "v1")
    return map_columns(raw, CATALOG.loan_layouts["v1"].columns, keep=["county_name"])


@query
def map_columns_v2(spark, sf_dir):
    raw = fx.loans_in_layout(spark, sf_dir, "v2")
    return map_columns(raw, CATALOG.loan_layouts["v2"].columns, keep=["county_code"])


def _loans_of_layout(spark, sf_dir, version):
    raw = fx.loans_in_layout(spark, sf_dir, version)
    return loans.city_loans(standard_loans(raw, CATALOG, version), CATALOG)


@query
def loan_city_by_name(spark, sf_dir):
    return _loans_of_layout(spark, sf_dir, "v1")


@query
def loan_city_by_code(spark, sf_dir):
    return _loans_of_layout(spark, sf_dir, "v2")


@query
def income_parse(spark, sf_dir):
    raw = fx.loans_raw(spark, sf_dir)
    return raw.select("activity_year", "income", parse_int(F.col("income")).alias("income_int"))


@query
def income_present(spark, sf_dir):
    parsed = income_parse(spark, sf_dir)
    return parsed.where(has_income(F.col("income_int")))


@query
def income_level(spark, sf_dir):
    parsed = income_parse(spark, sf_dir)
    return parsed.withColumn("level", level_of(F.col("income_int")))


@query
def tract_normalize(spark, sf_dir):
    tract, code = F.col("census_tract"), F.col("county_code")
    return fx.loans_raw(spark, sf_dir).select(
        "census_tract", "county_code", normalize_tract(tract, code).alias("full_tract")
    )


# --- incidents ------------------------------------------------------------------


@query
def incident_date_parts(spark, sf_dir):
    dated = incidents.with_day(fx.incidents_raw(spark, sf_dir), CATALOG)
    return dated.select("city", "date", F.year("day").alias("year"), F.month("day").alias("month"))


@query
def incident_located(spark, sf_dir):
    raw = fx.incidents_raw(spark, sf_dir)
    return raw.where(F.col("longitude").isNotNull() & F.col("latitude").isNotNull())


@query
def incident_clean(spark, sf_dir):
    return _clean(spark, sf_dir)


@query
def incident_sorted(spark, sf_dir):
    return incidents.sort_by_location(_clean(spark, sf_dir))


@query
def incident_period(spark, sf_dir):
    return _clean(spark, sf_dir, *PERIOD)


@query
def incident_year_only(spark, sf_dir):
    return _clean(spark, sf_dir, PERIOD[0])


@query
def incident_all_time(spark, sf_dir):
    return _clean(spark, sf_dir, "", PERIOD[1])


@query
def period_exists_semi(spark, sf_dir):
    requested = fx.requested_periods(spark, sf_dir)
    return incidents.existing_periods(requested, _clean(spark, sf_dir))


@query
def distinct_coordinates(spark, sf_dir):
    return distinct_points(_clean(spark, sf_dir))


@query
def coordinate_tract(spark, sf_dir):
    points = distinct_points(_clean(spark, sf_dir))
    return attach_tract(points, _index(spark, sf_dir))


@query
def incident_tract_join(spark, sf_dir):
    return attach_tract(_clean(spark, sf_dir), _index(spark, sf_dir))


@query
def incident_tract_year(spark, sf_dir):
    return _tract_years(spark, sf_dir)


@query
def coordinate_tract_shuffled(spark, sf_dir):
    """The plan for an index too large to broadcast."""
    points = distinct_points(_clean(spark, sf_dir))
    return attach_tract(points, _index(spark, sf_dir, broadcast_bytes=0))


@query
def incident_tract_join_shuffled(spark, sf_dir):
    return attach_tract(_clean(spark, sf_dir), _index(spark, sf_dir, broadcast_bytes=0))


@query
def incident_tract_year_shuffled(spark, sf_dir):
    return incidents.tract_years(_clean(spark, sf_dir), _index(spark, sf_dir, broadcast_bytes=0))


@query
def incident_tract_month(spark, sf_dir):
    return incidents.tract_months(_clean(spark, sf_dir), _index(spark, sf_dir))


@query
def incident_trend(spark, sf_dir):
    return incidents.incident_trend(_tract_years(spark, sf_dir))


@query
def incident_rate(spark, sf_dir):
    population = _population(_city_loans(spark, sf_dir))
    return incidents.incident_rates(_tract_years(spark, sf_dir), population)


# --- schools, lookup, profile ---------------------------------------------------


@query
def school_tract(spark, sf_dir):
    return schools.school_tracts(fx.schools_raw(spark, sf_dir), _index(spark, sf_dir))


@query
def schools_by_tract(spark, sf_dir):
    return schools.schools_by_tract(school_tract(spark, sf_dir))


@query
def city_county_lookup(spark, sf_dir):
    return lookup_counties(fx.city_requests(spark, sf_dir), fx.city_places(spark, sf_dir))


@query
def area_profile(spark, sf_dir):
    """Two marts need the loans, so these are written once; one index serves both joins."""
    index = _index(spark, sf_dir)
    city_loans = write_once(_city_loans(spark, sf_dir), "city-loans")
    school_rows = schools.school_tracts(fx.schools_raw(spark, sf_dir), index)
    return profile.area_profile(
        _population(city_loans),
        incidents.tract_years(_clean(spark, sf_dir), index),
        _ranks(city_loans),
        schools.schools_by_tract(school_rows),
    )


# --- sources and sinks: the whole table is written, then read through the source ---


@query
def src_csv_header(spark, sf_dir):
    path = new_table_path(spark, "csv-header")
    fx.incidents_raw(spark, sf_dir).write.csv(path, header=True)
    return read_csv_header(spark, path)


def _write_lines(lines, header, path):
    """Lines of text as they are below a header line, in CSV files."""
    raw = {"header": True, "quote": "", "sep": "\u0001"}
    lines.toDF(header).write.mode("append").options(**raw).csv(path)


def _line(*fields):
    return F.concat_ws(",", *(F.coalesce(F.col(f), F.lit("")) for f in fields))


@query
def src_odd_headers(spark, sf_dir):
    """Headers that repeat a name and end in a comma, in files of two column orders."""
    path = new_table_path(spark, "odd-headers")
    raw = fx.incidents_raw(spark, sf_dir)
    rest = ["category", "longitude", "latitude"]
    for some, columns, header in (
        (F.col("city") == "SF", ["city", "version", "date"], "city,kind,date"),
        (F.col("city") != "SF", ["date", "version", "city"], "date,kind,city"),
    ):
        lines = raw.where(some).select(F.concat(_line(*columns, *rest), F.lit(",")))
        _write_lines(lines, f"{header},Kind,longitude,latitude,", path)
    return read_csv_header(spark, path)


@query
def src_rejects(spark, sf_dir):
    """Lines that do not parse: those of unlocated reports end early, some have a field more."""
    path = new_table_path(spark, "rejects")
    raw = fx.incidents_raw(spark, sf_dir)
    full = _line("city", "date", "category", "latitude", "longitude")
    lines = raw.select(
        F.when(F.col("longitude").isNull(), _line("city", "date"))
        .when(F.col("category") == "AF", F.concat(full, F.lit(",x")))
        .otherwise(full)
    )
    _write_lines(lines, "city,date,category,latitude,longitude", path)
    _, rejects = read_delimited_checked(spark, path)
    return rejects.select("line", "reason")


@query
def src_csv_schema(spark, sf_dir):
    """Headerless rows; those of unlocated reports end early and get nulls."""
    path = new_table_path(spark, "csv-schema")
    raw = fx.incidents_raw(spark, sf_dir)
    full = F.concat_ws(",", "city", "category", "date", "latitude", "longitude")
    short = F.concat_ws(",", "city", "category", "date")
    raw.select(F.when(F.col("longitude").isNull(), short).otherwise(full)).write.text(path)
    schema = "city string, category string, date string, latitude double, longitude double"
    return read_csv_schema(spark, path, schema)


@query
def src_xml_rows(spark, sf_dir):
    path = new_table_path(spark, "xml")
    tags = {"rootTag": "schools", "rowTag": "school"}
    fx.schools_raw(spark, sf_dir).write.format("xml").options(**tags).save(path)
    return read_school_file(spark, path)


@query
def src_delimited_text(spark, sf_dir):
    path = new_table_path(spark, "delimited")
    fx.loans_in_layout(spark, sf_dir, "v2").write.csv(path, sep="|", header=True)
    return read_delimited(spark, path)


@query
def src_year_glob(spark, sf_dir):
    """Three of the year folders, each of files with a header line, in two column orders."""
    path = new_table_path(spark, "years")
    _write_year_folders(fx.loans_in_layout(spark, sf_dir, "v1"), "as_of_year", f"{path}/y=", ",")
    return read_csv_header(spark, year_paths(f"{path}/y=", [1995, 1996, 1997]))


def _write_year_folders(rows, year, prefix, separator):
    """Folders ``<prefix><year>``; a part of each folder's files has its columns reversed.
    Returns the years.

    The rows are derived once, into partitions by folder and order of columns; each write reads
    its own partition.
    """
    years, spark = set(), rows.sparkSession
    folder, _, name = prefix.rpartition("/")
    parted = rows.withColumns(
        {"folder": F.concat(F.lit(name), F.col(year)), "odd": F.col("action_taken") == "1"}
    )
    path = new_table_path(spark, "year-folders")
    parted.write.partitionBy("folder", "odd").parquet(path)
    staged = spark.read.schema(parted.schema).parquet(path)
    for found in sorted(staged.select("folder", "odd").distinct().collect(), reverse=True):
        files = staged.where((F.col("folder") == found.folder) & (F.col("odd") == found.odd))
        files = files.select(*rows.columns[:: 1 if found.odd else -1])
        files.write.mode("append").csv(f"{folder}/{found.folder}", sep=separator, header=True)
        years.add(int(found.folder.removeprefix(name)))
    return sorted(years)


@query
def loan_files(spark, sf_dir):
    """Eligible loans of all cities of 1996, 1997 and 1998, read from the year folders of both
    file layouts."""
    root, _ = _write_loan_files(spark, sf_dir)
    applications = read_loans(spark, CATALOG, root, [1996, 1997, 1998])
    return loans.city_loans(applications, CATALOG)


@query
def loan_files_every_year(spark, sf_dir):
    """Eligible loans of all cities and years, read from the year folders of both layouts."""
    root, years = _write_loan_files(spark, sf_dir)
    return loans.city_loans(read_loans(spark, CATALOG, root, years), CATALOG)


def _write_loan_files(spark, sf_dir):
    """The folder of the year folders of both layouts, and its years."""
    root = new_table_path(spark, "loan-files") + "/"
    years = set()
    for version, separator in (("v1", ","), ("v2", "|")):
        rows = fx.loans_in_layout(spark, sf_dir, version)
        year = CATALOG.loan_layouts[version].columns["activity_year"]
        years.update(_write_year_folders(rows, year, root, separator))
    return root, sorted(years)


@query
def src_versioned_union(spark, sf_dir):
    """Reports from one file set per city and version; versions overlap by a year."""
    root = new_table_path(spark, "versions") + "/"
    _write_incident_files(_dated_reports(spark, sf_dir), root)
    return read_incidents(spark, CATALOG, root)


def _dated_reports(spark, sf_dir):
    """Reports of all cities with their day, derived once for all files that are made of them."""
    dated = incidents.with_day(fx.incidents_raw(spark, sf_dir), CATALOG)
    return write_once(dated.drop("version", "date").withColumn("y", F.year("day")), "reports")


def _write_incident_files(reports, root, some=None, mode="error"):
    """The files of every city and version, of the reports that meet ``some``."""
    day = F.col("day")
    for city in CATALOG.cities.values():
        for version, layout in city.incident_layouts.items():
            rows = reports.where(F.col("city") == city.key)
            rows = rows if some is None else rows.where(some)
            if len(city.incident_layouts) > 1:
                early = F.col("y") <= fx.LAST_V1_YEAR + 1
                rows = rows.where(early if version == "v1" else F.col("y") >= fx.LAST_V1_YEAR)
            text = F.date_format(day, layout.date_format)
            named = rows.withColumn("date", text).select(
                *(F.col(target).alias(source) for target, source in layout.columns.items())
            )
            named.write.mode(mode).csv(root + layout.file, header=True)


def _is_late():
    return F.col("category") == "AF"


@query
def incident_ledger(spark, sf_dir):
    """Raw rows by landing: all files at once, then those of late reports, added later."""
    root, out = new_table_path(spark, "raw") + "/", new_table_path(spark, "tables")
    reports = _dated_reports(spark, sf_dir)
    _write_incident_files(reports, root, ~_is_late())
    landing.land_incidents(spark, CATALOG, root, out)
    _write_incident_files(reports, root, _is_late(), mode="append")
    landing.land_incidents(spark, CATALOG, root, out)
    counts = landing.landed_counts(spark, out).groupBy("city", "version", "landing")
    return counts.agg(
        F.sum("row_count").alias("row_count"), F.sum("reject_count").alias("reject_count")
    )


@query
def incident_landed(spark, sf_dir):
    """Clean reports after all files have landed, and again without the late reports."""
    root, out = new_table_path(spark, "raw") + "/", new_table_path(spark, "tables")
    reports = _dated_reports(spark, sf_dir)
    for some, mode in ((None, "error"), (~_is_late(), "overwrite")):
        _write_incident_files(reports, root, some, mode)
        landing.land_incidents(spark, CATALOG, root, out)
    return landing.read_landed(spark, out)


@query
def src_catalog_dim(spark, sf_dir):
    """The catalog's sources with the number of reports from each."""
    found = fx.incidents_raw(spark, sf_dir).groupBy("city", "version").agg(
        F.count("*").alias("report_count")
    )
    sources = CATALOG.incident_source_dim(spark).join(CATALOG.city_dim(spark), "city")
    return sources.join(found, ["city", "version"], "left")


@query
def sink_incident_partitions(spark, sf_dir):
    """All periods written, then one month again: the totals stay the same."""
    path = new_table_path(spark, "incidents")
    write_incidents(_clean(spark, sf_dir), path)
    write_incidents(_clean(spark, sf_dir, *PERIOD), path)
    return read_partitions(spark, path, INCIDENT_SCHEMA)


@query
def sink_loan_partitions(spark, sf_dir):
    path = new_table_path(spark, "loans")
    fact = _city_loans(spark, sf_dir)
    write_loans(fact, path)
    write_loans(fact.where(F.col("activity_year") == PERIOD[0]), path)
    return read_partitions(spark, path, LOAN_SCHEMA)


@query
def sink_incident_correction(spark, sf_dir):
    """A year written, and again from a source that has lost one of its months."""
    path = new_table_path(spark, "corrected")
    year, month = PERIOD
    write_incidents(_clean(spark, sf_dir), path)
    corrected = _clean(spark, sf_dir, year).where(F.col("month") != month)
    write_incidents(corrected, path, owned=F.col("year") == year)
    return read_partitions(spark, path, INCIDENT_SCHEMA)


def _write_raw(spark, sf_dir):
    """A folder of raw files of all sources, and one for the tables."""
    root = new_table_path(spark, "raw") + "/"
    _write_incident_files(_dated_reports(spark, sf_dir), root)
    for version, separator in (("v1", ","), ("v2", "|")):
        rows = fx.loans_in_layout(spark, sf_dir, version)
        year = CATALOG.loan_layouts[version].columns["activity_year"]
        _write_year_folders(rows, year, root + CATALOG.loan_folder, separator)
    _write_schools(spark, sf_dir, root, F.lit(True))
    fx.tracts(spark, sf_dir).write.parquet(root + "tracts")
    return root, new_table_path(spark, "tables")


def _write_schools(spark, sf_dir, root, some):
    odd = F.col("gsRating") % 2 == 1
    for city, half in (("SF", odd), ("LA", ~odd)):
        rows = fx.schools_raw(spark, sf_dir).where(half & some)
        tags = {"rootTag": "schools", "rowTag": "school"}
        path = root + CATALOG.cities[city].school_file
        rows.write.format("xml").mode("overwrite").options(**tags).save(path)


@query
def refresh_tables(spark, sf_dir):
    """The periodic job over raw files: the year before ``PERIOD`` at once, the month of
    ``PERIOD`` and the next one, loans of both years, then the profile of these periods."""
    root, out = _write_raw(spark, sf_dir)
    year, month = PERIOD
    job.refresh(spark, CATALOG, root, out, year - 1, None, with_loans=True)
    for number in (month, month + 1):
        job.refresh(spark, CATALOG, root, out, year, number, with_loans=number == month)
    job.refresh_profile(spark, out)
    return read_partitions(spark, f"{out}/area_profile", PROFILE_SCHEMA)


@query
def profile_by_changes(spark, sf_dir):
    """The profile made after each of two runs, the second for a month only and after some
    schools have closed: rows as if it were made at once."""
    root, out = _write_raw(spark, sf_dir)
    year, month = PERIOD
    job.refresh(spark, CATALOG, root, out, year - 1, None, with_loans=True)
    job.refresh_profile(spark, out)
    _write_schools(spark, sf_dir, root, F.col("enrollment").isNotNull())
    job.refresh(spark, CATALOG, root, out, year, month, with_loans=True)
    job.refresh_profile(spark, out)
    return read_partitions(spark, f"{out}/area_profile", PROFILE_SCHEMA)
