"""What sources exist per city and year, and how their columns are called.

The catalog is small, hand-written metadata: it is plain Python on the driver and
becomes a dimension DataFrame where a plan joins it.
"""

import json
from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# A dimension of at most this many rows, counted on the driver, is broadcast.
BROADCAST_ROWS = 100_000

_NO_YEAR = -1


@dataclass(frozen=True)
class Versions:
    """Which file version holds which years; years in no range use the latest."""

    ranges: dict[str, tuple[int, int]]
    latest: str

    def __post_init__(self):
        years = [y for first, last in self.ranges.values() for y in range(first, last + 1)]
        if len(set(years)) != len(years):
            raise ValueError(f"a year has two file versions: {self.ranges}")

    def of_year(self, year: int) -> str:
        for version, (first, last) in self.ranges.items():
            if first <= year <= last:
                return version
        return self.latest

    def is_source(self, version: str, year: Column) -> Column:
        """Whether reports of ``year`` come from ``version``; no year fits every version.

        ``year`` is used once only, because the test ends up in a pushed-down filter.
        """
        listed = {v: range(first, last + 1) for v, (first, last) in self.ranges.items()}
        if version == self.latest:
            others = [y for v, years in listed.items() if v != version for y in years]
            return ~F.coalesce(year, F.lit(_NO_YEAR)).isin(others)
        return F.coalesce(year, F.lit(_NO_YEAR)).isin(_NO_YEAR, *listed.get(version, []))


@dataclass(frozen=True)
class Layout:
    """One file version: target column -> source column, and its date pattern."""

    columns: dict[str, str]
    file: str = ""
    date_format: str = ""


@dataclass(frozen=True)
class City:
    key: str
    name: str
    state: str
    county_name: str
    county_code: str
    incident_layouts: dict[str, Layout]
    incident_versions: Versions
    school_file: str = ""

    def incident_version(self, year: int | None) -> str:
        """Without a year there is nothing to look up: the latest version."""
        if year is None or year == "":
            return self.incident_versions.latest
        return self.incident_versions.of_year(int(year))


@dataclass(frozen=True)
class Catalog:
    cities: dict[str, City]
    loan_layouts: dict[str, Layout]
    loan_versions: Versions
    loan_folder: str = "loans/"

    def only(self, keys) -> "Catalog":
        return replace(self, cities={key: self.cities[key] for key in keys})

    def city_dim(self, spark: SparkSession) -> DataFrame:
        """One row per city."""
        return dimension(
            spark,
            ["city", "city_name", "state", "county_name", "county_code"],
            [(c.key, c.name, c.state, c.county_name, c.county_code) for c in self.cities.values()],
        )

    def county_dim(self, spark: SparkSession) -> DataFrame:
        """How each loan layout names a city's county: by name (v1) or by code (v2).

        Keyed on (layout, county_key), so a loan meets at most one city.
        """
        rows = []
        for city in self.cities.values():
            rows.append(("v1", city.county_name, city.key, city.county_code))
            rows.append(("v2", city.county_code, city.key, city.county_code))
        if len({row[:2] for row in rows}) != len(rows):
            raise ValueError("two cities share a county name or code")
        return dimension(spark, ["layout", "county_key", "city", "county_code"], rows)

    def incident_source_dim(self, spark: SparkSession) -> DataFrame:
        """One row per city and file version of the incident reports."""
        rows = [
            (
                city.key,
                version,
                layout.date_format,
                layout.columns["date"],
                layout.columns["category"],
                layout.columns["longitude"],
                layout.columns["latitude"],
                version == city.incident_versions.latest,
            )
            for city in self.cities.values()
            for version, layout in city.incident_layouts.items()
        ]
        names = ["city", "version", "date_format", "date_column", "category_column"]
        names += ["longitude_column", "latitude_column", "is_latest"]
        return dimension(spark, names, rows)

    def incident_files(self, spark: SparkSession) -> DataFrame:
        """One row per city and file version: the file or folder of its reports."""
        rows = [
            (layout.file, city.key, version)
            for city in self.cities.values()
            for version, layout in city.incident_layouts.items()
        ]
        if len({row[0] for row in rows}) != len(rows):
            raise ValueError("two sources share a file")
        return dimension(spark, ["source_file", "city", "version"], rows)

    def incident_years_dim(self, spark: SparkSession) -> DataFrame:
        """One row per city and file version: the years it is the source of, or, for the
        latest version, those that it is not."""
        rows = []
        for city in self.cities.values():
            of = city.incident_versions
            years = {v: list(range(first, last + 1)) for v, (first, last) in of.ranges.items()}
            for version in city.incident_layouts:
                latest = version == of.latest
                others = [y for v, ys in years.items() if v != version for y in ys]
                rows.append((city.key, version, latest, others if latest else years.get(version, [])))
        return dimension(spark, ["city", "version", "is_latest", "listed_years"], rows)

    def date_formats(self) -> list[str]:
        """The distinct date patterns of all incident files."""
        layouts = [x for city in self.cities.values() for x in city.incident_layouts.values()]
        return sorted({layout.date_format for layout in layouts})

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Catalog":
        """Read a catalog file (JSON, same shape as ``DEFAULT_CATALOG``) from any storage."""
        (row,) = spark.read.text(path, wholetext=True).collect()
        return from_dict(json.loads(row.value))


def dimension(spark: SparkSession, names: list[str], rows: list[tuple]) -> DataFrame:
    """Rows of metadata as a table inside the plan, without Python workers.

    A dimension that may be broadcast is marked so; a longer one is joined as its size asks.
    """
    if not rows:
        raise ValueError("a dimension without rows")
    columns = [
        pa.array(column, pa.list_(pa.int32()) if isinstance(column[0], list) else None)
        for column in zip(*rows, strict=True)
    ]
    table = spark.createDataFrame(pa.table(columns, names=names))
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


def from_dict(data: dict) -> Catalog:
    def versions(entry):
        return Versions({v: tuple(span) for v, span in entry["years"].items()}, entry["latest"])

    cities = {}
    for key, entry in data["cities"].items():
        reports = entry["incidents"]
        cities[key] = City(
            key=key,
            name=entry["name"],
            state=entry["state"],
            county_name=entry["county_name"],
            county_code=entry["county_code"],
            incident_layouts={v: Layout(**layout) for v, layout in reports["layouts"].items()},
            incident_versions=versions(reports),
            school_file=entry.get("school_file", ""),
        )
    loans = data["loans"]
    return Catalog(
        cities=cities,
        loan_layouts={v: Layout(columns) for v, columns in loans["layouts"].items()},
        loan_versions=versions(loans),
        loan_folder=loans["folder"],
    )


# County names and codes, source column names, date patterns and the
# years each file version covers, as the published files have them.
DEFAULT_CATALOG = {
    "loans": {
        "folder": "loans/",
        "latest": "v2",
        "years": {"v1": [2007, 2017], "v2": [2018, 2018]},
        "layouts": {
            "v1": {
                "activity_year": "as_of_year",
                "loan_amount": "loan_amount_000s",
                "census_tract": "census_tract_number",
                "income": "applicant_income_000s",
                "tract_population": "population",
                "tract_owner_occupied_units": "number_of_owner_occupied_units",
                "tract_one_to_four_family_homes": "number_of_1_to_4_family_units",
            },
            "v2": {
                "activity_year": "activity_year",
                "loan_amount": "loan_amount",
                "census_tract": "census_tract",
                "income": "income",
                "tract_population": "tract_population",
                "tract_owner_occupied_units": "tract_owner_occupied_units",
                "tract_one_to_four_family_homes": "tract_one_to_four_family_homes",
            },
        },
    },
    "cities": {
        "SF": {
            "name": "San Francisco",
            "state": "CA",
            "county_name": "San Francisco county",
            "county_code": "06075",
            "school_file": "schools/SF.xml",
            "incidents": {
                "latest": "v2",
                "years": {"v1": [2007, 2017], "v2": [2018, 2019]},
                "layouts": {
                    "v1": {
                        "file": "incidents/SF_v1.csv",
                        "date_format": "MM/dd/yyyy",
                        "columns": {
                            "date": "Date",
                            "latitude": "Y",
                            "longitude": "X",
                            "category": "Category",
                        },
                    },
                    "v2": {
                        "file": "incidents/SF_v2.csv",
                        "date_format": "yyyy/MM/dd",
                        "columns": {
                            "date": "Incident Date",
                            "latitude": "Latitude",
                            "longitude": "Longitude",
                            "category": "Incident Category",
                        },
                    },
                },
            },
        },
        "LA": {
            "name": "Los Angeles",
            "state": "CA",
            "county_name": "Los Angeles county",
            "county_code": "06037",
            "school_file": "schools/LA.xml",
            "incidents": {
                "latest": "v1",
                "years": {"v1": [2018, 2018]},
                "layouts": {
                    "v1": {
                        "file": "incidents/LA_v1.csv",
                        "date_format": "MM/dd/yyyy HH:mm:ss",
                        "columns": {
                            "date": "DATE OCC",
                            "latitude": "LAT",
                            "longitude": "LON",
                            "category": "Crm Cd Desc",
                        },
                    },
                },
            },
        },
    },
}


def default_catalog() -> Catalog:
    return from_dict(DEFAULT_CATALOG)
