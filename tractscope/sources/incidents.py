"""Incident reports of all cities, each file in the layout of its city and version."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from tractscope.catalog import Catalog, dimension
from tractscope.plans.incidents import INCIDENT_COLUMNS, clean_incidents, is_given, with_day
from tractscope.sources.files import is_absent
from tractscope.sources.headers import (
    CORRUPT,
    header_census,
    header_names,
    positions,
    read_positions,
)

FILE_SCHEMA = (
    "path string, file string, length bigint, modified bigint, city string, version string"
)
TARGETS = ["date", "category", "longitude", "latitude"]


def _bare(root: str) -> str:
    """A root without its scheme, as it occurs in the path of every file below it."""
    return root.split("://", 1)[-1]


def escaped(path: str) -> str:
    """A path that names one file, whatever characters it holds."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)


def list_sources(spark: SparkSession, catalog: Catalog, root: str) -> DataFrame:
    """(path, file, length, modified, city, version) of the files of all sources there are.

    A source is a file or a folder of files. Folders are listed once, whatever the number of
    cities; a source that is absent has no files, and a file of no source is left alone.
    """
    sources = catalog.incident_files(spark)
    names = {x.file for c in catalog.cities.values() for x in c.incident_layouts.values()}
    found = []
    for folder in sorted({name.rpartition("/")[0] for name in names}):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
        try:
            found.append(reader.load(escaped(root + folder)))
        except AnalysisException as error:
            if not is_absent(error):
                raise
    if not found:
        return spark.createDataFrame([], FILE_SCHEMA)
    listed = reduce(DataFrame.union, [
        f.select("path", F.col("_metadata.file_path").alias("file"), "length",
                 F.unix_micros("modificationTime").alias("modified"))
        for f in found
    ])
    bare = F.lit(_bare(root))
    inner = F.substring(F.col("path"), F.instr("path", bare) + F.length(bare), F.length("path"))
    # A file belongs to the source of its own name or of a folder above it.
    steps = F.split(inner, "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(steps)), lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/")
    )
    return listed.withColumn("source_file", F.explode(above)).join(sources, "source_file").select(
        "path", "file", "length", "modified", "city", "version"
    )


def parse_files(
    spark: SparkSession, catalog: Catalog, files, entries: dict[str, int]
) -> DataFrame | None:
    """Rows of the listed files: the four texts, with city, version, the file, its number in
    ``entries``, and the line where it does not parse. None if no file has a header line.

    One scan serves all files whose headers are of the same width, whatever their cities.
    Where a file keeps a column comes with its row of a joined table, so the plan does not
    grow with the number of files, cities or layouts.
    """
    if not files:
        return None
    census = header_census(spark, [escaped(r.path) for r in files])
    headers = {r.file: r.line for r in census.collect()}
    names_of = {line: header_names(spark, line, ",") for line in set(headers.values())}
    rows, widths = [], {}
    for found in files:
        if found.file not in headers:
            continue
        names = names_of[headers[found.file]]
        layout = catalog.cities[found.city].incident_layouts[found.version]
        wanted = [layout.columns[target] for target in TARGETS]
        absent = [name for name in wanted if name not in names]
        if absent:
            raise ValueError(f"{found.path} has no column {absent[0]}; it has {names}")
        at = [names.index(name) + 1 for name in wanted]
        entry = entries[found.file]
        rows.append((found.file, entry, found.city, found.version, len(names), *at))
        widths.setdefault(len(names), []).append(escaped(found.path))
    if not rows:
        return None
    columns = ["_file", "entry", "city", "version", "width", *[f"{t}_at" for t in TARGETS]]
    places = dimension(spark, columns, rows)
    parts = []
    for width, paths in sorted(widths.items()):
        raw = read_positions(spark, paths, ",", width, corrupt=True)
        raw = raw.withColumn("_file", F.col("_metadata.file_path")).join(places, "_file")
        cells = F.array(*positions(width))
        texts = [F.element_at(cells, F.col(f"{t}_at").cast("int")).alias(t) for t in TARGETS]
        parts.append(raw.select("_file", "entry", "city", "version", "width", CORRUPT, *texts))
    return reduce(DataFrame.unionByName, parts)


def of_their_version(rows: DataFrame, catalog: Catalog, year=None, month=None) -> DataFrame:
    """Located reports with year and month, of the years their file version is the source of.

    Date patterns and years come with joined rows. File versions overlap in time, and a
    report of a year is taken from the one version the catalog names for it. Reports without
    a readable date belong to no year; they stay unless a period is asked for. Rows that
    already have the ``day`` of their date are not parsed again.
    """
    if "day" not in rows.columns:
        rows = with_day(rows, catalog)
    years = catalog.incident_years_dim(rows.sparkSession)
    extra = [c for c in rows.columns if c not in ("city", "day", *TARGETS)]
    extra += ["is_latest", "listed_years"]
    dated = rows.join(years, ["city", "version"])
    clean = clean_incidents(dated, F.col("day"), year, month, extra)
    # One mention of the year: each would parse the text once more. No year fits.
    listed = F.array_contains("listed_years", F.col("year"))
    fits = F.coalesce(listed != F.col("is_latest"), F.lit(True))
    return clean.where(fits).drop("is_latest", "listed_years")


def read_incidents(
    spark: SparkSession, catalog: Catalog, root: str, year=None, month=None
) -> DataFrame:
    """Clean reports of all cities; with a year, only the files of that year's versions are
    read. A city without files has no reports."""
    files = list_sources(spark, catalog, root).orderBy("path").collect()
    if is_given(year):
        files = [r for r in files if r.version == catalog.cities[r.city].incident_version(year)]
    rows = parse_files(spark, catalog, files, {r.file: i for i, r in enumerate(files)})
    if rows is None:
        rows = spark.createDataFrame([], "city string, version string, " + _texts())
    return of_their_version(rows, catalog, year, month).select(*INCIDENT_COLUMNS)


def _texts() -> str:
    return ", ".join(f"{target} string" for target in TARGETS)
