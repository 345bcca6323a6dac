"""Raw incident files as one clean table, each file landed once.

A ledger says which files have landed, when, and with how many rows; it is compared with a
listing, so that a run reads only files that are new or have changed, of all cities and
layouts together. Landed rows carry the number of their file's entry in the ledger. The
entries of a run are written last: rows without a valid entry are not seen, so a run that
fails half-way leaves everything as it was, and the next one lands its files again.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tractscope.catalog import Catalog, dimension
from tractscope.plans.incidents import INCIDENT_COLUMNS, with_day
from tractscope.session import write_once
from tractscope.sinks.tables import read_partitions
from tractscope.sources.headers import BROADCAST_FILES, CORRUPT, reject_reason
from tractscope.sources.incidents import list_sources, of_their_version, parse_files

INCIDENT_SCHEMA = (
    "city string, year int, month int, date string, category string, "
    "latitude string, longitude string"
)
LANDED_SCHEMA = INCIDENT_SCHEMA + ", version string, entry bigint"
LANDED_PARTITIONS = ["city", "version", "year", "month"]
LEDGER_SCHEMA = (
    "entry bigint, landing bigint, path string, length bigint, modified bigint, "
    "city string, version string"
)
REJECT_SCHEMA = "entry bigint, file string, line string, reason string"
ROW_SCHEMA = "entry bigint, row_count bigint, reject_count bigint"


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """The last entry of every file that was ever seen; ``length`` is null once it is gone."""
    entries = read_partitions(spark, f"{out}/landed_files", LEDGER_SCHEMA)
    columns = [c for c in entries.columns if c != "path"]
    last = F.max(F.struct("landing", *[c for c in columns if c != "landing"])).alias("last")
    return entries.groupBy("path").agg(last).select("path", *[f"last.{c}" for c in columns])


def read_landed(spark: SparkSession, out: str) -> DataFrame:
    """Clean reports of the files as they are now; year and month pick partitions."""
    rows = read_partitions(spark, f"{out}/landed_incidents", LANDED_SCHEMA)
    valid = ledger(spark, out).where(F.col("length").isNotNull()).select("entry")
    if valid.count() <= BROADCAST_FILES:
        valid = F.broadcast(valid)
    return rows.join(valid, "entry", "left_semi").select(*INCIDENT_COLUMNS)


def land_incidents(spark: SparkSession, catalog: Catalog, root: str, out: str) -> list[str]:
    """Land the files that are new or have changed, and note those that are gone.

    Returns the paths that were read. Sources of cities outside the catalog are left as they
    are. What the driver holds is one row for each file it has to read.
    """
    listed = write_once(list_sources(spark, catalog, root), "listed")
    known = write_once(ledger(spark, out), "ledger")
    same = ["path", "length", "modified"]
    changed = listed.join(known.select(*same), same, "left_anti").orderBy("path").collect()
    sources = catalog.incident_files(spark).select("city", "version")
    gone = (
        known.where(F.col("length").isNotNull())
        .join(sources, ["city", "version"], "left_semi")
        .join(listed.select("path"), "path", "left_anti")
    )
    gone = gone.select("path", "city", "version").orderBy("path").collect()
    if not changed and not gone:
        return []
    landing = (known.agg(F.max("landing")).first()[0] or 0) + 1
    # Drawn anew, so that rows of a landing that failed never get a valid entry.
    first = uuid.uuid4().int % (1 << 39) << 24
    if changed:
        _append_rows(spark, catalog, changed, first, out)
    noted = [
        (first + i, landing, r.path, r.length, r.modified, r.city, r.version)
        for i, r in enumerate(changed)
    ]
    noted += [
        (first + len(changed) + i, landing, r.path, None, None, r.city, r.version)
        for i, r in enumerate(gone)
    ]
    entries = spark.createDataFrame(noted, LEDGER_SCHEMA).coalesce(1)
    entries.write.mode("append").parquet(f"{out}/landed_files")
    return [r.path for r in changed]


def _append_rows(spark, catalog, changed, first, out) -> None:
    """The clean rows, the quarantine and the counts of the files.

    Lines and dates are parsed once. A row names its file by its entry, not by its path.
    """
    entries = {r.file: first + i for i, r in enumerate(changed)}
    parsed = parse_files(spark, catalog, changed, entries)
    if parsed is None:
        return
    parsed = write_once(with_day(parsed.drop("_file"), catalog), "landing")
    files = dimension(spark, ["entry", "file"], [(entry, file) for file, entry in entries.items()])
    bad = parsed.where(F.col(CORRUPT).isNotNull()).join(files, "entry").select(
        "entry",
        "file",
        F.col(CORRUPT).alias("line"),
        reject_reason(F.col(CORRUPT), ",", F.col("width")).alias("reason"),
    )
    bad.write.mode("append").parquet(f"{out}/landed_rejects")
    counts = parsed.groupBy("entry").agg(
        F.count("*").alias("row_count"), F.count(CORRUPT).alias("reject_count")
    )
    counts.coalesce(1).write.mode("append").parquet(f"{out}/landed_counts")
    clean = of_their_version(parsed, catalog).select(*INCIDENT_COLUMNS, "version", "entry")
    balanced = clean.hint("rebalance", *LANDED_PARTITIONS)
    balanced.write.mode("append").partitionBy(*LANDED_PARTITIONS).parquet(f"{out}/landed_incidents")


def rejects(spark: SparkSession, out: str) -> DataFrame:
    """Quarantine of the files as they are now: (city, version, path, line, reason)."""
    lines = read_partitions(spark, f"{out}/landed_rejects", REJECT_SCHEMA)
    valid = ledger(spark, out).where(F.col("length").isNotNull())
    return lines.join(valid.select("entry", "city", "version", "path"), "entry").select(
        "city", "version", "path", "line", "reason"
    )


def landed_counts(spark: SparkSession, out: str) -> DataFrame:
    """Files as they are now, with the rows each had and how many did not parse."""
    counts = read_partitions(spark, f"{out}/landed_counts", ROW_SCHEMA)
    valid = ledger(spark, out).where(F.col("length").isNotNull())
    found = valid.join(counts, "entry", "left")
    zero = F.lit(0).cast("long")
    return found.select(
        "city", "version", "path", "length", "landing",
        F.coalesce("row_count", zero).alias("row_count"),
        F.coalesce("reject_count", zero).alias("reject_count"),
    )
