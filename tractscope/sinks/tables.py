"""Partitioned Parquet tables, rewritten per period."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from tractscope.sinks import swap

INCIDENT_PARTITIONS = ["city", "year", "month"]
LOAN_PARTITIONS = ["city", "activity_year"]


def replace_partitions(
    df: DataFrame, path: str, partitions: list[str], sort=(), owned: Column | None = None
) -> None:
    """Write ``df``, replacing the partitions it has rows for.

    ``owned`` is a condition on partition columns: the partitions this run answers for.
    Those of them that have no rows any more are removed, so a corrected source leaves
    nothing behind. All of it takes effect at once (``swap.py``): a run that fails leaves the
    old table, and a rerun of a period one copy of it. The rebalance splits a period with
    very many rows over several tasks and gathers small ones, so files come out of a useful
    size.
    """
    folders, run = swap.Folders(df.sparkSession, path), swap.new_run()
    swap.recover(folders)
    balanced = df.hint("rebalance", *partitions)
    if sort:
        balanced = balanced.sortWithinPartitions(*partitions, *sort)
    ahead = f"{path.rstrip('/')}/{swap.NEXT}/{run}"
    balanced.write.partitionBy(*partitions).parquet(ahead)
    stale = _owned_partitions(df, folders, partitions, owned) if owned is not None else set()
    written = folders.partitions(f"{swap.NEXT}/{run}", len(partitions))
    if not written and stale.issuperset(folders.partitions("", len(partitions))):
        # A table without rows still says what its columns are.
        nowhere = "/".join(f"{name}={swap.NO_VALUE}" for name in partitions)
        df.drop(*partitions).limit(0).write.parquet(f"{ahead}/{nowhere}")
        written = [nowhere]
    swap.commit(folders, run, len(partitions), sorted(stale.difference(written)))


def _owned_partitions(df, folders, partitions, owned) -> set[str]:
    """Partition folders that meet the condition, by their names; no data is read."""
    found = folders.partitions("", len(partitions))
    if not found:
        return set()
    types = dict(df.dtypes)
    rows = [(folder, *swap.values_of(folder)) for folder in found]
    texts = ", ".join(f"`{name}` string" for name in partitions)
    table = df.sparkSession.createDataFrame(rows, f"_folder string, {texts}")
    typed = table.select("_folder", *[F.col(name).cast(types[name]) for name in partitions])
    return {row._folder for row in typed.where(owned).collect()}


def write_incidents(incidents: DataFrame, path: str, owned: Column | None = None) -> None:
    replace_partitions(
        incidents, path, INCIDENT_PARTITIONS, sort=["longitude", "latitude"], owned=owned
    )


def write_loans(loans: DataFrame, path: str, owned: Column | None = None) -> None:
    replace_partitions(loans, path, LOAN_PARTITIONS, owned=owned)


def read_partitions(spark, path: str, schema, **equal) -> DataFrame:
    """The table, or the partitions with the given values; only those are listed.

    Partition values are taken by the declared schema, never guessed from folder names. A
    table that was never written is empty. A change that a killed run has committed is
    carried out first.
    """
    swap.recover(swap.Folders(spark, path))
    try:
        table = spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    for name, value in equal.items():
        table = table.where(F.col(name) == value)
    return table
