"""What columns delimited files have: one scan for the header lines of any number of files.

Rows are then read by position, so a header may end in a delimiter, leave names out or repeat
them; the names are those that Spark's own reader would give.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tractscope.session import new_table_path, write_once

# Files of at most so many, counted, meet the rows by broadcast (a path and a number each).
BROADCAST_FILES = 100_000
# Bytes of a file's beginning that are searched for its header line.
FIRST_BYTES = 8 << 20
# Distinct header lines of one source; every one is a case in the plan.
MOST_HEADERS = 200
CORRUPT = "_corrupt_record"


def text_schema(columns) -> StructType:
    return StructType([StructField(name, StringType()) for name in columns])


def header_census(spark: SparkSession, path) -> DataFrame:
    """(file, line): the header line of every file that has one, as a written table.

    As in Spark's reader that is the first line that is not blank, a byte order mark being no
    part of it. The files are cut into short blocks for this scan, so that only the lines at the
    beginning of each reach Python, whatever its length; nothing of them but the header lines
    leaves the tasks, and nothing is done per file on the driver.
    """
    short = spark.newSession()
    short.conf.set("spark.sql.files.maxPartitionBytes", FIRST_BYTES)

    def first_of_each(batches):
        # A split's rows are in order, so a file's first row is where the file changes.
        last = None
        for batch in batches:
            files = batch.column("file").dictionary_encode()
            codes, names = files.indices.to_numpy(), files.dictionary.to_pylist()
            if not len(codes):
                continue
            first = [0, *((codes[1:] != codes[:-1]).nonzero()[0] + 1).tolist()]
            if names[codes[0]] == last:
                del first[0]
            last = names[codes[-1]]
            yield batch.take(pa.array(first, pa.int64()))

    lines = short.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    starts = lines.where((F.col("file_block_start") == 0) & (F.trim("value") != "")).select(
        F.col("file_path").alias("file"), F.col("value").alias("line")
    )
    found = starts.mapInArrow(first_of_each, "file string, line string")
    table = new_table_path(spark, "headers")
    found.write.parquet(table)
    return spark.read.schema(found.schema).parquet(table)


def header_names(spark: SparkSession, line: str, delimiter: str) -> list[str]:
    """Column names of a header line, as Spark's reader names them: ``_c2`` where a name is
    left out, the position added to names that are repeated."""
    one = spark.sparkContext.parallelize([line], 1)
    return spark.read.option("header", True).option("sep", delimiter).csv(one).columns


def headers_of(spark: SparkSession, census: DataFrame, delimiter: str) -> dict[str, list[str]]:
    """Names for each distinct header line."""
    lines = [r.line for r in census.select("line").distinct().limit(MOST_HEADERS + 1).collect()]
    if len(lines) > MOST_HEADERS:
        raise ValueError(f"more than {MOST_HEADERS} different header lines")
    return {line: header_names(spark, line, delimiter) for line in sorted(lines)}


def positions(width: int) -> list[str]:
    return [f"_p{i}" for i in range(width)]


def read_positions(spark: SparkSession, path, delimiter: str, width: int, corrupt=False) -> DataFrame:
    """Rows below the header lines, as texts ``_p0`` on. Short rows end in nulls, long ones
    lose their end; with ``corrupt`` such a row's whole line is kept as well."""
    names = positions(width) + [CORRUPT] * corrupt
    reader = spark.read.option("header", True).option("sep", delimiter)
    return reader.option("columnNameOfCorruptRecord", CORRUPT).schema(text_schema(names)).csv(path)


def with_header(rows: DataFrame, census: DataFrame, numbers: dict[str, int], name: str) -> DataFrame:
    """``rows`` with the number of their file's header line in ``name``."""
    cases = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])
    files = census.select(F.col("file").alias("_file"), cases[F.col("line")].alias(name))
    if files.count() <= BROADCAST_FILES:
        files = F.broadcast(files)
    # The rows' own column, so that the scan gives it.
    found = rows.withColumn("_file", F.col("_metadata.file_path"))
    return found.join(files, "_file").drop("_file")


def by_header(number: Column, positions_of: list[int]) -> Column:
    """The column at ``positions_of[n]`` where the header has number n: one case for each
    position the column has, not for each header."""
    cases: dict[int, list[int]] = {}
    for n, position in enumerate(positions_of):
        cases.setdefault(position, []).append(n)
    (first, _), *others = cases.items()
    if not others:
        return F.col(f"_p{first}")
    out = F
    for position, numbers in others:
        out = out.when(number.isin(numbers), F.col(f"_p{position}"))
    return out.otherwise(F.col(f"_p{first}"))


def read_by_header(spark: SparkSession, path, delimiter: str) -> DataFrame | None:
    """All columns of all files as texts, by name; None if no file has a header line.

    Files whose columns are in another order are read by their own header. Files with other
    columns are an error. One scan of headers and one of rows serve any number of files.
    """
    census = header_census(spark, path)
    headers = headers_of(spark, census, delimiter)
    if not headers:
        return None
    wanted = next(iter(headers.values()))
    for line, names in headers.items():
        if sorted(names) != sorted(wanted):
            (row,) = census.where(F.col("line") == line).limit(1).collect()
            raise ValueError(f"{row.file} has other columns: {names} instead of {wanted}")
    rows = read_positions(spark, path, delimiter, len(wanted))
    if len(headers) == 1:
        return rows.toDF(*wanted)
    numbers = {line: n for n, line in enumerate(headers)}
    numbered = with_header(rows, census, numbers, "_header")
    at = {name: [names.index(name) for names in headers.values()] for name in wanted}
    return numbered.select(
        *[by_header(F.col("_header"), at[name]).alias(name) for name in wanted]
    )


def reject_reason(line: Column, delimiter: str, width: int) -> Column:
    """Why a line is not a row of ``width`` texts: ``short``, ``long``, or ``quote`` if a quote
    is not closed."""
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1
    return (
        F.when(F.contains(bare, F.lit('"')), "quote")
        .when(found < width, "short")
        .when(found > width, "long")
        .otherwise("quote")
    )


def read_checked(spark: SparkSession, path, delimiter: str) -> tuple[DataFrame, DataFrame]:
    """Rows by name as ``read_by_header`` gives them, and the quarantine: (file, line, reason).

    Rows that do not parse stay among the rows, short ones with nulls, as they do for any
    reader; the quarantine names them, so that they are not lost unseen. The files are parsed
    once, into a written table that both are read from.
    """
    census = header_census(spark, path)
    headers = headers_of(spark, census, delimiter)
    if len({tuple(sorted(names)) for names in headers.values()}) > 1:
        raise ValueError("files with other columns are read one set at a time")
    wanted = next(iter(headers.values()), ["_c0"])
    width = len(wanted)
    parsed = read_positions(spark, path, delimiter, width, corrupt=True)
    numbers = {line: n for n, line in enumerate(headers)} or {"": 0}
    # Only a file's path is looked up, so that header and rows come from one parse.
    kept = parsed.withColumn("_from", F.col("_metadata.file_path"))
    kept = write_once(with_header(kept, census, numbers, "_header"), "parsed")
    at = {name: [names.index(name) for names in headers.values()] or [0] for name in wanted}
    rows = kept.select(*[by_header(F.col("_header"), at[name]).alias(name) for name in wanted])
    bad = kept.where(F.col(CORRUPT).isNotNull()).select(
        F.col("_from").alias("file"),
        F.col(CORRUPT).alias("line"),
        reject_reason(F.col(CORRUPT), delimiter, width).alias("reason"),
    )
    return rows, bad
