"""Compare a Spark result with the SQL result as multisets of rows, columns by name."""

import datetime
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def multiset(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(row[i]).__name__, _plain(row[i])) for i in order) for row in rows)


def compare(df, con, sql):
    """None if equal, else a short description of the difference."""
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    wanted_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} instead of {sorted(names)}"
    found = multiset(df.collect(), df.columns)
    wanted = multiset(wanted_rows, names)
    if found == wanted:
        return None
    extra, missing = list((found - wanted).items())[:2], list((wanted - found).items())[:2]
    return f"{found.total()} rows, wanted {wanted.total()}; extra {extra}; missing {missing}"
