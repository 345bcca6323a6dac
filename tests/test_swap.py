"""A table changes as one step, also if a run is killed."""

import pytest
from pyspark.sql import functions as F

from tractscope.sinks import swap, tables

KIND = "city string, year int, n int"
PARTS = ["city", "year"]


def frame(spark, rows):
    return spark.createDataFrame(rows, KIND)


def stored(spark, path):
    rows = tables.read_partitions(spark, path, KIND).select("city", "year", "n").collect()
    return sorted(map(tuple, rows), key=str)


OLD = [("SF", 1, 1), ("SF", 2, 2), ("a/b = c%", None, 3), (None, 1, 4)]
NEW = [("SF", 2, 20), ("a/b = c%", None, 30), ("LA", 5, 50)]


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_partitions(frame(spark, OLD), path, PARTS)
    return path


def test_odd_partition_values(spark, table):
    assert stored(spark, table) == sorted(OLD, key=str)
    tables.replace_partitions(frame(spark, NEW), table, PARTS)
    assert stored(spark, table) == sorted([OLD[0], OLD[3], *NEW], key=str)


def test_owned_partitions_without_rows_go(spark, table):
    owned = F.col("city").isin("SF", "LA") | F.col("city").isNull()
    tables.replace_partitions(frame(spark, NEW), table, PARTS, owned=owned)
    assert stored(spark, table) == sorted(NEW, key=str)
    tables.replace_partitions(frame(spark, []), table, PARTS, owned=F.lit(True))
    assert stored(spark, table) == []


@pytest.mark.parametrize("step", ["write", "commit"])
def test_killed_before_the_journal(spark, table, monkeypatch, step):
    """The old table stays, for any reader, and the next run is not hindered."""

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        if step == "write":
            patch.setattr(swap.Folders, "write", killed)
        else:
            patch.setattr(swap, "commit", killed)
        tables.replace_partitions(frame(spark, NEW), table, PARTS)
    assert stored(spark, table) == sorted(OLD, key=str)
    assert spark.read.parquet(table).count() == len(OLD)
    tables.replace_partitions(frame(spark, NEW), table, PARTS)
    assert stored(spark, table) == sorted([OLD[0], OLD[3], *NEW], key=str)


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_killed_while_folders_move(spark, table, monkeypatch, moves):
    """From the journal on the new table is there; the next reader carries it out."""
    left, real = [moves], swap.Folders.move

    def some(self, inner, to):
        if not left[0]:
            raise RuntimeError("killed")
        left[0] -= 1
        real(self, inner, to)

    with monkeypatch.context() as patch:
        patch.setattr(swap.Folders, "move", some)
        if moves < 3:
            with pytest.raises(RuntimeError):
                tables.replace_partitions(frame(spark, NEW), table, PARTS)
        else:
            tables.replace_partitions(frame(spark, NEW), table, PARTS)
    assert stored(spark, table) == sorted([OLD[0], OLD[3], *NEW], key=str)
    folders = swap.Folders(spark, table)
    assert folders.names("_journal", folders=False) == []
    assert spark.read.parquet(table).count() == 5
