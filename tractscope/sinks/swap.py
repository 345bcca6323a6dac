"""Partition folders of a table, exchanged as one step.

New partitions are written beside the table, under a name that readers pass over. Then one
small file, the journal, says which folders take the place of which: with it the change has
happened. The folders are moved after that. A run that is killed before the journal is there
leaves the old table; one that is killed later leaves a journal, which the next reader or
writer carries out to its end. A folder that has been moved is not moved twice.
"""

import json
import re
import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession

NEXT, JOURNAL = "_next", "_journal"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Folders:
    """The file system below a path, as Hadoop knows it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, inner: str):
        path = f"{self.root}/{inner}" if inner else self.root
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, inner: str) -> bool:
        return self.fs.exists(self.at(inner))

    def names(self, inner: str, folders=True) -> list[str]:
        """Names of the folders, or of the files, in a folder; none if it is absent."""
        if not self.exists(inner):
            return []
        found = self.fs.listStatus(self.at(inner))
        return sorted(s.getPath().getName() for s in found if s.isDirectory() == folders)

    def partitions(self, inner: str, depth: int) -> list[str]:
        """Partition folders ``a=1/b=2`` below a folder."""
        found = [""]
        for _ in range(depth):
            found = [
                f"{above}/{name}".lstrip("/")
                for above in found
                for name in self.names(f"{inner}/{above}".strip("/"))
                if re.match(r"[^_.][^=]*=", name)
            ]
        return found

    def write(self, inner: str, text: str) -> None:
        """A small file that is there whole or not at all."""
        draft = f"{inner}.draft"
        stream = self.fs.create(self.at(draft), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.rename(self.at(draft), self.at(inner)):
            raise OSError(f"cannot write {inner} in {self.root}")

    def read(self, inner: str) -> str:
        stream = self.fs.open(self.at(inner))
        text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        return text

    def delete(self, inner: str) -> None:
        self.fs.delete(self.at(inner), True)

    def move(self, inner: str, to: str) -> None:
        """Put a folder in the place of another; nothing if it has been moved before."""
        if not self.exists(inner):
            return
        self.delete(to)
        self.fs.mkdirs(self.at(to).getParent())
        if not self.fs.rename(self.at(inner), self.at(to)):
            raise OSError(f"cannot move {inner} to {to} in {self.root}")


def values_of(partition: str) -> list[str | None]:
    """Texts of the values of ``a=1/b=2``."""
    found = [unquote(step.partition("=")[2]) for step in partition.split("/")]
    return [None if value == NO_VALUE else value for value in found]


def new_run() -> str:
    return uuid.uuid4().hex


def commit(folders: Folders, run: str, depth: int, cleared: list[str]) -> None:
    """Let the partitions written under ``_next/run`` take their places, and empty others."""
    replaced = folders.partitions(f"{NEXT}/{run}", depth)
    folders.write(f"{JOURNAL}/{run}", json.dumps({"replaced": replaced, "cleared": cleared}))
    finish(folders, run)


def finish(folders: Folders, run: str) -> None:
    """Carry out a journal; doing it again changes nothing."""
    change = json.loads(folders.read(f"{JOURNAL}/{run}"))
    for partition in change["cleared"]:
        folders.delete(partition)
    for partition in change["replaced"]:
        folders.move(f"{NEXT}/{run}/{partition}", partition)
    folders.delete(f"{NEXT}/{run}")
    folders.delete(f"{JOURNAL}/{run}")


def recover(folders: Folders) -> None:
    """Finish what a killed run has committed."""
    for run in folders.names(JOURNAL, folders=False):
        if not run.endswith(".draft"):
            finish(folders, run)
