"""Several tables written as one set: all of them become visible at once, or none does.

Each write of a set goes to a folder of its own; when every table is there, one empty file in `_sets` says so. To make that
file is the commit: it is the only step that readers can see, and a file system makes it at once or not at all.
Its name has a number above all others and the set's folder, so a reader finds the newest whole set by a listing,
and a write that ended between two tables leaves the set before it as it was. Sets are never changed;
old ones and the remains of broken writes go by `clean`.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

MARKER = re.compile(r"^(\d{12})\.(.+)\.([0-9a-f]{32})$")


@dataclass(frozen=True)
class Commit:
    """A whole set: its number, the run that wrote it, and its folder's name."""

    number: int
    run_key: str
    attempt: str

    @property
    def marker(self) -> str:
        return f"{self.number:012d}.{self.run_key}.{self.attempt}"

    @property
    def folder(self) -> str:
        return f"{self.run_key}.{self.attempt}"


class TableSets:
    """The sets below a folder that all executors reach; run keys are letters, digits, `-` and `_`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = lambda *parts: path("/".join([self.root, *parts]))
        self._fs = path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        where = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(where)) if self._fs.exists(where) else []

    def commits(self) -> list[Commit]:
        """Whole sets, the oldest first; of two with one number the later by name counts as newer, everywhere alike."""
        found = [m for name in self._names("_sets") if (m := MARKER.match(name))]
        return [Commit(int(m[1]), m[2], m[3]) for m in found]

    def newest(self, run_key: str | None = None) -> Commit | None:
        found = [c for c in self.commits() if run_key is None or c.run_key == run_key]
        return found[-1] if found else None

    def write(self, run_key: str, tables: dict[str, DataFrame]) -> Commit:
        """Write the tables and commit them as one set. A run that is committed already isn't written again: its set is returned."""
        if not re.fullmatch(r"[A-Za-z0-9_-]+", run_key):
            raise ValueError(f"not a run key: {run_key!r}")
        done = self.newest(run_key)
        if done:
            return done
        attempt = uuid.uuid4().hex
        for name, rows in tables.items():
            rows.write.parquet(f"{self.root}/{run_key}.{attempt}/{name}")
        last = self.newest()
        commit = Commit(last.number + 1 if last else 1, run_key, attempt)
        self._fs.mkdirs(self._path("_sets"))
        if not self._fs.createNewFile(self._path("_sets", commit.marker)):
            raise RuntimeError(f"the set {commit.marker} is there already")
        return commit

    def read(self, name: str, commit: Commit | None = None) -> DataFrame:
        """A table of a set, by default of the newest. To read several tables of one set pass its commit."""
        commit = commit or self.newest()
        if commit is None:
            raise LookupError(f"no whole set in {self.root}")
        return self.spark.read.parquet(f"{self.root}/{commit.folder}/{name}")

    def tables(self, commit: Commit | None = None) -> dict[str, DataFrame]:
        commit = commit or self.newest()
        return {name: self.read(name, commit) for name in self._names(commit.folder)} if commit else {}

    def clean(self, keep: int = 2) -> list[str]:
        """Remove all but the newest `keep` sets, markers first, and folders that no marker names; the folders that went.

        Only while nobody writes: a folder without a marker may be a write under way.
        """
        commits = self.commits()
        for old in commits[: max(0, len(commits) - keep)]:
            self._fs.delete(self._path("_sets", old.marker), False)
        kept = {c.folder for c in self.commits()}
        gone = [name for name in self._names("") if name != "_sets" and name not in kept]
        for name in gone:
            self._fs.delete(self._path(name), True)
        return gone
