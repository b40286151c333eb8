"""Keyed writes over immutable Parquet: upsert, replace children, delete by key, insert if absent.

A store is a folder of tables. A table's rows are files in folders that nobody changes; which folders are whose says the newest
file of the store's commit log. A write makes new folders and then one new commit, which may concern several tables, so
readers see all of it or nothing, and a crash in between leaves the old state and some folders that no commit names. One
writer at a time; a reader's folders stay for the next `KEEP` commits."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def upserted(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` in place of those with the same keys, besides the rest."""
    return existing.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def replaced(existing: DataFrame, parents: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Children of the parents go, whether or not there are new ones; the new ones come."""
    return existing.join(parents.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def deleted(existing: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows but those whose keys are given; null keys match nothing."""
    return existing.join(gone.select(*keys).distinct(), keys, "left_anti")


def inserted(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` whose keys aren't there yet are added."""
    return existing.unionByName(new.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti"), allowMissingColumns=True)


#: Commits whose folders are kept, and folders of a table from which appending puts them together.
KEEP, MOST_FOLDERS = 50, 64


class Store:
    """The commit log of a folder of tables: numbered files, each with the folders of every table; the newest holds."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._known: dict[int, dict[str, list[str]]] = {}

    def _numbers(self) -> list[int]:
        log = self._path(f"{self.path}/_commits")
        if not self._fs.exists(log):
            return []
        jvm = self.spark.sparkContext._jvm
        names = jvm.org.apache.commons.lang3.ArrayUtils.toString(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(self._fs.listStatus(log)))  # one call for all names
        return sorted(map(int, re.findall(r"/_commits/(\d+)\.json(?=[,}])", names)))

    def _file(self, number: int) -> str:
        return f"{self.path}/_commits/{number:012d}.json"

    def _read(self, number: int) -> dict[str, list[str]]:
        """A commit, by the driver alone: no Spark job."""
        stream = self._fs.open(self._path(self._file(number)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def state(self) -> dict[str, list[str]]:
        numbers = self._numbers()
        return self._read(numbers[-1]) if numbers else {}

    def commit(self, changes: dict[str, list[str]]) -> None:
        """The tables have these folders now, the others what they had. The file gets its name when it is whole."""
        numbers = self._numbers()
        number = numbers[-1] + 1 if numbers else 1
        last = numbers[-1] if numbers else 0
        state = (self._known.get(last) or self._read(last) if last else {}) | changes
        part = self._path(f"{self.path}/_commits/part-{uuid.uuid4().hex}")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        if not self._fs.rename(part, self._path(self._file(number))):
            raise RuntimeError(f"another writer made commit {number} of {self.path}")
        self._known = {n: c for n, c in self._known.items() if n in numbers} | {number: state}
        self._forget([n for n in numbers if n <= number - KEEP])

    def _forget(self, numbers: list[int]) -> None:
        """Old commits go, and of their folders those that no commit left names, be it by a folder above or below."""
        if not numbers:
            return

        def folders(n: int) -> set[str]:
            if n not in self._known:
                self._known[n] = self._read(n)
            return {f for fs in self._known[n].values() for f in fs}

        named = set().union(*(folders(n) for n in self._numbers() if n not in numbers))
        above = {f[:at] for f in named for at in range(len(f)) if f[at] == "/"}
        old = set().union(*map(folders, numbers)) - named - above
        gone = [f for f in sorted(old) if not any(f[:at] in named for at in range(len(f)) if f[at] == "/")]
        for path in (*(f"{self.path}/{f}" for f in gone), *map(self._file, numbers)):
            self._fs.delete(self._path(path), True)


class VersionedTable:
    """A Parquet table of a store: `path` is the store's folder and the table's name."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType | str):
        folder, _, self.name = path.rstrip("/").rpartition("/")
        self.spark, self.store = spark, Store(spark, folder)
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema

    def _frame(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(*[f"{self.store.path}/{f}" for f in folders])

    def read(self) -> DataFrame:
        return self._frame(self.store.state().get(self.name, []))

    def put(self, df: DataFrame) -> str:
        """Rows in a new folder, which a commit may name."""
        folder = f"{self.name}/v-{uuid.uuid4().hex}"
        df.select(*self.schema.fieldNames()).write.parquet(f"{self.store.path}/{folder}")
        return folder

    def put_parts(self, df: DataFrame, by: str) -> str:
        """Rows in a new folder with a folder `by`=value for each value of the whole number `by`. A commit may name some of
        these, or the one above for all of them."""
        folder = f"{self.name}/v-{uuid.uuid4().hex}"
        df.select(*self.schema.fieldNames(), by).write.partitionBy(by).parquet(f"{self.store.path}/{folder}")
        return folder

    def replacing(self, df: DataFrame) -> dict[str, list[str]]:
        """A change for commit(): `df`, which may be made from read(), becomes the table."""
        return {self.name: [self.put(df)]}

    def adding(self, df: DataFrame) -> dict[str, list[str]]:
        """A change for commit(): rows are added; where a table has many folders, all go together into one."""
        folders = self.store.state().get(self.name, [])
        if len(folders) < MOST_FOLDERS:
            return {self.name: [*folders, self.put(df)]}
        return self.replacing(self._frame(folders).unionByName(df.select(*self.schema.fieldNames())))

    def packed(self) -> list[str]:
        """The table's folders; where they are many, a new one with all of its rows, which a commit may name in their place."""
        folders = self.store.state().get(self.name, [])
        return folders if len(folders) < MOST_FOLDERS else [self.put(self._frame(folders))]

    def write(self, df: DataFrame) -> None:
        self.store.commit(self.replacing(df))

    def append(self, df: DataFrame) -> None:
        self.store.commit(self.adding(df))

    def truncate(self) -> None:
        self.store.commit({self.name: []})

    def upsert(self, new: DataFrame, keys: list[str]) -> None:
        self.write(upserted(self.read(), new, keys))
