"""A target whose files are seen only through lists of committed loads.

An append writes files to a folder of its own and then puts a new list beside the older ones. Readers take the newest
list and read what it names, so they see all of a load or nothing of it: what a failed or running write leaves is named by no
list. A load that is tried again takes the place of its earlier attempt in the same list. Deleting a load rewrites only the
files that hold rows of it, and no reader finds the target without rows meanwhile.

A list names folders, or single files of a folder once others were taken out, so it is as long as there are loads and
not as the table. Replaced files stay for readers that have begun; `clean` removes them. As for every target, one
writer at a time is a precondition; a second one that comes between is noticed where the file system does not
replace a file by renaming, and its list is built upon.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.versions import without_load
from tidemark.workspace import delete_folder, empty_frame, names_in, put_text, read_text

LISTS = "_loads"
DIGITS = 12


@dataclass(frozen=True)
class Committed:
    """Files of one append: a folder, or some files of it, and the load they belong to where that is known."""

    folder: str
    load: int | None = None
    files: tuple[str, ...] | None = None


@dataclass(frozen=True)
class CommittedTarget:
    """A folder of parquet files with lists of committed loads. With `load`, appends belong to that load."""

    path: str
    schema: T.StructType
    load: int | None = None

    def for_load(self, load_id: int) -> CommittedTarget:
        """The target for one load: what it appends, rows with that load id only, replaces an earlier attempt of the load."""
        return replace(self, load=load_id)

    def version(self, spark: SparkSession) -> int:
        """The number of the newest list, 0 if there is none."""
        return max((int(n.partition(".")[0]) for n in names_in(spark, f"{self.path}/{LISTS}") if n.endswith(".json") and n[0] != "."), default=0)

    def committed(self, spark: SparkSession, version: int | None = None) -> list[Committed]:
        """What a list names, by default the newest."""
        return self._list(spark, version)[0]

    def note(self, spark: SparkSession) -> dict:
        """What the newest list says besides, for the sake of its writer."""
        return self._list(spark, None)[1]

    def _list(self, spark: SparkSession, version: int | None) -> tuple[list[Committed], dict]:
        number = self.version(spark) if version is None else version
        if not number:
            return [], {}
        found = json.loads(read_text(spark, self._list_path(number)))
        return [Committed(c["folder"], c["load"], tuple(c["files"]) if c["files"] is not None else None) for c in found["committed"]], found["note"]

    def _list_path(self, number: int) -> str:
        return f"{self.path}/{LISTS}/{number:0{DIGITS}d}.json"

    def exists(self, spark: SparkSession) -> bool:
        return self.version(spark) > 0

    def columns(self, spark: SparkSession) -> T.StructType:
        return self.schema

    def read(self, spark: SparkSession) -> DataFrame:
        return self.read_committed(spark, self.committed(spark))

    def read_committed(self, spark: SparkSession, committed: list[Committed]) -> DataFrame:
        """The rows of some appends."""
        paths = [p for c in committed for p in self._paths(c)]
        return spark.read.schema(self.schema).parquet(*paths) if paths else empty_frame(spark, self.schema)

    def _paths(self, committed: Committed) -> list[str]:
        folder = f"{self.path}/{committed.folder}"
        return [folder] if committed.files is None else [f"{folder}/{name}" for name in committed.files]

    def append(self, df: DataFrame) -> None:
        new = self._write(df)
        own = lambda c: self.load is not None and c.load == self.load
        self._commit(df.sparkSession, lambda there: [*[c for c in there if not own(c)], new])

    def overwrite(self, df: DataFrame, note: dict | None = None) -> None:
        """Replace all rows by those of `df`, which may read this target."""
        new = self._write(df)
        self._commit(df.sparkSession, lambda there: [new], note)

    def _write(self, df: DataFrame) -> Committed:
        folder = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return Committed(folder, self.load)

    def _commit(self, spark: SparkSession, change: Callable[[list[Committed]], list[Committed]], note: dict | None = None) -> None:
        while True:
            number = self.version(spark)
            entries = [{"folder": c.folder, "load": c.load, "files": c.files} for c in change(self.committed(spark, number))]
            if put_text(spark, self._list_path(number + 1), json.dumps({"committed": entries, "note": note or {}})):
                return

    def count_load(self, spark: SparkSession, load_id: int, load_col: str) -> int:
        """Rows of a load; appends that belong to another load are not read."""
        perhaps = [c for c in self.committed(spark) if c.load in (None, load_id)]
        return self.read_committed(spark, perhaps).where(F.col(load_col) == F.lit(load_id)).count() if perhaps else 0

    def drop_load(self, spark: SparkSession, load_id: int, load_col: str) -> bool:
        """Take a load out. Its own appends go as they are; of appends without a load, the files with rows of it are written anew."""
        there = self.committed(spark)
        others = [c for c in there if c.load != load_id]
        unknown = [c for c in others if c.load is None]
        touched = set()
        if unknown:
            rows = self.read_committed(spark, unknown)
            holding = rows.where(F.col(load_col) == F.lit(load_id)).select(F.col("_metadata.file_name").alias("name")).distinct()
            touched = {r["name"] for r in holding.collect()}  # names of files only
        kept, hit = [], []
        for entry in others:
            if entry.load is not None or not touched:
                kept.append(entry)
                continue
            names = entry.files if entry.files is not None else self._data_files(spark, entry.folder)
            if touched.isdisjoint(names):
                kept.append(entry)
                continue
            hit.append(replace(entry, files=tuple(n for n in names if n in touched)))
            if left := tuple(n for n in names if n not in touched):
                kept.append(replace(entry, files=left))
        if hit:
            rest = replace(self, load=None)._write(without_load(self.read_committed(spark, hit), load_id, load_col))
            kept.append(rest)

        def change(now: list[Committed]) -> list[Committed]:
            if now != there:
                raise RuntimeError(f"another writer changed {self.path} while load {load_id} was deleted")
            return kept

        if kept != there:
            self._commit(spark, change)
        return True

    def _data_files(self, spark: SparkSession, folder: str) -> list[str]:
        return [n for n in names_in(spark, f"{self.path}/{folder}") if n[0] not in "._"]

    def clean(self, spark: SparkSession, keep: int = 1) -> None:
        """Remove the files that none of the newest `keep` lists names, and older lists. No write may be running."""
        newest = self.version(spark)
        first = max(1, newest - keep + 1)
        named: dict[str, set[str] | None] = {}
        for number in range(first, newest + 1):
            for entry in self.committed(spark, number):
                before = named.get(entry.folder, set())
                named[entry.folder] = None if entry.files is None or before is None else before | set(entry.files)
        for folder in names_in(spark, self.path):
            if folder.startswith("data-"):
                if folder not in named:
                    delete_folder(spark, f"{self.path}/{folder}")
                elif named[folder] is not None:
                    for name in set(self._data_files(spark, folder)) - named[folder]:
                        delete_folder(spark, f"{self.path}/{folder}/{name}")
        for name in names_in(spark, f"{self.path}/{LISTS}"):
            if name[0] == "." or int(name.partition(".")[0]) < first:
                delete_folder(spark, f"{self.path}/{LISTS}/{name}")
