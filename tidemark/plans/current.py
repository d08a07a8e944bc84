"""The current versions of a target: key, load id and hash of the latest rows of every key, ties kept.

A load that compares with them reads as many rows as there are keys, however long the history is. The table says which
committed appends it comprises. Whatever the target has more is merged before the next use, so a crash between an append and
the merge loses nothing; if something it comprises is gone (a deleted or repeated load), it is built from the history again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.versions import latest_per_key
from tidemark.sinks.committed import Committed, CommittedTarget
from tidemark.specs import HASH_COLUMN, LOAD_COLUMN


def _described(entry: Committed) -> list:
    return [entry.folder, sorted(entry.files) if entry.files is not None else None]


@dataclass(frozen=True)
class CurrentVersions:
    """The current versions of `target`, kept below `path`."""

    path: str
    target: CommittedTarget
    keys: tuple[str, ...]
    load_col: str = LOAD_COLUMN
    hash_col: str = HASH_COLUMN

    @classmethod
    def of(cls, target: CommittedTarget, keys: str | Sequence[str], **columns: str) -> CurrentVersions:
        """Kept beside the target's own files."""
        return cls(f"{target.path}/_current", target, (keys,) if isinstance(keys, str) else tuple(keys), **columns)

    @property
    def _names(self) -> list[str]:
        return [*self.keys, self.load_col, self.hash_col]

    @property
    def _table(self) -> CommittedTarget:
        return CommittedTarget(self.path, T.StructType([self.target.schema[n] for n in self._names]))

    def read(self, spark: SparkSession) -> DataFrame:
        """The current versions, brought up to date first."""
        self.refresh(spark)
        return self._table.read(spark)

    def missing(self, spark: SparkSession) -> list[Committed] | None:
        """The target's appends that are not comprised yet; None if the table must be built anew."""
        comprised = self._table.note(spark).get("comprises")
        if comprised is None:
            return None
        there = self.target.committed(spark)
        if any(c not in [_described(t) for t in there] for c in comprised):
            return None
        return [t for t in there if _described(t) not in comprised]

    def refresh(self, spark: SparkSession) -> None:
        """Merge what the target has more, if anything."""
        missing = self.missing(spark)
        if missing is None:
            self.rebuild(spark)
        elif missing:
            there = self.target.committed(spark)
            more = self.target.read_committed(spark, missing).select(*self._names)
            self._put(spark, self._table.read(spark).unionByName(more), there)

    def rebuild(self, spark: SparkSession) -> None:
        """Build the table from the whole history."""
        there = self.target.committed(spark)
        self._put(spark, self.target.read_committed(spark, there).select(*self._names), there)

    def _put(self, spark: SparkSession, rows: DataFrame, there: list[Committed]) -> None:
        latest = latest_per_key(rows, self.keys, self.load_col).hint("rebalance")
        self._table.overwrite(latest, {"comprises": [_described(c) for c in there]})
        self._table.clean(spark, keep=2)  # one before the last stays for readers that have begun
