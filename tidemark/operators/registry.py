"""Numbers for natural keys that never change.

A registry is a table of natural keys and their numbers. Keys it lacks get the next numbers without gaps, in the order asked for;
keys it has keep theirs, so a row added at the source renumbers nothing. Keys compare as in `rows_not_in`: NULL equals NULL.
Only distinct keys are looked up and numbered; rows meet their number in one join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.membership import rows_not_in
from tidemark.operators.numbering import global_row_number
from tidemark.operators.screening import MOST_BYTES, bit_sets, mark_perhaps_known, table_bits
from tidemark.sinks.committed import CommittedTarget

NUMBER = "NUMBER"


@dataclass(frozen=True)
class KeyRegistry:
    """The registry below `path`. One run at a time may add to it."""

    path: str
    schema: T.StructType

    @classmethod
    def of(cls, path: str, keys: DataFrame) -> KeyRegistry:
        """A registry for keys with the columns of `keys`."""
        fields = [T.StructField(f.name, f.dataType) for f in keys.schema.fields]
        return cls(path, T.StructType([*fields, T.StructField(NUMBER, T.LongType())]))

    @property
    def columns(self) -> list[str]:
        return self.schema.names[:-1]

    @property
    def _table(self) -> CommittedTarget:
        return CommittedTarget(self.path, self.schema)

    def read(self, spark: SparkSession) -> DataFrame:
        return self._table.read(spark)

    def register(self, rows: DataFrame, order_by: Sequence[str | Column] = ()) -> int:
        """Number the keys among `rows` that have none yet, and say how many they are.

        They are numbered by the columns of `order_by`, least first within a key, then by the key. The append is seen whole or not at
        all, so a run that is repeated after a failure numbers as the first would have.
        """
        spark = rows.sparkSession
        leading = [F.col(c) if isinstance(c, str) else c for c in order_by]
        named = [f"_order_{i}" for i in range(len(leading))]
        keys = rows.select(*self.columns, *[c.alias(n) for c, n in zip(leading, named)])
        keys = keys.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("_rows"), *[F.min(n).alias(n) for n in named])
        known = self.read(spark)
        new = rows_not_in(keys.drop("_rows"), known, {c: c for c in self.columns})
        numbered = global_row_number(new, named, NUMBER, tie_break=self.columns, distinct_rows=True)
        highest = known.agg(F.max(NUMBER)).first()[0] or 0
        added = numbered.select(*self.columns, (F.col(NUMBER) + highest).alias(NUMBER))
        if count := numbered.count():
            self._table.append(added)
        return count

    def assigned(self, rows: DataFrame, out_col: str, order_by: Sequence[str | Column] = ()) -> DataFrame:
        """`register` and `numbered` at once for rows of which no two have one key.

        Rows that no known key can have are told by bit sets (see `screening`); the others are looked up. All are sorted with those
        without a number in front, so a new key's number is its row's place, and nothing is moved again to meet it.
        """
        spark = rows.sparkSession
        before = self.read(spark)
        highest = before.agg(F.max(NUMBER)).first()[0] or 0
        looked_up = self._looked_up(rows, before)
        placed = global_row_number(
            looked_up, [F.col("_number").isNotNull(), *order_by], "_place", tie_break=self.columns, distinct_rows=True)
        next_number = F.col("_place") + highest
        added = placed.where(F.col("_number").isNull()).select(*self.columns, next_number.alias(NUMBER))
        if not added.isEmpty():
            self._table.append(added)
        return placed.select(F.coalesce("_number", next_number).alias(out_col), *[F.col(f"`{c}`") for c in rows.columns])

    def _looked_up(self, rows: DataFrame, known: DataFrame) -> DataFrame:
        bits = table_bits(known.count())
        # Equal values of different types have different hashes.
        types = {f.name: f.dataType for f in rows.schema.fields}
        if bits // 8 > MOST_BYTES or any(types[f.name] != f.dataType for f in self.schema.fields[:-1]):
            return self.numbered(rows, "_number")
        marked = mark_perhaps_known(rows, bit_sets(known, self.columns, bits), self.columns, bits)
        back = lambda part: part.select(*[F.col("row").getField(c).alias(c) for c in rows.columns])
        new = back(marked.where(~F.col("known"))).select(F.lit(None).cast("long").alias("_number"), "*")
        return new.unionByName(self.numbered(back(marked.where("known")), "_number"))

    def numbered(self, rows: DataFrame, out_col: str) -> DataFrame:
        """`rows` with their keys' numbers in front; a key without a number, as before `register`, gives NULL."""
        known = self.read(rows.sparkSession).toDF(*[f"_known_{i}" for i in range(len(self.columns))], "_number")
        same = [rows[c].eqNullSafe(known[f"_known_{i}"]) for i, c in enumerate(self.columns)]
        joined = rows.join(known, same, "left")
        return joined.select(known["_number"].alias(out_col), *[rows[c] for c in rows.columns])
