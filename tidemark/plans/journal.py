"""The states of a run's feeds, written as the run goes, so that a run outlives its driver."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.specs import FeedSpec
from tidemark.workspace import names_in, put_text, read_text

AUDIT_SCHEMA = (
    "target_table string, company string, source_database string, hierarchy int, load_id bigint, "
    "retrieved bigint, inserted bigint, rejected bigint, columns int, status string, error string"
)
AUDIT_COLUMNS = [field.split()[0] for field in AUDIT_SCHEMA.split(", ")]
STARTED = "started"
FINISHED = ("loaded", "empty")


def spec_columns(spec: FeedSpec) -> tuple:
    """What names a feed in the audit and in the journal."""
    return spec.target_table, spec.company, spec.source_database, spec.hierarchy


@dataclass(frozen=True)
class RunJournal:
    """One run's journal: a small file below `path` per feed and state, each written whole or not at all.

    A feed's states are `started`, under the load id it then keeps, and `loaded`, `empty` or `failed`. The files are as
    many as feeds and states, and never depend on rows.
    """

    path: str

    def _name(self, spec: FeedSpec) -> str:
        return hashlib.sha256(json.dumps(spec_columns(spec)).encode()).hexdigest()[:32]

    def _states(self, spark: SparkSession, spec: FeedSpec) -> list[str]:
        return [n for n in names_in(spark, self.path) if n.startswith(self._name(spec))]

    def record(self, spark: SparkSession, spec: FeedSpec, outcome: tuple) -> None:
        """Add a state to a feed; `outcome` is a row of the audit."""
        number = len(self._states(spark, spec)) + 1
        row = {**dict(zip(AUDIT_COLUMNS, outcome)), "state": number}
        if not put_text(spark, f"{self.path}/{self._name(spec)}-{number:06d}.json", json.dumps(row)):
            raise RuntimeError(f"another run writes to the journal {self.path}")

    def last(self, spark: SparkSession, spec: FeedSpec) -> dict | None:
        """A feed's last state, if it has any."""
        states = self._states(spark, spec)
        return json.loads(read_text(spark, f"{self.path}/{states[-1]}")) if states else None

    def states(self, spark: SparkSession) -> DataFrame:
        """All states: the audit's columns, and `state`, a feed's states in order from 1."""
        return spark.read.schema(f"{AUDIT_SCHEMA}, state int").json(self.path)

    def audit(self, spark: SparkSession) -> DataFrame:
        """The last state of every feed, in the form of the audit."""
        row = F.struct("state", *AUDIT_COLUMNS)
        by_feed = self.states(spark).groupBy(*AUDIT_COLUMNS[:4]).agg(F.max_by(row, "state").alias("row"))
        return by_feed.select(*[F.col(f"row.{c}").alias(c) for c in AUDIT_COLUMNS])
