"""A run over many feeds: every feed is tried, a failing one does not stop the others."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.current import CurrentVersions
from tidemark.plans.journal import AUDIT_COLUMNS, AUDIT_SCHEMA, FINISHED, STARTED, RunJournal, spec_columns
from tidemark.plans.load import incremental_load
from tidemark.sinks.targets import Target
from tidemark.specs import FeedSpec
from tidemark.workspace import delete_folder, intermediates, new_path, written

log = logging.getLogger(__name__)

MAX_CONCURRENT = 8


def feed_reader(
    read_view: Callable[[FeedSpec, str], DataFrame],
    transformations: Mapping[str, Callable[[Callable[[str], DataFrame]], DataFrame]],
) -> Callable[[FeedSpec], DataFrame]:
    """The `read` of `run_feeds` for feeds of both kinds.

    A feed whose statement is the name of a transformation gets what that makes of the source views;
    the transformation is called with a function that reads one of them. Any other statement is read
    as it is. `read_view` reads a statement or view from the feed's source.
    """

    def read(spec: FeedSpec) -> DataFrame:
        if spec.statement in transformations:
            return transformations[spec.statement](lambda view: read_view(spec, view))
        return read_view(spec, spec.statement)

    return read


@contextmanager
def shared_views(
    spark: SparkSession, read_view: Callable[[FeedSpec, str], DataFrame], names: Iterable[str]
) -> Iterator[Callable[[FeedSpec, str], DataFrame]]:
    """A `read_view` that reads each view of `names` once per source, for all feeds of a run made within the block.

    The first feed that asks for such a view writes it to the shared folder; the files are removed at the end.
    """
    names, tables, paths, locks, guard = set(names), {}, [], {}, Lock()

    def read(spec: FeedSpec, view: str) -> DataFrame:
        if view not in names:
            return read_view(spec, view)
        key = (spec.company, spec.server, spec.source_database, view)
        with guard:
            lock = locks.setdefault(key, Lock())
        with lock:
            if key not in tables:
                path = new_path(spark, "view")
                paths.append(path)
                tables[key] = written(read_view(spec, view), path)
        return tables[key]

    try:
        yield read
    finally:
        for path in paths:
            delete_folder(spark, path)


def _run_one(
    spark: SparkSession,
    spec: FeedSpec,
    read: Callable[[FeedSpec], DataFrame],
    target: Callable[[FeedSpec], Target],
    load_id: Callable[[FeedSpec], int],
    land: Callable[[FeedSpec], bool],
    current: Callable[[FeedSpec], CurrentVersions | None],
    journal: RunJournal | None,
    rejects: Target | None,
) -> tuple:
    number, resumed = None, False
    try:
        before = journal.last(spark, spec) if journal else None
        if before and before["status"] in FINISHED:
            return tuple(before[c] for c in AUDIT_COLUMNS)
        resumed = bool(before) and before["load_id"] is not None
        number = before["load_id"] if resumed else load_id(spec)
        if journal:
            journal.record(spark, spec, (*spec_columns(spec), number, None, None, None, None, STARTED, None))
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", spec.label)
        with intermediates(spark):
            result = incremental_load(
                read(spec), target(spec), keys=spec.keys, load_id=number,
                load_col=spec.load_column, delete_first=spec.delete_last or resumed, land=land(spec), current=current(spec),
                rejects=rejects, reject_as=spec.target_table,
            )
        status = "loaded" if result.inserted else "empty"
        counts = (result.retrieved, result.inserted, result.rejected, result.columns)
        error = None
    except Exception as failure:
        log.exception("feed %s failed", spec.label)
        status, counts, error = "failed", (None, None, None, None), f"{type(failure).__name__}: {failure}"
    outcome = (*spec_columns(spec), number, *counts, status, error)
    if journal:
        journal.record(spark, spec, outcome)
    return outcome


def run_feeds(
    spark: SparkSession,
    specs: Iterable[FeedSpec],
    *,
    read: Callable[[FeedSpec], DataFrame],
    target: Callable[[FeedSpec], Target],
    load_id: Callable[[FeedSpec], int],
    land: Callable[[FeedSpec], bool] = lambda spec: True,
    current: Callable[[FeedSpec], CurrentVersions | None] = lambda spec: None,
    journal: RunJournal | None = None,
    rejects: Target | None = None,
    max_concurrent: int = MAX_CONCURRENT,
) -> DataFrame:
    """Load every feed and return the audit, one row per feed.

    `read`, `target` and `load_id` give a feed's batch, target and fresh load id, and `land` tells
    whether to land its batch first (see `incremental_load`). Feeds of one target
    run one after the other, as each must see what the one before appended; different targets are
    submitted from a few driver threads, and Spark's fair scheduler shares the executors among them.

    Rows that a feed marks as unreadable go to `rejects` and are counted in the audit; several targets may share the table
    if it is one with lists of committed loads or partitioned by load id. `current` gives the current versions of a feed's target, if they are kept. With a `journal`, a run that was
    cut short is finished by calling this again: feeds it has as finished are not run again, and the others go on
    under the load ids they began with, after what these left behind is deleted.
    """
    by_target: dict[str, list[FeedSpec]] = {}
    for spec in specs:
        by_target.setdefault(spec.target_table, []).append(spec)

    @inheritable_thread_target(spark)
    def run_target(feeds: list[FeedSpec]) -> list[tuple]:
        return [_run_one(spark, spec, read, target, load_id, land, current, journal, rejects) for spec in feeds]

    with ThreadPoolExecutor(max_workers=max_concurrent) as pool:
        outcomes = [row for rows in pool.map(run_target, by_target.values()) for row in rows]
    return spark.createDataFrame(outcomes, AUDIT_SCHEMA)


def run_summary(audit: DataFrame) -> DataFrame:
    """One row for the run: feeds, failed feeds, rows retrieved and inserted."""
    return audit.agg(
        F.count(F.lit(1)).alias("feeds"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.coalesce(F.sum("retrieved"), F.lit(0)).alias("retrieved"),
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("inserted"),
    )
