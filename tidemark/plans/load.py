"""The incremental load: append what is new or changed since the latest load of every key."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.cleaning import nan_to_null
from tidemark.functions.decoding import unused_name
from tidemark.functions.hashing import hash_to_string
from tidemark.operators.projection import stamp_load_id
from tidemark.operators.versions import hash_anti_join, latest_per_key, mark_new
from tidemark.operators.screening import screened_rows_not_in
from tidemark.plans.current import CurrentVersions
from tidemark.plans.rejects import REJECTS, accepted, rejected
from tidemark.sinks.committed import CommittedTarget
from tidemark.sinks.targets import TableTarget, Target, append_by_name, count_load, delete_load
from tidemark.specs import HASH_COLUMN, LOAD_COLUMN
from tidemark.workspace import landed

MATCH_ON = ("hash", "key_hash")


def _with_columns_named(df: DataFrame, names: Sequence[str], what: str) -> DataFrame:
    """`df` with its columns of these names, in whatever case, spelt as given; a missing one is an error."""
    found = {c.lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in found]
    if missing:
        raise ValueError(f"the {what} lacks the columns {missing}")
    return df.withColumnsRenamed({found[n.lower()]: n for n in names if found[n.lower()] != n})


def incremental_rows(
    batch: DataFrame,
    target: DataFrame,
    *,
    keys: str | Sequence[str],
    load_id: int,
    load_col: str = LOAD_COLUMN,
    hash_col: str = HASH_COLUMN,
    match_on: str = "hash",
    current: bool = False,
    co_located: bool = False,
    screened: bool = False,
) -> DataFrame:
    """The rows a load would append: stamped with the load id, hash not among the target's latest, NaN as NULL.

    The hash gets the type it has in the target, a binary one becoming hex text.
    With `match_on="hash"` a row is also dropped when another key's latest row has its hash; with
    "key_hash" only its own key's latest row counts, and a row whose key is NULL has none: it is appended by every
    load. Rows deleted at the source are not detected. `current` says that `target` has the latest rows only
    (see `plans.current`), `co_located` that it is a table bucketed by the keys, and `screened` keeps rows that are certainly new out of the join's shuffle (see
    `operators.screening`).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if match_on not in MATCH_ON:
        raise ValueError(f"match_on must be one of {MATCH_ON}")
    batch = _with_columns_named(batch, [*keys, hash_col], "batch")
    target = _with_columns_named(target, [*keys, load_col, hash_col], "target")
    stamped = hash_to_string(stamp_load_id(batch, load_id, load_col), hash_col)
    # Only key, load id and hash are read from the target.
    history = hash_to_string(target.select(*keys, load_col, hash_col), hash_col)
    stored = history.schema[hash_col].dataType
    if stamped.schema[hash_col].dataType != stored:
        stamped = stamped.withColumn(hash_col, F.col(hash_col).cast(stored))
    latest = history if current else latest_per_key(history, keys, load_col, co_located=co_located)
    match_keys = keys if match_on == "key_hash" else []
    if screened:
        return nan_to_null(screened_rows_not_in(stamped, latest, [*match_keys, hash_col]))
    return nan_to_null(hash_anti_join(stamped, latest, hash_col, keys=match_keys or None))


@dataclass(frozen=True)
class LoadResult:
    """What one load did."""

    load_id: int
    retrieved: int
    inserted: int
    columns: int
    rejected: int = 0


def incremental_load(
    batch: DataFrame,
    target: Target,
    *,
    keys: str | Sequence[str],
    load_id: int,
    load_col: str = LOAD_COLUMN,
    hash_col: str = HASH_COLUMN,
    match_on: str = "hash",
    delete_first: bool = False,
    land: bool = True,
    current: CurrentVersions | None = None,
    screened: bool = False,
    rejects: Target | None = None,
    reject_as: str = "",
) -> LoadResult:
    """Append the new and changed rows of `batch` to `target`, and count them.

    The batch is landed as a table first, so the source is queried once, and the counts are of the
    very rows compared. They come from the written files rather than from counters kept by tasks,
    which would count twice when a lost task is run again. `land=False` skips this for a source that
    is cheap to read twice and does not change. `delete_first` removes an earlier attempt with the
    same load id, such as one that failed half-way; without it, a used id is an error. With `current`, the
    target's current versions stand for its history and comprise the load afterwards. Rows that the batch
    marks as unreadable (see `plans.rejects`) go to `rejects`, under the name `reject_as`, and are not loaded; without
    `rejects` they are an error.
    """
    spark = batch.sparkSession
    if current is not None and (current.target.path != getattr(target, "path", None) or
                                (list(current.keys), current.load_col, current.hash_col) !=
                                ([keys] if isinstance(keys, str) else list(keys), load_col, hash_col)):
        raise ValueError("the current versions are of another target or of other columns")
    if delete_first:
        delete_load(spark, target, load_id, load_col)
    if any(f.name.lower() == hash_col.lower() and isinstance(f.dataType, T.BinaryType)
           for f in target.columns(spark).fields):
        raise ValueError(f"the target must store {hash_col} as text or number: binary hashes are loaded as hex text")
    if count_load(spark, target, load_id, load_col):
        raise ValueError(f"load {load_id} already has rows in the target")

    with landed(batch, f"landed-{load_id}") if land else nullcontext(batch) as rows:
        turned_down = 0
        if REJECTS in rows.columns:
            turned_down = rows.where(F.size(REJECTS) > 0).count()
            if turned_down and rejects is None:
                raise ValueError(f"{turned_down} rows cannot be read, and there is no reject table")
            if rejects is not None:
                key_names = [keys] if isinstance(keys, str) else list(keys)
                if delete_first:
                    _take_back(spark, rejects, reject_as, load_id)
                append_by_name(rejected(rows, key_names, reject_as, load_id), rejects)
        fresh = incremental_rows(
            accepted(rows) if REJECTS in rows.columns else rows, target.read(spark) if current is None else current.read(spark), keys=keys, load_id=load_id,
            load_col=load_col, hash_col=hash_col, match_on=match_on, current=current is not None, screened=screened,
            co_located=isinstance(target, TableTarget) and target.bucketed_by(spark) == tuple(
                [keys] if isinstance(keys, str) else keys),
        )
        # Few rows usually survive out of many tasks; rebalancing them makes a few well-filled files.
        append_by_name(fresh.hint("rebalance"), target.for_load(load_id) if isinstance(target, CommittedTarget) else target)
        retrieved = rows.count()
    if current is not None:
        current.refresh(spark)
    inserted = count_load(spark, target, load_id, load_col)
    return LoadResult(load_id, retrieved, inserted, len(fresh.columns), turned_down)


def _take_back(spark: SparkSession, rejects: Target, reject_as: str, load_id: int) -> None:
    """Remove the rejects of an earlier attempt, if it left any; load ids are not shared by tables of one reject table."""
    if count_load(spark, rejects, load_id) and rejects.read(spark).where(
            (F.col(LOAD_COLUMN) == load_id) & (F.col("TARGET_TABLE") == reject_as)).limit(1).count():
        delete_load(spark, rejects, load_id)


def load_counts(batch: DataFrame, latest: DataFrame, by: Sequence[str], *, hash_col: str = HASH_COLUMN) -> DataFrame:
    """Rows retrieved and rows a load would insert, per value of `by`, without loading. One pass over the batch."""
    flag = unused_name(batch, "_new")
    marked = mark_new(batch, latest, hash_col, flag)
    return marked.groupBy(*by).agg(
        F.count(F.lit(1)).alias("retrieved"),
        F.count_if(flag).alias("inserted"),
    )
