"""Version history: latest rows per key, comparison by content hash, next load id."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.membership import mark_absent, rows_not_in
from tidemark.specs import HASH_COLUMN, LOAD_COLUMN


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str], version_col: str = LOAD_COLUMN, *, co_located: bool = False
) -> DataFrame:
    """Rows whose version is the highest of their key; all rows tied at it, none without key or version.

    The maxima are aggregated on the map side, so a key with a third of all rows costs one row per
    map task. The rows then meet their maximum in a semi join on key **and** version: the versions of
    a hot key go to different tasks, and AQE can split a partition that is still too large, which it
    could not do for a window over the key.

    `co_located` says that `df` is a table bucketed by the key: the join is then on the key alone, the
    version being compared within it, and neither the maxima nor the join move rows. A task reads one bucket and holds
    one row per key of it, so a hot key costs its bucket's task time and no memory.
    """
    keys = _names(keys)
    known = df.where(_all([F.col(c).isNotNull() for c in [*keys, version_col]]))
    newest = known.groupBy(*keys).agg(F.max(version_col).alias(version_col))
    if co_located:
        newest = newest.toDF(*[f"_newest_{i}" for i in range(len(newest.columns))])
        same = [known[c] == newest[f"_newest_{i}"] for i, c in enumerate(keys)]
        return known.join(newest, _all([*same, known[version_col] >= newest[f"_newest_{len(keys)}"]]), "left_semi")
    return known.join(newest, [*keys, version_col], "left_semi")


def hash_anti_join(
    batch: DataFrame,
    latest: DataFrame,
    hash_col: str = HASH_COLUMN,
    *,
    keys: str | Sequence[str] | None = None,
) -> DataFrame:
    """Rows of `batch` whose hash is not among the hashes of `latest`, repeats within the batch kept.

    A NULL hash matches a NULL hash. By default the hash alone decides, whatever key it belongs to;
    with `keys`, key and hash must both match.
    """
    match_on = [*(_names(keys) if keys else []), hash_col]
    return rows_not_in(batch, latest, {c: c for c in match_on})


def next_load_id(
    target: DataFrame, fallback: DataFrame, load_col: str = LOAD_COLUMN, fallback_col: str | None = None
) -> DataFrame:
    """One row `next_load_id`: one above the highest load id of `target`, or of `fallback` while `target` has none.

    One aggregation over both, so nothing but two maxima per task is moved. With neither, the id is 1.
    """
    own = target.select(F.col(load_col).cast("bigint").alias("_own"))
    other = fallback.select(F.col(fallback_col or load_col).cast("bigint").alias("_other"))
    highest = own.unionByName(other, allowMissingColumns=True).agg(
        F.max("_own").alias("_own"), F.max("_other").alias("_other")
    )
    return highest.select((F.coalesce("_own", "_other", F.lit(0)) + 1).alias("next_load_id"))


def without_load(df: DataFrame, load_id: int, load_col: str = LOAD_COLUMN) -> DataFrame:
    """All rows but those of one load; rows without a load id stay."""
    return df.where(~F.col(load_col).eqNullSafe(F.lit(load_id)))


def mark_new(
    batch: DataFrame, latest: DataFrame, hash_col: str = HASH_COLUMN, out_col: str = "is_new"
) -> DataFrame:
    """Every row of `batch` with a flag that is true where `hash_anti_join` would keep it."""
    return mark_absent(batch, latest, {hash_col: hash_col}, out_col)
