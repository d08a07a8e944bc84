"""Content hashes of rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Control characters that do not occur in business text, so that ('ab', 'c') and ('a', 'bc'), or NULL
# and '', hash differently.
SEPARATOR = "\x1f"
NULL_MARK = "\x1e"

_DIGESTS = {"sha256": lambda text: F.sha2(text, 256), "sha1": F.sha1, "md5": F.md5}


def _as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def zone_free(df: DataFrame) -> DataFrame:
    """Instants (`timestamp`) as zone-less times in UTC; all other columns as they are.

    An instant turned into text reads differently in every session time zone, and so would its hash. Apply
    this to a frame with such columns before hashing. JDBC sources read zone-less times to begin with.
    """
    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        return df
    utc = lambda c: F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + unix_micros(`{c}`) * INTERVAL '0.000001' SECOND")
    return df.select(*[
        utc(f.name).alias(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def zone_free_views(feed: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Makes a feed read all frames it is given through `zone_free`.

    A feed's hashes are then the same in every session time zone, also where its views are files with instants; else a
    load from a session in another zone would find every row changed.
    """

    @wraps(feed)
    def read(*args, **kwargs):
        free = lambda value: zone_free(value) if isinstance(value, DataFrame) else value
        return feed(*map(free, args), **{name: free(value) for name, value in kwargs.items()})

    return read


def row_hash(*cols: str | Column, algo: str = "sha256") -> Column:
    """Hash of the values of `cols` in order: hex text, or a bigint for `algo="xxhash64"`.

    `xxhash64` is the cheapest, but at billions of rows 64 bits do collide, and a collision hides a
    change. The digests are the safe choice. Columns of instants make the hash depend on the session's
    time zone; pass them through `zone_free` first, as every feed does (see `zone_free_views`).
    """
    columns = [_as_column(c) for c in cols]
    if algo == "xxhash64":
        # Markers keep a NULL from being skipped, which would make (NULL, x) equal to (x, NULL).
        return F.xxhash64(*[part for c in columns for part in (c, c.isNull())])
    if algo not in _DIGESTS:
        raise ValueError(f"unknown hash algorithm {algo!r}")
    text = F.concat_ws(SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(NULL_MARK)) for c in columns])
    return _DIGESTS[algo](text)


def sha1_null_marked(*cols: str | Column, null_as: str = "NA") -> Column:
    """SHA-1 over the bare concatenation, each NULL replaced by `null_as`."""
    return F.sha1(F.concat(*[F.coalesce(_as_column(c).cast("string"), F.lit(null_as)) for c in cols]))


def sha1_null_skipped(*cols: str | Column) -> Column:
    """SHA-1 over the bare concatenation, NULL counting as empty text."""
    return F.sha1(F.concat_ws("", *[_as_column(c).cast("string") for c in cols]))


def hash_to_string(df: DataFrame, hash_col: str = "HASH_VALUE") -> DataFrame:
    """A binary hash column as lower-case hex text; any other type is left as it is."""
    if isinstance(df.schema[hash_col].dataType, T.BinaryType):
        return df.withColumn(hash_col, F.lower(F.hex(F.col(hash_col))))
    return df
