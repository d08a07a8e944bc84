"""Feed definitions: what is loaded, from where, into which table, and in which order it is promoted."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOAD_COLUMN = "B_LOADID"
HASH_COLUMN = "HASH_VALUE"
DEFAULT_PARTS = 32

FEED_SCHEMA = T.StructType([
    T.StructField("target_table", T.StringType(), False),
    T.StructField("company", T.StringType(), False),
    T.StructField("hierarchy", T.IntegerType(), False),
    T.StructField("server", T.StringType(), True),
    T.StructField("source_database", T.StringType(), True),
    T.StructField("load_column", T.StringType(), False),
    T.StructField("statement", T.StringType(), True),
    T.StructField("primary_key", T.StringType(), False),
    T.StructField("delete_last", T.BooleanType(), False),
    T.StructField("split_column", T.StringType(), True),
    T.StructField("split_parts", T.IntegerType(), True),
    T.StructField("split_lower", T.StringType(), True),
    T.StructField("split_upper", T.StringType(), True),
])


@dataclass(frozen=True)
class FeedSpec:
    """One feed. `statement` is the SQL text or view to read; a composite key is written `a,b`.

    With a `split_column` the source is read in `split_parts` parts: by ranges where both bounds are given, else by
    the column's hash.
    """

    target_table: str
    company: str
    hierarchy: int
    primary_key: str
    server: str | None = None
    source_database: str | None = None
    statement: str | None = None
    load_column: str = LOAD_COLUMN
    delete_last: bool = False
    split_column: str | None = None
    split_parts: int | None = None
    split_lower: str | None = None
    split_upper: str | None = None

    def __post_init__(self) -> None:
        if self.split_column is not None and self.split_parts is None:
            object.__setattr__(self, "split_parts", DEFAULT_PARTS)

    @property
    def keys(self) -> list[str]:
        return [key.strip() for key in self.primary_key.split(",")]

    @property
    def label(self) -> str:
        return f"{self.hierarchy}_{self.target_table}_{self.source_database}"


def feeds_frame(spark: SparkSession, specs: Iterable[FeedSpec]) -> DataFrame:
    """The specs as a DataFrame of `FEED_SCHEMA`."""
    rows = [tuple(getattr(spec, name) for name in FEED_SCHEMA.names) for spec in specs]
    return spark.createDataFrame(rows, FEED_SCHEMA)


def load_specs(feeds: DataFrame) -> list[FeedSpec]:
    """Specs from a feed table (one row per feed, so tens of rows), in promotion order. Optional columns may be missing."""
    given = set(feeds.columns)
    columns = [
        F.col(f.name) if f.name in given or not f.nullable else F.lit(None).cast(f.dataType).alias(f.name)
        for f in FEED_SCHEMA.fields
    ]
    ordered = feeds.select(*columns).orderBy("hierarchy", "target_table", "source_database")
    return [FeedSpec(**row.asDict()) for row in ordered.toLocalIterator()]


def select_feeds(feeds: DataFrame, companies: Sequence[str], excluded_databases: Sequence[str] = ()) -> DataFrame:
    """Feeds of the given companies, less the excluded databases. A feed without a database is kept."""
    chosen = feeds.where(F.col("company").isin(*companies))
    if excluded_databases:
        excluded = F.coalesce(F.col("source_database").isin(*excluded_databases), F.lit(False))
        chosen = chosen.where(~excluded)
    return chosen


def feed_counts(feeds: DataFrame, total_label: str = "TOTAL") -> DataFrame:
    """Feeds per company and in all, from one aggregation."""
    return (
        feeds.rollup("company")
        .agg(F.count(F.lit(1)).alias("feeds"), F.grouping("company").alias("_total"))
        .select(
            F.when(F.col("_total") == 1, F.lit(total_label)).otherwise(F.col("company")).alias("company"),
            "feeds",
        )
    )
