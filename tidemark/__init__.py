"""tidemark: incremental, hash-compared feed loading on Spark DataFrames."""

from tidemark.specs import FEED_SCHEMA, FeedSpec, feed_counts, feeds_frame, load_specs, select_feeds

__all__ = [
    "FEED_SCHEMA",
    "FeedSpec",
    "feed_counts",
    "feeds_frame",
    "load_specs",
    "select_feeds",
]
