"""Feeds with a transformation of their own. A feed without one is its view, read whole.

Each function takes the source views as DataFrames, with the columns their documentation lists, and
gives the columns of the staging table. `as_of` is the time of the load (text, datetime or column) and
`creator` the name put into B_CREATOR.
"""

from tidemark.plans.feeds.communications import communications_feed
from tidemark.plans.feeds.inspections import inspections_feed
from tidemark.plans.feeds.property import blocks_feed, schemes_feed, units_feed
from tidemark.plans.feeds.residents import residents_feed
from tidemark.plans.feeds.survey import (
    attribute_type_feed,
    finding_maxima,
    key_lookup_feed,
    key_value_feed,
    key_value_registry,
    survey_findings,
    survey_rows,
)

__all__ = [
    "attribute_type_feed",
    "blocks_feed",
    "communications_feed",
    "finding_maxima",
    "inspections_feed",
    "key_lookup_feed",
    "key_value_feed",
    "key_value_registry",
    "residents_feed",
    "schemes_feed",
    "survey_findings",
    "survey_rows",
    "units_feed",
]
