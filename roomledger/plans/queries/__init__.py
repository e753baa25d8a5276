"""Registered queries: each runs over whole given tables, most with the same result in SQL."""

from roomledger.plans.queries import (  # noqa: F401
    coverage,
    drifting,
    history,
    listings,
    merging,
    pages,
    profiles,
    stores,
    streams,
    texts,
)
from roomledger.plans.queries.registry import QUERIES, SQL  # noqa: F401
