"""Registered queries, grouped by the kind of operator they exercise."""

from epitide.plans import (  # noqa: F401
    breakdown_queries,
    corpus_queries,
    mart_queries,
    merge_queries,
    metric_queries,
    place_queries,
    quality_queries,
    repair_queries,
    reshape_queries,
    scalar_queries,
    source_queries,
)
from epitide.plans.registry import REGISTRY, Query, Tables  # noqa: F401
