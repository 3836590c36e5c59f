"""Named queries.  Importing this package registers all of them."""

from logweave.plans import (  # noqa: F401
    counts_plans,
    intervals_plans,
    metrics_plans,
    ml_plans,
    stream_plans,
    table_plans,
    overlap_plans,
    prep_plans,
    sampling_plans,
    sink_plans,
    tensor_plans,
    tfidf_plans,
)
from logweave.plans.registry import ORACLE, QUERIES, RAW

__all__ = ["QUERIES", "ORACLE", "RAW"]
