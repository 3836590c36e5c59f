"""Set-valued cells (array columns) with the reference's NULL rules.

For sets that can grow with the data, logweave keeps them long (one row per
member, see ``operators.overlap``); these column functions are for array
cells a user already holds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _empty() -> Column:
    return F.array().cast("array<string>")


def set_union(a, b) -> Column:
    """Union; NULL only when both are NULL, one NULL -> the other."""
    a, b = _c(a), _c(b)
    u = F.array_union(F.coalesce(a, _empty()), F.coalesce(b, _empty()))
    return F.when(a.isNull() & b.isNull(), F.lit(None)).otherwise(F.array_sort(u))


def set_symdiff(a, b) -> Column:
    """Symmetric difference; one NULL -> the other, both NULL -> NULL."""
    a, b = _c(a), _c(b)
    d = F.array_union(F.array_except(a, b), F.array_except(b, a))
    return (
        F.when(a.isNull() & b.isNull(), F.lit(None))
        .when(a.isNull(), F.array_sort(F.array_distinct(b)))
        .when(b.isNull(), F.array_sort(F.array_distinct(a)))
        .otherwise(F.array_sort(d))
    )


def set_intersect(a, b) -> Column:
    """Intersection; any NULL -> NULL."""
    a, b = _c(a), _c(b)
    return F.array_sort(F.array_intersect(a, b))
