"""DuckDB SQL fragments for the oracle side.

These are deliberately written as a *different* derivation from the Spark
plans: plain window functions over whole keys, DuckDB's own aggregates,
and dense cross joins where Spark uses implicit zeros.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

R = 6  # rounding digits, same as registry.DIGITS

LOG_EVENTS = (
    "(SELECT 'f' || CAST(user_id AS VARCHAR) AS \"FileID\", "
    "'c' || json_extract_string(props, '$.k') AS \"CustomerID\", "
    "CAST(floor(epoch(ts)) AS BIGINT) AS \"QueryTs\", "
    "event_type AS \"ProductID\" FROM events)"
)

LOG_LINEITEM = (
    "(SELECT 'f' || CAST(l_partkey AS VARCHAR) AS \"FileID\", "
    "'c' || CAST(o_custkey AS VARCHAR) AS \"CustomerID\", "
    "CAST(floor(epoch(l_shipdate)) AS BIGINT) AS \"QueryTs\", "
    "'s' || CAST(l_suppkey AS VARCHAR) AS \"ProductID\" "
    "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
)

IDS_EVENTS = (
    "(SELECT DISTINCT 'f' || CAST(user_id AS VARCHAR) AS \"FileID\", "
    "CAST(user_id % 4 = 0 AS INTEGER) AS y, "
    "CASE WHEN user_id % 10 < 7 THEN 'train' ELSE 'test' END AS split FROM events)"
)


def q(name: str) -> str:
    return f'"{name}"'


def batched(log: str, n: int) -> str:
    """Log with ``day`` (UTC day index) and ``batch_id`` of n days."""
    return (
        f"(SELECT *, CAST(floor((dense_rank() OVER (ORDER BY day) - 1) / {n}) AS INTEGER) AS batch_id "
        f"FROM (SELECT *, CAST(floor(\"QueryTs\" / 86400) AS BIGINT) AS day FROM {log}))"
    )


def stat_expr(stat: str, x: str) -> str:
    """One statistic of column ``x`` as a DuckDB aggregate (``_mu`` = key mean)."""
    if stat == "sum":
        return f"coalesce(sum({x}), 0)"
    if stat == "size":
        return "count(*)"
    if stat == "count":
        return f"count({x})"
    if stat == "nunique":
        return f"count(DISTINCT {x})"
    if stat == "mean":
        return f"avg({x})"
    if stat == "std":
        # sum (n x - s)^2 / n^2 = sum (x - mean)^2; exact HUGEINT for integers
        return f"CASE WHEN count({x}) > 1 THEN sqrt(CAST(sum((_n * {x} - _s) * (_n * {x} - _s)) AS DOUBLE) / (any_value(_n) * any_value(_n) * (any_value(_n) - 1))) END"
    if stat == "max":
        return f"max({x})"
    if stat == "min":
        return f"min({x})"
    if stat == "median":
        return f"quantile_cont({x}, 0.5)"
    if stat.startswith("percentile_"):
        p = float(stat.split("_", 1)[1]) / 100.0
        return f"quantile_cont({x}, {p})"
    if stat == "skew":
        m2 = f"CAST(sum((_n * {x} - _s) * (_n * {x} - _s)) AS DOUBLE)"
        m3 = f"CAST(sum((_n * {x} - _s) * (_n * {x} - _s) * (_n * {x} - _s)) AS DOUBLE)"
        return (
            f"CASE WHEN count({x}) > 2 AND {m2} > 0 THEN any_value(_n) * sqrt(any_value(_n) - 1) * {m3} "
            f"/ ((any_value(_n) - 2) * ({m2} * sqrt({m2}))) ELSE 0 END"
        )
    if stat == "mad":
        # exact for integer x (HUGEINT sums): sum |n x - s| / n^2
        return f"sum(abs(_n * {x} - _s)) / (any_value(_n) * any_value(_n))"
    raise ValueError(stat)


INT_STATS = {"size", "count", "nunique"}


def stats_sql(
    src: str,
    keys: Sequence[str],
    x: str,
    stats: Sequence[str],
    name: Callable[[str], str] = lambda s: s,
    raw: bool = False,
) -> str:
    """``SELECT keys, stats FROM src GROUP BY keys`` with fill 0 (and rounding
    unless ``raw``, for results that feed further arithmetic)."""
    kq = ", ".join(q(k) for k in keys)
    parts, outer = [], []
    for s in stats:
        e = stat_expr(s, q(x))
        n = q(name(s))
        if s in INT_STATS:
            parts.append(f"CAST({e} AS BIGINT) AS {n}")
            outer.append(n)
        else:
            parts.append(f"coalesce(CAST({e} AS DOUBLE), 0) AS {n}")
            outer.append(n if raw else f"{rnd(n)} AS {n}")
    inner = (
        f"SELECT {kq}, {', '.join(parts)} FROM "
        f"(SELECT *, avg({q(x)}) OVER (PARTITION BY {kq}) AS _mu, "
        f"count({q(x)}) OVER (PARTITION BY {kq}) AS _n, sum({q(x)}) OVER (PARTITION BY {kq}) AS _s FROM {src}) "
        f"GROUP BY {kq}"
    )
    return f"SELECT {kq}, {', '.join(outer)} FROM ({inner})"


MAG_STEPS = 7


def rnd(expr: str) -> str:
    """Magnitude-aware rounding, same ladder as ``registry.round_value``."""
    x = f"CAST({expr} AS DOUBLE)"
    arms = " ".join(
        f"WHEN abs({x}) < {float(10 ** (5 + 2 * i))} THEN round({x}, {R - 2 * i})" for i in range(MAG_STEPS)
    )
    return f"(CASE {arms} ELSE {x} END)"
