"""Tabular preparation as one job: train and test rows together are cleaned,
mapped, encoded and filled, then split again.

``prepare`` is general; ``prepare_housing`` runs it with the housing tables'
fixed values.  Statistics (levels, fills) come from both parts together, and
rows carry their part as a column, so nothing depends on row order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.functions.encode import HOUSING_DROP, HOUSING_GRADES, HOUSING_IMPUTE, HOUSING_USELESS
from logweave.operators import prep as P

PART = "part"


def prepare(
    train: DataFrame,
    test: DataFrame,
    key: str,
    label: str | None = None,
    useless: Sequence[str] = (),
    grades: Mapping[str, Mapping[str, int]] | None = None,
    period: tuple[str, str] | None = None,
    impute: Mapping[str, object] | None = None,
    levels: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """One table of both parts (column ``part``), with ``key`` and ``label``.

    Steps: drop ``useless`` columns, map ordinal grades, combine the ``period``
    columns, encode strings as codes (or, for the columns listed in ``levels``,
    as one 0/1 column per listed level), fill what is missing by the strategies
    in ``impute`` (other columns: most frequent value).
    """
    both = train.withColumn(PART, F.lit("train")).unionByName(test.withColumn(PART, F.lit("test")), allowMissingColumns=True)
    fixed = [key, PART] + ([label] if label else [])
    x = both.drop(*[c for c in useless if c not in fixed])
    x = P.ordinal_map(x, grades or {})
    if period and set(period) <= set(x.columns):
        x = P.combine_period(x, *period)
    for c, vals in (levels or {}).items():
        x = x.withColumns({f"{c}_{v}": F.coalesce(F.col(c) == F.lit(v), F.lit(False)).cast("int") for v in vals}).drop(c)
    body = [c for c in x.columns if c not in fixed]
    x = P.label_encode(x, [c for c in P.string_columns(x) if c in body])
    holes = [c for c, n in P.null_counts(x.select(*body)).items() if n]
    return P.impute_simple(x, {c: (impute or {}).get(c, "most_frequent") for c in holes})


def prepare_housing(train: DataFrame, test: DataFrame, delete: bool = False) -> DataFrame:
    """The housing tables prepared: grades, year and month of sale combined, other
    strings as codes; ``delete`` drops the wider list of columns."""
    drop = [c for c in [*HOUSING_USELESS, *(HOUSING_DROP if delete else [])] if c != "Id"]
    return prepare(
        train, test, "Id", "SalePrice", drop, HOUSING_GRADES, ("YrSold", "MoSold"), HOUSING_IMPUTE
    )
