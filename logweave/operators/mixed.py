"""Features from raw tables with numbers, strings and NULLs.

One pass over the table decides per column: a number (numeric type, or strings
that all parse) or levels.  Levels become indicators in a sparse vector, so any
number of levels fits a row; NULL has an indicator of its own where it occurs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from logweave.operators.cluster import rf_proximity


def _q(c: str):
    return F.col(f"`{c}`")


#: Stands for NULL among the levels of a column (text has "=" before it, as the
#: encoder takes no empty level); sorts after all text.
NULL_LEVEL = "\U0010ffff"


def type_probe(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[str, bool]]:
    """``{column: (kind, has_null)}`` in one pass: kind ``number`` or ``levels``.

    A column of strings is a number if every non-NULL value parses (one without
    values is, too); NaN counts as a number."""
    types = {f.name: f.dataType for f in df.schema.fields}
    number = {c for c in cols if isinstance(types[c], (NumericType, BooleanType))}
    aggs = []
    for k, c in enumerate(cols):
        aggs.append(F.coalesce(F.bool_or(_q(c).isNull()), F.lit(False)).alias(f"n{k}"))
        text = _q(c).cast("string")
        bad = F.lit(False) if c in number else text.isNotNull() & text.try_cast("double").isNull()
        aggs.append(F.coalesce(F.bool_or(bad), F.lit(False)).alias(f"b{k}"))
    row = df.agg(*aggs).first()
    return {c: ("levels" if row[f"b{k}"] else "number", row[f"n{k}"]) for k, c in enumerate(cols)}


def mixed_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> tuple[DataFrame, list[str]]:
    """Adds a vector of ``cols`` and names its entries.

    Numbers are one entry (NULL as 0 with an entry ``<col>_null`` of 1); levels one
    entry each but for the first in order, as ``<col>_<level>``, and ``<col>_null``."""
    kinds = type_probe(df, cols)
    work, parts, coded, plain = df, [], [], {}
    for k, c in enumerate(cols):
        kind, has_null = kinds[c]
        if kind == "number":
            work = work.withColumn(f"__n{k}", F.coalesce(_q(c).cast("string").try_cast("double"), F.lit(0.0)))
            parts.append((c, f"__n{k}", None))
            if has_null:
                work = work.withColumn(f"__e{k}", _q(c).isNull().cast("double"))
                parts.append((c, f"__e{k}", "null"))
        else:
            work = work.withColumn(f"__s{k}", F.coalesce(F.concat(F.lit("="), _q(c).cast("string")), F.lit(NULL_LEVEL)))
            coded.append(k)
            parts.append((c, f"__v{k}", "levels"))
            plain[c] = f"__i{k}"
    stages = []
    if coded:
        # Falling order: the encoder drops the last index, the first level in order.
        stages.append(StringIndexer(inputCols=[f"__s{k}" for k in coded], outputCols=[f"__i{k}" for k in coded], stringOrderType="alphabetDesc"))
        stages.append(OneHotEncoder(inputCols=[f"__i{k}" for k in coded], outputCols=[f"__v{k}" for k in coded], dropLast=True))
    stages.append(VectorAssembler(inputCols=[p[1] for p in parts], outputCol=out))
    model = Pipeline(stages=stages).fit(work)
    labels = dict(zip(coded, model.stages[0].labelsArray, strict=True)) if coded else {}
    names = []
    for c, column, kind in parts:
        if kind == "levels":
            names += [f"{c}_{'null' if v == NULL_LEVEL else v[1:]}" for v in labels[int(column[3:])][:-1]]
        else:
            names.append(c if kind is None else f"{c}_null")
    return model.transform(work).select(*[_q(c) for c in df.columns], out), names


def proximity(df: DataFrame, label: str, target: str, cols: Sequence[str], trees: int = 10, seed: int = 42) -> DataFrame:
    """L4 from a raw table: forest proximity between labels on mixed features."""
    features, _ = mixed_features(df.withColumn("__target", _q(target).cast("double")), cols, "__features")
    return rf_proximity(features, label, "__target", "__features", trees, seed)
