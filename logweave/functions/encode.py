"""Fixed value tables of the tabular (housing) toolkit and column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for identical results).
# Ordinal grade maps per housing column; unmapped values become 0.
HOUSING_GRADES = {
    "ExterQual": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "Po": -1},
    "ExterCond": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "Po": -1},
    "BsmtQual": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "NA": 0, "Po": -1},
    "BsmtCond": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "NA": 0, "Po": -1},
    "BsmtExposure": {"Gd": 3, "Av": 2, "Mn": 1, "No": 0, "NA": 0},
    "BsmtFinType1": {"GLQ": 2, "ALQ": 1, "BLQ": 0, "Rec": 1, "LwQ": -1, "Unf": 0, "NA": 0},
    "BsmtFinType2": {"GLQ": 2, "ALQ": 1, "BLQ": 0, "Rec": 1, "LwQ": -1, "Unf": 0, "NA": 0},
    "HeatingQC": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "Po": -1},
    "KitchenQual": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "Po": -1},
    "FireplaceQu": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "NA": 0, "Po": -1},
    "GarageQual": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "NA": 0, "Po": -1},
    "GarageCond": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "NA": 0, "Po": -1},
    "PoolQC": {"Ex": 3, "Gd": 2, "TA": 1, "Fa": 0, "NA": 0, "Po": -1},
    "Fence": {"GdPrv": 2, "MnPrv": 1, "GdWo": 2, "MnWw": 1, "NA": 0},
}
# Imputation strategy per housing column (others: most_frequent).
HOUSING_IMPUTE = {
    "GarageCars": 0,
    "GarageArea": 0,
    "BsmtFinSF2": 0,
    "MSZoning": "most_frequent",
    "BsmtFullBath": "most_frequent",
    "BsmtHalfBath": "most_frequent",
    "BsmtFinSF1": "median",
    "BsmtUnfSF": "median",
    "LotFrontage": "median",
    "MasVnrArea": "median",
    "TotalBsmtSF": "median",
}
# Columns dropped as useless, and the optional wider drop list.
HOUSING_USELESS = ["Id", "GarageYrBlt", "MiscFeature", "Alley"]
HOUSING_DROP = [
    "MiscFeature", "Alley",
    "Id", "BsmtHalfBath", "BsmtFinSF2", "FullBath", "HalfBath", "KitchenAbvGr",
    "Fireplaces", "EnclosedPorch", "3SsnPorch", "ScreenPorch", "PoolArea",
    "MiscVal", "MoSold", "YrSold",
    "Utilities",
]
# Minimum group size for group-wise imputation; variance threshold of the
# housing variant (0.8 * (1 - 0.8)) and of the feature-table variant.
MIN_GROUP_ROWS = 5
HOUSING_VARIANCE_THRESHOLD = 0.8 * (1 - 0.8)
FEATURE_VARIANCE_THRESHOLD = 0.15
# ---------------------------------------------------------------------------


def grade(col: str, mapping: dict) -> Column:
    """H3: map a column through a literal dict; unmapped and NULL -> 0."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, F.col(col)), F.lit(0)).cast("int")
