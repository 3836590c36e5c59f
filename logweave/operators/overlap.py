"""Train / test overlap of products, customers and (product, customer) pairs.

Sets are long tables: ``(split, ProductID)``, ``(split, CustomerID)``,
``(split, ProductID, CustomerID)``, all kinds built from one pass over the
log.  Comparing train and test is one ``groupBy`` with a side bit
(``bit_or``), so intersection and symmetric difference cost one shuffle
and no group is ever collected into an array.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.session import kept_table

KINDS = {"product": ["ProductID"], "customer": ["CustomerID"], "prod_cus": ["ProductID", "CustomerID"]}


def split_log(log: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of listed files with their split; rows with any NULL dropped."""
    return log.join(ids.select("FileID", "split"), "FileID").dropna()


def train_test_sets(log: DataFrame, ids: DataFrame, kinds: Sequence[str] = tuple(KINDS)) -> dict[str, DataFrame]:
    """Distinct members per split, one long table per kind.

    All kinds come from one scan: the distinct pairs are kept, products and customers
    are the distinct ones of those.
    """
    s = split_log(log, ids)
    if len(kinds) > 1:
        s = kept_table(s.select("split", *KINDS["prod_cus"]).distinct(), "pairs")
    return {k: s.select("split", *KINDS[k]) if k == "prod_cus" and len(kinds) > 1 else s.select("split", *KINDS[k]).distinct() for k in kinds}


def compare_sets(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, side)`` with side ``both`` / ``left`` / ``right`` in one shuffle."""
    u = left.select(*keys, F.lit(1).alias("_b")).unionByName(right.select(*keys, F.lit(2).alias("_b")))
    g = u.groupBy(*keys).agg(F.bit_or("_b").alias("_bits"))
    side = F.when(F.col("_bits") == 3, "both").when(F.col("_bits") == 1, "left").otherwise("right")
    return g.select(*keys, side.alias("side"))


def _sides(t: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, _bits)``: 1 = train only, 2 = test only, 3 = both (one shuffle)."""
    bits = F.when(F.col("split") == "train", 1).otherwise(2)
    return t.groupBy(*keys).agg(F.bit_or(bits).alias("_bits"))


def overlap(sets: dict[str, DataFrame], kind: str, reverse: bool = False) -> DataFrame:
    """Common (intersection) or uncommon (symmetric difference) members.

    For ``prod_cus`` only products present on both sides take part (the
    reference joins the per-product sets with ``join='inner'`` first); then
    per product the customer sets are intersected or differenced.
    """
    keys = KINDS[kind]
    g = _sides(sets[kind], keys)
    both = F.col("_bits") == 3
    if not reverse:
        return g.where(both).select(*keys)
    out = g.where(~both)
    if kind == "prod_cus":
        prods = _sides(sets[kind], ["ProductID"]).where(both).select("ProductID")
        out = out.join(prods, "ProductID", "left_semi")
    return out.select(*keys)


def per_product_sets(sets: dict[str, DataFrame], op: str) -> DataFrame:
    """G1-G3 on long sets: per product, ``union`` / ``symdiff`` / ``intersect``
    of the train and test customer sets (a product missing on one side
    counts as a NULL set: union and symdiff return the other side,
    intersect returns nothing)."""
    keys = ["ProductID", "CustomerID"]
    g = _sides(sets["prod_cus"], keys)
    both = F.col("_bits") == 3
    if op == "union":
        return g.select(*keys)
    if op == "intersect":
        return g.where(both).select(*keys)
    if op == "symdiff":
        return g.where(~both).select(*keys)
    raise ValueError(op)


def overlap_all(log: DataFrame, ids: DataFrame, reverse: bool = False) -> dict[str, DataFrame]:
    """Overlap of all three kinds from one scan of the log and one shuffle of its
    pairs: a product's or customer's side bits are those of its pairs together."""
    pairs = kept_table(_sides(split_log(log, ids), KINDS["prod_cus"]), "sides")
    both = F.col("_bits") == 3
    sides = {k: pairs if k == "prod_cus" else kept_table(pairs.groupBy(*cols).agg(F.bit_or("_bits").alias("_bits")), f"sides-{k}") for k, cols in KINDS.items()}
    out = {k: t.where(~both if reverse else both).select(*KINDS[k]) for k, t in sides.items()}
    if reverse:
        prods = sides["product"].where(both).select("ProductID")
        out["prod_cus"] = out["prod_cus"].join(prods, "ProductID", "left_semi")
    return out


_NEEDS = {"tight": ["prod_cus"], "product": ["product"], "customer": ["customer"], "loose": ["product", "customer"]}


def common_filter(log: DataFrame, target: dict[str, DataFrame], typ: str = "tight") -> DataFrame:
    """Keep log rows matching the overlap.

    tight: (product, customer) pair in the pair set; product / customer: id
    in that set; loose: product in the product set and customer in the
    customer set.  AQE broadcasts a member table by its measured bytes and
    splits a hot product or customer otherwise.
    """
    if typ not in _NEEDS:
        raise ValueError(typ)
    t = target
    if typ == "tight":
        return log.join(t["prod_cus"], ["ProductID", "CustomerID"], "left_semi")
    if typ == "product":
        return log.join(t["product"], "ProductID", "left_semi")
    if typ == "customer":
        return log.join(t["customer"], "CustomerID", "left_semi")
    return log.join(t["product"], "ProductID", "left_semi").join(t["customer"], "CustomerID", "left_semi")


def overlap_filtered_log(
    log: DataFrame, target: dict[str, DataFrame], typs: Sequence[str] = ("tight", "loose")
) -> DataFrame:
    """Every typ filters the original log; rows tagged with ``typ``.

    One pass: the log is left-joined to the three member tables (each
    distinct per key; AQE picks the join by measured bytes), each row lists
    the types it passes, and the list is exploded -- the log is read once
    for all types.
    """
    def flag(t: DataFrame, name: str) -> DataFrame:
        return t.withColumn(name, F.lit(True))

    j = (
        log.join(flag(target["prod_cus"], "_pc"), ["ProductID", "CustomerID"], "left")
        .join(flag(target["product"], "_p"), "ProductID", "left")
        .join(flag(target["customer"], "_c"), "CustomerID", "left")
    )
    pc, p, c = (F.coalesce(F.col(x), F.lit(False)) for x in ("_pc", "_p", "_c"))
    conds = {"tight": pc, "loose": p & c, "product": p, "customer": c}
    tags = F.filter(F.array(*[F.when(conds[t], F.lit(t)) for t in typs]), lambda x: x.isNotNull())
    return j.select(*log.columns, F.explode(tags).alias("typ"))
