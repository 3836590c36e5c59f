"""Quality classifier by co-training: two views teach each other.

The *text* view sees a document's content (hashed words, hashed word shapes,
classes of the shares of symbols, capitals, repeated words and lines), the
*metadata* view its page's facts (source, language, length class).  Both start
from the labelled rows.  In each round a view labels unlabelled documents it
is confident of, and the *other* view learns from those.  Confident means: at
the same score, held-out labelled documents had that label in ``PRECISION`` of
all cases; a view that can't reach it teaches nothing.  In the end both views'
scores are calibrated on held-out labels and combined into one probability.

Every unlabelled document takes part: in each round both views score all of
them where they are read, and the confident ones are counted.  What is bounded
(documented, parameters) are the rows handed to a fit: ``MAX_LABELLED`` labelled
ones, drawn by hash from the labels of documents that exist, and per round,
view and label ``MAX_PSEUDO`` pseudo-labelled ones, drawn by a hash of their
rows from all confident ones, others in each round.

Scale: vectors of all documents are made once and written; rounds read that
table without a shuffle.  Coefficients (bounded by the hash spaces), counts and
the held-out scores (bounded by the sample) are what the driver sees.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, Normalizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import written

MAX_LABELLED, MAX_PSEUDO = 12_000, 2_000
ROUNDS, PRECISION, HELD_OUT = 2, 0.95, 0.3
WORDS, SHAPES, SHARES, META = 1 << 12, 1 << 9, 1 << 9, 1 << 8
#: At most this share of held-out good documents may fall below the threshold.
GOOD_LOSS = 0.01
VIEWS = ("text", "meta")


def features(docs: DataFrame) -> DataFrame:
    """Adds the vectors ``__text`` and ``__meta`` (null texts are empty, unknown
    metadata columns are a value of their own)."""
    has = docs.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    meta = [
        F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("?"))) for c in ("source", "lang") if c in has
    ]
    length = F.col("n_chars").cast("double") if "n_chars" in has else F.lit(None).cast("double")
    meta.append(F.concat(F.lit("length="), F.coalesce(F.floor(F.log2(length + 1) * 2).cast("string"), F.lit("?"))))
    shape = text
    for kind, letter in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"\p{N}+", "9")):
        shape = F.regexp_replace(shape, kind, letter)
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    out = docs.withColumns({"__t": text, "__w": words, "__s": F.filter(F.split(shape, r"[\x20\x09-\x0D]+"), lambda w: w != ""), "__m": F.array(*meta)})
    n = F.greatest(F.size("__w"), F.lit(1)).cast("double")
    lines = F.filter(F.split("__t", "\n"), lambda line: F.trim(line) != "")
    count = lambda kind: F.length(F.regexp_replace("__t", f"[^{kind}]+", ""))
    # Neighbouring words by hash: how many pairs are repeats.
    pairs = F.transform("__w", lambda w, i: F.xxhash64(w, F.get(F.col("__w"), i + 1)))
    shares = {
        "symbols": F.least(count("#*$%&|<>") / n, F.lit(2.0)) * 10,
        "capitals": 20 * count(r"\p{Lu}") / F.greatest(count(r"\p{L}"), F.lit(1)),
        "repeats": 20 * (1 - F.size(F.array_distinct(pairs)) / n),
        "variety": F.least(F.size(F.array_distinct("__w")) / F.sqrt(n), F.lit(20.0)),
        "lines": 10 * (1 - F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1))),
        "words": F.log2(n + 1),
    }
    out = out.withColumn("__c", F.array(*[F.concat(F.lit(f"{k}="), F.floor(v).cast("string")) for k, v in shares.items()]))
    for source, name, size in (("__w", "__tw", WORDS), ("__s", "__ts", SHAPES), ("__c", "__tc", SHARES), ("__m", "__meta", META)):
        out = HashingTF(inputCol=source, outputCol=name, numFeatures=size, binary=source != "__s").transform(out)
    # Counts of shapes become shares, words a unit vector: long and short documents alike.
    out = Normalizer(inputCol="__ts", outputCol="__tsn", p=1.0).transform(out)
    out = Normalizer(inputCol="__tw", outputCol="__twn", p=2.0).transform(out)
    out = VectorAssembler(inputCols=["__twn", "__tsn", "__tc"], outputCol="__text").transform(out)
    return out.drop("__t", "__w", "__s", "__m", "__c", "__tw", "__ts", "__tc", "__twn", "__tsn")


def prepared(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """The vectors of all rows, written: __row, __id, __y (null if unlabelled or beyond
    the bound), __part (0 to 1, by hash of the id) and a vector per view."""
    known = (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy(F.col("doc_id").cast("bigint").alias("__id"))
        .agg(F.min("quality").cast("double").alias("__y"))
    )
    # Labels of documents that aren't there don't use up the bound.
    ids = docs.select(F.col("doc_id").cast("bigint").alias("__id")).distinct()
    known = known.join(ids, "__id", "left_semi").orderBy(F.xxhash64("__id"), "__id").limit(max_labelled)
    has = [c for c in ("text", "source", "lang", "n_chars") if c in docs.columns]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("__id"), *has).join(F.broadcast(written(known, "known")), "__id", "left")  # bounded
    part = F.pmod(F.xxhash64(F.lit("part"), "__id"), F.lit(1000)) / 1000
    out = features(rows).select("__id", "__y", part.alias("__part"), *(f"__{v}" for v in VIEWS))
    return written(out.withColumn("__row", F.monotonically_increasing_id()), "features")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients (last: intercept) of a small logistic regression, by Newton."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def confident(margin: np.ndarray, y: np.ndarray, label: int, precision: float, least: int = 20) -> float | None:
    """The margin beyond which ``precision`` of the held-out rows have ``label``."""
    sign = 1 if label else -1
    order = np.argsort(-sign * margin, kind="stable")
    right = np.cumsum(y[order] == label) / np.arange(1, len(y) + 1)
    ends = np.flatnonzero(np.append(np.diff(margin[order]) != 0, True)) if len(y) else np.empty(0, int)  # ties go together
    good = ends[(right[ends] >= precision) & (ends >= least - 1)]
    return float(margin[order[good[-1]]]) if len(good) else None


def scored(model, df: DataFrame, name: str) -> DataFrame:
    out = model.setRawPredictionCol("__raw").setProbabilityCol("").setPredictionCol("").transform(df)
    return out.withColumn(name, vector_to_array("__raw")[1]).drop("__raw")


def sure(view: str, limits: dict[int, float | None]) -> F.Column:
    """The label that a view is confident of, by its margin; null between the limits."""
    margin, said = F.col(f"__m_{view}"), F.lit(None).cast("double")
    for label, limit in limits.items():
        if limit is not None:
            said = F.coalesce(said, F.when(margin >= limit if label else margin <= limit, F.lit(float(label))))
    return said


def exchanged(rows: DataFrame, models: dict, limits: dict[str, dict], turn: int, max_pseudo: int) -> tuple[dict, dict]:
    """One exchange over all unlabelled rows: what each view teaches the other, and
    how many rows it is confident of by (view, label); (None, "all"): rows scored.

    Rows taught are drawn by a hash of round, view and row: about ``max_pseudo`` of
    a label, all if there are fewer."""
    pool = rows.where("__y is null")
    both = pool
    for v in VIEWS:
        both = scored(models[v], both, f"__m_{v}")
    both = both.select("__row", *[sure(v, limits[v]).alias(f"__s_{v}") for v in VIEWS])
    counts = both.agg(
        F.count(F.lit(1)), *[F.count(F.when(F.col(f"__s_{v}") == label, 1)) for v in VIEWS for label in (0, 1)]
    ).first()
    known = {(None, "all"): counts[0]} | {(v, label): counts[1 + 2 * i + label] for i, v in enumerate(VIEWS) for label in (0, 1)}
    taught = {}
    for v, other in (VIEWS, VIEWS[::-1]):
        if not known[v, 0] + known[v, 1]:
            continue
        draw = F.pmod(F.xxhash64(F.lit(f"{turn} {v}"), "__row"), F.lit(1 << 30)) / float(1 << 30)
        share = [min(1.0, max_pseudo / max(1, known[v, label])) for label in (0, 1)]
        some = scored(models[v], pool.where(draw < max(share)), f"__m_{v}").withColumn("__said", sure(v, limits[v]))
        some = some.where(draw < F.when(F.col("__said") == 1, share[1]).when(F.col("__said") == 0, share[0]))
        taught[other] = written(some.select(F.col("__said").alias("__y"), f"__{other}"), "taught")
    return taught, known


def fit(rows: DataFrame, rounds: int = ROUNDS, max_pseudo: int = MAX_PSEUDO) -> dict | None:
    """Both views' models from ``prepared`` rows and how to combine them; None without
    labels of both kinds."""
    # One row of each labelled id: an id may have any number of copies.
    known = written(rows.where("__y is not null").dropDuplicates(["__id"]), "labelled")
    held, train = known.where(F.col("__part") < HELD_OUT), known.where(F.col("__part") >= HELD_OUT)
    for part in (held, train):
        if {r[0] for r in part.select("__y").distinct().collect()} != {0.0, 1.0}:
            return None
    taught: dict[str, DataFrame] = {}
    models, seen_in = {}, []
    for turn in range(rounds + 1):
        for v in VIEWS:
            own = train.select("__y", f"__{v}")
            models[v] = LogisticRegression(
                featuresCol=f"__{v}", labelCol="__y", regParam=1e-3, maxIter=20, standardization=False
            ).fit((own.unionByName(taught[v]) if v in taught else own).coalesce(4))
        tested = held
        for v in VIEWS:
            tested = scored(models[v], tested, f"__m_{v}")
        seen = tested.select("__y", "__m_text", "__m_meta").collect()
        y = np.array([r[0] for r in seen])
        margins = {v: np.array([r[1 + k] for r in seen]) for k, v in enumerate(VIEWS)}
        if turn == rounds:
            break
        limits = {v: {label: confident(margins[v], y, label, PRECISION) for label in (0, 1)} for v in VIEWS}
        taught, counts = exchanged(rows, models, limits, turn, max_pseudo)
        seen_in.append(counts)
    platt = {v: logistic(margins[v][:, None], y) for v in VIEWS}
    logits = np.column_stack([margins[v] * platt[v][0] + platt[v][1] for v in VIEWS])
    weights = logistic(logits, y)
    p = 1 / (1 + np.exp(-np.clip(logits @ weights[:2] + weights[2], -30, 30)))
    threshold = min(0.5, float(np.quantile(p[y == 1], GOOD_LOSS)))
    return {"models": models, "platt": platt, "weights": weights, "threshold": threshold, "exchanges": seen_in}


def add_scores(vectors: DataFrame, model: dict | None) -> DataFrame:
    """Rows with the views' vectors, and __p_text, __p_meta, __p (of both) and __kept.
    Without a model (no labels of both kinds) probabilities are null and all is kept."""
    if model is None:
        none = F.lit(None).cast("double")
        return vectors.withColumns({"__p_text": none, "__p_meta": none, "__p": none, "__kept": F.lit(True)})
    out = vectors
    for v in VIEWS:
        out = scored(model["models"][v], out, f"__m_{v}").drop(f"__{v}")
    logit = {v: F.col(f"__m_{v}") * float(model["platt"][v][0]) + float(model["platt"][v][1]) for v in VIEWS}
    w = model["weights"].tolist()
    squash = lambda x: 1 / (1 + F.exp(-x))
    p = squash(logit["text"] * w[0] + logit["meta"] * w[1] + w[2])
    out = out.withColumns({"__p_text": squash(logit["text"]), "__p_meta": squash(logit["meta"]), "__p": p})
    return out.withColumn("__kept", F.col("__p") >= model["threshold"]).drop("__m_text", "__m_meta")


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, **bounds) -> DataFrame:
    """doc_id, p_text, p_meta, p_good and kept of every row of ``docs``.

    Null and empty texts are scored as empty; null ids and repeated rows keep
    their rows; ids with several labels count with the lowest; columns that
    clash with this module's names (``__...``) aren't read.
    """
    rows = prepared(docs, labels, max_labelled)
    out = add_scores(rows, fit(rows, **bounds))
    return out.select(F.col("__id").alias("doc_id"), F.col("__p_text").alias("p_text"), F.col("__p_meta").alias("p_meta"), F.col("__p").alias("p_good"), F.col("__kept").alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED, **bounds) -> DataFrame:
    """The rows of ``docs`` that the combined classifier keeps, columns as they are."""
    has = [c for c in ("text", "source", "lang", "n_chars") if c in docs.columns]
    model = fit(prepared(docs, labels, max_labelled), **bounds)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    own = docs.select(whole, *has)
    out = add_scores(features(own) if model else own, model)
    # The id keeps Catalyst from copying the features into the filter, once per use.
    return out.withColumn("__id", F.monotonically_increasing_id()).where("__kept").select("__row.*")
