"""Classifiers over stored embeddings, recall-bounded thresholds, and combined predictions."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.nulls import differs, holds
from .curate import unseen
from .splits import folds


# --- encoders -----------------------------------------------------------------------------------

Encoder = Callable[[list[str]], np.ndarray]

#: Words whose hashes an encoder remembers.
MEMO_WORDS = 100_000


def hash_encoder(dimensions: int = 64) -> Encoder:
    """A deterministic stand-in for a pretrained encoder: signed hashes of words, unit length."""

    known: dict[str, int] = {}

    def place(word: str) -> int:
        """The word's dimension; negative signs come behind all positive ones."""
        h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        at = h % dimensions + (0 if h >> 63 else dimensions)
        if len(known) < MEMO_WORDS:
            known[word] = at
        return at

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions), np.float32)
        for i, t in enumerate(texts):
            places = [known[w] if w in known else place(w) for w in t.lower().split()]
            counts = np.bincount(np.array(places, np.int64), minlength=2 * dimensions)
            out[i] = counts[:dimensions] - counts[dimensions:]
        norms = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norms == 0, 1, norms)

    return encode


def embed(df: DataFrame, text: Column, load: Callable[[], Encoder], batch: int = 32, output: str = "embeddings") -> DataFrame:
    """Add embeddings; the encoder is loaded once for each worker and fed in small batches."""

    @F.pandas_udf("array<float>")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in it:
            rows = texts.fillna("").tolist()
            yield pd.Series([v for lo in range(0, len(rows), batch) for v in encode(rows[lo : lo + batch])])

    return df.withColumn(output, run(text))


def embed_new(df: DataFrame, stored: DataFrame, text: Column, load: Callable[[], Encoder]) -> DataFrame:
    """id and embeddings of rows that have none stored; the table of embeddings is the checkpoint."""
    return embed(unseen(df, stored), text, load).select("id", "embeddings")


# --- thresholds ---------------------------------------------------------------------------------


def fn_threshold(df: DataFrame, label: str = "label", proba: str = "proba", max_fn: float = 0.01, steps: int = 1000) -> DataFrame:
    """The largest of 0, 1/steps ... 1 at which positives below it are less than ``max_fn`` of all rows.

    Counts go into one bucket for each step before anything is summed up.
    """
    if max_fn <= 0:
        raise ValueError("max_fn must be positive")
    p = F.col(proba)
    # a positive is below every threshold from this step on; the product may be a rounding error off
    near = F.floor(p * steps)
    step = F.when(p < near / steps, near).when(p < (near + 1) / steps, near + 1).otherwise(near + 2)
    lost = df.where(holds(F.col(label) == 1) & p.isNotNull()).select(F.least(step, F.lit(steps + 1)).cast("int").alias("step"))
    sums = lost.groupBy("step").agg(F.count("*").alias("n"))
    total = df.agg(F.count("*").alias("rows"))
    grid = df.sparkSession.range(0, steps + 1).select(F.col("id").cast("int").alias("step"))
    run = grid.join(sums, "step", "left").withColumn("fn", F.sum(F.coalesce("n", F.lit(0))).over(Window.orderBy("step")))
    good = run.crossJoin(F.broadcast(total)).where(F.col("fn") / F.col("rows") < max_fn)  # one row
    return good.agg((F.max("step") / steps).alias("threshold"), F.max_by("fn", "step").cast("long").alias("false_negatives"))


def combine(pillar: str = "pred_pillar", scope: str = "pred_scope") -> Column:
    """1 if a pillar is named (null counts as named) or the scope classifier says so."""
    return (differs(pillar, "NA") | holds(F.col(scope) == 1)).cast("int")


def in_out(flag: str) -> Column:
    return F.when(F.col(flag) == 1, "in").when(F.col(flag) == 0, "out")


# --- models -------------------------------------------------------------------------------------


def balanced(df: DataFrame, label: str = "label") -> tuple[DataFrame, int]:
    """Weights n / (classes x rows of the class), and n; rows with a null label are left out."""
    sizes = {r[0]: r["n"] for r in df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")).collect()}  # a row for each class
    n, weight = sum(sizes.values()), F.lit(None).cast("double")
    for value, rows in sizes.items():
        weight = F.when(F.col(label) == value, F.lit(n / (len(sizes) * rows))).otherwise(weight)
    return df.where(F.col(label).isNotNull()).withColumn("weight", weight), n


def features(df: DataFrame, column: str = "embeddings") -> DataFrame:
    return df.withColumn("features", array_to_vector(F.col(column).cast("array<double>")))


def logistic(df: DataFrame, c: float = 0.1, label: str = "label", max_iter: int = 1000):
    """Balanced logistic regression with inverse penalty ``c``, as summed losses have it."""
    rows, n = balanced(df, label)
    return LogisticRegression(labelCol=label, weightCol="weight", regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=1e-9).fit(rows)


def cross_validated(df: DataFrame, fit: Callable[[DataFrame], object], k: int = 5, label: str = "label", id_col: str = "id") -> DataFrame:
    """Out-of-fold ``proba`` of the positive class; folds hold each label in proportion."""
    dealt = folds(df, id_col, label, k)
    out = None
    for f in range(k):
        model = fit(dealt.where(F.col("fold") != f))
        part = model.transform(dealt.where(F.col("fold") == f)).withColumn("proba", vector_to_array("probability")[1]).select(id_col, label, "proba")
        out = part if out is None else out.unionByName(part)
    return out


def pillar_model(df: DataFrame, c: float = 0.1, column: str = "pillar", missing: str | None = "NA") -> PipelineModel:
    """Multinomial logistic regression over pillar names; a null pillar is ``missing``, if given."""
    rows = df.withColumn(column, F.coalesce(column, F.lit(missing))) if missing else df.where(F.col(column).isNotNull())
    index = StringIndexer(inputCol=column, outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    return PipelineModel([index, logistic(index.transform(rows), c)])


def predict_pillar(model: PipelineModel, df: DataFrame) -> DataFrame:
    """proba_pillar and pred_pillar: the largest probability and its class."""
    names = model.stages[0].labels
    out = model.stages[1].transform(df).withColumn("__p", vector_to_array("probability"))
    best = F.array_max("__p")
    return out.withColumns({"proba_pillar": best, "pred_pillar": F.array(*[F.lit(n) for n in names])[F.array_position("__p", best).cast("int") - 1]}).drop("__p", "probability", "rawPrediction", "prediction", "label")


def linear_score(column: str, weights: list[float], bias: float = 0.0) -> Column:
    """Dot product with fixed weights, inside generated code."""
    products = F.zip_with(F.col(column), F.array(*[F.lit(float(w)) for w in weights]), lambda a, b: a.cast("double") * b)
    return F.aggregate(products, F.lit(float(bias)), lambda s, x: s + x)
