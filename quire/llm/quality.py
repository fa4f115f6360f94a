"""Quality classifier: regularised quadratic discriminant over text statistics.

Each text becomes a vector of transformed statistics (expressions only). Per
class, counts, sums and sums of products over all training rows give mean and
covariance; the covariance is shrunk towards the pooled one and towards a
multiple of the identity, and its Cholesky factor is kept with the model. A
score is the logistic of the difference of the classes' log densities (from
Mahalanobis distances) plus the log ratio of the class sizes.

Labels, lang, source and ids are never inputs of a score. Defined results: a
null text counts as empty; rows without an id are not held out and never train;
repeated documents score alike and each trains; several labels of a document
each count; labels other than 0 and 1 are ignored. With one class or none in
training, the score is the share of class 1 (0.5 without any label).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import staged

POOLED = 0.3        # share of the pooled covariance
SPHERE = 0.05       # share of the scaled identity
TEMPERATURE = 2.0   # divides the log density difference: statistics are not independent draws
THRESHOLD = 0.3

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"
MARKS = "!#$%&*|<>{}[]=~^_\\"
DIGITS = "0123456789"


def _count(text: Column, chars: str) -> Column:
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


FEATURES = ("word_length", "marks", "upper", "digits", "distinct_words", "repeats", "distinct_lines",
            "sentence_words", "long_words")


def features(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``x``, the array of transformed statistics (see FEATURES)."""
    t = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = df.select(*keep, t.alias("_t")).select(
        *keep, "_t", F.filter(F.split(F.lower("_t"), r"[ \t-\r]+"), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n"), lambda line: line != "").alias("_l"))
    n = F.greatest(F.char_length("_t"), F.lit(1))
    words = F.greatest(F.size("_w"), F.lit(1))
    lines = F.greatest(F.size("_l"), F.lit(1))
    same = F.size(F.filter(F.zip_with("_w", F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 1, F.lit(0))),
                                      lambda a, b: a == b), lambda x: x))
    stops = _count(F.col("_t"), ".?") + 1
    x = [
        F.log(F.lit(1.0) + n / words),
        F.sqrt(_count(F.col("_t"), MARKS) / n),
        # Capitals beyond one a word, so that a short sentence is not odd.
        F.sqrt(F.greatest(_count(F.col("_t"), UPPER) - F.size("_w"), F.lit(0)) / n),
        F.sqrt(_count(F.col("_t"), DIGITS) / n),
        # The share of distinct words falls with length; the power law removes most of that.
        F.log(F.greatest(F.size(F.array_distinct("_w")), F.lit(1)) + F.lit(1.0)) / F.log(words + F.lit(1.0)),
        F.sqrt(same / words),
        F.size(F.array_distinct("_l")) / lines,
        F.log1p(words / stops),
        F.sqrt(F.size(F.filter("_w", lambda w: F.char_length(w) > 15)) / words),
    ]
    return base.select(*keep, F.array(*[c.cast("double") for c in x]).alias("x"))


@dataclass
class Model:
    prior: float                       # share of class 1 in training
    classes: list | None               # per class: mean, inverse Cholesky factor, log determinant

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.full(len(x), self.prior)
        density = [-0.5 * ((((x - mean) @ inverse.T) ** 2).sum(axis=1) + logdet) for mean, inverse, logdet in self.classes]
        z = (density[1] - density[0]) / TEMPERATURE + math.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def fit(train: DataFrame, label: str = "quality") -> Model:
    """Fit on columns ``x`` and ``label``. Every row counts; what reaches the
    driver is one row of sums per class."""
    p = len(FEATURES)
    x = [F.element_at("x", i + 1) for i in range(p)]
    products = [F.sum(x[i] * x[j]) for i in range(p) for j in range(i, p)]
    sums = {r[label]: r for r in train.where(F.col(label).isin(0, 1)).groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in x]).alias("s"), F.array(*products).alias("p")).collect()}
    total = sum(r["n"] for r in sums.values())
    if len(sums) < 2:
        return Model(0.5 if not sums else float(1 in sums), None)
    moments = {}
    for c, r in sums.items():
        mean = np.array(r["s"]) / r["n"]
        second = np.zeros((p, p))
        second[np.triu_indices(p)] = np.array(r["p"]) / r["n"]
        second = second + np.triu(second, 1).T
        moments[c] = (r["n"], mean, second - np.outer(mean, mean))
    pooled = sum(n * cov for n, _, cov in moments.values()) / total
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-8))
    out = []
    for c in (0, 1):
        _, mean, cov = moments[c]
        cov = ((1 - POOLED) * cov + POOLED * pooled) / np.outer(scale, scale)
        cov = (1 - SPHERE) * cov + SPHERE * max(np.trace(cov) / p, 1e-3) * np.eye(p)
        factor = np.linalg.cholesky(cov)
        out.append((mean, np.linalg.inv(factor) / scale, 2 * np.log(np.diag(factor)).sum()))
    return Model(moments[1][0] / total, out)


def held_out(id_col: Column, folds: int = 5, fold: int = 0) -> Column:
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def fit_on(statistics: DataFrame, labels: DataFrame) -> Model:
    """Fit on the labelled documents outside the held-out fold; ``statistics``
    has doc_id and x, so no text moves."""
    known = labels.select("doc_id", "quality").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return fit(statistics.select("doc_id", "x").join(known, "doc_id"))


def score_column(spark, model: Model) -> Callable[..., Column]:
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        if not len(xs):
            return pd.Series([], dtype=float)
        return pd.Series(shared.value.score(np.stack([np.asarray(x, float) for x in xs])))

    return score


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``. The texts
    are read once; their statistics are staged for training and scoring."""
    statistics = staged(features(docs, "text", ["doc_id"]), "statistics")
    score = score_column(docs.sparkSession, fit_on(statistics, labels))
    out = statistics.select("doc_id", score("x").alias("score"))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the classifier does not reject, all columns unchanged. Texts
    are read twice (training, filtering) and neither moved nor stored."""
    model = fit_on(features(docs, "text", ["doc_id"]), labels)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))
    score = score_column(docs.sparkSession, model)
    return features(packed, "_text", ["_row"]).where(score("x") >= threshold).select("_row.*")
