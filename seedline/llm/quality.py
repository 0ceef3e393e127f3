"""Regularised quadratic discriminant over document statistics.

Each text becomes a short vector of transformed statistics (JVM expressions). One grouped sum over the labelled
rows gives counts, sums and sums of products per class; the driver turns these few numbers into means, shrunk
covariances and their Cholesky factors. A text's score is the logistic of the difference of the two classes'
log-densities and log-shares, each density from the Mahalanobis distance by the cached factor.

Null and empty texts have the statistics of an empty text and are scored like any other. Rows are scored one by
one: repeated rows and null ids come back as they are. Labels are matched to texts by id; of several labels of
an id the largest counts. With no labelled rows of a class, or none at all, every score is the share of label 1
(1 without labels). Extra columns stay in ``accepted``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import durable
from .columns import free_prefix, quoted
from .mixing import WORD_GAPS, word_count

THRESHOLD = 0.7
SHRINK_TO_POOLED = 0.1  # share of the pooled covariance in each class's
SHRINK_TO_DIAGONAL = 0.02  # share of its own diagonal
FLOOR = 1e-4  # added to each variance
TEMPERATURE = 0.25  # the features are not independent normals: distances are damped before the logistic


def statistics(text: Column) -> list[Column]:
    """The transformed statistics of a text."""
    whole = F.coalesce(text, F.lit(""))
    size = F.length(whole)
    n = word_count(whole)
    words = F.split(whole, WORD_GAPS)
    distinct = F.size(F.array_distinct(words))
    per_char = size.cast("double") + 100.0
    per_word = n.cast("double") + 16.0

    def rate(pattern: str) -> Column:
        return F.regexp_count(whole, F.lit(pattern)) / per_char

    return [
        F.log(n + F.lit(16.0)),
        F.log((size + F.lit(100.0)) / per_word),  # word length
        F.log((distinct + F.lit(16.0)) / per_word) / F.log(per_word),  # repetition, made comparable over lengths
        F.sqrt(rate(r"[#*$%&|<>=+_~^\\]")),
        F.sqrt(rate(r"[A-Z]")),
        F.sqrt(rate(r"[.,;:]")),
        F.sqrt(rate(r"[!?]")),
        F.sqrt(rate(r"[0-9]")),
        F.sqrt(F.regexp_count(whole, F.lit(r"(?<!\S)\S{1,3}(?!\S)")) / per_word),  # short words, as function words are
        F.sqrt(F.regexp_count(whole, F.lit(r"\n")) / per_word),
    ]


@dataclass(frozen=True)
class Model:
    means: tuple[np.ndarray, ...]
    factors: tuple[np.ndarray, ...]  # inverse Cholesky factors
    offsets: tuple[float, ...]  # log share minus half the log determinant
    share: float  # of label 1

    def score(self, features: Column) -> Column:
        """The score of a column of statistics, as one JVM expression over the cached factors."""
        if len(self.means) < 2:
            return F.lit(self.share)
        density = []
        for mean, factor, offset in zip(self.means, self.factors, self.offsets):
            centred = [F.get(features, F.lit(i)) - F.lit(float(m)) for i, m in enumerate(mean)]
            distance = F.lit(0.0)
            for i, row in enumerate(factor):
                y = reduce(lambda a, b: a + b, [c * F.lit(float(w)) for c, w in zip(centred, row[: i + 1])])
                distance = distance + y * y
            density.append(F.lit(offset) - distance * F.lit(0.5))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-TEMPERATURE) * (density[1] - density[0])))


def fit(labelled: DataFrame, features: str = "_q", label: str = "_ql") -> Model:
    """One grouped sum over all labelled rows; what reaches the driver is a few numbers per class."""
    d = len(statistics(F.lit("")))
    x = [F.get(F.col(features), F.lit(i)) for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    found = {r["k"]: r for r in labelled.groupBy(F.col(label).alias("k")).agg(F.count("*").alias("n"), *sums, *products).collect()}
    n = np.array([float(found[k]["n"]) if k in found else 0.0 for k in (0, 1)])
    share = float(n[1] / n.sum()) if n.sum() else 1.0
    if n.min() < 2:
        return Model((), (), (), share)
    means, own = [], []
    for k in (0, 1):
        mean = np.array([found[k][f"s{i}"] for i in range(d)]) / n[k]
        square = np.array([[found[k][f"p{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)]) / n[k]
        means.append(mean)
        own.append(square - np.outer(mean, mean))
    pooled = (n[0] * own[0] + n[1] * own[1]) / n.sum()
    factors, offsets = [], []
    for k in (0, 1):
        shrunk = (1 - SHRINK_TO_POOLED) * own[k] + SHRINK_TO_POOLED * pooled
        shrunk = (1 - SHRINK_TO_DIAGONAL) * shrunk + SHRINK_TO_DIAGONAL * np.diag(np.diag(shrunk)) + FLOOR * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors.append(np.linalg.inv(lower))
        offsets.append(float(np.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum()))
    return Model(tuple(means), tuple(factors), tuple(offsets), share)


def held_out(doc_id: Column) -> Column:
    """Rows whose crc32 of the id as text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def known_labels(labels: DataFrame, label: str = "quality") -> DataFrame:
    """_qd, _ql: labels to learn from, one per id."""
    known = labels.where(F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).groupBy(F.col("doc_id").alias("_qd"))
    return known.agg(F.max(label).cast("int").alias("_ql"))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, _q: the statistics of every row, written down."""
    return durable(docs.select("doc_id", F.array(*statistics(F.col(text))).alias("_q")), "quality-statistics")


def learned(rows: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """The model of the labelled rows among ``rows``, which come from ``measured``."""
    known = known_labels(labels, label)
    return fit(rows.join(known, rows["doc_id"] == known["_qd"]).select("_q", "_ql"))


def scored(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted; one row per input row. Texts are measured once."""
    rows = measured(docs, text)
    model = learned(rows, labels, label)
    out = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("_q")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "quality") -> DataFrame:
    """The rows of ``docs`` whose texts are predicted to be good; what is learned comes from labelled rows of ``docs``.

    Texts are measured twice, for the fit and for the verdict, and never shuffled or written."""
    model = learned(measured(docs, text), labels, label)
    p = free_prefix(docs)
    # a generator of one row: the statistics are worked out once below it and not again in each of their uses
    once = docs.withColumn(f"{p}all", F.array(*statistics(F.col(text)))).withColumn(f"{p}q", F.explode(F.array(f"{p}all")))
    return once.where(model.score(F.col(f"{p}q")) >= THRESHOLD).select(*quoted(docs))
