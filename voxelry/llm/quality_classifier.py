"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Class means and covariances come from sums that Spark aggregates over all labelled documents, so the driver only sees a
table whose size is that of the feature space. Covariances are shrunk towards their diagonal and the pooled spread; each class
keeps its Cholesky factor, with which a score is the difference of two Mahalanobis log-densities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .frame import OWN, narrow, per_text

#: Bytes whose counts make the character classes.
SYMBOL_BYTES = b"#*$%&|<>"
STOP_BYTES = b"!?"
FEATURES = ("log_words", "word_chars", "symbols", "shouts", "capitals", "digits", "distinct_words", "repeat_windows", "dup_lines",
            "line_words", "longest_word", "commas", "stops")


def describe(text: str | None) -> list[float]:
    """Features of a text, each transformed so that its bulk is roughly normal: logarithms of lengths and of smoothed shares."""
    text = text or ""
    words = text.split()
    n = len(words)
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    lines = [line for line in text.split("\n") if line.strip()]
    size = max(len(text), 1)
    per = max(n, 1)

    def share(count: float, of: float) -> float:
        return float(np.log((count + 0.5) / (of + 1.0)))

    windows = max(n - 2, 0)
    distinct = len(set(zip(words, words[1:], words[2:])))
    return [
        float(np.log1p(n)),
        float(np.log1p(sum(map(len, words)) / per)),
        share(min(raw[list(SYMBOL_BYTES)].sum() / per, 1.0), 1.0),
        share(min(raw[list(STOP_BYTES)].sum() / per, 1.0), 1.0),
        share(raw[65:91].sum() / size, 1.0),
        share(min(raw[48:58].sum() / per, 1.0), 1.0),
        len(set(words)) / per,
        share((windows - distinct) / max(windows, 1), 1.0),
        share((len(lines) - len(set(lines))) / max(len(lines), 1), 1.0),
        float(np.log1p(n / max(len(lines), 1))),
        float(np.log1p(max(map(len, words), default=0))),
        share(raw[44] / per, 1.0),
        share(raw[46] / per, 1.0),
    ]


def features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``features`` (array<double>) in place of the text; null counts as an empty text."""
    measure = per_text(lambda: lambda texts: [describe(t) for t in texts], "array<double>", pa.list_(pa.float64()))
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != text], measure(F.col(f"`{text}`")).alias("features"))


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    #: by class 0 and 1: centre, inverse of the Cholesky factor, log-density constant with the prior
    classes: tuple[tuple[np.ndarray, np.ndarray, float], ...]

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        z = (rows - self.mean) / self.scale
        logs = [const - 0.5 * np.square((z - centre) @ inverse.T).sum(axis=1) for centre, inverse, const in self.classes]
        return logs[1] - logs[0]

    def score(self, rows: np.ndarray, temper: float) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.log_odds(rows) * temper, -500, 500)))


def moments(labelled: DataFrame, label: str = "label") -> DataFrame:
    """For class 0 and 1: number of rows, sums and sums of products of the features; one narrow row a class and task is shuffled."""
    d = len(FEATURES)
    x = [F.get("features", F.lit(i)) for i in range(d)]
    sums = [F.sum(x[i]).alias(f"s{i}") for i in range(d)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    return labelled.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("label")).agg(F.count("*").alias("n"), *sums, *products)


def fit(labelled: DataFrame, label: str = "label", shrink: float = 0.1, pool: float = 0.2) -> Model | None:
    """Fit on all labelled rows. ``shrink`` moves each covariance towards its diagonal, ``pool`` towards the spread of all rows.
    None if a class has no row."""
    d = len(FEATURES)
    found = {r["label"]: r for r in moments(labelled, label).collect()}  # two rows
    if set(found) != {0, 1}:
        return None
    n, sums, products = {}, {}, {}
    for k, r in found.items():
        n[k] = r["n"]
        sums[k] = np.array([r[f"s{i}"] for i in range(d)])
        products[k] = np.array([[r[f"p{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)])
    total = n[0] + n[1]
    mean = (sums[0] + sums[1]) / total
    scale = np.sqrt(np.maximum(np.diag((products[0] + products[1]) / total - np.outer(mean, mean)), 1e-6))
    classes = []
    for k in (0, 1):
        centre = sums[k] / n[k]
        spread = (products[k] / n[k] - np.outer(centre, centre)) / np.outer(scale, scale)
        spread = (1 - shrink) * spread + shrink * np.diag(np.diag(spread))
        spread = (1 - pool) * spread + pool * np.eye(d)
        factor = np.linalg.cholesky(spread)
        const = np.log(n[k] / total) - np.log(np.diag(factor)).sum()
        classes.append(((centre - mean) / scale, np.linalg.inv(factor), float(const)))
    return Model(mean, scale, tuple(classes))


def score(measured: DataFrame, model: Model | None, threshold: float = 0.7, temper: float = 0.5) -> DataFrame:
    """``measured`` with ``score`` (0 to 1, higher: class 1 likelier) and ``predicted`` in place of ``features``.

    ``temper`` flattens the log-odds, as features are correlated beyond what a Gaussian describes. Every row, also of an empty text, gets a
    score; without a model it is 0.5.
    """
    rest = [F.col(f"`{c}`") for c in measured.columns if c.lower() not in ("features", "score", "predicted")]
    if model is None:
        value = F.lit(0.5)
    else:
        shared = measured.sparkSession.sparkContext.broadcast(model)

        def make():
            known = shared.value
            return lambda rows: known.score(np.array(rows, float), temper).tolist() if rows else []

        value = per_text(make, "double", pa.float64())(F.col("features"))
    return measured.select(*rest, value.alias("score")).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def labelled_features(measured: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """Features with the known labels, joined on doc_id; several labels of a document count as several rows."""
    known = labels.select(F.col("doc_id").alias(f"{OWN}id"), F.col(label).alias("label")).filter("label IS NOT NULL")
    return narrow(measured, "doc_id", "features").join(known, F.col("doc_id") == F.col(f"{OWN}id"))
