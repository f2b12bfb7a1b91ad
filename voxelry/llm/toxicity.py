"""Toxicity by compression distance: Zstandard dictionaries of ordinary and of toxic text.

Two dictionaries are trained on a bounded sample of labelled texts: one on windows of ordinary texts, one on the parts of toxic texts
that ordinary ones lack (words with character n-grams much more frequent in toxic texts; trained on whole toxic texts, most of the dictionary would
repeat ordinary words). A window of a text is compressed with the ordinary dictionary alone and with the toxic one put before it. The
difference of the two lengths is what knowledge of toxic text saves; its mean, maximum and exceedances over a text are
calibrated on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from .frame import OWN, per_text

WINDOW_WORDS = 8
ORDINARY_BYTES = 8192
TOXIC_BYTES = 1536
#: Lengths of the character n-grams that tell toxic words.
GRAMS = (5, 7)
#: Bounds of the training sample: texts of either class, characters of a text and of all together.
MAX_DOCS = 3000
MAX_CHARS = 200_000
MAX_TOTAL = 100_000_000
#: A saving of at least so many bytes counts as an exceedance.
STEPS = (1, 2, 3, 4, 6)
_BUCKET_BITS = 22


def plain(text: str | None) -> list[bytes]:
    """Words, in lower case, of the UTF-8 bytes."""
    return (text or "").lower().encode("utf-8", "surrogatepass").split()


def windows(words: Sequence[bytes], size: int = WINDOW_WORDS) -> list[bytes]:
    return [b" " + b" ".join(words[i:i + size]) + b" " for i in range(0, len(words), size)]


def _parameters() -> zstandard.ZstdCompressionParameters:
    return zstandard.ZstdCompressionParameters(window_log=15, chain_log=14, hash_log=14, search_log=6, min_match=4, target_length=32,
                                               strategy=zstandard.STRATEGY_LAZY2, write_content_size=0, write_checksum=0, write_dict_id=0)


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    params = _parameters()
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(compression_params=params, dict_data=known)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float


class Distance:
    """Features of a text: what the toxic dictionary saves over its windows."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.base, self.with_toxic = _compressor(ordinary), _compressor(toxic + ordinary)

    def features(self, text: str | None) -> np.ndarray:
        base, more = self.base.compress, self.with_toxic.compress
        saved = np.fromiter((len(base(w)) - len(more(w)) for w in windows(plain(text))), float)
        if not len(saved):
            return np.zeros(3 + 2 * len(STEPS))
        over = [(saved >= s).sum() for s in STEPS]
        return np.array([saved.mean(), saved.max(), np.sort(saved)[-3:].mean(), *[o / len(saved) for o in over], *np.log1p(over)])


def _grams(words: Sequence[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams (with the space before a word) and the number of the word each lies in."""
    raw = np.frombuffer(b" " + b" ".join(words), np.uint8).astype(np.uint64)
    count = len(raw) - size + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = np.zeros(count, np.uint64)
    for k in range(size):
        h = h * np.uint64(0x100000001B3) + raw[k:k + count]
    h = (h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - _BUCKET_BITS)
    word = np.cumsum(raw == 32) - 1
    return h.astype(np.int64), word[size // 2:size // 2 + count]


def _marked(toxic: list[str], ordinary: list[str], size: int, sigma: float, odds: float) -> np.ndarray:
    """Hashed n-grams whose texts are toxic far more often than chance: ``sigma`` standard deviations and ``odds`` times.

    The table has room for the n-grams of a bounded sample; were it small, rare marks would share their place with common n-grams.
    """
    seen = []
    for texts in (toxic, ordinary):
        count = np.zeros(1 << _BUCKET_BITS, np.float32)
        for text in texts:
            count[np.unique(_grams(plain(text), size)[0])] += 1
        seen.append(count)
    share = len(toxic) / (len(toxic) + len(ordinary))
    total = seen[0] + seen[1]
    z = (seen[0] - total * share) / np.sqrt(np.maximum(total, 1) * share * (1 - share))
    return (z >= sigma) & (seen[0] / len(toxic) >= odds * seen[1] / len(ordinary))


def dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary; the samples themselves where there are too few to train on."""
    try:
        return zstandard.train_dictionary(size, samples, k=32, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def train_dictionaries(toxic: list[str], ordinary: list[str], sigma: float = 6.5, odds: float = 10.0) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionaries of texts."""
    marked = {size: _marked(toxic, ordinary, size, sigma, odds) for size in GRAMS}
    samples = []
    for text in toxic:
        words, told = plain(text), set()
        for size, found in marked.items():
            grams, word = _grams(words, size)
            told.update(word[found[grams]].tolist())
        samples += windows([words[i] for i in sorted(told)])
    common = []
    for text in ordinary:
        cut = windows(plain(text))
        common += cut[::max(1, len(cut) // 40)]
    return dictionary(common, ORDINARY_BYTES), dictionary(samples, TOXIC_BYTES) if samples else b""


def calibrate(rows: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Logistic regression on standardised features, by Newton's method."""
    centre, spread = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.hstack([(rows - centre) / spread, np.ones((len(rows), 1))])
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), x.T @ (labels - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return centre, spread, w[:-1], float(w[-1])


def sample(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS, max_total: int = MAX_TOTAL) -> DataFrame:
    """Texts (doc_id, text, label) of at most ``max_docs`` labelled documents of either class, those with the smallest hash of their id: the bound of the
    training sample. Texts of more than ``max_chars`` characters are left out of it, and so are all, in the order of that hash, from where they pass ``max_total`` together. Only labels are ordered (a top-k per class, no full sort); the
    chosen ids, twice ``max_docs`` at most, are broadcast, so no text is shuffled."""
    known = labels.select(F.col("doc_id").alias(f"{OWN}id"), F.col("label").cast("int").alias("label"))
    parts = [known.filter(F.col("label") == k).orderBy(F.xxhash64(f"{OWN}id"), f"{OWN}id").limit(max_docs) for k in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    fit = docs.select("doc_id", "text").filter(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    drawn = fit.select("doc_id", F.length("text").alias(f"{OWN}n")).join(chosen, F.col("doc_id") == F.col(f"{OWN}id")).drop("doc_id")
    so_far = Window.orderBy(F.xxhash64(f"{OWN}id"), f"{OWN}id", "label").rowsBetween(Window.unboundedPreceding, 0)  # of a bounded number of ids and sizes
    kept = drawn.withColumn(f"{OWN}n", F.sum(f"{OWN}n").over(so_far)).filter(F.col(f"{OWN}n") <= max_total).select(f"{OWN}id", "label").distinct()
    return fit.join(F.broadcast(kept), F.col("doc_id") == F.col(f"{OWN}id")).select("doc_id", "text", "label")


def fit(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS, max_chars: int = MAX_CHARS) -> Model | None:
    """Fit on the texts of ``docs`` (doc_id, text) that ``sample`` takes by ``labels`` (doc_id, label); None if a class has no text.

    Of every three sampled texts two train the dictionaries and one calibrates; with fewer than 12 toxic texts all do both.
    """
    taken = sample(docs, labels, max_docs, max_chars).orderBy(F.xxhash64("doc_id"), "doc_id", "label").select("text", "label").toArrow()
    pairs = list(dict.fromkeys(zip(taken.column("text").to_pylist(), taken.column("label").to_pylist())))  # a copied text counts once
    labels = np.array([k for _, k in pairs], np.int64)
    if set(labels.tolist()) != {0, 1}:
        return None
    texts = [t for t, _ in pairs]
    order = np.empty(len(labels), np.int64)
    for k in (0, 1):
        order[labels == k] = np.arange((labels == k).sum())
    few = (labels == 1).sum() < 12
    learn = np.ones(len(labels), bool) if few else order % 3 != 2
    held = np.ones(len(labels), bool) if few else ~learn
    ordinary, toxic = train_dictionaries([texts[i] for i in np.flatnonzero(learn & (labels == 1))],
                                         [texts[i] for i in np.flatnonzero(learn & (labels == 0))])
    distance = Distance(ordinary, toxic)
    rows = np.array([distance.features(texts[i]) for i in np.flatnonzero(held)])
    return Model(ordinary, toxic, *calibrate(rows, labels[held].astype(float)))


def score(spark, model: Model | None) -> "callable":
    """Column function: text -> probability of class 1. Null and empty texts are scored as a text that saves nothing; 0 without a model."""
    if model is None:
        return lambda text: F.lit(0.0)
    shared = spark.sparkContext.broadcast(model)

    def make():
        known = shared.value
        distance = Distance(known.ordinary, known.toxic)

        def work(texts: list[str | None]) -> list[float]:
            rows = np.array([distance.features(t) for t in texts])
            odds = ((rows - known.centre) / known.spread) @ known.weights + known.bias
            return (1 / (1 + np.exp(-np.clip(odds, -30, 30)))).tolist()

        return work

    return per_text(make, "double", pa.float64())


def classify(docs: DataFrame, model: Model | None, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with ``score`` and ``predicted``; whole texts, each row by itself. Columns named like the results are replaced."""
    value: Column = score(docs.sparkSession, model)(F.col(f"`{text}`"))
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")]
    return (docs.select(*rest, value.alias(f"{OWN}r"))
            .select(*rest, F.col(f"{OWN}r").alias("score"), (F.col(f"{OWN}r") >= threshold).cast("int").alias("predicted")))
