"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of every labelled text in Spark tasks and sums (language, bucket) rows; the driver gets a table of languages x
buckets, whose size does not depend on the corpus. Its log-probabilities are broadcast and texts are scored in numpy as
sparse (document, bucket) coordinates.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .frame import OWN, per_text

ORDERS = (1, 2, 3)
BUCKETS = 1 << 14
#: Languages a model may hold: bounds the table that reaches the driver to MAX_LANGS x BUCKETS numbers.
MAX_LANGS = 500
#: Characters that are turned into n-grams at once.
BLOCK = 1 << 18
UNKNOWN = "und"


def letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


class Grams:
    """Hashed n-grams of texts, in blocks of bounded size. Everything but letters counts as one space, letters in lower case."""

    def __init__(self, buckets: int = BUCKETS):
        self.shift = np.uint32(32 - buckets.bit_length() + 1)
        self.letters = letter_table()

    def _codes(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = self.letters[codes]
        keep = letters.copy()
        keep[1:] |= letters[:-1]
        return np.where(letters, codes, np.uint32(32))[keep]

    def blocks(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(numbers of texts, buckets) of all n-grams; a long text spans several blocks, overlapping so that no n-gram is lost or repeated."""
        parts: list[np.ndarray] = []
        owners: list[int] = []
        held = 0
        reach = max(ORDERS) - 1
        for k, text in enumerate(texts):
            if not text:
                continue
            codes = self._codes(text)
            for at in range(0, len(codes), BLOCK):
                piece = codes[at:at + BLOCK + reach]
                parts.append(piece)
                owners.append(k if at + BLOCK >= len(codes) else -1 - k)
                held += len(piece)
                if held >= BLOCK:
                    yield self._hashed(parts, owners)
                    parts, owners, held = [], [], 0
        if parts:
            yield self._hashed(parts, owners)

    def _hashed(self, parts: list[np.ndarray], owners: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """A negative owner marks a piece that goes on in the next block: its last characters only complete n-grams that start before them."""
        codes = np.concatenate(parts)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        part = np.repeat(np.arange(len(parts), dtype=np.int32), sizes)
        ends = np.cumsum(sizes)
        left = ends[part] - np.arange(len(codes))  # characters from here to the end of the piece
        more = np.fromiter((o < 0 for o in owners), bool, len(owners))
        skip = np.where(more, max(ORDERS) - 1, 0)[part]
        doc = np.fromiter((o if o >= 0 else -1 - o for o in owners), np.int32, len(owners))[part]
        h = np.zeros(len(codes), np.uint32)
        out_doc, out_bucket = [], []
        for n in range(1, max(ORDERS) + 1):
            h = h[:len(codes) - n + 1] * np.uint32(0x01000193) + codes[n - 1:]
            if n not in ORDERS or not len(h):
                continue
            good = (left[:len(h)] >= n) & (left[:len(h)] > skip[:len(h)])
            mixed = (h ^ np.uint32(n * 0x9E37)) * np.uint32(0x9E3779B1)
            out_doc.append(doc[:len(h)][good])
            out_bucket.append((mixed >> self.shift)[good])
        return np.concatenate(out_doc), np.concatenate(out_bucket)


@dataclass(frozen=True)
class Model:
    langs: list[str]
    log_prior: np.ndarray
    #: buckets x languages
    log_prob: np.ndarray


def count_grams(labelled: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(lang, bucket, n) over all texts; bucket -1 has the number of texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, totals, rows = Grams(buckets), {}, {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for at in range(0, len(langs), 256):
                texts, own = batch.column(1).slice(at, 256).to_pylist(), langs[at:at + 256]
                names = {x: i for i, x in enumerate(dict.fromkeys(own))}
                code = np.fromiter((names[x] for x in own), np.int64, len(own))
                for name in own:
                    rows[name] = rows.get(name, 0) + 1
                for doc, bucket in grams.blocks(texts):
                    counted = np.bincount(code[doc] * buckets + bucket, minlength=len(names) * buckets).reshape(len(names), buckets)
                    for name, i in names.items():
                        if name in totals:
                            totals[name] += counted[i]
                        else:
                            totals[name] = counted[i].copy()
        for name, total in rows.items():
            counted = totals.get(name, np.zeros(buckets, np.int64))
            some = np.flatnonzero(counted)
            yield pa.RecordBatch.from_arrays([pa.array([name] * (len(some) + 1), pa.string()), pa.array(np.append(some, -1).astype(np.int32)),
                                              pa.array(np.append(counted[some], total).astype(np.int64))], names=["lang", "bucket", "n"])

    rows = labelled.select("lang", "text").mapInArrow(count, "lang string, bucket int, n bigint")
    return rows.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(labelled: DataFrame, buckets: int = BUCKETS, alpha: float = 0.5, max_langs: int = MAX_LANGS) -> Model:
    """Fit on all rows with a text and a language. Without any such row the model has no language."""
    rows = count_grams(labelled.filter("text IS NOT NULL AND lang IS NOT NULL"), buckets).toArrow()
    names = sorted(set(rows.column("lang").to_pylist()))
    if len(names) > max_langs:
        raise ValueError(f"{len(names)} languages; the model is bounded to {max_langs}")
    at = {x: i for i, x in enumerate(names)}
    code = np.array([at[x] for x in rows.column("lang").to_pylist()], np.int64)
    bucket, n = rows.column("bucket").to_numpy(), rows.column("n").to_numpy()
    table, texts = np.zeros((buckets, len(names))), np.zeros(len(names))
    texts[code[bucket < 0]] = n[bucket < 0]
    table[bucket[bucket >= 0], code[bucket >= 0]] = n[bucket >= 0]
    if names:
        table = np.log((table + alpha) / (table.sum(axis=0) + alpha * buckets))
        texts = np.log(texts / texts.sum())
    return Model(names, texts, table.astype(np.float32))


def classify(spark, model: Model) -> "callable":
    """A column function: text -> struct(lang_pred string, score double)."""
    shared = spark.sparkContext.broadcast(model)
    schema = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    def make():
        known = shared.value
        grams, count = Grams(len(known.log_prob)), len(known.langs)

        def work(texts: list[str | None]) -> list[tuple]:
            out = [(UNKNOWN, 0.0)] * len(texts)
            if not count:
                return [dict(lang_pred=a, score=b) for a, b in out]
            sums = np.zeros((len(texts), count))
            seen = np.zeros(len(texts), np.int64)
            for doc, bucket in grams.blocks(texts):
                # the n-grams come as runs of equal documents, once per order
                starts = np.flatnonzero(np.diff(doc, prepend=-1))
                np.add.at(sums, doc[starts], np.add.reduceat(known.log_prob[bucket], starts, axis=0, dtype=np.float64))
                np.add.at(seen, doc[starts], np.diff(np.append(starts, len(doc))))
            logs = sums / len(ORDERS) + known.log_prior  # n-grams of all orders overlap: each character counts once
            best = logs.argmax(axis=1)  # ties: the first language in alphabetical order
            share = np.exp(logs - logs.max(axis=1, keepdims=True))
            share /= share.sum(axis=1, keepdims=True)
            return [dict(lang_pred=known.langs[b], score=float(s[b])) if n else dict(lang_pred=UNKNOWN, score=0.0)
                    for b, s, n in zip(best, share, seen)]

        return work

    return per_text(make, "struct<lang_pred:string,score:double>", schema)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the posterior of that language, 0 to 1).

    ``und`` and 0 for a null text or one without a letter, and for every text if the model was trained on nothing. Each row
    is scored by itself: repeated rows get equal results, an empty table none, columns named like the results are replaced.
    """
    label = classify(docs.sparkSession, model)
    rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    return docs.select(*rest, label(F.col(f"`{text}`")).alias(f"{OWN}r")).select(*rest, f"{OWN}r.*")
