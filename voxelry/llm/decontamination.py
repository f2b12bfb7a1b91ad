"""Benchmark decontamination with suffix arrays over shards of the training texts.

A shard is a bounded run of documents inside a task. Its suffix array over words is searched by bisection for the beginning of every suffix of every test
item, all distinct ones at once: the interval found holds all places where a window stands verbatim. Where an item occurs, a suffix array over the document and
the item gives their longest match as a pair of neighbours. Benchmark items travel to the tasks in blocks of bounded size, one block after the other; documents are
never shuffled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .frame import OWN, refuse

WINDOW = 13
#: Benchmark characters that are broadcast at once; more go through the documents in further blocks.
BLOCK_CHARS = 8_000_000
#: Words of a shard.
SHARD_WORDS = 1 << 20
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after A-Z became a-z, as UTF-8: every byte of a non-ASCII character belongs to a word."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))


def _keys(numbers: np.ndarray, at: np.ndarray, room: np.ndarray, depth: int) -> np.ndarray:
    """The first ``depth`` word numbers (from 1 on, 0 beyond their room) at places of a sequence, as byte strings in the order of the numbers."""
    steps = np.arange(depth)
    taken = np.minimum(at[:, None] + steps, max(len(numbers) - 1, 0))
    words = np.where(steps[None, :] < room[:, None], numbers[taken] + 1, 0) if len(numbers) else np.zeros((len(at), depth))
    return np.ascontiguousarray(words.astype(">u4")).view(f"S{4 * depth}").ravel()


class Items:
    """Test items as word numbers, one after the other; their distinct windows are looked for once each."""

    def __init__(self, ids: list, texts: list[str | None], window: int = WINDOW):
        self.ids, self.window, self.vocabulary = list(ids), window, {}
        number = self.vocabulary.setdefault
        self.parts = [np.array([number(w, len(self.vocabulary)) for w in words_of(t)], np.int64) for t in texts]
        self.least = min((min(window, len(p)) for p in self.parts if len(p)), default=0)

    @cached_property
    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows and their sizes, and the items with each: those of window k are ``item[first[k]:first[k + 1]]``. Made where it is asked for first."""
        keys, sizes, items = [], [], []
        for k, own in enumerate(self.parts):
            size = min(self.window, len(own))
            at = np.arange(len(own) - size + 1 if size else 0)
            keys.append(_keys(own, at, np.full(len(at), size), self.window))
            sizes.append(np.full(len(at), size))
            items.append(np.full(len(at), k))
        if not keys:
            return np.zeros(0, f"S{4 * self.window}"), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64)
        distinct, first, place = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        size, item = np.concatenate(sizes)[first], np.concatenate(items)
        pairs = np.unique(place * np.int64(len(self.ids)) + item)
        return distinct, size, pairs % len(self.ids), np.searchsorted(pairs, np.arange(len(distinct) + 1) * np.int64(len(self.ids)))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "windows"}


class SuffixArray:
    """Suffixes of a sequence of word numbers in order of their first ``depth`` words; negative numbers stand for words that no item has.

    Only suffixes that begin with ``least`` words known to the items are kept: no other can begin with a whole window.
    """

    def __init__(self, words: np.ndarray, ends: np.ndarray, least: int, depth: int):
        self.depth = depth
        stop = np.where(words >= 0, len(words), np.arange(len(words)))
        # first unknown word at or after each position, not beyond the end of its document
        stop = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], ends) if len(words) else stop
        room = stop - np.arange(len(words))
        at = np.flatnonzero(room >= least)
        keys = _keys(words, at, room[at], depth)
        order = keys.argsort(kind="stable")
        self.at, self.keys = at[order], keys[order]

    def intervals(self, queries: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query (a window's key and its size), by bisection, the places in the array whose suffixes begin with it."""
        last = np.ascontiguousarray(queries).view(">u4").reshape(-1, self.depth).copy()
        last[np.arange(self.depth)[None, :] >= sizes[:, None]] = 0xFFFFFFFF
        return np.searchsorted(self.keys, queries, "left"), np.searchsorted(self.keys, last.view(queries.dtype).ravel(), "right")


def longest_match(text: np.ndarray, item: np.ndarray) -> tuple[int, int, int]:
    """Start in the item, start in the text and words of their longest common run, by a suffix array over both: two neighbours in it, one from each, share it.
    Of several the first in the item, then in the text, among such neighbours."""
    sequence = np.concatenate([text, [-1], item, [-2]])
    ranks, step = [np.unique(sequence, return_inverse=True)[1]], 1
    while ranks[-1].max() < len(sequence) - 1:
        following = np.concatenate([ranks[-1][step:] + 1, np.zeros(min(step, len(sequence)), np.int64)])
        ranks.append(np.unique(ranks[-1] * np.int64(len(sequence) + 1) + following, return_inverse=True)[1])
        step *= 2
    order = ranks[-1].argsort()
    a, b = order[:-1], order[1:]
    mixed = (a < len(text)) != (b < len(text))
    a, b = a[mixed], b[mixed]
    a, b = np.minimum(a, b), np.maximum(a, b)
    shared = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        i, j = (np.minimum(x + shared, len(sequence) - 1) for x in (a, b))
        shared += (ranks[k][i] == ranks[k][j]) * (1 << k)
    best = np.flatnonzero(shared == shared.max())
    k = best[np.lexsort((a[best], b[best]))[0]]
    return int(b[k] - len(text) - 1), int(a[k]), int(shared[k])


def search(items: Items, texts: list[str | None]) -> list[dict]:
    """For each text of a shard: ``n_words``, ``spans`` (merged [start, end) word positions inside occurring windows), ``items`` (those that occur)
    and ``matches``: for each of them its longest verbatim match (item, start in the item, start in the text, words).

    Each distinct window is looked for once; windows of one size begin at different places, so the work follows the words of the shard and not the product of
    places and windows.
    """
    get = items.vocabulary.get
    parts = [np.array([get(w, -1) for w in words_of(t)], np.int64) for t in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    rows = [dict(n_words=int(n), spans=[], items=[], matches=[]) for n in sizes]
    words, ends = np.concatenate(parts) if parts else np.zeros(0, np.int64), np.cumsum(sizes)
    if not items.least or not len(words):
        return rows
    doc = np.repeat(np.arange(len(parts)), sizes)
    array = SuffixArray(words, ends[doc], items.least, items.window)
    keys, length, item, first = items.windows
    low, high = array.intervals(keys, length)
    counts = high - low
    found = np.repeat(np.arange(len(keys)), counts)
    if not len(found):
        return rows
    at = array.at[np.arange(len(found)) - np.repeat(np.cumsum(counts) - counts, counts) + low[found]]
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + length[found], -1)
    hit = np.cumsum(marks[:-1]) > 0
    # a run of hit words ends with its document
    begins = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (doc[1:] == doc[:-1])]))
    stops = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (doc[1:] == doc[:-1]), [False]])) + 1
    offset = ends - sizes
    for a, b in zip(begins, stops):
        d = doc[a]
        rows[d]["spans"].append((int(a - offset[d]), int(b - offset[d])))
    seen = np.unique(doc[at] * np.int64(len(keys)) + found)
    d, window = np.divmod(seen, len(keys))
    many = first[window + 1] - first[window]
    own = item[np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[window], many)]
    for pair in np.unique(np.repeat(d, many) * np.int64(len(items.ids)) + own):
        d, k = divmod(int(pair), len(items.ids))
        rows[d]["items"].append(k)
        rows[d]["matches"].append((k, *longest_match(parts[d], items.parts[k])))
    return rows


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_MATCHES = pa.list_(pa.struct([("item_id", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("words", pa.int64())]))
RESULT = pa.struct([("n_words", pa.int64()), ("spans", _SPANS), ("items", pa.list_(pa.string())), ("matches", _MATCHES)])
RESULT_DDL = ("struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>,"
              "matches:array<struct<item_id:string,item_start:bigint,start:bigint,words:bigint>>>")


def _searcher(shared, shard_words: int):
    """Column function over texts."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        items = shared.value
        for batch in batches:
            out: list[dict] = []
            shard: list[str | None] = []
            held = 0
            texts = (t for at in range(0, len(batch), 256) for t in batch.slice(at, 256).to_pylist())
            for text in texts:
                shard.append(text)
                held += len(text or "") // 4
                if held >= shard_words:
                    out += search(items, shard)
                    shard, held = [], 0
            out += search(items, shard)
            for row in out:
                row["spans"] = [dict(start=a, end=b) for a, b in row["spans"]]
                row["matches"] = [dict(item_id=str(items.ids[k]), item_start=i, start=a, words=n) for k, i, a, n in row["matches"]]
                row["items"] = sorted(str(items.ids[k]) for k in row["items"])
            yield pa.array(out, RESULT)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, RESULT_DDL).asNondeterministic()


def _merged(results: list[Column]) -> Column:
    """Results of several blocks of items as one: spans are united, lists joined."""
    if len(results) == 1:
        return results[0]
    spans = F.sort_array(F.flatten(F.array(*[r["spans"] for r in results])))
    joined = F.aggregate(spans, F.lit(None).cast("array<struct<start:bigint,end:bigint>>"), lambda done, s: F.when(done.isNull(), F.array(s)).when(
        s["start"] <= F.element_at(done, -1)["end"],
        F.concat(F.slice(done, F.lit(1), F.size(done) - 1), F.array(F.struct(
            F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], s["end"]).alias("end")))))
        .otherwise(F.concat(done, F.array(s))))
    return F.struct(results[0]["n_words"].alias("n_words"), F.coalesce(joined, F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"),
                    F.array_sort(F.array_distinct(F.flatten(F.array(*[r["items"] for r in results])))).alias("items"),
                    F.array_sort(F.flatten(F.array(*[r["matches"] for r in results]))).alias("matches"))


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Iterator[Items]:
    """Test items in blocks of about ``block_chars`` characters, one block at a time on the driver. A null or wordless item has no window."""
    chars = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    rows = benchmark.select(F.col("item_id"), F.col("text"), F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias(f"{OWN}b"))
    for k in range(blocks):
        block = rows.filter(F.col(f"{OWN}b") == k).orderBy(F.col("item_id").cast("string"), "text").toArrow()
        yield Items(block.column("item_id").to_pylist(), block.column("text").to_pylist())


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_chars: int = BLOCK_CHARS,
                 shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``spans``, ``items``, ``matches`` and ``contaminated``.

    ``items`` are the ids, as sorted strings, of the items with an occurring window; rows that repeat an item_id count as one item each
    but give one id. A document is contaminated if at least one word in twenty is hit. Null and wordless texts have no hit; an empty benchmark
    finds nothing; repeated documents are judged each. Columns named like a result are refused.
    """
    refuse(docs, "n_words", "n_hit", "spans", "items", "matches", "contaminated")
    context = docs.sparkSession.sparkContext
    found, results = docs, []
    shared = None
    for k, items in enumerate(item_blocks(benchmark, block_chars)):
        if shared is not None:
            # one block of items at a time in the memory of the workers
            found = staged(found, "contamination")
            shared.unpersist()
        shared = context.broadcast(items)
        found = found.withColumn(f"{OWN}{k}", _searcher(shared, shard_words)(F.col(f"`{text}`")))
        results.append(F.col(f"{OWN}{k}"))
    one = found.select(*[F.col(f"`{c}`") for c in docs.columns], _merged(results).alias(f"{OWN}r"))
    hit = F.aggregate(f"{OWN}r.spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return (one.select(*[F.col(f"`{c}`") for c in docs.columns], F.col(f"{OWN}r.n_words"), hit.alias("n_hit"), F.col(f"{OWN}r.spans"),
                       F.array_distinct(f"{OWN}r.items").alias("items"), F.col(f"{OWN}r.matches"))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns."""
    return find_matches(docs, benchmark, **options).filter("NOT contaminated").select(*[F.col(f"`{c}`") for c in docs.columns])
