"""MinHash near-duplicate detection with HyperMinHash registers.

A document's set are its distinct five-word shingles. The hashes of a set fall into 256 buckets by their leading bits; a bucket keeps of its
smallest hash the count of leading zeros and ten mantissa bits (16 bits). Bands of registers are the keys under which candidates meet,
a collision-corrected estimate of the Jaccard similarity sorts out most of the others, and a link is made only after both full sets were compared.

Documents of equal sets are one node. Nodes that meet under a key are not paired with each other: they are first tested against the smallest
of them, and only members of different components are compared any further, inside tasks and in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .frame import OWN, narrow, per_text
from .links import components

SHINGLE = 5
BUCKETS = 256
MANTISSA = 10
#: Largest probability with which the bands may miss a pair exactly at the threshold.
MISS = 1e-5
#: Standard deviations below the threshold at which an estimate still leads to a comparison of the full sets.
SIGMAS = 5.0
#: Members of a key, and bytes of their texts, that one task compares with each other; a key of more is cut into blocks.
BLOCK, BLOCK_BYTES = 2048, 64 << 20
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: For each bucket, an order of all buckets: an empty one takes its value from the first in its order that is not.
_ORDER = np.random.default_rng(20240501).permuted(np.tile(np.arange(BUCKETS, dtype=np.int16), (BUCKETS, 1)), axis=1)


class _Words(dict):
    """64-bit hashes of words met before; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 18:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, known: _Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of fewer words the whole sequence is one shingle, without words there is none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(SHINGLE, len(w))
    h = w[:len(w) - size + 1]
    for k in range(1, size):
        h = h * _MULTIPLIER + w[k:len(w) - size + 1 + k]
    return np.unique(_mixed(h + np.uint64(size)))


def registers(hashes: np.ndarray) -> np.ndarray:
    """256 registers of 16 bits of a non-empty sorted set of hashes: leading zeros and mantissa of the smallest hash of each bucket."""
    bucket = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    mantissa, exponent = np.frexp((hashes[first] << np.uint64(8)).astype(np.float64))
    zeros = np.minimum(64 - exponent, 63)
    bits = ((mantissa * 2 - 1) * (1 << MANTISSA)).astype(np.int64)
    value = (zeros << MANTISSA) | np.clip(bits, 0, (1 << MANTISSA) - 1)
    out = np.zeros(BUCKETS, np.uint16)
    filled = bucket[first]
    out[filled] = value
    if len(filled) < BUCKETS:
        empty = np.setdiff1d(np.arange(BUCKETS), filled, assume_unique=True)
        out[empty] = value[_ORDER[np.ix_(empty, filled)].argmin(axis=1)]
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, size (bytes of the text), digest of the set and registers; the last two are null for an empty set."""
    schema = pa.struct([("n_shingles", pa.int64()), ("digest", pa.binary()), ("registers", pa.binary())])

    def make():
        known = _Words()

        def work(texts: list[str | None]) -> list[dict]:
            rows = []
            for text in texts:
                h = shingle_set(text, known)
                if len(h):
                    rows.append(dict(n_shingles=len(h), digest=xxhash.xxh3_128_digest(h.tobytes()), registers=registers(h).astype("<u2").tobytes()))
                else:
                    rows.append(dict(n_shingles=0, digest=None, registers=None))
            return rows

        return work

    value = per_text(make, "struct<n_shingles:bigint,digest:binary,registers:binary>", schema)(F.col("text"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")
    return docs.select("doc_id", size, value.alias(f"{OWN}s")).select("doc_id", "size", f"{OWN}s.*")


def band_rows(percent: int) -> int:
    """Registers of a band: as many as keep the bands' misses at the threshold below ``MISS`` (7 at 85 %, 6 at 80 %)."""
    missed = lambda rows: (1 - (percent / 100) ** rows) ** (BUCKETS // rows)
    return max((rows for rows in range(1, BUCKETS + 1) if missed(rows) < MISS), default=1)


def keys_of(registers_col: Column, rows: int) -> Column:
    """Hashes of the bands: array<bigint>."""
    return F.transform(F.sequence(F.lit(0), F.lit(BUCKETS // rows - 1)),
                       lambda k: F.xxhash64(k, F.substring(registers_col, k * (2 * rows) + 1, F.lit(2 * rows))))


def _effective(n: np.ndarray) -> np.ndarray:
    """Buckets with a value of their own, in expectation."""
    return BUCKETS * (1 - np.exp(-np.maximum(n, 1) / BUCKETS))


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from registers (rows x 256) of sets of n and m shingles.

    Different minima share leading zeros and mantissa with a probability of about ``nm / (n+m)^2 / (2 ln 2) / 2^MANTISSA``: with
    minima that are exponential of rates n and m, the sum over cells of width 2^-i-MANTISSA in octave i of the product of the densities.
    """
    equal = (a == b).mean(axis=1)
    by_chance = n * m / np.square(n + m) / (2 * np.log(2)) / (1 << MANTISSA)
    return (equal - by_chance) / (1 - by_chance)


def least_estimate(n: np.ndarray, m: np.ndarray, threshold: float) -> np.ndarray:
    return threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / _effective(np.minimum(n, m)))


def _two(run, kind):
    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind).asNondeterministic()


def _likely(threshold: float):
    def run(batches):
        for a, b, n, m in batches:
            if not len(a):
                yield pa.array([], pa.bool_())
                continue
            x, y = (np.frombuffer(b"".join(c.to_pylist()), "<u2").reshape(-1, BUCKETS) for c in (a, b))
            n, m = (c.to_numpy(zero_copy_only=False).astype(float) for c in (n, m))
            yield pa.array(estimate(x, y, n, m) >= least_estimate(n, m, threshold))
    return _two(run, "boolean")


def alike(p: np.ndarray, q: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of full sets."""
    if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
        return False
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= percent * (len(p) + len(q) - both)


def _alike(percent: int):
    def run(batches):
        known = _Words()
        of = lru_cache(64)(lambda text: shingle_set(text, known))
        for a, b in batches:
            out = []
            for at in range(0, len(a), 64):
                out += [alike(of(x), of(y), percent) for x, y in zip(a.slice(at, 64).to_pylist(), b.slice(at, 64).to_pylist())]
            yield pa.array(out, pa.bool_())
    return _two(run, "boolean")


def confirm(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (u > v) among the distinct candidate ``pairs``: estimated from registers first, then confirmed on full sets.

    Both joins are plain shuffles, so the planner can split the partition of a node that is in very many pairs.
    """
    threshold = percent / 100
    side = lambda k: nodes.select(F.col("id").alias(k), F.col("registers").alias(f"r{k}"), F.col("n_shingles").alias(f"n{k}"))
    likely = pairs.join(side("u"), "u").join(side("v"), "v").filter(_likely(threshold)("ru", "rv", "nu", "nv")).select("u", "v")
    text = lambda k: texts.select(F.col("id").alias(k), F.col("text").alias(f"t{k}"))
    return likely.join(text("u"), "u").join(text("v"), "v").filter(_alike(percent)("tu", "tv")).select("u", "v").distinct()


def _comparer(percent: int):
    """Rows of ``across``, sorted by cell -> links that join components. A pair is looked at under the first of the keys it shares only."""
    threshold, per_band = percent / 100, band_rows(percent)
    bands = BUCKETS // per_band

    def compare(group: pa.Table, sets: "callable") -> Iterator[pa.RecordBatch]:
        ids, comps, sizes, side = (group.column(c).to_numpy() for c in ("id", "comp", "n_shingles", "side"))
        band, texts = group.column("band")[0].as_py(), group.column("text")
        drawn = np.frombuffer(b"".join(group.column("registers").to_pylist()), "<u2").reshape(-1, BUCKETS)
        joined: dict[int, int] = {}

        def root(c: int) -> int:
            while c in joined:
                c = joined[c]
            return c

        rows = np.arange(len(ids))
        inside = group.column("i")[0].as_py() == group.column("j")[0].as_py()
        links = []
        for k in rows if inside else rows[side == 0]:
            right = rows[k + 1:] if inside else rows[side == 1]
            right = right[(comps[right] != comps[k]) & (np.minimum(sizes[right], sizes[k]) >= threshold * np.maximum(sizes[right], sizes[k]))]
            if not len(right):
                continue
            close = estimate(drawn[right], drawn[k][None, :], sizes[right].astype(float), float(sizes[k]))
            right = right[close >= least_estimate(sizes[right], sizes[k], threshold)]
            same = (drawn[right, :bands * per_band] == drawn[k, :bands * per_band]).reshape(-1, bands, per_band).all(axis=2)
            for other in right[same.argmax(axis=1) == band]:
                a, b = root(int(comps[k])), root(int(comps[other]))
                if a != b and alike(sets(texts[int(k)].as_py()), sets(texts[int(other)].as_py()), percent):
                    joined[max(a, b)] = min(a, b)
                    links.append((max(ids[k], ids[other]), min(ids[k], ids[other])))
        if links:
            u, v = zip(*links)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups are contiguous; the last of a batch waits for the next one, at most two blocks of rows."""
        known = _Words()
        sets = lru_cache(1024)(lambda text: shingle_set(text, known))
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            key = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1 if len(key) else []
            starts = [0, *cuts]
            for a, b in zip(starts[:-1], starts[1:]):
                yield from compare(table.slice(a, b - a), sets)
            rest = table.slice(starts[-1])
        if rest is not None and rest.num_rows:
            yield from compare(rest, sets)

    return run


def across(members: DataFrame, nodes: DataFrame, texts: DataFrame, percent: int, block: int = BLOCK, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Links (u > v), confirmed on full sets, that join the components known so far: enough of them to find what all links would.

    ``members``: key, band, id, size, comp. Keys whose members are all of one component are dropped. Of a key, only members of different components are
    compared, by registers first; no pair leaves the task unless it joins two components there. The members of the largest component of a key and
    the others are dealt to cells of about ``block`` and no more than ``block_bytes`` of text; every two cells of others meet in a task of their own, and every cell of others meets every cell of the
    largest component, whose members never meet each other. The memory of a task is bounded whatever the size of the key, and where nearly all members
    are of one component each of them is sent once.
    """
    parts = members.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    largest = F.max(F.struct("n", (-F.col("comp")).alias("c"), "bytes")).alias("m")
    cells_of = lambda n, size: F.greatest(F.ceil(n / block), F.ceil(size / block_bytes)).cast("int")
    spread = (parts.groupBy("key").agg(largest, F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).filter("m.n < n")
              .select("key", (-F.col("m.c")).alias("main"), cells_of(F.col("m.n"), F.col("m.bytes")).alias("s_main"),
                      cells_of(F.col("n") - F.col("m.n"), F.col("bytes") - F.col("m.bytes")).alias("s_other")))
    in_main = F.col("comp") == F.col("main")
    other_cells, main_cells = (F.sequence(F.lit(0), F.col(s) - 1) for s in ("s_other", "s_main"))

    def meeting(i, j, side):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), side.cast("int").alias("side"))

    # cells of the largest component have the numbers -1, -2, ...
    c = F.col("c")
    with_others = F.transform(other_cells, lambda o: F.when(in_main, meeting(o, -1 - c, F.lit(1))).otherwise(meeting(F.least(c, o), F.greatest(c, o), c > o)))
    with_main = F.transform(main_cells, lambda o: meeting(c, -1 - o, F.lit(0)))
    meetings = F.when(in_main, with_others).otherwise(F.concat(with_others, with_main))
    cells = (members.join(spread, "key")
             .withColumn("c", F.pmod(F.xxhash64("id"), F.when(in_main, F.col("s_main")).otherwise(F.col("s_other"))).cast("int"))
             .join(nodes.select("id", "n_shingles", "registers"), "id").join(texts, "id")
             .select("key", "band", "id", "comp", "n_shingles", "registers", "text", F.explode(meetings).alias("at"))
             .select("key", "band", "at.*", "id", "comp", "n_shingles", "registers", "text"))
    dealt = cells.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(_comparer(percent), "u bigint, v bigint").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """A row a document: doc_id, n_shingles, component_id (smallest doc_id it can be reached from by links) and kept (doc_id = component_id).

    Two documents are linked if ``100 * intersection >= percent * union`` of their sets. Null, empty and wordless texts have an empty set
    and are linked with nothing. doc_id (a bigint) is the key of a document: rows that repeat it with the same text get the same result; rows with a null
    id are linked with nothing and kept. Only doc_id and text are read.
    """
    docs = narrow(docs, "doc_id", "text")
    drawn = staged(sketches(docs), "sketches")
    known = drawn.filter("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = staged(known.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    firsts = classes.select(F.col("rep").alias("id"), "digest")
    nodes = staged(known.withColumnRenamed("doc_id", "id").join(firsts, ["id", "digest"], "left_semi").drop("digest"), "nodes")
    keyed = nodes.select("id", "size", F.posexplode(keys_of(F.col("registers"), band_rows(percent))).alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi").select("key", "lo")
    members = staged(keyed.join(shared, "key"), "members")
    texts = staged(docs.withColumnRenamed("doc_id", "id").join(members.select("id").distinct(), "id", "left_semi"), "texts")

    # first the smallest node under the most keys of each node, which links most copies; then what is still apart
    first = (members.filter("id > lo").groupBy("id", "lo").agg(F.count("*").alias("n"))
             .groupBy("id").agg(F.max_by("lo", F.struct("n", -F.col("lo"))).alias("v")).select(F.col("id").alias("u"), "v"))
    links = staged(confirm(first, nodes, texts, percent), "links")
    labels = components(links)
    parted = members.select("key", "band", "id", "size").join(labels.select(F.col("u").alias("id"), F.col("v").alias("comp")), "id", "left")
    more = across(parted.withColumn("comp", F.coalesce("comp", "id")), nodes, texts, percent)
    labels = components(labels.unionByName(more)).select(F.col("u").alias("rep"), F.col("v").alias("comp"))

    named = classes.join(labels, "rep", "left").select("digest", F.coalesce("comp", "rep").alias("comp"))
    rows = drawn.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    out = rows.join(named, "digest", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with all its columns; rows with a null doc_id stay."""
    gone = near_duplicates(docs, percent).filter("NOT kept").select(F.col("doc_id").alias(f"{OWN}id"))
    return docs.join(gone, F.col("doc_id") == F.col(f"{OWN}id"), "left_anti")
