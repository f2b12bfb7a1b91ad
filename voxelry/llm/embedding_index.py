"""Embedding near-duplicates with an inverted multi-index.

The halves of the unit vectors have a codebook each, fitted on a bounded sample; the product of the two is a grid of cells and every vector is at home in the cell of
its nearest codewords. A multi-sequence traversal visits the cells for a vector from the nearest on, by the sum of the distances of the halves, until what it has
visited finds the asked-for share of neighbours exactly at the threshold. All vectors of a visited cell are then compared in double precision.

Equal vectors are one node with a count. The rows of a cell (those at home and visitors) are cut into blocks, and every two blocks meet in a task of their own, which gives
on the number of links of each row and the stars of its components, never pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged
from .frame import narrow, refuse
from .links import components, stars

#: Vectors that the codebooks are fitted on and the depth of the traversal is measured with.
SAMPLE = 16_384
#: Vectors a cell has on average, as long as there are no more codewords than this a half.
PER_CELL, MOST_CODES = 32, 512
#: Share of neighbours exactly at the threshold that the traversal finds (in one of the two directions) in the sample.
RECALL = 0.999
#: Rows of a block; two blocks meet in a task.
BLOCK = 1024
ROUNDS = 12


class Index(NamedTuple):
    """Codebooks of the two halves, and how much farther than the nearest cell (in squared distance) the traversal goes."""
    left: np.ndarray
    right: np.ndarray
    slack: float


def unit(rows: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision, scaled by the largest component first, so that no square overflows or vanishes."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt(np.square(rows).sum(axis=1, keepdims=True))


def squares(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all codewords."""
    return np.square(rows).sum(axis=1)[:, None] - 2 * rows @ codes.T + np.square(codes).sum(axis=1)


def codebook(rows: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Codewords by Lloyd's iteration, from distinct rows drawn by a fixed seed."""
    distinct = np.unique(rows, axis=0)
    codes = distinct[np.random.default_rng(seed).choice(len(distinct), min(count, len(distinct)), replace=False)]
    for _ in range(ROUNDS):
        near = squares(rows, codes).argmin(axis=1)
        sums = np.zeros_like(codes)
        np.add.at(sums, near, rows)
        sizes = np.bincount(near, minlength=len(codes))
        codes = np.where(sizes[:, None] > 0, sums / np.maximum(sizes, 1)[:, None], codes)
    return codes


def fit_sample(rows: np.ndarray, cosine: float, count: int, recall: float = RECALL) -> Index:
    """Codebooks from sample rows; the slack is the quantile of what is needed to visit the home of a neighbour turned by exactly the threshold's angle, or to be visited from there. A recall of 1 visits every cell."""
    half = rows.shape[1] // 2
    left, right = codebook(rows[:, :half], count, 1), codebook(rows[:, half:], count, 2)
    turn = np.random.default_rng(3).standard_normal(rows.shape)
    turn -= (turn * rows).sum(axis=1, keepdims=True) * rows
    length = np.sqrt(np.square(turn).sum(axis=1, keepdims=True))
    near = cosine * rows + np.sqrt(max(0.0, 1 - cosine * cosine)) * turn / np.where(length > 0, length, 1)
    sides = [(squares(r[:, :half], left), squares(r[:, half:], right)) for r in (rows, near)]
    home = [(a.argmin(axis=1), b.argmin(axis=1)) for a, b in sides]
    at = np.arange(len(rows))
    needed = [a[at, home[1 - k][0]] + b[at, home[1 - k][1]] - a.min(axis=1) - b.min(axis=1) for k, (a, b) in enumerate(sides)]
    return Index(left, right, np.inf if recall >= 1 else float(np.quantile(np.minimum(*needed), recall)) + 1e-9)


def traverse(a: np.ndarray, b: np.ndarray, slack: float) -> list[int]:
    """Cells (left * number of right codewords + right) by increasing sum of distances, nearest first: the multi-sequence algorithm over the two sorted halves."""
    first, second = a.argsort(kind="stable"), b.argsort(kind="stable")
    a, b, width = a[first].tolist(), b[second].tolist(), len(b)
    limit, queue, found = a[0] + b[0] + slack, [(a[0] + b[0], 0, 0)], []
    while queue and queue[0][0] <= limit:
        _, i, j = heapq.heappop(queue)
        found.append(int(first[i]) * width + int(second[j]))
        # a cell is pushed by the one before it in its row, the first of a row by the first of the row before
        if j + 1 < len(b):
            heapq.heappush(queue, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(queue, (a[i + 1] + b[0], i + 1, 0))
    return found


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column; shorter ones are filled with zeros, which changes no cosine among rows of one length."""
    out = np.zeros((len(column), width))
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out[np.arange(width)[None, :] < sizes[:, None]] = values
    return out


def fit(nodes: DataFrame, cosine: float, width: int, total: int, recall: float) -> Index:
    """The index, from a sample of at most ``SAMPLE`` nodes (id, embedding) drawn by a digest of their ids."""
    rows = nodes.select("id", "embedding").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("embedding").toArrow()
    sample = unit(_matrix(rows.column(0).combine_chunks(), width))
    return fit_sample(sample, cosine, int(np.clip(round(np.sqrt(total / PER_CELL)), 2, MOST_CODES)), recall)


def _visits(index: Index, width: int):
    half = width // 2

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out = []
            for at in range(0, len(batch), 1024):
                rows = unit(_matrix(batch.slice(at, 1024), width))
                a, b = squares(rows[:, :half], index.left), squares(rows[:, half:], index.right)
                out += [traverse(x, y, index.slack) for x, y in zip(a, b)]
            yield pa.array(out, pa.list_(pa.int32()))

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "array<int>").asNondeterministic()


def _meet(cosine: float, width: int):
    """Rows of two blocks of a cell -> (u, null, links) for the links of a row, (u, v, null) for stars."""
    def compare(group: pa.Table) -> Iterator[pa.RecordBatch]:
        ids, counts, home, size, side = (group.column(c).to_numpy() for c in ("id", "n", "home", "length", "side"))
        rows, visits, cell = unit(_matrix(group.column("embedding").combine_chunks(), width)), group.column("visits").combine_chunks(), group.column("cell")[0].as_py()
        one, two = (np.arange(len(ids)),) * 2 if group.column("i")[0].as_py() == group.column("j")[0].as_py() else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        if not len(one) or not len(two):
            return
        linked = rows[one] @ rows[two].T >= cosine
        guest = home != cell
        linked &= ~(guest[one][:, None] & guest[two][None, :]) & (size[one][:, None] == size[two][None, :])
        if one is two:
            linked &= np.triu(np.ones_like(linked), 1)
        p, q = np.nonzero(linked)
        p, q = one[p], two[q]
        apart = guest[p] | guest[q]
        if apart.any():
            # a guest and a row at home also meet at the guest's home, if the other one goes there: the smaller cell counts
            g, m = np.where(guest[p], p, q)[apart], np.where(guest[p], q, p)[apart]
            offsets, values = visits.offsets.to_numpy() - visits.offsets[0].as_py(), visits.flatten().to_numpy()
            row_of = np.repeat(np.arange(len(ids)), np.diff(offsets))
            wide = np.int64(1) << 32
            known = np.sort(row_of * wide + values)
            wanted = m * wide + home[g]
            place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
            keep = np.ones(len(p), bool)
            keep[np.flatnonzero(apart)[(known[place] == wanted) & (home[g] < cell)]] = False
            p, q = p[keep], q[keep]
        if not len(p):
            return
        links = np.bincount(p, counts[q], len(ids)) + np.bincount(q, counts[p], len(ids))
        u, v = stars(ids[p], ids[q])
        some = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([ids[some], u]), pa.int64()), pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(v, pa.int64())]),
                                          pa.concat_arrays([pa.array(links[some].astype(np.int64)), pa.nulls(len(u), pa.int64())])], names=["u", "v", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if rest is not None:
                table = pa.concat_tables([rest, table]).combine_chunks()
            if not table.num_rows:
                continue
            key = np.stack([table.column(c).to_numpy() for c in ("cell", "i", "j")], axis=1)
            starts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1)]
            for a, b in zip(starts[:-1], starts[1:]):
                yield from compare(table.slice(a, b - a).combine_chunks())
            rest = table.slice(starts[-1])
        if rest is not None and rest.num_rows:
            yield from compare(rest.combine_chunks())

    return run


def _sound(column: Column) -> Column:
    """Whether a vector has a direction: no null and no non-finite component, and one that is not zero."""
    finite = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, cosine: float = 0.95, block: int = BLOCK, recall: float = RECALL) -> DataFrame:
    """A row a vector: vec_id, n_links (other vectors of at least this cosine that were found), component_id (smallest vec_id that links lead to, itself included) and
    kept (vec_id = component_id).

    ``vectors``: vec_id (bigint), embedding (array of float or double). Null, empty and zero vectors, those with null or non-finite components and rows with a null id link with
    nothing; vectors of different lengths are never linked. Rows that repeat an id are vectors of their own that share a component. Pairs below the cosine are never linked; of those above it
    the traversal finds at least ``recall`` of the ones exactly at it, measured on the sample, and more of the closer ones; a recall of 1 visits
    all cells. Other columns are not read.
    """
    refuse(vectors)
    vectors = narrow(vectors, "vec_id", "embedding")
    text = F.md5(F.array_join(F.transform("embedding", lambda x: x.cast("string")), ","))
    rows = staged(vectors.select("vec_id", "embedding", F.when(_sound(F.col("embedding")) & F.col("vec_id").isNotNull(), text).alias("sig")), "vectors")
    nodes = rows.filter("sig IS NOT NULL").groupBy("sig").agg(F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("embedding").alias("embedding"))
    nodes = staged(nodes, "vector-classes")
    total, width = nodes.agg(F.count("*"), F.max(F.size("embedding"))).first()
    single = rows.select("vec_id", "sig")
    if not total:
        return single.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = max(2, width)
    index = fit(nodes, cosine, width, total, recall)
    placed = nodes.select("id", "n", "embedding", F.size("embedding").alias("length"), _visits(index, width)("embedding").alias("visits"))
    placed = staged(placed, "visits").withColumn("home", F.col("visits")[0])
    met = placed.select("id", "home", F.explode("visits").alias("cell"))
    # at most MOST_CODES ** 2 cells
    cells = (met.groupBy("cell").agg(F.count("*").alias("rows"), F.count_if(F.col("home") == F.col("cell")).alias("members"))
             .filter("members > 0 AND rows > 1").select("cell", F.ceil(F.col("rows") / block).cast("int").alias("s")))
    own = F.pmod(F.xxhash64("id"), F.col("s")).cast("int")
    dealt = (placed.select("*", F.explode("visits").alias("cell")).join(F.broadcast(cells), "cell").withColumn("b", own)
             .select("cell", "id", "n", "home", "length", "embedding", "visits", "b", F.explode(F.sequence(F.lit(0), F.col("s") - 1)).alias("o"))
             .select("cell", F.least("b", "o").alias("i"), F.greatest("b", "o").alias("j"), (F.col("b") > F.col("o")).cast("int").alias("side"),
                     "id", "n", "home", "length", "embedding", "visits"))
    dealt = dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    found = staged(dealt.mapInArrow(_meet(cosine, width), "u bigint, v bigint, links bigint"), "vector-links")
    labels = components(found.filter("v IS NOT NULL").select("u", "v")).select(F.col("u").alias("id"), F.col("v").alias("least"))
    links = found.filter("v IS NULL").groupBy(F.col("u").alias("id")).agg(F.sum("links").alias("links"))
    named = (nodes.select("sig", "id", "n").join(links, "id", "left").join(labels, "id", "left")
             .select("sig", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("least", "id").alias("least")))
    out = single.join(named, "sig", "left").select("vec_id", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("least", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
