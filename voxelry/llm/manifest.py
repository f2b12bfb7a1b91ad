"""Merkle manifest of a table in the van Emde Boas layout.

The rows of a group, in the order of their keys, are the leaves of a tree in which every eight consecutive nodes become one, up to the group's subroot; the subroots in
the order of the groups are the leaves of one more such tree, up to the root. The nodes are kept in aligned subtrees of up to 8^4 leaves, one row of a
table each, whose digests stand in van Emde Boas order: a subtree is cut at half its height into a top and its bottom subtrees, each stored in one piece and cut
likewise. Addresses are arithmetic, so construction and the retrieval of siblings need no links; the roots of the blocks are the leaves of the next tier.

A subtree is built in a task of its own from its rows alone, so a group of any size is spread over tasks. Texts are hashed where they are read; only digests and keys
are shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import staged
from .frame import refuse

FAN = 8
#: Levels of hashing in a block: it holds up to FAN ** LEVELS leaves.
LEVELS = 4
DIGEST = 32
PATH = "array<struct<left:string,right:string>>"


def nodes(levels: int) -> int:
    """Nodes of a complete tree of so many levels."""
    return (FAN ** levels - 1) // (FAN - 1)


def levels_of(leaves: int) -> int:
    """Levels, that of the leaves included, until one node remains."""
    levels = 1
    while FAN ** (levels - 1) < leaves:
        levels += 1
    return levels


@lru_cache(None)
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """For each level, from the root down, the places of its nodes in van Emde Boas order."""
    if levels == 1:
        return (np.zeros(1, np.int64),)
    top, bottom = levels // 2, levels - levels // 2
    lower, found = addresses(bottom), list(addresses(top))
    for down in range(bottom):
        tree, inside = np.divmod(np.arange(FAN ** (top + down)), FAN ** down)
        found.append(nodes(top) + tree * nodes(bottom) + lower[down][inside])
    return tuple(found)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def build(leaves: Sequence[bytes]) -> bytes:
    """Digests of a subtree over the leaves in van Emde Boas order; places without a node are zero."""
    levels = levels_of(len(leaves))
    where = addresses(levels)
    store = np.zeros((nodes(levels), DIGEST), np.uint8)
    level = [leaf.hex() for leaf in leaves]
    for depth in range(levels - 1, -1, -1):
        store[where[depth][:len(level)]] = np.frombuffer(bytes.fromhex("".join(level)), np.uint8).reshape(-1, DIGEST)
        if depth:
            level = [digest("".join(level[k:k + FAN])) for k in range(0, len(level), FAN)]
    return store.tobytes()


class Subtree:
    """A block read back: siblings and folds by address."""

    def __init__(self, store: bytes, leaves: int, path: Sequence[tuple[str, str]]):
        self.levels = levels_of(leaves)
        self.store, self.path, self.known = store.hex(), list(path), {}
        self.counts = [-(-leaves // FAN ** (self.levels - 1 - depth)) for depth in range(self.levels)]
        self.where = addresses(self.levels)
        self.tails: dict[tuple[int, int], str] = {(0, 0): "".join(a + b for a, b in self.path)}

    def node(self, depth: int, at: int) -> str:
        place = int(self.where[depth][at]) * 2 * DIGEST
        return self.store[place:place + 2 * DIGEST]

    @lru_cache(1 << 13)
    def siblings(self, depth: int, at: int) -> tuple[str, str]:
        """Digests of the others of the node's run, left and right of it."""
        run = at - at % FAN
        return ("".join(self.node(depth, k) for k in range(run, at)),
                "".join(self.node(depth, k) for k in range(at + 1, min(run + FAN, self.counts[depth]))))

    def tail(self, depth: int, at: int) -> str:
        """Siblings of the node and of all that is above it, up to the root of the whole."""
        found = self.tails.get((depth, at))
        if found is None:
            left, right = self.siblings(depth, at)
            found = left + right + self.tail(depth - 1, at // FAN)
            if depth < self.levels - 1:
                self.tails[depth, at] = found
        return found

    def path_of(self, at: int) -> list[tuple[str, str]]:
        """(left, right) siblings of a leaf, level by level up to the root of the whole."""
        return [self.siblings(depth, at // FAN ** (self.levels - 1 - depth)) for depth in range(self.levels - 1, 0, -1)] + self.path

    def fold(self, at: int, leaf: str) -> str:
        """The root that a leaf of this digest has with the stored siblings; folds of the same node and digest are made once."""
        for depth in range(self.levels - 1, 0, -1):
            left, right = self.siblings(depth, at)
            leaf, at = digest(left + leaf + right), at // FAN
            if (depth, at, leaf) in self.known:
                return self.known[depth, at, leaf]
            if leaf == self.node(depth - 1, at):
                # from here on the fold is that of the stored node, the same for every leaf below it
                self.known[depth, at, leaf] = found = self.fold_from(depth - 1, at, leaf)
                return found
        return self.fold_from(0, 0, leaf)

    def fold_from(self, depth: int, at: int, node: str) -> str:
        for d in range(depth, 0, -1):
            left, right = self.siblings(d, at)
            node, at = digest(left + node + right), at // FAN
        for left, right in self.path:
            node = digest(left + node + right)
        return node


class Tree(NamedTuple):
    """Tiers of blocks (grp, block, leaves, store, items, last), from the leaves up; ``last`` is the number of the group's last block there."""
    tiers: list[DataFrame]


def _arrow(run, kind: str, several: bool = False):
    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, ...]] if several else Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, kind)


def _built(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    schema = pa.struct([("store", pa.binary()), ("root", pa.string()), ("raised", pa.string())])
    for batch in batches:
        rows = []
        for k in range(len(batch)):
            leaves = batch[k].as_py()
            store = build(leaves)
            raised = root = store[:DIGEST].hex()
            for _ in range(LEVELS + 1 - levels_of(len(leaves))):
                raised = digest(raised)
            rows.append({"store": store, "root": root, "raised": raised})
        yield pa.array(rows, schema)


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Rows (grp, ...) with ``pos``, their place in the group in the order of the given columns, without a task that holds a group."""
    keys = ["grp", *order]
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    dealt = staged(dealt.withColumn("id", F.monotonically_increasing_id()), "leaves")
    part = F.shiftright("id", 33)
    parts = dealt.groupBy("grp", part.alias("part")).agg(F.min("id").alias("least"), F.count("*").alias("n"))
    before = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("grp", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("least")).alias("shift"))
    return dealt.withColumn("part", part).join(parts, ["grp", "part"]).withColumn("pos", F.col("id") + F.col("shift")).drop("id", "part", "shift")


def blocks_of(leaves: DataFrame, name: str) -> DataFrame:
    """Blocks of one tier from rows (grp, pos, digest (binary), item)."""
    block = F.shiftright("pos", 3 * LEVELS).alias("block")
    packed = leaves.groupBy("grp", block).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "item"))).alias("l"))
    made = _arrow(_built, "struct<store:binary,root:string,raised:string>")(F.col("l.digest"))
    made = packed.select("grp", "block", F.size("l").alias("leaves"), F.col("l.item").alias("items"), made.alias("m")).select("grp", "block", "leaves", "items", "m.*")
    made = staged(made, name)
    last = made.groupBy("grp").agg(F.max("block").alias("last"))
    return made.join(last, "grp")


def plant(leaves: DataFrame, name: str) -> Tree:
    """The tree of every group over rows (grp, pos, digest, item): block roots are the leaves of the next tier, until each group has one block."""
    tiers = [blocks_of(leaves, f"{name}-0")]
    while (tiers[-1].agg(F.max("last")).first()[0] or 0) > 0:
        up = tiers[-1].filter("last > 0").select("grp", F.col("block").alias("pos"), F.unhex("raised").alias("digest"), F.lit(None).cast("int").alias("item"))
        tiers.append(blocks_of(up, f"{name}-{len(tiers)}"))
    return Tree(tiers)


def roots(tree: Tree) -> DataFrame:
    """grp, subroot."""
    found = [t.filter("last = 0").select("grp", F.col("root").alias("subroot")) for t in tree.tiers]
    return found[0] if len(found) == 1 else _union(found)


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _paths(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    """Blocks -> paths of all their leaves; a block below its full height is raised by levels without siblings."""
    schema = pa.list_(pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))
    for store, leaves, path, raise_by in batches:
        rows = []
        for k in range(len(store)):
            own = [("", "")] * raise_by[k].as_py() + [(p["left"], p["right"]) for p in path[k].as_py()]
            block = Subtree(store[k].as_py(), leaves[k].as_py(), own)
            rows.append([[{"left": a, "right": b} for a, b in block.path_of(at)] for at in range(leaves[k].as_py())])
        yield pa.array(rows, schema)


def _raise_by() -> Column:
    """Levels that lift the root of a block to its full height; none for the only block of a group."""
    height = F.ceil(F.log(float(FAN), F.col("leaves").cast("double")) - F.lit(1e-9)).cast("int")
    return F.when(F.col("last") > 0, F.lit(LEVELS) - height).otherwise(F.lit(0)).cast("int")


def _path_column() -> Column:
    return _arrow(_paths, f"array<{PATH}>", True)("store", "leaves", "path", _raise_by())


def _with_paths(tier: DataFrame, above: DataFrame | None, tops: DataFrame) -> DataFrame:
    """Blocks of a tier with the path of their root and what the group's root is called: from the tier above, or from ``tops`` (grp, path, subroot)."""
    ends = tops.join(tier.filter("last = 0").select("grp"), "grp").select("grp", F.lit(0).cast("long").alias("block"), "path", "subroot")
    known = ends if above is None else above.select("grp", F.col("pos").alias("block"), "path", "subroot").unionByName(ends)
    return tier.withColumn("block", F.col("block").cast("long")).join(known, ["grp", "block"])


def descend(tree: Tree, tops: DataFrame) -> DataFrame:
    """Blocks of the lowest tier with the path of each block's root; ``tops``: grp, path of the group's root, subroot."""
    above = None
    for tier in reversed(tree.tiers[1:]):
        blocks = _with_paths(tier, above, tops)
        spread = blocks.select("grp", "block", "subroot", F.posexplode(_path_column()).alias("at", "path"))
        above = staged(spread.select("grp", (F.shiftleft("block", 3 * LEVELS) + F.col("at")).alias("pos"), "path", "subroot"), "paths")
    return _with_paths(tree.tiers[0], above, tops)


def _proofs(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    schema = pa.list_(pa.struct([("leaf", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string())]))
    for store, leaves, path, raise_by, altered in batches:
        rows = []
        for k in range(len(store)):
            own = [("", "")] * raise_by[k].as_py() + [(p["left"], p["right"]) for p in path[k].as_py()]
            block = Subtree(store[k].as_py(), leaves[k].as_py(), own)
            depth, out = block.levels - 1, []
            for at, other in enumerate(altered[k].as_py()):
                leaf = block.node(depth, at)
                out.append({"leaf": leaf, "proof_sha256": digest(block.tail(depth, at)), "folded_root": block.fold(at, leaf if other is None else other.hex())})
            rows.append(out)
        yield pa.array(rows, schema)


def sized(column: Column) -> Column:
    """A field of a leaf: ``-`` if null, else its UTF-8 byte count, a colon and the value."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
             altered: dict[str, Column] | None = None) -> DataFrame:
    """A row a row of ``docs``: key, leaf, subroot, root, proof_sha256, folded_root and verified.

    The leaf is the SHA-256 of the ``fields`` in their order. In each group leaves ascend by key (null first, then by leaf, so that repeated rows have a place each), in
    the tree of subroots groups ascend bytewise, null first. The proof of a row are the digests of its siblings level by level up to the root, proof_sha256 its
    digest. ``altered`` replaces fields for a trial (see the query): folded_root is recomputed from the altered leaf and the original siblings, and
    verified tells whether it equals the root. A group of one row has its leaf as subroot, a single subroot is the root. Other columns are not read; an empty
    table gives an empty result.
    """
    refuse(docs)
    of = lambda change: F.sha2(F.concat(*[sized(change.get(c, F.col(f"`{c}`"))) for c in fields]), 256)
    named = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("grp")
    other = F.unhex(of(altered)) if altered else F.lit(None).cast("binary")
    rows = docs.select(named, F.col(f"`{key}`").alias("key"), F.unhex(of({})).alias("digest"), other.alias("other"))
    leaves = numbered(rows, "key", "digest").select("grp", "pos", "digest", F.struct("key", "other").alias("item"))
    tree = plant(leaves, "tree")
    subroots = staged(roots(tree), "subroots")
    one = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), F.unhex("subroot").alias("digest"))
    upper = plant(numbered(one, "name").select("grp", "pos", "digest", F.col("name").alias("item")), "roots")
    top = roots(upper).first()
    empty = F.array().cast(PATH)
    starts = docs.sparkSession.createDataFrame([("", top[1] if top else "")], "grp string, subroot string").withColumn("path", empty)
    named_paths = descend(upper, starts).select("items", F.posexplode(_path_column()).alias("at", "path"))
    named_paths = named_paths.select(F.element_at("items", F.col("at") + 1).alias("grp"), "path")
    tops = staged(named_paths.join(subroots, "grp"), "tops")

    proofs = _arrow(_proofs, "array<struct<leaf:string,proof_sha256:string,folded_root:string>>", True)("store", "leaves", "path", _raise_by(), F.col("items.other"))
    row = F.zip_with("items", "p", lambda item, p: F.struct(item["key"].alias(key), p["leaf"].alias("leaf"), p["proof_sha256"].alias("proof_sha256"),
                                                            p["folded_root"].alias("folded_root")))
    out = descend(tree, tops).select("subroot", "items", proofs.alias("p")).select("subroot", F.explode(row).alias("z"))
    out = out.select(F.col(f"z.`{key}`"), "z.leaf", "subroot", F.lit(top[1] if top else "").alias("root"), "z.proof_sha256", "z.folded_root")
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
