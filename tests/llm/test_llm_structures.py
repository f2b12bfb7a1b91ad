"""Embedding near-duplicates, the Merkle manifest and the repair of conversations against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_llm_rows import LONG
from voxelry.llm import conversations, embedding_index, links, manifest
from voxelry.llm.queries import QUERIES

VECTORS = "vec_id bigint, embedding array<float>, label int, n int"


def brute_vectors(rows, cosine):
    """vec_id -> (links, smallest reachable id), over all pairs."""
    def sound(v):
        return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
    good = [(i, np.asarray(v, float)) for i, v in rows if i is not None and sound(v)]
    root, count = {i: i for i, _ in rows if i is not None}, {}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(good):
        count.setdefault(k, 0)
        for m, (j, b) in enumerate(good[:k]):
            if len(a) == len(b) and a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= cosine:
                count[k], count[m] = count[k] + 1, count[m] + 1
                x, y = sorted((find(i), find(j)))
                root[y] = x
    found = {}
    for k, (i, _) in enumerate(good):
        found.setdefault(i, []).append((count[k], find(i)))
    return found


def made_vectors(seed, groups=60, width=16):
    """Groups of near copies, whose members are turned by up to about the threshold's angle, and of equal ones."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rng.standard_normal(width)
        for _ in range(int(rng.choice([1, 2, 6, 15]))):
            step = rng.standard_normal(width)
            step *= np.linalg.norm(centre) / np.linalg.norm(step) * rng.choice([0, 0.02, 0.2, 0.3])
            rows.append((centre + step).astype(np.float32).tolist())
    rng.shuffle(rows)
    return [(int(i), r) for i, r in zip(rng.permutation(len(rows)) * 3, rows)]


@pytest.mark.parametrize("block, recall", [(8, 1.0), (1024, 1.0), (8, 0.999), (1024, 0.999)])
def test_near_vectors_against_all_pairs(spark, block, recall):
    rows = made_vectors(block, 90)
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], VECTORS).repartition(5)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_index.near_vectors(df, 0.95, block, recall).collect()}
    want = {i: v[0] for i, v in brute_vectors(rows, 0.95).items()}
    if recall == 1:
        assert got == want
    assert all(got[i][0] <= want[i][0] and got[i][1] >= want[i][1] for i in want)
    assert sum(n for n, _ in got.values()) >= 0.99 * sum(n for n, _ in want.values())


def test_near_vectors_dense_group(spark):
    """A third of the rows are distinct near copies of one vector: cut into many blocks, and counted in full."""
    rng = np.random.default_rng(5)
    centre = rng.standard_normal(24)
    rows = [(k, (centre + 0.03 * rng.standard_normal(24)).astype(np.float32).tolist()) for k in range(400)]
    rows += [(1000 + k, rng.standard_normal(24).astype(np.float32).tolist()) for k in range(800)]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], VECTORS)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_index.near_vectors(df, 0.95, 32).collect()}
    want = brute_vectors(rows, 0.95)
    assert got == {i: (v[0][0], v[0][1], v[0][1] == i) for i, v in want.items()}
    assert sum(n == 399 for n, _, _ in got.values()) == 400


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (9, [1.0, 2.0]),
            (9, [1.0, 2.0]), (None, [1.0, 2.0]), (10, [1.0, 2.0, 0.0]), (11, [1e30, 2e30]), (12, [-1.0, -2.0]), (13, [5.0]), (14, [7.0])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], VECTORS)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in embedding_index.near_vectors(df, 0.95).collect())
    alone = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 10, 12)]
    linked = [(i, 4, 7, i == 7) for i in (7, 8, 9, 9, 11)] + [(13, 1, 13, True), (14, 1, 13, False)]
    assert got == sorted([(0, 0, None, True), *alone, *linked], key=lambda r: (r[0], r[1]))
    empty = embedding_index.near_vectors(df.limit(0))
    assert empty.columns == ["vec_id", "n_links", "component_id", "kept"] and empty.count() == 0
    assert [r.n_links for r in embedding_index.near_vectors(df.filter("vec_id < 4")).collect()] == [0, 0, 0]


def test_traversal_visits_nearest_first():
    rng = np.random.default_rng(2)
    a, b = rng.random(9), rng.random(7)
    cells = embedding_index.traverse(a, b, 0.8)
    sums = [a[c // 7] + b[c % 7] for c in cells]
    assert sums == sorted(sums)
    assert set(cells) == {i * 7 + j for i in range(9) for j in range(7) if a[i] + b[j] <= a.min() + b.min() + 0.8}


def test_recall_at_the_threshold():
    """Neighbours turned by exactly the threshold's angle, of rows that were not in the sample."""
    rng = np.random.default_rng(8)
    rows = embedding_index.unit(rng.standard_normal((6000, 64)) + 2 * rng.standard_normal((12, 64))[rng.integers(0, 12, 6000)])
    index = embedding_index.fit_sample(rows[:3000], 0.95, 16)
    x = rows[3000:]
    turn = rng.standard_normal(x.shape)
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    y = 0.95 * x + np.sqrt(1 - 0.95 ** 2) * turn / np.linalg.norm(turn, axis=1, keepdims=True)
    cells = [[embedding_index.traverse(a, b, index.slack) for a, b in zip(embedding_index.squares(r[:, :32], index.left), embedding_index.squares(r[:, 32:], index.right))]
             for r in (x, y)]
    found = np.mean([p[0] in q or q[0] in p for p, q in zip(*cells)])
    assert found >= 0.99


def test_components(spark):
    rng = random.Random(4)
    hub = [(k, 0) for k in range(1, 3000)]
    path = [(10_000 + k + 1, 10_000 + k) for k in range(500)]
    tangled = [(a, b) for a, b in ((rng.randrange(20_000, 20_400), rng.randrange(20_000, 20_400)) for _ in range(260))]
    every = hub + path + tangled + tangled[:20] + [(7, 7)]
    rng.shuffle(every)
    df = spark.createDataFrame([(max(e), min(e)) for e in every], "u bigint, v bigint").repartition(8)
    root = {x: x for e in every for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in every:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {(r.u, r.v) for r in links.components(df).collect()}
    assert got == {(x, find(x)) for x in root if find(x) != x}
    assert links.components(df.limit(0)).count() == 0


DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows, lower):
    """Plain lists, level by level."""
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def up(level):
        levels = [level]
        while len(levels[-1]) > 1:
            level = levels[-1]
            levels.append([sha("".join(level[k:k + 8])) for k in range(0, len(level), 8)])
        return levels

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = up([leaf(r) for r in groups[g]])
    top = up([trees[g][-1][0] for g in order])
    root, out = top[-1][0], []
    for k, g in enumerate(order):
        for at, r in enumerate(groups[g]):
            node, proof = leaf(lower(r)), ""
            for levels, place in ((trees[g], at), (top, k)):
                for level in levels[:-1]:
                    run = place // 8 * 8
                    left, right = level[run:place], level[place + 1:run + 8]
                    proof += "".join(left + right)
                    node, place = sha("".join(left) + node + "".join(right)), place // 8
            out.append((r[0], trees[g][0][at], trees[g][-1][0], root, sha(proof), node, node == root))
    return out


def lowered(r):
    change = r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
    return (*r[:4], r[4].translate({c: c + 32 for c in range(65, 91)})) if change else r


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 9, "de": 8, None: 1}, {"en": 5000, "x": 64, "": 65, None: 3}, {f"l{k}": 1 + k % 3 for k in range(70)}])
def test_manifest_against_plain_lists(spark, sizes):
    rng, rows = random.Random(len(sizes)), []
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((rng.randrange(10 ** 6), rng.choice(["web", None, "ü"]), lang, rng.choice([None, 5]), rng.choice([None, "", "Größe A", "low", LONG[:300]])))
    rows += [rows[0], (None, None, rows[0][2], None, None)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], DOCS).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lower = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        got = manifest.manifest(df, altered={"text": F.coalesce(lower, F.col("text"))}).select(
            "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(brute_manifest(rows, lowered), key=key)


def test_manifest_of_nothing_and_unaltered(spark):
    df = spark.createDataFrame([(k, "s", "en", 1, f"t{k}", "x") for k in range(20)], DOCS)
    assert manifest.manifest(df.limit(0)).count() == 0
    assert manifest.manifest(df).filter("verified").count() == 20


def test_van_emde_boas_addresses():
    for levels in range(1, 6):
        where = np.concatenate(manifest.addresses(levels))
        assert sorted(where.tolist()) == list(range(manifest.nodes(levels)))
    # four levels: the top two are one piece, then each bottom subtree of two levels
    where = manifest.addresses(4)
    assert where[1].tolist() == list(range(1, 9))
    assert where[2][:3].tolist() == [9, 18, 27] and where[3][:9].tolist() == [*range(10, 18), 19]


TURNS = "conv_id bigint, turn bigint, role string, text string, gone boolean, audit string"


def brute_repair(rows):
    """Least (cost, edits) for each state, forward over (turn, role, text) rows; strings in full."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    need = {"": "user", "s": "user", "u": "assistant", "a": "user"}
    best = {"": (0, "", ())}

    def inserted(states):
        for _ in range(4):
            for s, (c, a, o) in list(states.items()):
                to = need[s][0]
                states[to] = min(states.get(to, (10 ** 9,)), (c + 5, a + "I", (*o, need[s] + ":")))
        return states

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for s, (c, a, o) in inserted(best).items():
            ways = [(s, c + 2, "D", ())]
            if fault not in ("blank", "duplicate"):
                c += 5 * (fault == "truncated")
                ways.append((need[s][0], c + 1, "R", (f"{need[s]}:{text}",)))
                if role[:1] == need[s][0] or (role[:1] == "s" and s == ""):
                    ways.append((role[:1], c, "K", (f"{role}:{text}",)))
            for to, cost, name, made in ways:
                after[to] = min(after.get(to, (10 ** 9,)), (cost, a + name, o + made))
        best = after
    cost, audit, out = min(v for s, v in inserted(best).items() if s in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
            cost, audit, sha("\n".join(out)))


def talks(seed, count):
    rng, rows = random.Random(seed), []
    for conv in [None, *range(count)]:
        for _ in range(rng.randrange(0, 9)):
            rows.append((conv, rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", "", None, "ua"]),
                         rng.choice(["Yes.", "No?", "cut", " ", "", None, "Well. \n", "Größe!", "x. ", "a\x85"]), rng.random() < 0.1, "clash"))
    return rows


def want_of(rows):
    return {c: brute_repair([r[1:4] for r in rows if r[0] == c and not r[4]]) for c in {r[0] for r in rows}}


def got_of(pieces):
    return {r[0]: tuple(r[1:]) for r in conversations.reports(pieces).collect()}


@pytest.mark.parametrize("spread", [False, True])
def test_repair_against_brute_force(spark, spread):
    rows = talks(3, 300)
    df = spark.createDataFrame(rows, TURNS).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(not spread).lower())
    try:
        got = got_of(conversations.repair(df, block=3 if spread else conversations.BLOCK_ROWS))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == want_of(rows)


def test_repair_of_one_long_conversation(spark):
    """A third of all rows are one conversation, spread over partitions and blocks; its repaired turns are given in pieces."""
    rng = random.Random(9)
    rows = [(1, k, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"t{k}.", f"t{k}", "", "again."]), False, "") for k in range(1500)]
    rows += [(2, 1, "user", "same.", False, "")] * 200
    rows += [(100 + k // 4, k, "user", "Hm?", k % 5 == 0, "") for k in range(2000)]
    df = spark.createDataFrame(rows, TURNS).repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        pieces = conversations.repair(df, block=64).cache()
        assert got_of(pieces) == want_of(rows)
        own = [r for r in pieces.filter("conv_id = 1").orderBy("piece").collect()]
        assert len(own) > 8 and [r.piece for r in own] == list(range(len(own)))
        text = "\n".join(f"{t.role}:{t.text}" for r in own for t in r.repaired)
        assert sha(text) == own[-1].repaired_sha256
        pieces.unpersist()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repair_of_odd_conversations(spark):
    df = spark.createDataFrame([(1, 1, "user", LONG + ".", False, ""), (1, 2, "assistant", "Fine.", False, ""), (2, 1, "user", "x", True, "")], TURNS)
    got = got_of(conversations.repair(df))
    assert got[1] == (0, 0, 0, 0, 0, 0, "KK", sha(f"user:{LONG}.\nassistant:Fine."))
    assert got[2] == (0, 0, 0, 0, 0, 0, "", sha(""))
    assert conversations.repair(df.limit(0)).count() == 0
    assert conversations.damage(df).columns == ["conv_id", "turn", "role", "text", "gone"]


def test_walk_recomputes_the_same_vectors():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 10, 50):
        codes = [rng.randrange(16) for _ in range(n)]
        whole = conversations.walk(codes, conversations.END, conversations.START)
        cut = n // 2
        later = conversations.Costs()
        for code in reversed(codes[cut:]):
            later.prepend(code)
        a = conversations.walk(codes[:cut], conversations.Costs(later.packed()).before(conversations.END), conversations.START)
        b = conversations.walk(codes[cut:], conversations.END, a[2])
        assert (a[0] + b[0], a[1] + b[1], b[2]) == whole


def test_queries_are_registered():
    assert {"op11_embedding_dedup", "op12_merkle_manifest", "op13_conversation_repair"} <= set(QUERIES)
