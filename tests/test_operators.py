"""Operators against brute force on small volumes, and properties."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelry.functions.joins import attach, salted_join
from voxelry.functions.hull import half_spaces
from voxelry.functions.offsets import ellipsoid, neighbours
from voxelry.functions.quantiles import exact_percentiles
from voxelry.operators import components, fill, lines, models, morphology, parcellation, scoring, smoothing, stats, voxel

DIMS = (9, 8, 7)


def table(spark, volume, subject="a", value="v"):
    rows = [(subject, *map(int, ix), float(volume[tuple(ix)])) for ix in np.argwhere(volume)]
    df = spark.createDataFrame(rows, "subject_id string, i int, j int, k int, v double")
    return df if value == "v" else df.withColumn(value, F.col("v").cast("int")).drop("v")


def dense(df, dims=DIMS, value=None):
    out = np.zeros(dims)
    for r in df.collect():
        out[r.i, r.j, r.k] = 1 if value is None else r[value]
    return out


def flood(mask, connectivity):
    """Smallest voxel number of the component of each voxel."""
    out = np.full(mask.shape, -1)
    for start in map(tuple, np.argwhere(mask)):
        if out[start] >= 0:
            continue
        number, todo = np.ravel_multi_index(start, mask.shape), [start]
        out[start] = number
        while todo:
            at = todo.pop()
            for o in neighbours(connectivity):
                to = tuple(np.add(at, o))
                if all(0 <= x < n for x, n in zip(to, mask.shape)) and mask[to] and out[to] < 0:
                    out[to] = number
                    todo.append(to)
    return out


@pytest.fixture(scope="module")
def mask():
    return np.random.default_rng(3).random(DIMS) < 0.3


@pytest.mark.parametrize("connectivity, brick", [(26, 32), (6, 32), (18, 4), (6, 3)])
def test_components(spark, mask, connectivity, brick):
    got = components.label_components(table(spark, mask), DIMS, connectivity, brick=brick).collect()
    want = flood(mask, connectivity)
    assert len(got) == mask.sum()
    assert all(r.cluster_id == want[r.i, r.j, r.k] for r in got)


def test_component_through_many_bricks(spark):
    """One snake through every brick: the star steps have to join a long chain."""
    dims = (32, 4, 2)
    snake = np.zeros(dims, bool)
    snake[:, 0, 0] = snake[:, 3, 0] = snake[-1, :, 0] = True
    got = components.label_components(table(spark, snake), dims, brick=2)
    assert got.select("cluster_id").distinct().collect() == [(0,)]
    assert got.select("part_id").distinct().count() > 20
    sized = components.attach_to_clusters(got, components.census(got))
    assert {r.cluster_size for r in sized.collect()} == {int(snake.sum())}


def test_partition_count_does_not_matter(spark, mask):
    runs = []
    for n in (1, 8):
        rows = components.label_clusters(table(spark, mask).repartition(n), 0.5, DIMS, 2, brick=4)
        runs.append(sorted((r.i, r.j, r.k, r.cluster_id, r.new_id) for r in rows.collect()))
    assert runs[0] == runs[1]
    ids = sorted({r[3] for r in runs[0]})
    assert {r[3]: r[4] for r in runs[0]} == {c: n + 1 for n, c in enumerate(ids)}


def test_renumber_over_blocks(spark):
    rows = spark.createDataFrame([("a", 7 * n) for n in range(50)], "subject_id string, cluster_id bigint")
    got = {r.cluster_id: r.new_id for r in components.renumber(rows, block=20).collect()}
    assert got == {7 * n: n + 1 for n in range(50)}


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_exact_percentiles(spark, accuracy):
    """With a coarse sketch only the brackets are ranked, and the result is still exact."""
    rng = np.random.default_rng(5)
    groups = {"a": rng.normal(size=3000), "b": np.repeat([1.0, 2.0], [2500, 700]), "c": np.array([4.0]), "d": rng.integers(0, 40, 900).astype(float)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in groups.items() for v in vs], "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.95, 0.999, 1.0]
    got = {r.g: r.q for r in exact_percentiles(df, ["g"], "v", probs, accuracy).collect()}
    for g, vs in groups.items():
        assert np.allclose(got[g], np.percentile(vs, [100 * p for p in probs])), g


def test_attach_small_and_large(spark, mask):
    rows, small = table(spark, mask), spark.createDataFrame([("a", 1)], "subject_id string, x int")
    assert attach(rows, small).count() == attach(rows, small, limit=0).count() == mask.sum()
    assert salted_join(rows, small, how="left_anti").count() == 0
    with pytest.raises(ValueError):
        salted_join(rows, small, how="full_outer")


def test_morphology_properties(spark, mask):
    df = table(spark, mask)
    grown, shrunk = dense(morphology.dilate_box(df, (1, 2, 1), DIMS)), dense(morphology.erode_box(df, (1, 1, 1), DIMS))
    opened = dense(morphology.open_box(df, (1, 1, 1), DIMS))
    assert (shrunk <= mask).all() and (mask <= grown).all() and (opened <= mask).all()
    ball = dense(morphology.dilate_l1(df, 1, DIMS))
    foot = dense(morphology.dilate_footprint(df, [(0, 0, 0)] + neighbours(6), DIMS))
    assert (ball == foot).all()


def test_erosion_edge_cases(spark):
    full = np.ones(DIMS, bool)
    df = table(spark, full)
    assert morphology.erode_box(df, (2, 2, 2), DIMS).count() == full.size
    assert morphology.erode_l1(df, 3, DIMS).count() == full.size
    assert morphology.erode_steps(df, 1, DIMS).count() == 7 * 6 * 5
    empty = df.filter("v < 0")
    assert morphology.dilate_l1(empty, 2, DIMS).count() == 0
    assert fill.hull_fill(empty).count() == 0


def test_euclidean_limit(spark, mask):
    df = table(spark, mask)
    all_ = {(r.i, r.j, r.k): r.d for r in morphology.euclidean_distance(df, DIMS).collect()}
    near = {(r.i, r.j, r.k): r.d for r in morphology.euclidean_distance(df, DIMS, limit=1.5).collect()}
    assert near == {x: v for x, v in all_.items() if v <= 1.5}


def test_ellipsoid():
    assert len(ellipsoid((1, 1, 1))) == 7 and len(ellipsoid((0.2, 1, 1))) == 7
    assert max(o[0] for o in ellipsoid((9, 1, 1), 3)) == 3


def test_half_spaces_against_all_triples():
    """Random small sets, also flat ones, lines and single points, against the planes of all triples of points."""
    rng = np.random.default_rng(5)
    grid = np.stack(np.meshgrid(*[np.arange(7)] * 3, indexing="ij"), -1).reshape(-1, 3)
    for n in (1, 2, 3, 4, 5, 8, 14, 30):
        for case in range(12):
            pts = rng.integers(0, 7, (n, 3))
            if case % 4 == 1:
                pts[:, case % 3] = 3
            if case % 4 == 2:
                pts = pts[:1] + np.outer(np.arange(n) % 3, [1, -1, 0])
                pts = pts - pts.min(axis=0)
            found = half_spaces(pts)
            inside = (grid @ found[:, :3].T <= found[:, 3]).all(axis=1)
            assert (pts @ found[:, :3].T <= found[:, 3]).all()
            if np.linalg.matrix_rank(pts - pts[0]) < 3:
                # in a flat set the hull is where no point of the plane or line is cut off by a line through two points
                d = pts - pts[0]
                rank, off = np.linalg.matrix_rank(d), grid - pts[0]
                flat = np.array([np.linalg.matrix_rank(np.vstack([d, o])) == rank for o in off])
                want = flat.copy()
                if rank == 2:
                    normal = next(c for c in (np.cross(a, b) for a in d for b in d) if c.any())
                    for a in pts:
                        for b in pts:
                            side = np.cross(normal, b - a)
                            if side.any() and ((pts - a) @ side <= 0).all():
                                want &= (grid - a) @ side <= 0
                elif rank == 1:
                    u = next(x for x in d if x.any())
                    want &= (off @ u >= (d @ u).min()) & (off @ u <= (d @ u).max())
            else:
                want = np.ones(len(grid), bool)
                for a in range(n):
                    for b in range(a):
                        for c in range(b):
                            normal = np.cross(pts[b] - pts[a], pts[c] - pts[a])
                            for m in (normal, -normal):
                                if m.any() and ((pts - pts[a]) @ m <= 0).all():
                                    want &= (grid - pts[a]) @ m <= 0
            assert (inside == want).all(), (n, case)


def test_hull_contains_and_is_idempotent(spark):
    tetra = np.zeros(DIMS, bool)
    for p in ((0, 0, 0), (8, 0, 0), (0, 7, 0), (0, 0, 6)):
        tetra[p] = True
    once = dense(fill.hull_fill(table(spark, tetra)))
    assert (tetra <= once).all() and once[1, 1, 1] and not once[8, 7, 6]
    assert (dense(fill.hull_fill(table(spark, once))) == once).all()


def test_gaussian_keeps_constant(spark):
    image = np.full(DIMS, 3.0)
    out = dense(smoothing.gaussian_smooth(table(spark, image), DIMS, 4.0, (1.0, 2.0, 0.7)), value="v")
    assert np.allclose(out, 3.0)


def test_gaussian_by_own_voxel_sizes(spark):
    """Scans of differing grids and voxel sizes in one call equal one call a scan; voxels beyond the own grid and unnamed scans are left out."""
    rng = np.random.default_rng(5)
    scans = {1: ((9, 8, 7), (1.0, 2.0, 0.7)), 2: ((5, 8, 3), (0.5, 1.0, 1.0)), 3: ((9, 2, 7), (2.0, 2.0, 2.5))}
    shape = tuple(max(g[0][a] for g in scans.values()) for a in range(3))
    rows, want = [], {}
    for s, (dims, sizes) in scans.items():
        image = rng.random(dims)
        rows += [(s, *map(int, p), float(image[p])) for p in np.ndindex(*dims)]
        alone = spark.createDataFrame([(s, *map(int, p), float(image[p])) for p in np.ndindex(*dims)], "subject_id bigint, i int, j int, k int, v double")
        want |= {(s, r.i, r.j, r.k): r.v for r in smoothing.gaussian_smooth(alone, dims, 3.0, sizes).collect()}
    rows += [(2, 8, 7, 6, 99.0), (4, 0, 0, 0, 99.0)]
    grids = spark.createDataFrame([(s, *d, *v) for s, (d, v) in scans.items()], "subject_id bigint, ni int, nj int, nk int, vx double, vy double, vz double")
    image = spark.createDataFrame(rows, "subject_id bigint, i int, j int, k int, v double")
    got = {(r.subject_id, r.i, r.j, r.k): r.v for r in smoothing.gaussian_smooth(image, shape, 3.0, grids=grids).collect()}
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-12 for p in want)


def test_otsu_classes(spark):
    """Three separate levels are split between the levels; brute force over all pairs of cuts agrees."""
    rng = np.random.default_rng(2)
    image = np.concatenate([rng.normal(1, 0.05, 200), rng.normal(2, 0.05, 200), rng.normal(4, 0.05, 104)]).reshape(DIMS)
    cuts = stats.otsu_threshold(table(spark, image), DIMS, 3, 64).first().thresholds
    counts, edges = np.histogram(image, 64)
    centre = (edges[1:] + edges[:-1]) / 2
    def score(parts):
        return sum((c * np.arange(64)[s]).sum() ** 2 / max(c.sum(), 1) for s in parts for c in [counts[s]])
    best = max(((score([slice(0, a + 1), slice(a + 1, b + 1), slice(b + 1, 64)]), -a, -b) for a in range(63) for b in range(a + 1, 63)))
    assert np.allclose(sorted(cuts), [centre[-best[1]], centre[-best[2]]])


def test_remove_islands_to_background(spark):
    volume = np.zeros(DIMS, int)
    volume[1:4, 1:4, 1:4] = 5
    volume[7, 6, 5] = 5
    out = parcellation.remove_islands(table(spark, volume, value="label"), DIMS, 10)
    assert {(r.i, r.label, r.removed) for r in out.filter("removed IS NOT NULL").collect()} == {(7, 0, 5)}
    assert out.filter("label <> 0").count() == 27


def test_predict_tiles_match_whole(spark, mask):
    def box_mean(channels, fold):
        padded = np.pad(channels[..., 0], 1)
        total = sum(padded[1 + a:padded.shape[0] - 1 + a, 1 + b:padded.shape[1] - 1 + b, 1 + c:padded.shape[2] - 1 + c]
                    for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1))
        return (total / 27 + 0.01) * (fold + 1) / 2

    stack = voxel.stack_channels([table(spark, mask)])
    whole = models.predict_volumes(stack, box_mean, 2, DIMS)
    tiled = models.predict_volumes(stack, box_mean, 2, DIMS, (4, 4, 4), 1)
    key = lambda df: {(r.fold, r.i, r.j, r.k): round(r.v, 5) for r in df.collect()}
    assert key(whole) == key(tiled) and len(key(tiled)) == 2 * np.prod(DIMS)  # also tiles without any voxel
    nobody = models.predict_volumes(stack, box_mean, 1, DIMS, (4, 4, 4), 1, subjects=spark.createDataFrame([("z",)], "subject_id string"))
    assert nobody.filter("subject_id = 'z'").count() == np.prod(DIMS)
    mean = models.fold_ensemble(whole, 2)
    assert mean.count() >= whole.filter("fold = 0").count()
    hooked = models.binarise_prediction(whole, 0.1, lambda f, t: models.hilo_ensemble(f, 2, t))
    assert hooked.count() >= models.hilo_ensemble(whole, 2, 0.5).count()


def test_scores_of_a_side_without_hits(spark):
    """All clusters of one side are filtered away, the other side's touch them, nothing is invented: both rates are 1."""
    small, large = np.zeros(DIMS), np.zeros(DIMS)
    small[2, 2, 2], large[2:5, 2, 2] = 1, 1
    for truth, predicted in ((small, large), (large, small)):
        r = scoring.cluster_scores(table(spark, truth), table(spark, predicted), DIMS, 1).first()
        assert (r.sensitivity, r.precision, r.f1) == (1.0, 1.0, 1.0)
    far = np.zeros(DIMS)
    far[6:, 6, 5] = 1
    r = scoring.cluster_scores(table(spark, small), table(spark, far + large), DIMS, 1).first()
    assert (r.sensitivity, r.precision, r.fp) == (0.0, 0.5, 1)


def test_status_of_every_subject(spark):
    """The biggest cluster is not the topmost in one, nothing is large enough in another, a third has no voxel at all."""
    a, b = np.zeros(DIMS), np.zeros(DIMS)
    a[1:4, 1, 1], a[1:3, 5, 6] = 1, 1
    b[1, 1, 1], b[5, 5, 5] = 1, 1
    rows = table(spark, a, "a").unionByName(table(spark, b, "b"))
    everyone = spark.createDataFrame([("a",), ("b",), ("c",)], "subject_id string")
    for keep, want in (("size", "biggest cluster is not the topmost"), ("top", "ok"), ("keep_all", "ok")):
        found = components.check_clusters(rows, DIMS, keep, 1, subjects=everyone)
        assert {r.subject_id: r.status for r in found.status.collect()} == {
            "a": want, "b": "no cluster above the minimum volume", "c": "empty mask"}
        assert {r.subject_id for r in found.voxels.collect()} == ({"a"} if want == "ok" else set())


def test_reference_properties(spark, mask):
    """Normalised maximum below the input maximum, crop has its size, thresholding lowers the mean."""
    image = np.where(mask, 50.0 + np.arange(mask.size).reshape(DIMS), 0)
    df = table(spark, image)
    brain = table(spark, np.ones(DIMS))
    assert dense(voxel.normalise(df, brain), value="v").max() <= 1.0
    assert dense(voxel.threshold(df, 100.0), value="v").mean() <= image.mean()
    head = spark.createDataFrame([("a", *DIMS, np.eye(4).ravel().tolist())], "subject_id string, ni int, nj int, nk int, affine array<double>")
    box = voxel.crop_box(head, (4, 4, 4), brain, margin=0)
    cut = voxel.crop_voxels(df, box)
    r = cut.agg(F.max("i"), F.max("j"), F.max("k"), F.min("i")).first()
    assert max(r[:3]) <= 3 and r[3] >= 0
    back = voxel.uncrop_voxels(cut, box, head)
    assert back.join(df, ["subject_id", "i", "j", "k", "v"], "left_anti").count() == 0


def test_zero_percentile_is_reported(spark):
    one = np.zeros(DIMS)
    one[0, 0, 0] = 5
    scale = voxel.normalisation_scale(table(spark, one), table(spark, np.ones(DIMS)), [50.0]).first()
    assert scale.scale == [None] and scale.status == "zero percentile"


def test_random_shift_is_reproducible(spark, mask):
    df = table(spark, mask)
    a, b = (sorted(voxel.shift_volume(df, DIMS, seed=4).collect()) for _ in range(2))
    assert a == b
    assert len(voxel.orientation_codes()) == len(set(voxel.orientation_codes())) == 48


@pytest.mark.parametrize("length", [1, 2, 3, 12, 40])
def test_line_kernels_against_all_pairs(length):
    """Envelopes over a line, also with values beyond its length and with empty lines."""
    rng = np.random.default_rng(length)
    d = np.where(rng.random((300, length)) < 0.3, rng.integers(0, 2 * length + 2, (300, length)).astype(float), np.inf)
    x = np.arange(length)
    apart = np.abs(x[:, None] - x[None, :])
    assert (lines.chessboard_kernel(d) == np.minimum.reduce(np.maximum(d[:, None, :], apart[None]), axis=2)).all()
    for spacing in (1.0, 0.7):
        want = np.minimum.reduce((d * spacing)[:, None, :] + (apart * spacing)[None] ** 2, axis=2)
        assert np.allclose(lines.squared_kernel(spacing)(d * spacing), want, rtol=1e-12)


def test_nearest_label_fronts_against_all_pairs(spark):
    """Many labels, ties at every distance, a mask larger than the seeds' surroundings, a participant without seeds."""
    rng = np.random.default_rng(3)
    dims = (9, 14, 6)
    cells = np.argwhere(np.ones(dims))
    rows, want = [], {}
    for who, count in (("a", 40), ("b", 3), ("c", 0)):
        at = cells[rng.choice(len(cells), count, replace=False)]
        label = rng.integers(1, 30, count)
        rows += [(who, *map(int, p), int(v)) for p, v in zip(at, label)]
        for c in cells[::3] if count else []:
            far = np.abs(at - c).max(axis=1)
            want[(who, *map(int, c))] = int(label[far == far.min()].min())
    labels = spark.createDataFrame(rows, "subject_id string, i int, j int, k int, label int")
    mask = spark.createDataFrame([(w, *map(int, c)) for w in "abc" for c in cells[::3]], "subject_id string, i int, j int, k int")
    got = fill.nearest_label_fill(labels, mask, dims).collect()
    assert {(r.subject_id, r.i, r.j, r.k): r.label for r in got} == want and len(got) == len(want)


def joined(edges):
    """Smallest member of the component of every node, for edges (key, u, v)."""
    root = {(s, x): x for s, u, v in edges for x in (u, v)}

    def find(s, x):
        while root[s, x] != x:
            x = root[s, x]
        return x

    for s, u, v in edges:
        a, b = sorted((find(s, u), find(s, v)))
        root[s, b] = a
    return {(s, x, find(s, x)) for s, x in root if find(s, x) != x}


def test_contract_hub_snake_and_tangle(spark, monkeypatch):
    """A hub of most of all edges, a snake through all tasks, and a tangle; few rounds, keys kept apart."""
    rng = np.random.default_rng(7)
    edges = [("hub", k, 0) for k in range(1, 6000)] + [("snake", k + 1, k) for k in range(2000)]
    edges += [(w, int(max(a, b)), int(min(a, b))) for w in ("p", "q") for a, b in rng.integers(0, 300, (220, 2)) if a != b]
    order = rng.permutation(len(edges))
    df = spark.createDataFrame([edges[k] for k in order], "subject_id string, u bigint, v bigint").repartition(8)
    rounds, plain = [], components.staged
    monkeypatch.setattr(components, "staged", lambda df, name: rounds.append(name) or plain(df, name))
    got = {tuple(r) for r in components.contract(df, ["subject_id"]).collect()}
    assert got == joined(edges)
    assert len(rounds) <= 5
    assert components.contract(df.limit(0), ["subject_id"]).count() == 0


@pytest.mark.parametrize("brick", [32, 4])
def test_chains_cut_at_every_level(spark, brick):
    """A cut through the tree of components gives what labelling each threshold anew gives."""
    rng = np.random.default_rng(brick)
    levels = rng.integers(0, 6, DIMS) * (rng.random(DIMS) < 0.6)
    df = table(spark, levels, value="level")
    chains, stars = components.component_chains(df, DIMS, brick=brick)
    assert (stars is None) == (brick == 32)
    root = {(r.level, r.u): r.v for r in stars.collect()} if stars is not None else {}
    rows = chains.collect()
    assert len(rows) == (levels > 0).sum()
    for t in range(1, 6):
        want = flood(levels >= t, 26)
        for r in rows:
            if r.level >= t:
                assert root.get((t, r.chain[t - 1]), r.chain[t - 1]) == want[r.i, r.j, r.k]
            else:
                assert len(r.chain) < t


def brute_hull(points, dims):
    """Grid cells that no half-space of the points cuts off, all half-spaces on all cells."""
    planes = half_spaces(points)
    cells = np.argwhere(np.ones(dims))
    return {tuple(map(int, c)) for c in cells[(cells @ planes[:, :3].T <= planes[:, 3]).all(axis=1)]}


def test_hull_in_two_stages(spark):
    """Round, pointed, flat, thin and tiny masks, each a group of its own, against all half-spaces on all cells."""
    rng, dims = np.random.default_rng(5), (22, 19, 17)
    cells = np.argwhere(np.ones(dims))
    middle = np.array(dims) / 2
    shapes = {"ball": cells[np.square(cells - middle).sum(axis=1) <= 60], "octahedron": cells[np.abs(cells - middle).sum(axis=1) <= 7],
              "few": cells[rng.choice(len(cells), 5, replace=False)], "many": cells[rng.choice(len(cells), 200, replace=False)],
              "plane": cells[(cells[:, 2] == 4) & (np.square(cells[:, :2] - 9).sum(axis=1) <= 30)], "tilted": np.array([[0, 0, 0], [8, 0, 4], [0, 8, 4], [8, 8, 8]]),
              "wall": cells[(cells[:, 0] == 3) & (np.abs(cells[:, 1:] - 8).sum(axis=1) <= 5)], "line": np.array([[1, 1, 1], [4, 7, 10]]), "point": np.array([[2, 3, 4]]),
              "pillar": np.array([[5, 5, 2], [5, 5, 9]]), "sheet": np.array([[0, 0, 0], [9, 3, 0], [9, 3, 8]])}
    rows = [(name, *map(int, p)) for name, points in shapes.items() for p in points]
    mask = spark.createDataFrame(rows, "subject_id string, i int, j int, k int").repartition(7)
    got = {}
    for r in fill.hull_fill(mask).collect():
        got.setdefault(r.subject_id, []).append((r.i, r.j, r.k))
    for name, points in shapes.items():
        assert len(got[name]) == len(set(got[name])) and set(got[name]) == brute_hull(points, dims), name
    kept = {r.subject_id: r["count"] for r in fill.hull_corners(mask).groupBy("subject_id").count().collect()}
    assert kept["ball"] < 0.15 * len(shapes["ball"]) and kept["octahedron"] <= 24


def test_networks_are_loaded_once_a_worker(spark, mask, tmp_path):
    """Many tiles and folds: every worker process loads the network of a fold once, and a field gives the map of the whole grid."""
    import os
    import uuid

    folder = str(tmp_path)

    def load(fold):
        open(os.path.join(folder, f"{os.getpid()}-{fold}-{uuid.uuid4().hex}"), "w").close()

        def run(dense):
            padded = np.pad(dense[..., 0], 1)
            return sum(padded[1 + a:padded.shape[0] - 1 + a, 1:-1, 1:-1] for a in (-1, 0, 1)) / 3 * (fold + 1) / 2
        return run

    stack = voxel.stack_channels([table(spark, mask)])
    model = models.Loaded(load)
    key = lambda df: {(r.fold, r.i, r.j, r.k): round(r.v, 5) for r in df.collect()}
    tiled = key(models.predict_volumes(stack, model, 2, DIMS, (3, 3, 3), field=3))
    loads = [name.rsplit("-", 1)[0] for name in os.listdir(folder)]
    assert len(loads) == len(set(loads)) <= 2 * 8
    assert tiled == key(models.predict_volumes(stack, model, 2, DIMS))
