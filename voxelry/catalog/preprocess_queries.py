"""Queries that run the preprocessing plans over scans of differing grids, voxel sizes and orientations.

Every supplier's scan has a grid of its own. Odd ones have voxels of 0.5 x 1 x 2 mm and are interpolated, even ones keep their voxels; every fifth lies
along LPS. The brain masks come on a grid of their own, in two parts; some participants have specks only, some none at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import attach
from ..functions.matrix import pack
from ..plans import preprocess as plans
from ..plans.settings import Settings
from . import recipe as V
from .geometry_queries import OWN, _spline_views
from .recipe import NI, NJ, NK
from .registry import query
from .sqltext import VOX, components as cc_views, sql

GRID, CROP = (12, 12, 10), (8, 8, 6)
GI, GJ, GK = GRID
MIDDLE = tuple((n - 1) // 2 for n in GRID)
MASK_ORIGIN = (6.0, 5.0, 4.0)
#: Shift from the main scan to the other ones, in mm.
SHIFT = (1.0, 0.0, 0.5)
PLAN = Settings(conformed_dims=GRID, cropped_dims=CROP, voxel_size=(1.0, 1.0, 1.0), tolerance=0.0, min_mask_volume=4.0, mask_growth=0.0, crop_margin=2)


def _affine(sizes, origin):
    zero, one = F.lit(0.0), F.lit(1.0)
    return pack([[sizes[0], zero, zero, origin[0]], [zero, sizes[1], zero, origin[1]], [zero, zero, sizes[2], origin[2]], [zero, zero, zero, one]])


def scan_images(spark: SparkSession, d: str) -> DataFrame:
    s = F.col("subject_id")
    odd = s % 2 == 1
    sizes = (F.when(odd, 0.5).otherwise(1.0), F.lit(1.0), F.when(odd, 2.0).otherwise(1.0))
    origin = (F.lit(-2.0) - (s % 3).cast("double"), F.lit(-1.5), F.lit(0.5))
    return V.subjects(spark, d).select(
        "subject_id", (NI - s % 4).cast("int").alias("ni"), (NJ - s % 2).cast("int").alias("nj"), (NK - s % 3).cast("int").alias("nk"),
        *[v.alias(n) for n, v in zip(("vx", "vy", "vz"), sizes)], _affine(sizes, origin).alias("affine"), F.when(s % 5 == 0, "LPS").otherwise("RAS").alias("orient"))


def scan_voxels(spark: SparkSession, d: str, volume: DataFrame) -> DataFrame:
    own = scan_images(spark, d).select("subject_id", "ni", "nj", "nk")
    return volume.join(own, "subject_id").filter("i < ni AND j < nj AND k < nk").select("subject_id", "i", "j", "k", "v")


def mask_images(spark: SparkSession, d: str) -> DataFrame:
    one = [F.lit(1.0)] * 3
    return V.subjects(spark, d).select("subject_id", F.lit(NI).alias("ni"), F.lit(NJ).alias("nj"), F.lit(NK).alias("nk"),
                                       *[F.lit(1.0).alias(v) for v in ("vx", "vy", "vz")], _affine(one, [F.lit(-o) for o in MASK_ORIGIN]).alias("affine"), F.lit("RAS").alias("orient"))


MASK_RULE = "subject_id % 11 <> 3 AND i <> 4 AND (subject_id % 7 > 0 OR (i IN (2, 6) AND j IN (4, 5) AND k = 4))"


def mask_map(spark: SparkSession, d: str) -> DataFrame:
    return V.mask(spark, d).filter(MASK_RULE).withColumn("v", F.when((F.col("i") + F.col("j")) % 9 == 0, 0.25).otherwise(0.75))


def _place(axis: int, shift: float = 0.0, cell: str = "") -> str:
    """Position, in mm from the scan's own origin, of a conformed voxel."""
    n, size = OWN[axis].strip("()"), ("CASE subject_id % 2 WHEN 1 THEN 0.5 ELSE 1 END", "1", "CASE subject_id % 2 WHEN 1 THEN 2 ELSE 1 END")[axis]
    a = cell or "ijk"[axis]
    return f"({size} * (({n} - 1) // 2) + {a} - {MIDDLE[axis]} + {shift})::DOUBLE"


def _own_voxel(axis: int, shift: float = 0.0, cell: str = "") -> str:
    """The same in voxels of the scan."""
    size = ("CASE subject_id % 2 WHEN 1 THEN 0.5 ELSE 1 END", "1", "CASE subject_id % 2 WHEN 1 THEN 2 ELSE 1 END")[axis]
    return f"({_place(axis, shift, cell)} / ({size}))"


def _turned(axis: int) -> str:
    """Conformed voxel before it was turned to RAS."""
    a, n = "ijk"[axis], GRID[axis]
    return a if axis == 2 else f"(CASE subject_id % 5 WHEN 0 THEN {n - 1} - {a} ELSE {a} END)"


CELLS = f"SELECT s_suppkey AS subject_id, a.i::INT AS i, b.j::INT AS j, c.k::INT AS k FROM supplier, range({GI}) a(i), range({GJ}) b(j), range({GK}) c(k)"
INSIDE = " AND ".join(f"{x} BETWEEN 0 AND {n} - 1" for x, n in zip("xyz", OWN))
SPANS = ([NI - n for n in range(4)], [NJ, NJ - 1], [NK, NK - 1, NK - 2])


def _interpolated(image: str, points: str, name: str) -> dict[str, str]:
    """Cubic interpolation at points, clamped to the range of the scan with its background."""
    views = {f"{name}_{k}": v.replace("FROM ck ", f"FROM {name}_ck ").replace("FROM cj ", f"FROM {name}_cj ") for k, v in _spline_views(image, points, OWN, SPANS).items()}
    return {**views, f"{name}_range": f"SELECT subject_id, least(min(v), 0) AS lo, greatest(max(v), 0) AS hi FROM {image} GROUP BY 1",
            f"{name}_raw": f"""SELECT t.subject_id, t.i, t.j, t.k, sum(w * v) AS v FROM {name}_taps t JOIN {name}_ci c ON c.subject_id = t.subject_id AND c.i = si AND c.j = sj AND c.k = sk
 GROUP BY ALL HAVING abs(sum(w * v)) > 1e-12""",
            name: f"SELECT * FROM (SELECT {VOX}, least(greatest(v, lo), hi) AS v FROM {name}_raw JOIN {name}_range USING (subject_id)) WHERE v <> 0"}


def _normal(image: str, mask: str, name: str) -> dict[str, str]:
    return {f"{name}_q": f"SELECT subject_id, quantile_cont(greatest(coalesce(v, 0), 0), 0.99) AS q FROM {mask} LEFT JOIN {image} USING ({VOX}) GROUP BY 1",
            name: f"""SELECT {VOX}, CASE WHEN q > 0 THEN round(least(v / q, 1.3) / 1.3, 6) WHEN v > 0 THEN 1 END AS v FROM (SELECT {VOX}, v FROM {image} FULL JOIN {mask} USING ({VOX}))
 JOIN {name}_q USING (subject_id) WHERE v > 0 OR q = 0"""}


def _main_views(shift: float = 0.0) -> dict[str, str]:
    """``conformed``, ``brain``, ``box``, ``small`` and ``normal`` of a main scan whose mask lies ``shift`` times SHIFT away."""
    moved = [s * shift for s in SHIFT]
    origin = ["-2 - subject_id % 3", "-1.5", "0.5"]
    in_mask = ", ".join(f"{_place(a, moved[a], _turned(a))} + ({origin[a]}) + {MASK_ORIGIN[a]} AS {x}" for a, x in enumerate("xyz"))
    half = [n // 2 for n in CROP]
    inner = " AND ".join(f"{a} >= {a}0 AND {a} < {a}0 + {n}" for a, n in zip("ijk", CROP))
    crop = lambda source, rest: f"SELECT subject_id, i - i0 AS i, j - j0 AS j, k - k0 AS k{rest} FROM {source} JOIN box USING (subject_id) WHERE {inner}"
    return dict(
        cells=CELLS, own_prob="SELECT subject_id, i, j, k, v FROM prob WHERE " + " AND ".join(f"{a} < {n}" for a, n in zip("ijk", OWN)),
        points=f"SELECT * FROM (SELECT {VOX}, {', '.join(f'{_own_voxel(a)} AS {x}' for a, x in enumerate('xyz'))} FROM cells) WHERE {INSIDE}",
        odd_points="SELECT * FROM points WHERE subject_id % 2 = 1", odd_prob="SELECT * FROM own_prob WHERE subject_id % 2 = 1",
        **_interpolated("odd_prob", "odd_points", "cubic"),
        straight="""SELECT q.subject_id, q.i, q.j, q.k, v FROM points q JOIN own_prob p ON p.subject_id = q.subject_id AND p.i = q.x AND p.j = q.y AND p.k = q.z WHERE q.subject_id % 2 = 0""",
        conformed=f"SELECT subject_id, ({_turned(0)})::INT AS i, ({_turned(1)})::INT AS j, k, v FROM (SELECT * FROM cubic UNION ALL SELECT * FROM straight)",
        map=f"SELECT {VOX}, CASE WHEN (i + j) % 9 = 0 THEN 0.25 ELSE 0.75 END AS v FROM mask WHERE {MASK_RULE}",
        near=f"""SELECT q.subject_id, q.i, q.j, q.k FROM (SELECT * FROM (SELECT {VOX}, {in_mask} FROM cells) WHERE x BETWEEN 0 AND {NI - 1} AND y BETWEEN 0 AND {NJ - 1} AND z BETWEEN 0 AND {NK - 1}) q
 JOIN map m ON m.subject_id = q.subject_id AND m.i = floor(x + 0.5) AND m.j = floor(y + 0.5) AND m.k = floor(z + 0.5) WHERE m.v > 0.5""",
        **cc_views("near", name="nc", sides=(GJ, GK)),
        counted="SELECT *, count(*) OVER (PARTITION BY subject_id) AS n_clusters FROM (SELECT subject_id, cluster_id, count(*) AS n FROM nc GROUP BY ALL)",
        brain=f"SELECT {VOX} FROM nc JOIN (SELECT subject_id, cluster_id FROM counted WHERE n_clusters = 1 OR n > 4) USING (subject_id, cluster_id)",
        centre="SELECT subject_id, ceil(avg(i))::INT AS ci, ceil(avg(j))::INT AS cj, ceil(avg(k))::INT AS ck, max(k) AS top FROM brain GROUP BY 1",
        box=f"""SELECT subject_id, ci - {half[0]} AS i0, cj - {half[1]} AS j0, ck + CASE WHEN least(ck + {half[2]}, {GK}) <= top THEN top - least(ck + {half[2]}, {GK}) + 2 ELSE 0 END - {half[2]} AS k0 FROM centre""",
        small=crop("brain", ""), cropped=crop("conformed", ", v"), **_normal("cropped", "small", "normal"))


MAIN, SWI = _main_views(), _main_views(-1.0)
NORMAL_SQL = f"SELECT {VOX}, v FROM normal"


def _main(spark: SparkSession, d: str) -> plans.Prepared:
    return plans.preprocess(scan_images(spark, d), scan_voxels(spark, d, V.prob(spark, d)), mask_map(spark, d), mask_images(spark, d), PLAN)


def _rounded(df: DataFrame) -> DataFrame:
    return df.select("subject_id", "i", "j", "k", F.round("v", 6).alias("v"))


def _transforms(spark: SparkSession, d: str) -> DataFrame:
    one = [F.lit(1.0)] * 3
    return V.subjects(spark, d).select("subject_id", _affine(one, [F.lit(s) for s in SHIFT]).alias("transform"))


@query("preprocess", sql(NORMAL_SQL, **MAIN))
def preprocess(spark, d):
    """Conformed, masked, cropped and normalised main scans."""
    return _rounded(_main(spark, d).image)


@query("preprocess_mask", sql(f"SELECT {VOX}, i0, j0, k0 FROM small JOIN box USING (subject_id)", **MAIN))
def preprocess_mask(spark, d):
    """Cropped masks with the corner of their box."""
    main = _main(spark, d)
    return attach(main.mask, main.box.select("subject_id", "i0", "j0", "k0"))


@query("preprocess_status", sql("""SELECT s.subject_id, coalesce(max(n_clusters), 0)::BIGINT AS n_clusters, coalesce(count_if(n_clusters = 1 OR n > 4), 0)::BIGINT AS n_eligible,
 CASE WHEN max(n_clusters) IS NULL THEN 'empty mask' WHEN count_if(n_clusters = 1 OR n > 4) = 0 THEN 'no cluster above the minimum volume' ELSE 'ok' END AS status
 FROM subjects s LEFT JOIN counted c ON c.subject_id = s.subject_id GROUP BY 1""", **MAIN))
def preprocess_status(spark, d):
    """Every participant is told, also those whose mask failed."""
    return _main(spark, d).status


SECOND = {**MAIN, **dict(
    own_second="SELECT subject_id, i, j, k, v FROM folds WHERE fold = 1 AND " + " AND ".join(f"{a} < {n}" for a, n in zip("ijk", OWN)),
    crop_cells=f"SELECT subject_id, a.i::INT AS ci, b.j::INT AS cj, c.k::INT AS ck, a.i + i0 AS i, b.j + j0 AS j, c.k + k0 AS k FROM box, range({CROP[0]}) a(i), range({CROP[1]}) b(j), range({CROP[2]}) c(k)",
    second_points=f"SELECT * FROM (SELECT subject_id, ci AS i, cj AS j, ck AS k, {', '.join(f'{_own_voxel(a, SHIFT[a], _turned(a))} AS {x}' for a, x in enumerate('xyz'))} FROM crop_cells) WHERE {INSIDE}",
    **_interpolated("own_second", "second_points", "second"),
    second_masked=f"SELECT * FROM second SEMI JOIN small USING ({VOX})"),
    "second_q": f"SELECT subject_id, quantile_cont(greatest(coalesce(v, 0), 0), 0.99) AS q FROM small LEFT JOIN second_masked USING ({VOX}) GROUP BY 1"}


@query("preprocess_secondary", sql(f"""SELECT * FROM (SELECT {VOX}, CASE WHEN q > 0 THEN round(1 - least(coalesce(v, 0) / q, 1.3) / 1.3, 6) WHEN v > 0 THEN 0 END AS v FROM small LEFT JOIN second_masked USING ({VOX}) JOIN second_q USING (subject_id))
 WHERE v <> 0 OR v IS NULL""", **SECOND))
def preprocess_secondary(spark, d):
    """Another scan on the crop of the main one, through a known shift, with inverted intensities."""
    second = V.folds(spark, d).filter("fold = 1").select("subject_id", "i", "j", "k", "v")
    out = plans.preprocess_secondary(scan_images(spark, d), scan_voxels(spark, d, second), _main(spark, d), PLAN, _transforms(spark, d), inverse=True)
    return _rounded(out).filter("v <> 0 OR v IS NULL")


@query("preprocess_swi", sql(NORMAL_SQL, **SWI))
def preprocess_swi(spark, d):
    """A scan that keeps its own grid: the mask comes to it through the inverse of the shift."""
    return _rounded(plans.preprocess_swi(scan_images(spark, d), scan_voxels(spark, d, V.prob(spark, d)), mask_map(spark, d), mask_images(spark, d), _transforms(spark, d), PLAN).image)


@query("brain_segmentation_mask", sql(f"SELECT {VOX} FROM mask"))
def brain_segmentation_mask(spark, d):
    return plans.brain_segmentation("mask", V.DIMS, PLAN, mask=V.mask(spark, d))[1]


BLOCK_RULE = ("i BETWEEN 1 AND 10 AND j BETWEEN 1 AND 9 AND k BETWEEN 1 AND 6 AND subject_id % 6 <> 3 AND (subject_id % 6 NOT IN (1, 2) OR i <> 4) "
              "AND (subject_id % 6 <> 2 OR i < 4 OR k < 5)")
ROUGH_CROP, LEAST = (10, 10, 6), 50.0


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    """Dense blocks of tissue, in one part or two, whose background has bright specks."""
    rows = V.grid(spark, d).join(V.prob(spark, d), ["subject_id", "i", "j", "k"], "left")
    inside = (F.lit(0.6) + ((F.col("i") * 7 + F.col("j") * 5 + F.col("k") * 3 + F.col("subject_id")) % 10).cast("double") / 25)
    v = F.when(F.expr(BLOCK_RULE), inside).when(F.col("p") % 29 == 0, 0.9).otherwise(F.coalesce("v", F.lit(0.0)) / 2.5)
    return rows.select("subject_id", "i", "j", "k", v.alias("v")).filter("v > 0")


def _two_pass() -> dict[str, str]:
    half = [n // 2 for n in ROUGH_CROP]
    inner = " AND ".join(f"{a} >= {a}0 AND {a} < {a}0 + {n}" for a, n in zip("ijk", ROUGH_CROP))
    near = "abs(g.i-s.i) <= 1 AND abs(g.j-s.j) <= 1 AND abs(g.k-s.k) <= 1"
    verdict = lambda rank: f"SELECT subject_id, arg_max(cluster_id, {rank}) AS id FROM sized WHERE ok GROUP BY 1"
    return dict(
        tissue=f"""SELECT * FROM (SELECT {VOX}, CASE WHEN {BLOCK_RULE} THEN 0.6::DOUBLE + ((i*7 + j*5 + k*3 + subject_id) % 10)::DOUBLE / 25 WHEN p % 29 = 0 THEN 0.9 ELSE coalesce(v, 0) / 2.5 END AS v
 FROM grid LEFT JOIN prob USING ({VOX})) WHERE v > 0""",
        first=f"SELECT {VOX} FROM tissue WHERE v > 0.5",
        eroded=f"""SELECT g.subject_id, g.i, g.j, g.k FROM grid g JOIN first s ON s.subject_id = g.subject_id AND {near} GROUP BY ALL
 HAVING count(*) = """ + " * ".join(f"(least(g.{a} + 1, {n - 1}) - greatest(g.{a} - 1, 0) + 1)" for a, n in zip("ijk", V.DIMS)),
        opened=f"SELECT DISTINCT g.* FROM grid g JOIN eroded s ON s.subject_id = g.subject_id AND {near}",
        # what the opening leaves is one block, or two with the plane i = 4 between them; the closure over pairs of touching voxels would take minutes
        oc=f"SELECT *, min((i * {NJ} + j) * {NK} + k) OVER (PARTITION BY subject_id, subject_id % 6 IN (1, 2) AND i > 4)::BIGINT AS cluster_id FROM opened",
        sized=f"SELECT *, count(*) OVER (PARTITION BY subject_id) = 1 OR n > {LEAST} AS ok FROM (SELECT subject_id, cluster_id, count(*) AS n, max(k) AS top FROM oc GROUP BY ALL)",
        biggest=verdict("n * 100000 - cluster_id"), topmost=verdict("top::BIGINT * 1000000000 + n * 100000 - cluster_id"),
        chosen="SELECT subject_id, b.id AS cluster_id FROM biggest b JOIN topmost t USING (subject_id) WHERE b.id = t.id",
        rough=f"SELECT {VOX} FROM oc JOIN chosen USING (subject_id, cluster_id)",
        centre="SELECT subject_id, ceil(avg(i))::INT AS ci, ceil(avg(j))::INT AS cj, ceil(avg(k))::INT AS ck, max(k) AS top FROM rough GROUP BY 1",
        box=f"""SELECT subject_id, ci - {half[0]} AS i0, cj - {half[1]} AS j0, ck + CASE WHEN least(ck + {half[2]}, {NK}) <= top THEN top - least(ck + {half[2]}, {NK}) + 2 ELSE 0 END - {half[2]} AS k0 FROM centre""",
        bright=f"SELECT subject_id, quantile_cont(coalesce(v, 0), 0.99) AS q FROM (SELECT * FROM rough JOIN box USING (subject_id) WHERE {inner}) LEFT JOIN tissue USING ({VOX}) GROUP BY 1",
        second=f"SELECT {VOX} FROM tissue JOIN box USING (subject_id) JOIN bright USING (subject_id) WHERE {inner} AND least(v / q, 1.3) / 1.3 > 0.5")


def _bright(dense, fold):
    return (dense[..., 0] > 0.4 + 0.1 * fold).astype(float)


def _rough(spark: SparkSession, d: str):
    settings = Settings(conformed_dims=V.DIMS, cropped_dims=ROUGH_CROP, voxel_size=(1.0, 1.0, 1.0), mask_growth=0.0, crop_margin=2)
    return plans.two_pass_mask(V.images(spark, d), _blocks(spark, d), _bright, 2, settings, 1, LEAST)


@query("two_pass_mask", sql(f"SELECT {VOX} FROM second", **_two_pass()))
def two_pass_mask(spark, d):
    """A rough mask, opened and checked, then a second one inside its crop, back on the whole grid."""
    return _rough(spark, d).voxels.select("subject_id", "i", "j", "k")


@query("two_pass_mask_status", sql("""SELECT s.subject_id, coalesce(n_clusters, 0)::BIGINT AS n_clusters, coalesce(n_eligible, 0)::BIGINT AS n_eligible,
 CASE WHEN n_clusters IS NULL THEN 'empty mask' WHEN n_eligible = 0 THEN 'no cluster above the minimum volume' WHEN c.cluster_id IS NULL THEN 'biggest cluster is not the topmost' ELSE 'ok' END AS status
 FROM subjects s LEFT JOIN (SELECT subject_id, count(*) AS n_clusters, count_if(ok) AS n_eligible FROM sized GROUP BY 1) n ON n.subject_id = s.subject_id LEFT JOIN chosen c ON c.subject_id = s.subject_id""",
 **_two_pass()))
def two_pass_mask_status(spark, d):
    return _rough(spark, d).status
