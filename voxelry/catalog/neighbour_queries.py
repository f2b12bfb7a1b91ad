"""Queries of components, morphology, distances, fills, smoothing and edges."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions.offsets import ellipsoid
from ..operators import components, fill, morphology, smoothing
from . import recipe as V
from .recipe import DIMS, NI, NJ, NK
from .registry import query
from .sqltext import VOX, components as cc_views, eroded, near, sql

HIGH = {"high": f"SELECT {VOX} FROM prob WHERE p > 800"}
THICK = {"thick": f"SELECT {VOX} FROM grid ANTI JOIN (SELECT * FROM prob WHERE p > 900) q USING ({VOX})"}


def high(spark, d):
    return V.prob(spark, d).filter("p > 800").select("subject_id", "i", "j", "k")


def thick(spark, d):
    """A mask with holes: the grid without the highest voxels."""
    holes = V.prob(spark, d).filter("p > 900")
    return V.grid(spark, d).join(holes.select("subject_id", "i", "j", "k"), ["subject_id", "i", "j", "k"], "left_anti")


@query("connected_components_26", sql(f"SELECT {VOX}, cluster_id FROM cc", **HIGH, **cc_views("high")))
def connected_components_26(spark, d):
    return components.label_components(high(spark, d), DIMS).drop("part_id")


@query("connected_components_6", sql(f"SELECT {VOX}, cluster_id FROM cc", **HIGH, **cc_views("high", 1)))
def connected_components_6(spark, d):
    return components.label_components(high(spark, d), DIMS, 6).drop("part_id")


@query("connected_components_bricks", sql(f"SELECT {VOX}, cluster_id FROM cc", **HIGH, **cc_views("high")))
def connected_components_bricks(spark, d):
    """The same components, put together from bricks of 4x4x4 as on grids larger than one brick."""
    return components.label_components(high(spark, d), DIMS, brick=4).drop("part_id")


@query("connected_components_equal", sql(f"SELECT {VOX}, label, cluster_id FROM cc", high_label="SELECT * FROM parc WHERE label IN (2, 251, 14, 1002)",
                                         **cc_views("high_label", equal="label")))
def connected_components_equal(spark, d):
    rows = V.parc(spark, d).filter("label IN (2, 251, 14, 1002)")
    return components.label_components(rows, DIMS, equal="label").drop("part_id")


KEPT = dict(
    sized=f"SELECT cluster_id, subject_id, count(*) AS n, count(*) - count(one) AS n_out FROM cc LEFT JOIN (SELECT *, 1 AS one FROM mask) m USING ({VOX}) GROUP BY ALL",
    kept="SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY cluster_id) AS new_id FROM sized WHERE n >= 3 AND n_out <= 0.25 * n")


@query("label_clusters", sql(f"SELECT {VOX}, cluster_id, n AS cluster_size, new_id FROM cc JOIN kept USING (subject_id, cluster_id)", **HIGH, **cc_views("high"), **KEPT))
def label_clusters(spark, d):
    return components.label_clusters(V.prob(spark, d), 0.8, DIMS, 3, V.mask(spark, d)).drop("part_id")


@query("select_cluster", sql(f"SELECT {VOX}, 'ok' AS status FROM cc JOIN (SELECT subject_id, cluster_id,"
                             " row_number() OVER (PARTITION BY subject_id ORDER BY max(k) DESC, count(*) DESC, cluster_id) AS rn FROM cc GROUP BY 1, 2 HAVING count(*) > 2) USING (subject_id, cluster_id) WHERE rn = 1",
                             **HIGH, **cc_views("high")))
def select_cluster(spark, d):
    return components.select_cluster(high(spark, d), DIMS, "top", 2)


@query("select_cluster_dilated", sql(f"""SELECT DISTINCT h.subject_id, h.i, h.j, h.k, 'ok' AS status FROM cc h JOIN (SELECT cc.* FROM cc JOIN (SELECT subject_id, cluster_id,
 row_number() OVER (PARTITION BY subject_id ORDER BY max(k) DESC, count(*) DESC, cluster_id) AS rn FROM cc GROUP BY 1, 2 HAVING count(*) > 2) USING (subject_id, cluster_id) WHERE rn = 1) c
 ON h.subject_id = c.subject_id AND abs(h.i-c.i) <= 2 AND abs(h.j-c.j) <= 1 AND abs(h.k-c.k) <= 1""", **HIGH, **cc_views("high")))
def select_cluster_dilated(spark, d):
    return components.select_cluster(high(spark, d), DIMS, "top", 2, (2, 1, 1))


#: Clusters of a mask with their size and top, and what the three modes say of every participant.
CHECKED = dict(
    ccs="SELECT subject_id, cluster_id, count(*) AS n, max(k) AS top, count(*) OVER (PARTITION BY subject_id) AS nc FROM cc GROUP BY 1, 2",
    fit="SELECT * FROM ccs WHERE nc = 1 OR n > 4",
    firsts="""SELECT subject_id, count(*) AS ne, arg_max(cluster_id, n * 100000 - cluster_id) AS biggest, arg_max(cluster_id, (top * 100000 + n) * 100000 - cluster_id) AS topmost
 FROM fit GROUP BY 1""",
    modes="SELECT * FROM (VALUES ('size'), ('top'), ('keep_all')) t(keep)",
    told="""SELECT keep, s.subject_id, coalesce(nc, 0) AS n_clusters, coalesce(ne, 0) AS n_eligible, CASE WHEN nc IS NULL THEN 'empty mask'
 WHEN ne IS NULL THEN 'no cluster above the minimum volume' WHEN keep = 'size' AND biggest <> topmost THEN 'biggest cluster is not the topmost' ELSE 'ok' END AS status
 FROM modes, subjects s LEFT JOIN (SELECT DISTINCT subject_id, nc FROM ccs) c ON c.subject_id = s.subject_id LEFT JOIN firsts f ON f.subject_id = s.subject_id""")


@query("select_cluster_status", sql("SELECT * FROM told", **HIGH, part="SELECT * FROM high WHERE subject_id % 7 <> 3", **cc_views("part"), **CHECKED))
def select_cluster_status(spark, d):
    """Every participant has a row in every mode, also where the check fails or the mask is empty."""
    thick = high(spark, d).filter("subject_id % 7 <> 3")
    told = [components.check_clusters(thick, DIMS, keep, 4, subjects=V.subjects(spark, d)).status.withColumn("keep", F.lit(keep))
            for keep in ("size", "top", "keep_all")]
    return told[0].unionByName(told[1]).unionByName(told[2])


BOX = "abs(g.i-s.i) <= 2 AND abs(g.j-s.j) <= 1 AND abs(g.k-s.k) <= 1"
RADII = (2, 1, 1)
HOLES = {"holes": f"SELECT {VOX} FROM grid ANTI JOIN thick t USING ({VOX})"}
ERODED = f"SELECT {VOX} FROM thick s WHERE NOT EXISTS (SELECT 1 FROM holes g WHERE g.subject_id = s.subject_id AND {BOX})"


@query("dilate_box", sql(f"SELECT DISTINCT g.* FROM grid g JOIN high s ON g.subject_id = s.subject_id AND {BOX}", **HIGH))
def dilate_box(spark, d):
    return morphology.dilate_box(high(spark, d), RADII, DIMS)


@query("erode_box", sql(ERODED, **THICK, **HOLES))
def erode_box(spark, d):
    return morphology.erode_box(thick(spark, d), RADII, DIMS)


@query("open_box", sql(f"SELECT DISTINCT g.* FROM grid g JOIN shrunk s ON g.subject_id = s.subject_id AND {BOX}", **THICK, **HOLES, shrunk=ERODED))
def open_box(spark, d):
    return morphology.open_box(thick(spark, d), RADII, DIMS)


FOOT = ellipsoid((2, 1, 1))
FOOT_SQL = f"(g.i-s.i, g.j-s.j, g.k-s.k) IN ({', '.join(map(str, FOOT))})"
GREY = dict(
    full_grid=f"SELECT {VOX}, coalesce(v, 0.5) AS v FROM grid LEFT JOIN prob USING ({VOX})",
    eroded_grey=f"SELECT g.subject_id, g.i, g.j, g.k, min(s.v) AS v FROM grid g JOIN full_grid s ON g.subject_id = s.subject_id AND {FOOT_SQL} GROUP BY ALL")


@query("grey_opening", sql(f"SELECT g.subject_id, g.i, g.j, g.k, max(s.v) AS v FROM grid g JOIN eroded_grey s ON g.subject_id = s.subject_id AND {FOOT_SQL} GROUP BY ALL", **GREY))
def grey_opening(spark, d):
    image = V.grid(spark, d).join(V.prob(spark, d), ["subject_id", "i", "j", "k"], "left").withColumn("v", F.coalesce("v", F.lit(0.5)))
    return morphology.grey_opening(image, FOOT, DIMS)


@query("ellipsoid_dilation", sql(f"SELECT DISTINCT g.* FROM grid g JOIN high s ON g.subject_id = s.subject_id AND {FOOT_SQL}", **HIGH))
def ellipsoid_dilation(spark, d):
    return morphology.dilate_footprint(high(spark, d), FOOT, DIMS)


@query("l1_distance", sql("SELECT g.subject_id, g.i, g.j, g.k, min(abs(g.i-s.i) + abs(g.j-s.j) + abs(g.k-s.k)) AS d FROM grid g JOIN high s ON g.subject_id = s.subject_id GROUP BY ALL", **HIGH))
def l1_distance(spark, d):
    return morphology.l1_distance(high(spark, d), DIMS)


@query("dilate_l1", sql(near("high", 2), **HIGH))
def dilate_l1(spark, d):
    return morphology.dilate_l1(high(spark, d), 2, DIMS)


@query("erode_l1", sql(eroded("thick", 2), **THICK))
def erode_l1(spark, d):
    return morphology.erode_l1(thick(spark, d), 2, DIMS)


@query("erode_steps", sql(eroded("thick", 2, border=True), **THICK))
def erode_steps(spark, d):
    return morphology.erode_steps(thick(spark, d), 1, DIMS)


@query("l1_close", sql(eroded("grown", 3), **HIGH, grown=near("high", 3)))
def l1_close(spark, d):
    return morphology.close_l1(high(spark, d), 3, DIMS)


@query("euclidean_distance", sql("""SELECT g.subject_id, g.i, g.j, g.k, round(sqrt(min((g.i-s.i)**2 + (1.5*(g.j-s.j))**2 + (2*(g.k-s.k))**2)), 6) AS d
 FROM grid g JOIN high s ON g.subject_id = s.subject_id GROUP BY ALL""", **HIGH))
def euclidean_distance(spark, d):
    return morphology.euclidean_distance(high(spark, d), DIMS, (1.0, 1.5, 2.0)).withColumn("d", F.round("d", 6))


@query("nearest_label_fill", sql("""SELECT m.subject_id, m.i, m.j, m.k, arg_min(label, greatest(abs(m.i-s.i), abs(m.j-s.j), abs(m.k-s.k)) * 100000 + label) AS label
 FROM mask m JOIN (SELECT * FROM parc WHERE label IN (1003, 2003, 1008, 2001)) s ON m.subject_id = s.subject_id GROUP BY ALL"""))
def nearest_label_fill(spark, d):
    return fill.nearest_label_fill(V.parc(spark, d).filter("label IN (1003, 2003, 1008, 2001)"), V.mask(spark, d), DIMS)


def hull_sql(source: str, keys: str = "", cells: str = "grid") -> str:
    """Voxels of ``cells`` inside the convex hull of ``source``, from its definition: the planes through any three points that have all others on one side.
    Only points that end their lines along all three axes can be corners."""
    ks = ["subject_id", *keys.split()]
    inner, own = ", ".join(ks), ", ".join(f"h.{k}" for k in ks)
    same = lambda a, b: " AND ".join(f"{a}.{k} = {b}.{k}" for k in ks)
    end = " AND ".join(f"({x} = min({x}) OVER (PARTITION BY {inner}, {o}) OR {x} = max({x}) OVER (PARTITION BY {inner}, {o}))"
                       for x, o in (("i", "j, k"), ("j", "i, k"), ("k", "i, j")))
    cross = ("(b.j-a.j)*(c.k-a.k) - (b.k-a.k)*(c.j-a.j) AS x, (b.k-a.k)*(c.i-a.i) - (b.i-a.i)*(c.k-a.k) AS y, (b.i-a.i)*(c.j-a.j) - (b.j-a.j)*(c.i-a.i) AS z")
    return f"""SELECT {', '.join(f'g.{k}' if k == 'subject_id' else f'h.{k}' for k in ks)}, g.i, g.j, g.k FROM {cells} g JOIN (
 WITH q AS (SELECT {inner}, i, j, k, row_number() OVER (PARTITION BY {inner} ORDER BY i, j, k) AS n FROM (SELECT * FROM {source} QUALIFY {end})),
 t AS (SELECT {', '.join(f'a.{k}' for k in ks)}, {cross}, a.i AS ai, a.j AS aj, a.k AS ak FROM q a JOIN q b ON {same('a', 'b')} AND a.n < b.n JOIN q c ON {same('b', 'c')} AND b.n < c.n),
 s AS (SELECT {inner}, x, y, z, x*ai + y*aj + z*ak AS v FROM t WHERE x <> 0 OR y <> 0 OR z <> 0),
 d AS (SELECT DISTINCT {inner}, x // m AS x, y // m AS y, z // m AS z, v // m AS v FROM (SELECT *, gcd(gcd(abs(x), abs(y)), abs(z)) AS m FROM s)),
 r AS (SELECT {', '.join(f'd.{k}' for k in ks)}, d.x, d.y, d.z, d.v, max(d.x*q.i + d.y*q.j + d.z*q.k) AS hi, min(d.x*q.i + d.y*q.j + d.z*q.k) AS lo FROM d JOIN q ON {same('d', 'q')} GROUP BY ALL)
 SELECT {inner}, x AS a, y AS b, z AS c, v AS h FROM r WHERE hi = v UNION SELECT {inner}, -x, -y, -z, -v FROM r WHERE lo = v) h
 ON g.subject_id = h.subject_id GROUP BY ALL HAVING bool_and(h.a*g.i + h.b*g.j + h.c*g.k <= h.h)"""


@query("hull_fill", sql(hull_sql("nuclei"), nuclei="SELECT * FROM parc WHERE label IN (10, 11, 12)"))
def hull_fill(spark, d):
    return fill.hull_fill(V.parc(spark, d).filter("label IN (10, 11, 12)"))


@query("surface_voxels", sql(f"""SELECT {VOX} FROM thick s WHERE (SELECT count(*) FROM thick t WHERE t.subject_id = s.subject_id
 AND abs(t.i-s.i) + abs(t.j-s.j) + abs(t.k-s.k) = 1) < 6""", **THICK))
def surface_voxels(spark, d):
    return morphology.surface(thick(spark, d))


@query("fast_smooth", sql("""SELECT g.subject_id, g.i, g.j, g.k, round(sum(CASE WHEN g.i = s.i AND g.j = s.j AND g.k = s.k THEN v ELSE 0.2*v END) / 2.2, 6) AS v
 FROM grid g JOIN prob s ON g.subject_id = s.subject_id AND abs(g.i-s.i) + abs(g.j-s.j) + abs(g.k-s.k) <= 1 GROUP BY ALL"""))
def fast_smooth(spark, d):
    return smoothing.fast_smooth(V.prob(spark, d), DIMS).withColumn("v", F.round("v", 6))




def _blur(source: str, axis: str, n: int, fwhm: float) -> str:
    """One pass of a Gaussian with mirrored borders; a mirrored source cell counts once per image it has."""
    weights = smoothing.gaussian_weights(fwhm / math.sqrt(8 * math.log(2)))
    taps: dict[tuple[int, int], float] = {}
    for x in range(n):
        for o in range(-len(weights) + 1, len(weights)):
            y = (x + o) % (2 * n)
            y = 2 * n - 1 - y if y >= n else y
            taps[(x, y)] = taps.get((x, y), 0.0) + weights[abs(o)]
    rows = ", ".join(f"({x}, {y}, {w!r}::DOUBLE)" for (x, y), w in taps.items())
    keep = ", ".join(a if a != axis else f"x::INT AS {axis}" for a in ("subject_id", "i", "j", "k"))
    return f"SELECT {keep}, sum(v * w) AS v FROM {source} JOIN (VALUES {rows}) t(x, y, w) ON {axis} = y GROUP BY ALL"


def blur_views(source: str, fwhm: float, name: str) -> dict[str, str]:
    return {f"{name}_k": _blur(source, "k", NK, fwhm), f"{name}_j": _blur(f"{name}_k", "j", NJ, fwhm), name: _blur(f"{name}_j", "i", NI, fwhm)}


@query("gaussian_smooth", sql(f"SELECT {VOX}, round(v, 6) AS v FROM blurred WHERE v <> 0", **blur_views("prob", 2.0, "blurred")))
def gaussian_smooth(spark, d):
    return smoothing.gaussian_smooth(V.prob(spark, d), DIMS, 2.0).withColumn("v", F.round("v", 6))


#: Voxel sizes along i, j and k of a participant's own scan, by turns of the participants.
OWN_SIZES = {"vx": ("subject_id % 2", (1.0, 0.5)), "vy": ("subject_id % 3", (1.0, 1.5, 2.0)), "vz": ("subject_id % 2", (2.0, 1.0))}


def _blur_own(source: str, axis: str, n: int, size: str) -> str:
    turn, sizes = OWN_SIZES[size]
    parts = [_blur(f"(SELECT * FROM {source} WHERE {turn} = {t})", axis, n, 2.0 / s) for t, s in enumerate(sizes)]
    return " UNION ALL ".join(parts)


@query("gaussian_smooth_own_spacing", sql(f"SELECT {VOX}, round(v, 6) AS v FROM own_blurred WHERE v <> 0", own_k=_blur_own("prob", "k", NK, "vz"),
                                          own_j=_blur_own("own_k", "j", NJ, "vy"), own_blurred=_blur_own("own_j", "i", NI, "vx")))
def gaussian_smooth_own_spacing(spark, d):
    """Every participant's scan has voxel sizes of its own."""
    size = lambda c: F.get(F.array(*map(F.lit, OWN_SIZES[c][1])), F.expr(OWN_SIZES[c][0]).cast("int")).alias(c)
    grids = V.subjects(spark, d).select("subject_id", *[F.lit(n).alias(c) for c, n in zip(("ni", "nj", "nk"), DIMS)], *map(size, OWN_SIZES))
    return smoothing.gaussian_smooth(V.prob(spark, d), DIMS, 2.0, grids=grids).withColumn("v", F.round("v", 6))


DOG = dict(
    inside=f"SELECT {VOX}, v FROM prob SEMI JOIN mask USING ({VOX})",
    dlim="SELECT subject_id, least(min(v), 0) AS lo, max(v) AS hi, count(*) AS c FROM inside GROUP BY 1",
    dbin=f"""SELECT subject_id, lo, hi, bin, sum(n) AS n FROM (SELECT subject_id, lo, hi, least(floor((v - lo) / ((hi - lo) / 256)), 255)::INT AS bin, 1 AS n
 FROM inside JOIN dlim USING (subject_id) UNION ALL SELECT subject_id, lo, hi, 0, {NI*NJ*NK} - c FROM dlim) GROUP BY ALL""",
    dcut="""SELECT g.subject_id, any_value(lo) AS lo, any_value(hi) AS hi, c.t, sum(CASE WHEN bin <= t THEN n ELSE 0 END)::DOUBLE AS p0, sum(n)::DOUBLE AS p,
 sum(CASE WHEN bin <= t THEN n*bin ELSE 0 END)::DOUBLE AS s0, sum(n*bin)::DOUBLE AS s FROM dbin g, range(255) c(t) GROUP BY ALL""",
    dthr="""SELECT subject_id, arg_max(lo + (t + 0.5) * (hi - lo) / 256, (score, -t)) AS cut FROM (SELECT *,
 round(CASE WHEN p0 > 0 THEN s0*s0/p0 ELSE 0 END + CASE WHEN p - p0 > 0 THEN (s-s0)*(s-s0)/(p-p0) ELSE 0 END, 6) AS score FROM dcut) GROUP BY 1""",
    bright=f"SELECT {VOX}, v FROM inside JOIN dthr USING (subject_id) WHERE v >= cut",
    **blur_views("bright", 3.0, "narrow"), **blur_views("narrow", 3.0 * math.sqrt(1.6 ** 2 - 1), "wide"),
    positive=f"SELECT {VOX} FROM narrow a JOIN (SELECT {VOX}, v AS w FROM wide) b USING ({VOX}) WHERE a.v - w > 1e-9")


@query("dog_edges", sql(f"""SELECT {VOX} FROM positive s WHERE EXISTS (SELECT 1 FROM grid g ANTI JOIN positive q USING ({VOX}) WHERE g.subject_id = s.subject_id
 AND abs(g.i-s.i) + abs(g.j-s.j) + abs(g.k-s.k) = 1)""", **DOG))
def dog_edges(spark, d):
    return smoothing.dog_edges(V.prob(spark, d), V.mask(spark, d), DIMS)


@query("remove_dark_classes", sql(f"SELECT {VOX}, v FROM bright", **DOG))
def remove_dark_classes(spark, d):
    from ..operators.stats import remove_dark_classes as run

    return run(V.prob(spark, d).drop("p"), V.mask(spark, d), DIMS)
