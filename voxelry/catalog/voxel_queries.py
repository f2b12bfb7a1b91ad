"""Queries of projections, filters, boxes and voxel aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.regions import scheme_rows
from ..operators import stats, voxel
from . import recipe as V
from .recipe import DIMS, NI, NJ, NK
from .registry import affine_columns, affine_sql, query, r6
from .sqltext import VOX, sql

MAP = f"{VOX}, v"


@query("threshold_binarise", sql(f"SELECT {VOX}, 1.0::DOUBLE AS v FROM prob WHERE v > 0.8"))
def threshold_binarise(spark, d):
    return voxel.threshold(V.prob(spark, d).drop("p"), 0.8, "+", True)


@query("threshold_keep", sql(f"SELECT {MAP} FROM prob WHERE v <= 0.3"))
def threshold_keep(spark, d):
    return voxel.threshold(V.prob(spark, d).drop("p"), 0.3, "-")


@query("mask_semi_join", sql(f"SELECT {MAP} FROM prob SEMI JOIN mask USING ({VOX})"))
def mask_semi_join(spark, d):
    return voxel.apply_mask(V.prob(spark, d).drop("p"), V.mask(spark, d))


@query("mask_anti_join", sql(f"SELECT {MAP} FROM prob ANTI JOIN mask USING ({VOX})"))
def mask_anti_join(spark, d):
    return voxel.outside_mask(V.prob(spark, d).drop("p"), V.mask(spark, d))


@query("mask_union", sql(f"SELECT {VOX} FROM mask UNION SELECT {VOX} FROM truth"))
def mask_union(spark, d):
    return voxel.union_masks(V.mask(spark, d), V.truth(spark, d))


@query("weighted_mask", sql(f"SELECT {VOX}, round(a.v * b.v, 6) AS v FROM folds a JOIN prob b USING ({VOX}) WHERE fold = 1 AND a.v > 0"))
def weighted_mask(spark, d):
    fold = V.folds(spark, d).filter("fold = 1 AND v > 0").drop("fold")
    return voxel.apply_weights(fold, V.prob(spark, d)).withColumn("v", F.round("v", 6))


@query("label_in_list", sql("SELECT * FROM parc WHERE label IN (2, 41, 77)"))
def label_in_list(spark, d):
    return voxel.label_in(V.parc(spark, d), [2, 41, 77])


NORMAL = dict(
    filled=f"SELECT {VOX}, coalesce(v, 0) AS v, m.one IS NOT NULL AS inside FROM prob FULL JOIN (SELECT *, 1 AS one FROM mask) m USING ({VOX})",
    scale="SELECT subject_id, quantile_cont(v, 0.99) AS s FROM filled WHERE inside GROUP BY 1")


@query("normalise_intensity", sql(f"SELECT {VOX}, round(least(v / s, 1.3) / 1.3, 6) AS v FROM filled JOIN scale USING (subject_id) WHERE v > 0", **NORMAL))
def normalise_intensity(spark, d):
    return voxel.normalise(V.prob(spark, d), V.mask(spark, d), 99.0).withColumn("v", F.round("v", 6))


@query("normalise_inverted", sql(f"""SELECT {VOX}, round(z, 6) AS v FROM (SELECT {VOX},
 CASE WHEN inside THEN 1 - least(v / s, 1.3) / 1.3 ELSE least(v / s, 1.3) / 1.3 END AS z FROM filled JOIN scale USING (subject_id)) WHERE z <> 0""", **NORMAL))
def normalise_inverted(spark, d):
    return voxel.normalise(V.prob(spark, d), V.mask(spark, d), 99.0, inverse=True).withColumn("v", F.round("v", 6))


@query("near_zero_cut", sql(f"SELECT {MAP} FROM prob WHERE v >= 0.05"))
def near_zero_cut(spark, d):
    return voxel.drop_near_zero(V.prob(spark, d).drop("p"), 0.05)


@query("clamp_range", sql(f"""SELECT {VOX}, round(least(greatest(v * 2 - 0.5, lo), hi), 6) AS v FROM prob JOIN
 (SELECT subject_id, least(min(v), 0) AS lo, max(v) AS hi FROM prob GROUP BY 1) USING (subject_id) WHERE least(greatest(v * 2 - 0.5, lo), hi) <> 0"""))
def clamp_range(spark, d):
    p = V.prob(spark, d).drop("p")
    return voxel.clamp_to_source_range(p.withColumn("v", F.col("v") * 2 - 0.5), p, DIMS).withColumn("v", F.round("v", 6))


@query("binarise_clusters", sql(f"SELECT {VOX}, 1 AS v FROM truth"))
def binarise_clusters(spark, d):
    return voxel.binarise_clusters(V.truth(spark, d))


@query("reorient_axes", sql(f"""SELECT subject_id, label, CASE orient WHEN 'RAS' THEN i WHEN 'LPS' THEN {NI-1}-i WHEN 'ASR' THEN k WHEN 'SRP' THEN j ELSE {NK-1}-k END AS i,
 CASE orient WHEN 'RAS' THEN j WHEN 'LPS' THEN {NJ-1}-j WHEN 'ASR' THEN i WHEN 'SRP' THEN {NK-1}-k ELSE {NI-1}-i END AS j,
 CASE orient WHEN 'RAS' THEN k WHEN 'LPS' THEN k WHEN 'ASR' THEN j WHEN 'SRP' THEN i ELSE {NJ-1}-j END AS k FROM parc JOIN images USING (subject_id)"""))
def reorient_axes(spark, d):
    return voxel.reorient(V.parc(spark, d), V.images(spark, d))


@query("reorient_header", sql(f"""SELECT subject_id, ni2 AS ni, nk2 AS nk, round(x2, 6) AS vx, {affine_sql('b')} FROM (SELECT subject_id,
 CASE orient WHEN 'ASR' THEN nk WHEN 'SRP' THEN nj WHEN 'PIL' THEN nk ELSE ni END AS ni2, CASE orient WHEN 'ASR' THEN nj WHEN 'SRP' THEN ni WHEN 'PIL' THEN nj ELSE nk END AS nk2,
 CASE orient WHEN 'ASR' THEN vz WHEN 'SRP' THEN vy WHEN 'PIL' THEN vz ELSE vx END AS x2,
 flatten(list_transform([0,1,2,3], lambda r: CASE orient
  WHEN 'RAS' THEN affine[4*r+1:4*r+4]
  WHEN 'LPS' THEN [-affine[4*r+1], -affine[4*r+2], affine[4*r+3], affine[4*r+4] + affine[4*r+1]*{NI-1} + affine[4*r+2]*{NJ-1}]
  WHEN 'ASR' THEN [affine[4*r+3], affine[4*r+1], affine[4*r+2], affine[4*r+4]]
  WHEN 'SRP' THEN [affine[4*r+2], -affine[4*r+3], affine[4*r+1], affine[4*r+4] + affine[4*r+3]*{NK-1}]
  ELSE [-affine[4*r+3], -affine[4*r+1], -affine[4*r+2], affine[4*r+4] + affine[4*r+1]*{NI-1} + affine[4*r+2]*{NJ-1} + affine[4*r+3]*{NK-1}] END)) AS b FROM images)"""))
def reorient_header(spark, d):
    return voxel.reorient_images(V.images(spark, d)).select("subject_id", "ni", "nk", r6("vx", "vx"), *affine_columns())


CROP_DIMS = (8, 6, 4)
CROP = dict(
    mass="SELECT subject_id, ceil(avg(i))::INT AS ci, ceil(avg(j))::INT AS cj, ceil(avg(k))::INT AS c0, max(k) AS top FROM mask GROUP BY 1",
    lifted=f"SELECT *, (c0 + CASE WHEN least(c0 + 2, {NK}) <= top THEN top - least(c0 + 2, {NK}) + 1 ELSE 0 END)::INT AS ck FROM mass",
    box="SELECT subject_id, ci, cj, ck, ci - 4 AS i0, cj - 3 AS j0, ck - 2 AS k0, ci + 4 AS i1, cj + 3 AS j1, ck + 2 AS k1 FROM lifted",
    cropped="""SELECT p.subject_id, p.i - i0 AS i, p.j - j0 AS j, p.k - k0 AS k, v FROM prob p JOIN box b USING (subject_id)
 WHERE p.i >= i0 AND p.i < i1 AND p.j >= j0 AND p.j < j1 AND p.k >= k0 AND p.k < k1""")


def _box(spark, d):
    return voxel.crop_box(V.images(spark, d), CROP_DIMS, V.mask(spark, d), margin=1)


@query("crop_box", sql("""SELECT box.*, round(affine[4] + affine[1]*i0 + affine[2]*j0 + affine[3]*k0, 6) AS a03, round(affine[8] + affine[6]*j0, 6) AS a13,
 round(affine[12] + affine[11]*k0, 6) AS a23 FROM box JOIN images USING (subject_id)""", **CROP))
def crop_box(spark, d):
    return _box(spark, d).select("*", *[F.round(F.col("affine")[n], 6).alias(a) for a, n in (("a03", 3), ("a13", 7), ("a23", 11))]).drop("affine")


@query("crop_box_world", sql("""SELECT subject_id, ceil(x)::INT AS ci, ceil(y)::INT AS cj, ceil(z)::INT AS ck FROM (SELECT subject_id,
 (-affine[4] + affine[2]/affine[6]*affine[8]) / affine[1] AS x, -affine[8] / affine[6] AS y, -affine[12] / affine[11] AS z FROM images)"""))
def crop_box_world(spark, d):
    return voxel.crop_box(V.images(spark, d), CROP_DIMS, centre="world").select("subject_id", "ci", "cj", "ck")


@query("crop_voxels", sql("SELECT * FROM cropped", **CROP))
def crop_voxels(spark, d):
    return voxel.crop_voxels(V.prob(spark, d).drop("p"), _box(spark, d))


@query("uncrop_voxels", sql(f"""SELECT subject_id, c.i + i0 AS i, c.j + j0 AS j, c.k + k0 AS k, v FROM cropped c JOIN box USING (subject_id)
 WHERE c.i + i0 BETWEEN 0 AND {NI-1} AND c.j + j0 BETWEEN 0 AND {NJ-1} AND c.k + k0 BETWEEN 0 AND {NK-1}""", **CROP))
def uncrop_voxels(spark, d):
    box = _box(spark, d)
    return voxel.uncrop_voxels(voxel.crop_voxels(V.prob(spark, d).drop("p"), box), box, V.images(spark, d))


@query("shift_volume", sql(f"SELECT subject_id, i + 2 AS i, j - 1 AS j, k + 3 AS k, v FROM prob WHERE i + 2 < {NI} AND j >= 1 AND k + 3 < {NK}"))
def shift_volume(spark, d):
    return voxel.shift_volume(V.prob(spark, d).drop("p"), DIMS, (2, -1, 3))


@query("shift_affine", sql("""SELECT subject_id, round(affine[4] - 2*affine[1] + affine[2], 6) AS a03, round(affine[8] + affine[6], 6) AS a13,
 round(affine[12] - 3*affine[11], 6) AS a23 FROM images"""))
def shift_affine(spark, d):
    moved = voxel.shift_affine(V.images(spark, d), (2, -1, 3))
    return moved.select("subject_id", *[F.round(F.col("affine")[n], 6).alias(a) for a, n in (("a03", 3), ("a13", 7), ("a23", 11))])


@query("bounding_box", sql("SELECT subject_id, min(i) AS i0, max(i) AS i1, min(j) AS j0, max(j) AS j1, min(k) AS k0, max(k) AS k1 FROM truth GROUP BY 1"))
def bounding_box(spark, d):
    return voxel.bounding_box(V.truth(spark, d))


@query("crop_to_mask_box", sql("""SELECT subject_id, p.i - i0 AS i, p.j - j0 AS j, p.k - k0 AS k, v FROM prob p JOIN (SELECT subject_id, min(i) i0, max(i) i1,
 min(j) j0, max(j) j1, min(k) k0, max(k) k1 FROM mask GROUP BY 1) USING (subject_id) WHERE p.i BETWEEN i0 AND i1 AND p.j BETWEEN j0 AND j1 AND p.k BETWEEN k0 AND k1"""))
def crop_to_mask_box(spark, d):
    return voxel.crop_to_mask_box(V.prob(spark, d).drop("p"), V.mask(spark, d))


def quarter_affine(subject="subject_id"):
    """A voxel-to-voxel affine in quarters, so both engines compute it exactly."""
    s = (F.col(subject) % 3).cast("double")
    rows = [[0.75, 0.25, 0.0, s], [0.0, 0.75, 0.0, 1.0], [0.25, 0.0, 1.0, -0.25], [0.0, 0.0, 0.0, 1.0]]
    return F.array(*[c if not isinstance(c, float) else F.lit(c) for row in rows for c in row])


@query("register_clusters", sql(f"""SELECT subject_id, least(greatest(round_even(0.75*i + 0.25*j + subject_id % 3, 0), 0), {NI-1})::INT AS i,
 least(greatest(round_even(0.75*j + 1, 0), 0), {NJ-1})::INT AS j, least(greatest(round_even(0.25*i + k - 0.25, 0), 0), {NK-1})::INT AS k,
 max(p) AS cluster_id FROM (SELECT subject_id, i::DOUBLE AS i, j::DOUBLE AS j, k::DOUBLE AS k, p FROM prob WHERE p > 800) GROUP BY 1, 2, 3, 4"""))
def register_clusters(spark, d):
    clusters = V.prob(spark, d).filter("p > 800").withColumnRenamed("p", "cluster_id")
    moves = V.subjects(spark, d).withColumn("affine", quarter_affine())
    return voxel.register_clusters(clusters, moves, DIMS)


@query("voxel_size_policy", sql(f"""SELECT subject_id, ni, nj, nk, round(vx, 6) AS vx, round(vy, 6) AS vy, round(vz, 6) AS vz,
 round(CASE WHEN abs(vx - 1) <= 0.1 THEN vx ELSE 1 END, 6) AS out_vx, round(CASE WHEN abs(vy - 1) <= 0.1 THEN vy ELSE 1 END, 6) AS out_vy,
 round(CASE WHEN abs(vz - 1) <= 0.1 THEN vz ELSE 1 END, 6) AS out_vz, CASE WHEN abs(vx - 1) <= 0.1 THEN ceil(10 / vx)::INT ELSE 10 END AS oi,
 CASE WHEN abs(vy - 1) <= 0.1 THEN ceil(12 / vy)::INT ELSE 12 END AS oj, CASE WHEN abs(vz - 1) <= 0.1 THEN ceil(8 / vz)::INT ELSE 8 END AS ok,
 CASE WHEN abs(vx - 1) <= 0.1 AND abs(vy - 1) <= 0.1 AND abs(vz - 1) <= 0.1 THEN 0 ELSE 3 END AS interpolation_order FROM images"""))
def voxel_size_policy(spark, d):
    out = voxel.voxel_size_policy(V.images(spark, d), (1.0, 1.0, 1.0), (10, 12, 8), 0.1, adapt_dims=True)
    return out.select(*[r6(c, c) if t == "double" else F.col(c) for c, t in out.dtypes])


@query("qc_slices", sql(f"""SELECT {VOX}, axis, CASE axis WHEN 'i' THEN i ELSE k END AS slice, coalesce(v, 0) AS v, CASE WHEN one IS NULL THEN 0 ELSE 1 END AS in_mask
 FROM (prob FULL JOIN (SELECT *, 1 AS one FROM mask) m USING ({VOX})), (VALUES ('i'), ('k')) t(axis)
 WHERE (axis = 'i' AND i IN (2, 4, 6, 9)) OR (axis = 'k' AND k IN (1, 2, 4, 5))"""))
def qc_slices(spark, d):
    return voxel.qc_slices(V.prob(spark, d), V.mask(spark, d), DIMS, 4, ("i", "k"))


@query("crop_box_slices", sql(f"""SELECT {VOX}, coalesce(v, 0) AS v, CASE WHEN one IS NULL THEN 0 ELSE 1 END AS in_mask,
 (i >= i0 AND i < i1 AND j >= j0 AND j < j1 AND k >= k0 AND k < k1)::INT AS in_box
 FROM (prob FULL JOIN (SELECT *, 1 AS one FROM mask) m USING ({VOX})) JOIN box USING (subject_id) WHERE i = ci OR j = cj OR k = ck""", **CROP))
def crop_box_slices(spark, d):
    return voxel.crop_box_slices(V.prob(spark, d), V.mask(spark, d), _box(spark, d))


@query("stack_channels", sql(f"""SELECT {VOX}, coalesce(a.v, 0) AS c1, coalesce(b.v, 0) AS c2 FROM (SELECT * FROM prob WHERE p > 300) a
 FULL JOIN (SELECT * FROM folds WHERE fold = 1 AND v > 0.4) b USING ({VOX})"""))
def stack_channels(spark, d):
    return voxel.stack_channels([V.prob(spark, d).filter("p > 300"), V.folds(spark, d).filter("fold = 1 AND v > 0.4")])


BINS = dict(
    lims=f"SELECT subject_id, CASE WHEN count(*) < {NI*NJ*NK} THEN least(min(v), 0) ELSE min(v) END AS lo, max(v) AS hi, count(*) AS c FROM prob GROUP BY 1",
    bins=f"""SELECT subject_id, lo, hi, bin, sum(n) AS n FROM (
 SELECT subject_id, lo, hi, least(floor((v - lo) / ((hi - lo) / 64)), 63)::INT AS bin, 1 AS n FROM prob JOIN lims USING (subject_id)
 UNION ALL SELECT subject_id, lo, hi, floor((0 - lo) / ((hi - lo) / 64))::INT, {NI*NJ*NK} - c FROM lims) GROUP BY ALL""",
    best="SELECT subject_id, lo, hi, bin, row_number() OVER (PARTITION BY subject_id ORDER BY n DESC, bin) AS rn FROM bins WHERE bin BETWEEN 12 AND 56")


@query("histogram_mode", sql("SELECT subject_id, round(lo + bin * (hi - lo) / 64, 6) AS mode FROM best WHERE rn = 1", **BINS))
def histogram_mode(spark, d):
    return stats.histogram_mode(V.prob(spark, d), DIMS).withColumn("mode", F.round("mode", 6))


BEST = dict(
    filled=NORMAL["filled"],
    pct=" UNION ALL ".join(f"SELECT subject_id, {p} AS q, quantile_cont(v, {p}) AS s FROM filled WHERE inside GROUP BY 1" for p in (0.9, 0.95, 0.99)),
    tried="SELECT subject_id, q AS p, least(v / s, 1.3) / 1.3 AS v FROM prob JOIN pct USING (subject_id)",
    tlim="SELECT subject_id, p, least(min(v), 0) AS lo, max(v) AS hi, count(*) AS c FROM tried GROUP BY ALL",
    tbin="""SELECT subject_id, p, lo, hi, least(floor((v - lo) / ((hi - lo) / 64)), 63)::INT AS bin, count(*) AS n FROM tried JOIN tlim USING (subject_id, p) GROUP BY ALL""",
    tmode="""SELECT p, avg(lo + bin * (hi - lo) / 64) AS m FROM (SELECT *, row_number() OVER (PARTITION BY subject_id, p ORDER BY n DESC, bin) AS rn
 FROM tbin WHERE bin BETWEEN 12 AND 56) WHERE rn = 1 GROUP BY 1""")


@query("best_percentile", sql("""SELECT arg_min(p, dist) * 100 AS percentile, round(min(dist), 6) AS distance FROM (SELECT p::DOUBLE AS p, abs(m - cm) AS dist
 FROM tmode, (SELECT avg(lo + bin * (hi - lo) / 64) AS cm FROM best WHERE rn = 1))""", **BINS, **BEST))
def best_percentile(spark, d):
    p = V.prob(spark, d)
    return stats.best_percentile(p, V.mask(spark, d), [90.0, 95.0, 99.0], p, DIMS).withColumn("distance", F.round("distance", 6))


@query("brain_volume", sql("SELECT subject_id, n AS brain_mask_size, round(n * vx * vy * vz / 1000, 6) AS brain_volume_cm3 FROM (SELECT subject_id, count(*) AS n FROM mask GROUP BY 1) JOIN images USING (subject_id)"))
def brain_volume(spark, d):
    return stats.brain_volume(V.mask(spark, d), V.images(spark, d)).withColumn("brain_volume_cm3", F.round("brain_volume_cm3", 6))


@query("centre_of_mass", sql("SELECT subject_id, round(sum(i*v)/sum(v), 6) AS ci, round(sum(j*v)/sum(v), 6) AS cj, round(sum(k*v)/sum(v), 6) AS ck FROM prob GROUP BY 1"))
def centre_of_mass(spark, d):
    return stats.centre_of_mass(V.prob(spark, d), weighted=True).select("subject_id", *[r6(c, c) for c in ("ci", "cj", "ck")])


@query("salient_slices", sql("""SELECT subject_id, axis, slice FROM (SELECT subject_id, axis, slice, row_number() OVER (PARTITION BY subject_id, axis ORDER BY count(*) DESC, slice) AS rn
 FROM (SELECT subject_id, 'i' AS axis, i AS slice FROM prob UNION ALL SELECT subject_id, 'j', j FROM prob UNION ALL SELECT subject_id, 'k', k FROM prob) GROUP BY 1, 2, 3) WHERE rn = 1"""))
def salient_slices(spark, d):
    return stats.salient_slices(V.prob(spark, d))


OTSU = dict(
    olim=f"SELECT subject_id, CASE WHEN count(*) < {NI*NJ*NK} THEN least(min(v), 0) ELSE min(v) END AS lo, max(v) AS hi, count(*) AS c FROM prob GROUP BY 1",
    obin=f"""SELECT subject_id, lo, hi, bin, sum(n) AS n FROM (
 SELECT subject_id, lo, hi, least(floor((v - lo) / ((hi - lo) / 256)), 255)::INT AS bin, 1 AS n FROM prob JOIN olim USING (subject_id)
 UNION ALL SELECT subject_id, lo, hi, 0, {NI*NJ*NK} - c FROM olim) GROUP BY ALL""",
    ocut="""SELECT g.subject_id, any_value(lo) AS lo, any_value(hi) AS hi, c.t, sum(CASE WHEN bin <= t THEN n ELSE 0 END)::DOUBLE AS p0, sum(n)::DOUBLE AS p,
 sum(CASE WHEN bin <= t THEN n*bin ELSE 0 END)::DOUBLE AS s0, sum(n*bin)::DOUBLE AS s FROM obin g, range(255) c(t) GROUP BY ALL""")


@query("otsu_threshold", sql("""SELECT subject_id, round(arg_max(lo + (t + 0.5) * (hi - lo) / 256, (score, -t)), 6) AS threshold FROM (
 SELECT *, round(CASE WHEN p0 > 0 THEN s0*s0/p0 ELSE 0 END + CASE WHEN p - p0 > 0 THEN (s-s0)*(s-s0)/(p-p0) ELSE 0 END, 6) AS score FROM ocut) GROUP BY 1""", **OTSU))
def otsu_threshold(spark, d):
    return stats.otsu_threshold(V.prob(spark, d), DIMS, 2).select("subject_id", r6(F.col("thresholds")[0], "threshold"))


OTSU3 = dict(
    olim=OTSU["olim"],
    obin3=OTSU["obin"].replace("/ 256), 255)", "/ 64), 63)").replace("(hi - lo) / 256", "(hi - lo) / 64").replace("255)::INT", "63)::INT"),
    ocum="SELECT g.subject_id, any_value(lo) AS lo, any_value(hi) AS hi, t, sum(CASE WHEN bin <= t THEN n ELSE 0 END)::DOUBLE AS p, sum(CASE WHEN bin <= t THEN n*bin ELSE 0 END)::DOUBLE AS s FROM obin3 g, range(64) c(t) GROUP BY ALL",
    opair="""SELECT a.subject_id, a.lo, a.hi, a.t AS t1, b.t AS t2, round(CASE WHEN a.p > 0 THEN a.s*a.s/a.p ELSE 0 END + CASE WHEN b.p > a.p THEN (b.s-a.s)*(b.s-a.s)/(b.p-a.p) ELSE 0 END
 + CASE WHEN e.p > b.p THEN (e.s-b.s)*(e.s-b.s)/(e.p-b.p) ELSE 0 END, 6) AS score FROM ocum a JOIN ocum b ON a.subject_id = b.subject_id AND a.t < b.t
 JOIN ocum e ON e.subject_id = a.subject_id AND e.t = 63 AND b.t < 63""")


@query("otsu_three_classes", sql("""SELECT subject_id, round(lo + (t1 + 0.5) * (hi - lo) / 64, 6) AS threshold_1, round(lo + (t2 + 0.5) * (hi - lo) / 64, 6) AS threshold_2
 FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY score DESC, t1, t2) AS rn FROM opair) WHERE rn = 1""", **OTSU3))
def otsu_three_classes(spark, d):
    return stats.otsu_threshold(V.prob(spark, d), DIMS, 3, 64).select("subject_id", *[r6(F.col("thresholds")[n], f"threshold_{n + 1}") for n in (0, 1)])


def lut_values(scheme: str) -> str:
    return "(VALUES " + ", ".join(f"({a}, {b}, '{c}')" for a, b, c in scheme_rows(scheme)) + ") lut(src_label, region_label, region)"
