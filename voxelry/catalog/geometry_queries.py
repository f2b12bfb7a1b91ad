"""Queries of affines, resampling and alignment."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions.joins import attach
from ..operators import geometry, stats, voxel
from . import recipe as V
from .recipe import DIMS, NI, NJ, NK
from .registry import affine_columns, query, r6
from .sqltext import VOX, sql
from .voxel_queries import quarter_affine

# The skewed block [[1, s], [0, 1]] has the closed polar factor [[2, s], [-s, 2]] / sqrt(4 + s^2).
CHECKED = dict(
    com="SELECT subject_id, sum(i*v)/sum(v) AS ci, sum(j*v)/sum(v) AS cj, sum(k*v)/sum(v) AS ck FROM prob GROUP BY 1",
    skewed="SELECT *, affine[2] / vy AS s FROM images JOIN com USING (subject_id)",
    checked="""SELECT *, CASE WHEN s >= 0.005 THEN 'severe' WHEN s >= 0.00005 THEN 'mild' ELSE 'ok' END AS status,
 CASE WHEN s >= 0.005 THEN [vx, 0, 0, -vx * round_even(ci, 0), 0, vy, 0, -vy * round_even(cj, 0), 0, 0, -vz, vz * round_even(ck, 0)]
  WHEN s >= 0.00005 THEN [2 / sqrt(4 + s*s) * vx, s / sqrt(4 + s*s) * vy, 0, affine[4], -s / sqrt(4 + s*s) * vx, 2 / sqrt(4 + s*s) * vy, 0, affine[8], 0, 0, -vz, affine[12]]
  ELSE affine[1:12] END AS fixed FROM skewed""")
FIXED = ", ".join(f"round(fixed[{4 * r + c + 1}], 6) AS a{r}{c}" for r in range(3) for c in range(4))


def _checked(spark, d):
    return geometry.check_affine(V.images(spark, d), stats.centre_of_mass(V.prob(spark, d), weighted=True))


@query("affine_check", sql(f"SELECT subject_id, round(s, 6) AS deviation, status, {FIXED} FROM checked", **CHECKED))
def affine_check(spark, d):
    return _checked(spark, d).select("subject_id", r6("deviation", "deviation"), "status", *affine_columns())


# corrected * inverse(original) * sibling, where the sibling is the original with a doubled first column
SIBLING = sql("SELECT subject_id, " + ", ".join(
    [f"round({2 if c == 0 else 1} * fixed[{4 * r + c + 1}], 6) AS a{r}{c}" for r in range(3) for c in range(3)]
    + [f"round(fixed[{4 * r + 4}] + fixed[{4 * r + 1}] * (3 / vx), 6) AS a{r}3" for r in range(3)]) + " FROM checked", **CHECKED)


@query("companion_affine", SIBLING)
def companion_affine(spark, d):
    main = V.images(spark, d).withColumn("role", F.lit("img1"))
    doubled = F.transform("affine", lambda x, n: F.when(n % 4 == 0, 2 * x).when(n == 3, x + 3).otherwise(x))
    sibling = main.withColumns({"role": F.lit("img2"), "affine": doubled})
    fixed = _checked(spark, d).withColumn("role", F.lit("img1"))
    out = geometry.companion_affine(main.unionByName(sibling), fixed).filter("role = 'img2'")
    return out.select("subject_id", *affine_columns())


def rigid_transforms(spark, d, table="supplier"):
    """A rotation about z, then y, from the account balance, with a translation."""
    s = V.table(spark, d, table)
    a, b = F.col("s_acctbal") / 100000, F.col("s_nationkey").cast("double") / 500
    zero = F.lit(0.0)
    m = [F.cos(a) * F.cos(b), -F.sin(a), F.cos(a) * F.sin(b), F.sin(a) * F.cos(b), F.cos(a), F.sin(a) * F.sin(b), -F.sin(b), zero, F.cos(b),
         b * 100, a * 50, F.lit(1.5)]
    return s.select(F.col("s_suppkey").alias("subject_id"), F.array(*m).alias("transform"))


@query("registration_magnitude", sql("""SELECT s_suppkey AS subject_id, round(degrees(abs(a)) + degrees(abs(b)), 6) AS rotation,
 round(sqrt(b*b*10000 + a*a*2500 + 2.25), 6) AS translation FROM (SELECT s_suppkey, s_acctbal/100000 AS a, s_nationkey::DOUBLE/500 AS b FROM supplier)"""))
def registration_magnitude(spark, d):
    return geometry.registration_magnitude(rigid_transforms(spark, d)).select("subject_id", r6("rotation", "rotation"), r6("translation", "translation"))


TARGET = (10, 10, 8)
POINTS = dict(points=f"""SELECT subject_id, i, j, k, x, y, z FROM (SELECT s_suppkey AS subject_id, a.i::INT AS i, b.j::INT AS j, c.k::INT AS k,
 0.75::DOUBLE*a.i + 0.25::DOUBLE*b.j + s_suppkey % 3 AS x, 0.75::DOUBLE*b.j + 1 AS y, 0.25::DOUBLE*a.i + c.k - 0.25::DOUBLE AS z
 FROM supplier, range({TARGET[0]}) a(i), range({TARGET[1]}) b(j), range({TARGET[2]}) c(k)) WHERE x BETWEEN 0 AND {NI-1} AND y BETWEEN 0 AND {NJ-1} AND z BETWEEN 0 AND {NK-1}""")


def _moves(spark, d):
    return V.subjects(spark, d).withColumn("affine", quarter_affine())


@query("resample_nearest", sql("""SELECT q.subject_id, q.i, q.j, q.k, label FROM points q JOIN parc p ON p.subject_id = q.subject_id
 AND p.i = floor(x + 0.5)::INT AND p.j = floor(y + 0.5)::INT AND p.k = floor(z + 0.5)::INT""", **POINTS))
def resample_nearest(spark, d):
    return geometry.resample_nearest(V.parc(spark, d), _moves(spark, d), TARGET, DIMS, "label")


@query("resample_linear", sql("""SELECT q.subject_id, q.i, q.j, q.k, round(sum(v * (1 - abs(x - p.i)) * (1 - abs(y - p.j)) * (1 - abs(z - p.k))), 9) AS v
 FROM points q JOIN prob p ON p.subject_id = q.subject_id AND abs(x - p.i) < 1 AND abs(y - p.j) < 1 AND abs(z - p.k) < 1 GROUP BY ALL""", **POINTS))
def resample_linear(spark, d):
    return geometry.resample(V.prob(spark, d), _moves(spark, d), TARGET, DIMS, 1).withColumn("v", F.round("v", 9))


def _solved(source: str, axis: str, lengths: list[int], own: str) -> str:
    """One axis of the spline coefficients: a line times the inverse of the system of equations of its own length, ``own``."""
    rest = [a for a in "ijk" if a != axis]
    table = ", ".join(f"({n}, {t}, {s}, {float(inverse[t, s])!r}::DOUBLE)" for n in lengths
                      for inverse in [np.linalg.inv(geometry.spline_system(n))] for t in range(n) for s in range(n))
    return (f"SELECT subject_id, {rest[0]}, {rest[1]}, t::INT AS {axis}, sum(v * w) AS v FROM {source} JOIN (VALUES {table}) m(n, t, s, w) "
            f"ON {axis} = s AND n = {own} GROUP BY ALL")


def _tap(x: str, a: str) -> str:
    """Weight of the spline that is ``a`` voxels after the one at or before x."""
    t = f"({x} - floor({x}))"
    return f"CASE {a} WHEN -1 THEN (1 - {t})**3 WHEN 0 THEN 4 - 6*{t}**2 + 3*{t}**3 WHEN 1 THEN 4 - 6*(1 - {t})**2 + 3*(1 - {t})**3 ELSE {t}**3 END / 6"


def _mirrored(x: str, a: str, n: str) -> str:
    at = f"abs(floor({x}) + {a})"
    return f"(CASE WHEN {at} > {n} - 1 THEN 2 * ({n} - 1) - {at} ELSE {at} END)::INT"


def _spline_views(image: str, points: str, own: tuple[str, str, str], spans: tuple[list[int], list[int], list[int]]) -> dict[str, str]:
    return dict(ck=_solved(image, "k", spans[2], own[2]), cj=_solved("ck", "j", spans[1], own[1]), ci=_solved("cj", "i", spans[0], own[0]),
                taps=f"""SELECT q.subject_id, q.i, q.j, q.k, {_mirrored('x', 'a', own[0])} AS si, {_mirrored('y', 'b', own[1])} AS sj, {_mirrored('z', 'c', own[2])} AS sk,
 ({_tap('x', 'a')}) * ({_tap('y', 'b')}) * ({_tap('z', 'c')}) AS w FROM {points} q, range(-1, 3) ra(a), range(-1, 3) rb(b), range(-1, 3) rc(c)""")


SPLINE = dict(**POINTS, **_spline_views("prob", "points", (str(NI), str(NJ), str(NK)), ([NI], [NJ], [NK])))
# quarter weights make exact ties of the ninth decimal; the small shift decides them alike in both engines
CUBIC_SQL = """SELECT t.subject_id, t.i, t.j, t.k, round(sum(w * v) + 3e-11, 9) AS v FROM taps t JOIN ci c ON c.subject_id = t.subject_id AND c.i = si AND c.j = sj AND c.k = sk
 GROUP BY ALL HAVING abs(sum(w * v)) > 1e-12"""
# every participant's scan has a grid of its own, cut from the common one
OWN = (f"({NI} - subject_id % 4)", f"({NJ} - subject_id % 2)", f"({NK} - subject_id % 3)")
OWN_SPLINE = dict(**POINTS, own_prob="SELECT * FROM prob WHERE " + " AND ".join(f"{a} < {n}" for a, n in zip("ijk", OWN)),
                  own_points="SELECT * FROM points WHERE " + " AND ".join(f"{c} <= {n} - 1" for c, n in zip("xyz", OWN)),
                  **_spline_views("own_prob", "own_points", OWN, ([NI - n for n in range(4)], [NJ, NJ - 1], [NK, NK - 1, NK - 2])))


def own_grids(spark, d):
    s = F.col("subject_id")
    return V.subjects(spark, d).select("subject_id", (NI - s % 4).cast("int").alias("ni"), (NJ - s % 2).cast("int").alias("nj"), (NK - s % 3).cast("int").alias("nk"))


def _own_prob(spark, d):
    cut = V.prob(spark, d).join(own_grids(spark, d), "subject_id").filter("i < ni AND j < nj AND k < nk")
    return cut.select("subject_id", "i", "j", "k", "v")


@query("resample_cubic_own_grids", sql(CUBIC_SQL, **OWN_SPLINE))
def resample_cubic_own_grids(spark, d):
    """Borders are mirrored at the edge of every scan's own grid."""
    return geometry.resample(_own_prob(spark, d), _moves(spark, d), TARGET, DIMS, 3, grids=own_grids(spark, d)).withColumn("v", F.round(F.col("v") + 3e-11, 9))


@query("resample_linear_own_grids", sql("""SELECT q.subject_id, q.i, q.j, q.k, round(sum(v * (1 - abs(x - p.i)) * (1 - abs(y - p.j)) * (1 - abs(z - p.k))), 9) AS v
 FROM own_points q JOIN own_prob p ON p.subject_id = q.subject_id AND abs(x - p.i) < 1 AND abs(y - p.j) < 1 AND abs(z - p.k) < 1 GROUP BY ALL""", **OWN_SPLINE))
def resample_linear_own_grids(spark, d):
    return geometry.resample(_own_prob(spark, d), _moves(spark, d), TARGET, DIMS, 1, grids=own_grids(spark, d)).withColumn("v", F.round("v", 9))


@query("value_range_own_grids", sql(f"""SELECT subject_id, CASE WHEN count(*) >= {OWN[0]} * {OWN[1]} * {OWN[2]} THEN min(v) ELSE least(min(v), 0) END AS lo,
 CASE WHEN count(*) >= {OWN[0]} * {OWN[1]} * {OWN[2]} THEN max(v) ELSE greatest(max(v), 0) END AS hi FROM own_full GROUP BY subject_id""", **OWN_SPLINE,
 own_full=f"SELECT g.subject_id, g.i, g.j, g.k, coalesce(v, 0.5) AS v FROM grid g LEFT JOIN prob p USING ({VOX}) WHERE (g.subject_id % 5 > 0 OR g.i > 0) AND "
          + " AND ".join(f"g.{a} < {n.replace('subject_id', 'g.subject_id')}" for a, n in zip("ijk", OWN))))
def value_range_own_grids(spark, d):
    """A scan that fills its own grid has no zero outside its values."""
    cells = attach(V.grid(spark, d), own_grids(spark, d)).filter("i < ni AND j < nj AND k < nk AND (subject_id % 5 > 0 OR i > 0)")
    full = cells.select("subject_id", "i", "j", "k").join(V.prob(spark, d), ["subject_id", "i", "j", "k"], "left").withColumn("v", F.coalesce("v", F.lit(0.5)))
    return voxel.value_range(full, DIMS, own_grids(spark, d))


@query("resample_cubic", sql(CUBIC_SQL, **SPLINE))
def resample_cubic(spark, d):
    return geometry.resample(V.prob(spark, d), _moves(spark, d), TARGET, DIMS, 3).withColumn("v", F.round(F.col("v") + 3e-11, 9))


@query("spline_coefficients", sql(f"SELECT {VOX}, round(v, 6) AS v FROM ci WHERE abs(v) > 1e-5", **SPLINE))
def spline_coefficients(spark, d):
    return geometry.spline_coefficients(V.prob(spark, d), DIMS).filter("abs(v) > 1e-5").withColumn("v", F.round("v", 6))


@query("warp_labels", sql(f"""SELECT g.subject_id, g.i, g.j, g.k, label FROM grid g JOIN parc p ON p.subject_id = g.subject_id
 AND p.i = g.j + 1 AND p.j = {NJ-1} - g.i AND p.k = g.k - 1"""))
def warp_labels(spark, d):
    """A quarter turn with a shift, given as the transform from source to target space."""
    one = F.array(*[F.lit(float(x)) for x in (1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1)])
    # source voxel (j + 1, NJ - 1 - i, k - 1) for target voxel (i, j, k)
    turn = F.array(*[F.lit(float(x)) for x in (0, -1, 0, NJ - 1, 1, 0, 0, -1, 0, 0, 1, 1, 0, 0, 0, 1)])
    table = V.subjects(spark, d).select("subject_id", one.alias("source_affine"), one.alias("target_affine"), turn.alias("transform"))
    return geometry.warp_labels(V.parc(spark, d), table, DIMS, DIMS)


MI = dict(
    ab=f"SELECT subject_id, coalesce(p.v, 0) AS a, coalesce(f.v, 0) AS b FROM mask LEFT JOIN prob p USING ({VOX}) LEFT JOIN (SELECT * FROM folds WHERE fold = 1) f USING ({VOX})",
    ablim="SELECT subject_id, quantile_cont(a, 0.005) AS a0, quantile_cont(a, 0.995) AS a1, quantile_cont(b, 0.005) AS b0, quantile_cont(b, 0.995) AS b1 FROM ab GROUP BY 1",
    joint="""SELECT subject_id, least(floor((least(greatest(a, a0), a1) - a0) * 64 / (a1 - a0)), 63) AS x, least(floor((least(greatest(b, b0), b1) - b0) * 64 / (b1 - b0)), 63) AS y,
 count(*)::DOUBLE AS n FROM ab JOIN ablim USING (subject_id) GROUP BY ALL""",
    mx="SELECT subject_id, x, sum(n) AS nx FROM joint GROUP BY ALL", my="SELECT subject_id, y, sum(n) AS ny FROM joint GROUP BY ALL",
    tot="SELECT subject_id, sum(n) AS t FROM joint GROUP BY 1")


@query("mutual_information", sql("""SELECT subject_id, round(sum(n / t * ln(n * t / (nx * ny))), 6) AS mutual_information FROM joint JOIN mx USING (subject_id, x)
 JOIN my USING (subject_id, y) JOIN tot USING (subject_id) GROUP BY 1""", **MI))
def mutual_information(spark, d):
    second = V.folds(spark, d).filter("fold = 1")
    return geometry.mutual_information(V.prob(spark, d), second, V.mask(spark, d)).withColumn("mutual_information", F.round("mutual_information", 6))
