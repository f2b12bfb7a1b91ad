"""Queries over a second set of volumes: few participants, a grid of several bricks, and one participant with a third of all voxels.

All line items take part. A participant is a nation of suppliers; nine nations together are participant 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.offsets import ellipsoid
from ..functions.quantiles import exact_percentiles
from ..operators import components, fill, models, morphology, scoring, voxel
from ..session import staged
from . import recipe as V
from .cluster_queries import score_views
from .neighbour_queries import hull_sql
from .registry import query
from .sqltext import VOX, components as cc_views, sql

LARGE = (72, 72, 40)
LI, LJ, LK = LARGE


def prob_large(spark: SparkSession, d: str) -> DataFrame:
    nation = V.table(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.when(F.col("s_nationkey") < 9, 0).otherwise(F.col("s_nationkey")).cast("long").alias("subject_id"))
    rows = V.table(spark, d, "lineitem").join(nation, "l_suppkey").select(
        "subject_id", (F.col("l_partkey") % LI).cast("int").alias("i"), (F.col("l_orderkey") % LJ).cast("int").alias("j"),
        ((F.expr(f"l_orderkey div {LJ}") + F.col("l_linenumber") * 5) % LK).cast("int").alias("k"),
        (F.col("l_partkey") * 31 + F.col("l_orderkey") * 17 + F.col("l_linenumber") * 7).alias("s"))
    summed = rows.groupBy("subject_id", "i", "j", "k").agg((F.sum("s") % 1000).alias("p"))
    return summed.withColumn("v", F.col("p").cast("double") / 1000)


PROB = {"large": f"""SELECT *, p::DOUBLE / 1000 AS v FROM (SELECT (CASE WHEN s_nationkey < 9 THEN 0 ELSE s_nationkey END)::BIGINT AS subject_id, (l_partkey % {LI})::INT AS i,
 (l_orderkey % {LJ})::INT AS j, ((l_orderkey // {LJ} + l_linenumber * 5) % {LK})::INT AS k, (sum(l_partkey*31 + l_orderkey*17 + l_linenumber*7) % 1000)::BIGINT AS p
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""}
HALF = {**PROB, "half": f"SELECT {VOX} FROM large WHERE v > 0.5"}
SIZED = {**HALF, **cc_views("half", sides=(LJ, LK)),
         "kept": "SELECT subject_id, cluster_id, n, row_number() OVER (PARTITION BY subject_id ORDER BY cluster_id) AS new_id FROM (SELECT subject_id, cluster_id, count(*) AS n FROM cc GROUP BY 1, 2 HAVING count(*) >= 3)"}


@query("connected_components_large", sql(f"SELECT {VOX}, cluster_id FROM cc", **HALF, **cc_views("half", sides=(LJ, LK))))
def connected_components_large(spark, d):
    half = prob_large(spark, d).filter("v > 0.5").select("subject_id", "i", "j", "k")
    return components.label_components(half, LARGE).drop("part_id")


@query("label_clusters_large", sql(f"SELECT {VOX}, cluster_id, n AS cluster_size, new_id FROM cc JOIN kept USING (subject_id, cluster_id)", **SIZED))
def label_clusters_large(spark, d):
    return components.label_clusters(prob_large(spark, d), 0.5, LARGE, 3).drop("part_id")


@query("percentiles_large", sql("SELECT subject_id, count(*) AS n, round(quantile_cont(v, 0.25), 9) AS q25, round(quantile_cont(v, 0.99), 9) AS q99 FROM large GROUP BY 1", **PROB))
def percentiles_large(spark, d):
    q = exact_percentiles(staged(prob_large(spark, d), "prob-large"), ["subject_id"], "v", [0.25, 0.99])
    return q.select("subject_id", "n", F.round(F.col("q")[0], 9).alias("q25"), F.round(F.col("q")[1], 9).alias("q99"))


@query("distance_large", sql("""SELECT w.subject_id, w.i, w.j, w.k, round(sqrt(min((w.i-s.i)**2 + (w.j-s.j)**2 * 2.25 + (w.k-s.k)**2 * 4)), 6) AS d
 FROM large w JOIN large s ON w.subject_id = s.subject_id AND s.v > 0.95 WHERE w.v < 0.05 GROUP BY ALL""", **PROB))
def distance_large(spark, d):
    """Distances of some voxels to others: only the cells on the way to an asked-for voxel are made."""
    p = prob_large(spark, d)
    asked = p.filter("v < 0.05").select("subject_id", "i", "j", "k")
    far = morphology.euclidean_distance(p.filter("v > 0.95"), LARGE, (1.0, 1.5, 2.0), where=asked)
    return far.withColumn("d", F.round("d", 6))


@query("distance_large_own_spacing", sql("""SELECT w.subject_id, w.i, w.j, w.k, round(sqrt(min(((w.i-s.i) * (0.5 + w.subject_id % 3 * 0.25))**2 + (w.j-s.j)**2 * 2.25 + ((w.k-s.k) * (1 + w.subject_id % 4 * 0.5))**2)), 6) AS d
 FROM large w JOIN large s ON w.subject_id = s.subject_id AND s.v > 0.95 WHERE w.v < 0.05 GROUP BY ALL""", **PROB))
def distance_large_own_spacing(spark, d):
    """Every participant's scan has voxel sizes of its own."""
    p, s = prob_large(spark, d), F.col("subject_id")
    grids = p.select("subject_id").distinct().select("subject_id", (F.lit(0.5) + s % 3 * 0.25).alias("vx"), F.lit(1.5).alias("vy"), (F.lit(1.0) + s % 4 * 0.5).alias("vz"))
    asked = p.filter("v < 0.05").select("subject_id", "i", "j", "k")
    return morphology.euclidean_distance(p.filter("v > 0.95"), LARGE, where=asked, grids=grids).withColumn("d", F.round("d", 6))


@query("nearest_label_fill_large", sql("""SELECT w.subject_id, w.i, w.j, w.k, arg_min((s.p % 5)::INT, greatest(abs(w.i-s.i), abs(w.j-s.j), abs(w.k-s.k)) * 10 + s.p % 5) AS label
 FROM large w JOIN large s ON w.subject_id = s.subject_id AND s.p > 980 WHERE w.p < 100 GROUP BY ALL""", **PROB))
def nearest_label_fill_large(spark, d):
    p = prob_large(spark, d)
    labels = p.filter("p > 980").select("subject_id", "i", "j", "k", (F.col("p") % 5).cast("int").alias("label"))
    return fill.nearest_label_fill(labels, p.filter("p < 100"), LARGE)


@query("normalise_large", sql(f"""SELECT {VOX}, round(least(v / q, 1.3) / 1.3, 9) AS v FROM large JOIN (SELECT subject_id, quantile_cont(v, 0.99) AS q FROM large WHERE p % 3 > 0 GROUP BY 1) USING (subject_id)
 WHERE v > 0""", **PROB))
def normalise_large(spark, d):
    p = prob_large(spark, d)
    return voxel.normalise(p, p.filter("p % 3 > 0")).withColumn("v", F.round("v", 9))


BALL = ellipsoid((3, 2, 2))


@query("ellipsoid_dilation_large", sql("SELECT DISTINCT subject_id, (i + a)::INT AS i, (j + b)::INT AS j, (k + c)::INT AS k FROM large, ball WHERE p > 970 AND i + a BETWEEN 0 AND "
                                       f"{LI - 1} AND j + b BETWEEN 0 AND {LJ - 1} AND k + c BETWEEN 0 AND {LK - 1}", **PROB,
                                       ball="SELECT * FROM (VALUES " + ", ".join(map(str, BALL)) + ") t(a, b, c)"))
def ellipsoid_dilation_large(spark, d):
    """Footprints that reach over the borders of blocks."""
    return morphology.dilate_footprint(prob_large(spark, d).filter("p > 970"), BALL, LARGE)


CUTS = [0.5, 0.6, 0.7, 0.75, 0.8, 0.9, 0.95]
LARGE_SCORES = {"prob": PROB["large"], "truth": f"SELECT {VOX} FROM prob WHERE p > 800 AND (p + i) % 5 <> 0",
                **score_views(", ".join(f"({c})" for c in CUTS), sides=(LJ, LK))}


@query("score_sweep_large", sql("SELECT * FROM scores", **LARGE_SCORES))
def score_sweep_large(spark, d):
    """Seven thresholds over several bricks from one labelling."""
    p = prob_large(spark, d)
    found = scoring.score_sweep(p.filter("p > 800 AND (p + i) % 5 <> 0").select("subject_id", "i", "j", "k"), p, LARGE, CUTS, [0, 2])
    return found.withColumns({c: F.round(c, 6) for c in ("sensitivity", "precision", "f1")})


ROUND = "p > CASE WHEN subject_id = 0 THEN 990 ELSE 950 END AND (i - 36) * (i - 36) + (j - 36) * (j - 36) + 3 * (k - 20) * (k - 20) <= 1156"


@query("hull_fill_large", sql(hull_sql("round_", cells="cells"), **PROB, round_=f"SELECT {VOX} FROM large WHERE {ROUND}",
                              cells=f"SELECT subject_id, a.i::INT AS i, b.j::INT AS j, c.k::INT AS k FROM (SELECT DISTINCT subject_id FROM large), range({LI}) a(i), range({LJ}) b(j), range({LK}) c(k)"))
def hull_fill_large(spark, d):
    """Hulls of points spread over a ball that covers all bricks."""
    return fill.hull_fill(prob_large(spark, d).filter(ROUND))


def _box_mean(fold):
    """A small network: the mean over the neighbouring voxels of a row along every axis, wider in the second fold."""
    import numpy as np

    def run(dense):
        out = dense[..., 0].astype(float)
        for axis in range(3):
            padded = np.pad(out, [(1 + fold, 1 + fold) if a == axis else (0, 0) for a in range(3)])
            width = out.shape[axis]
            out = sum(np.take(padded, np.arange(s, s + width), axis) for s in range(3 + 2 * fold))
        return out / (3 + 2 * fold) ** 3
    return run


@query("predict_volumes_large", sql(" UNION ALL ".join(f"""SELECT s.subject_id, {f} AS fold, (s.i + a)::INT AS i, (s.j + b)::INT AS j, (s.k + c)::INT AS k, round(sum(v) / {(3 + 2 * f) ** 3}, 6) AS v
 FROM large s, range({-1 - f}, {2 + f}) ra(a), range({-1 - f}, {2 + f}) rb(b), range({-1 - f}, {2 + f}) rc(c) WHERE p > 700 AND s.i + a BETWEEN 0 AND {LI - 1} AND s.j + b BETWEEN 0 AND {LJ - 1}
 AND s.k + c BETWEEN 0 AND {LK - 1} GROUP BY ALL""" for f in (0, 1)), **PROB))
def predict_volumes_large(spark, d):
    """Tiles with a halo of half the receptive field give what the whole grid gives; a network is loaded once a worker."""
    channel = prob_large(spark, d).filter("p > 700").select("subject_id", "i", "j", "k", F.col("v").alias("c1"))
    return models.predict_volumes(channel, models.Loaded(_box_mean), 2, LARGE, field=5).withColumn("v", F.round("v", 6))
