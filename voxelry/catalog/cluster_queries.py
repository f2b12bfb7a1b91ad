"""Queries of clusters, regions, ensembles and scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import regions as R
from ..operators import cohort, components, models, parcellation, scoring
from ..operators import clusters as C
from . import recipe as V
from .neighbour_queries import HIGH, high
from .recipe import DIMS
from .registry import query
from .sqltext import VOX, components as cc_views, sql
from .voxel_queries import lut_values

STATS = ("count(sz) AS n_clusters, coalesce(sum(sz), 0)::BIGINT AS total_vol, round(avg(sz), 6) AS mean_vol, median(sz)::DOUBLE AS median_vol,"
         " round(stddev_samp(sz), 6) AS std_vol, min(sz) AS min_vol, max(sz) AS max_vol")
KEPT = dict(
    sized=f"SELECT cluster_id, subject_id, count(*) AS sz, count(*) - count(one) AS n_out FROM cc LEFT JOIN (SELECT *, 1 AS one FROM mask) m USING ({VOX}) GROUP BY ALL",
    kept="SELECT * FROM sized WHERE sz >= 2 AND n_out <= 0.25 * sz")


def region_views(scheme: str, priority: str = "") -> dict[str, str]:
    first = f"CASE WHEN region_label IN ({priority}) THEN 1 ELSE 0 END DESC, " if priority else ""
    return dict(
        **HIGH, **cc_views("high"), **KEPT,
        region_map=f"SELECT {VOX}, region_label, region FROM derived JOIN {lut_values(scheme)} ON label = src_label",
        votes=f"SELECT cc.subject_id, cluster_id, coalesce(region_label, 0) AS region_label, any_value(region) AS region, count(*) AS n FROM cc JOIN kept USING (subject_id, cluster_id) LEFT JOIN region_map USING ({VOX}) GROUP BY ALL"
        .replace("cc.subject_id", "subject_id"),
        won=f"SELECT *, row_number() OVER (PARTITION BY subject_id, cluster_id ORDER BY {first}n DESC, region_label) AS rn FROM votes",
        census="SELECT subject_id, cluster_id, sz, region FROM won JOIN kept USING (subject_id, cluster_id) WHERE rn = 1",
        region_cells="SELECT subject_id, region FROM subjects, (VALUES ('Whole brain'), " + ", ".join(f"('{n}')" for _, n, _ in R.SCHEMES[scheme]) + ") v(region)",
        stats=f"SELECT x.subject_id, x.region, {STATS} FROM region_cells x LEFT JOIN census c ON x.subject_id = c.subject_id AND (x.region = 'Whole brain' OR x.region = c.region) GROUP BY ALL")


def rounded(df):
    return df.withColumns({c: F.round(c, 6) for c in ("mean_vol", "std_vol")})


def _clusters(spark, d):
    return components.label_clusters(V.prob(spark, d), 0.8, DIMS, 2, V.mask(spark, d))


def _census(spark, d, scheme="pvs", priority=()):
    labels = parcellation.parcellate(V.derived(spark, d), scheme)
    return C.assign_region(_clusters(spark, d), labels, R.region_dictionary(spark, scheme), priority)


def _stats(spark, d):
    return C.region_stats(_census(spark, d), R.region_dictionary(spark, "pvs"), V.subjects(spark, d))


@query("cluster_census", sql("SELECT subject_id, cluster_id, count(*) AS cluster_size FROM cc GROUP BY 1, 2", **HIGH, **cc_views("high")))
def cluster_census(spark, d):
    return components.census(components.label_components(high(spark, d), DIMS))


@query("drop_outside_clusters", sql(f"SELECT {VOX}, cluster_id FROM cc JOIN sized USING (subject_id, cluster_id) WHERE n_out <= 0.25 * sz", **HIGH, **cc_views("high"), **KEPT))
def drop_outside_clusters(spark, d):
    marked = components.label_components(high(spark, d), DIMS)
    return components.drop_outside_clusters(marked, V.mask(spark, d)).select("subject_id", "i", "j", "k", "cluster_id")


@query("whole_brain_stats", sql(f"SELECT subject_id, {STATS} FROM kept GROUP BY 1", **HIGH, **cc_views("high"), **KEPT))
def whole_brain_stats(spark, d):
    return rounded(C.whole_brain_stats(_clusters(spark, d).groupBy("subject_id", "cluster_id").agg(F.count("*").alias("cluster_size"))))


@query("assign_region_wta", sql("SELECT subject_id, cluster_id, sz AS cluster_size, region FROM census", **region_views("pvs")))
def assign_region_wta(spark, d):
    return _census(spark, d)


@query("assign_region_priority", sql("SELECT subject_id, cluster_id, sz AS cluster_size, region FROM census", **region_views("wmh", "3, 7")))
def assign_region_priority(spark, d):
    return _census(spark, d, "wmh", (3, 7))


@query("region_stats", sql("SELECT * FROM stats", **region_views("pvs")))
def region_stats(spark, d):
    return rounded(_stats(spark, d))


@query("region_metrics", sql("SELECT * FROM stats", **region_views("wmh", "3, 7")))
def region_metrics(spark, d):
    _, stats = C.region_metrics(V.prob(spark, d), V.derived(spark, d), "wmh", DIMS, 0.8, 2, V.mask(spark, d), V.subjects(spark, d))
    return rounded(stats)


WIDE_REGIONS = ["Whole brain", *[name for _, name, _ in R.SCHEMES["pvs"]]]
WIDE_SQL = ", ".join(f"round(any_value(CASE WHEN region = '{r}' THEN {s} END), 6)::DOUBLE AS \"{r} - {s}\"" for r in WIDE_REGIONS for s in cohort.STATISTICS)


@query("region_stats_wide", sql(f"SELECT subject_id, {WIDE_SQL} FROM stats GROUP BY 1", **region_views("pvs")))
def region_stats_wide(spark, d):
    wide = cohort.metrics_wide(_stats(spark, d), WIDE_REGIONS)
    return wide.select("subject_id", *[F.round(f"`{c}`", 6).alias(c) for c in wide.columns[1:]])


@query("cohort_metrics_long", sql("SELECT * FROM stats WHERE region <> 'Brainstem'", **region_views("pvs")))
def cohort_metrics_long(spark, d):
    tagged = _stats(spark, d).withColumn("biomarker", F.when(F.col("region") == "Brainstem", "x").otherwise("pvs"))
    return rounded(cohort.cohort_metrics_long(tagged, "pvs"))


#: DuckDB's PIVOT makes its columns from the data, so a statistic that nobody has a value for leaves none.
FILLED = dict(**region_views("pvs"), metric_rows=" UNION ALL ".join(
    f"SELECT subject_id, region || ' - {s}' AS metric, round({s}, 6)::DOUBLE AS v FROM stats" for s in cohort.STATISTICS))


@query("cohort_metrics_wide", sql("SELECT * FROM (PIVOT (SELECT * FROM metric_rows WHERE v IS NOT NULL) ON metric USING any_value(v) GROUP BY subject_id)", **FILLED))
def cohort_metrics_wide(spark, d):
    """A region that nobody has a value for leaves no column."""
    wide = cohort.metrics_wide(_stats(spark, d), [*WIDE_REGIONS, "Nowhere"], drop_empty=True)
    return wide.select("subject_id", *[F.round(f"`{c}`", 6).alias(c) for c in wide.columns[1:]])


REPORT = dict(**region_views("pvs"), empties="SELECT subject_id, count(*) FILTER (n_clusters = 0) AS ne, list_sort(list(region) FILTER (n_clusters = 0)) AS el FROM stats GROUP BY 1")
REPORT_COLUMNS = ", ".join(f"CASE WHEN {s} IS NOT NULL THEN printf('%.2f', ({s} * 1.5)::DOUBLE) END AS {s}" for s in cohort.STATISTICS if s != "n_clusters")


@query("report_table", sql(f"""SELECT subject_id, region, n_clusters, {REPORT_COLUMNS}, CASE WHEN ne > 7 THEN array_to_string(el, ', ') ELSE '' END AS empty_regions
 FROM stats JOIN empties USING (subject_id) WHERE ne <= 7 OR n_clusters > 0""", **REPORT))
def report_table(spark, d):
    return cohort.report_table(rounded(_stats(spark, d)), 1.5)


@query("anonymise", sql("SELECT '' AS subject_id, brain_mask_size, main_norm_peak, flair_norm_peak, rotation_flair_reg FROM qc"))
def anonymise(spark, d):
    return cohort.anonymise(V.qc(spark, d))


VENT = dict(**HIGH, **cc_views("high"), vent="SELECT * FROM parc WHERE label IN (4, 43)",
            dist="SELECT h.subject_id, h.i, h.j, h.k, sqrt(min((h.i-v.i)**2 + (h.j-v.j)**2 + (h.k-v.k)**2)) AS d FROM high h JOIN vent v ON h.subject_id = v.subject_id GROUP BY ALL",
            far=f"SELECT subject_id, cluster_id, count(*) AS n, max(d) AS mx, min(d) AS mn FROM cc LEFT JOIN dist USING ({VOX}) GROUP BY ALL")
VENT["high"] = f"SELECT {VOX} FROM prob WHERE v >= 0.8"


@query("wmh_ventricle_distance", sql("""SELECT subject_id, cluster_id, n AS n_voxels, round(mx, 6) AS max_distance, round(mn, 6) AS min_distance, (mn <= 2)::INT AS pvwmh,
 (mn > 2)::INT AS dwmh, 0.8::DOUBLE AS threshold FROM subjects LEFT JOIN far USING (subject_id)""", **VENT))
def wmh_ventricle_distance(spark, d):
    ventricles = V.parc(spark, d).filter("label IN (4, 43)")
    out = C.wmh_ventricle_distance(V.prob(spark, d), ventricles, DIMS, 0.8, subjects=V.subjects(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("max_distance", "min_distance")})


@query("wmh_totals", sql("""SELECT subject_id, 0.8::DOUBLE AS threshold, count(*) FILTER (mn <= 2) AS n_clusters_pv, count(*) FILTER (mn > 2) AS n_clusters_deep,
 coalesce(sum(n) FILTER (mn <= 2), 0)::BIGINT AS n_voxels_pv, coalesce(sum(n) FILTER (mn > 2), 0)::BIGINT AS n_voxels_deep FROM subjects LEFT JOIN far USING (subject_id) GROUP BY 1""", **VENT))
def wmh_totals(spark, d):
    ventricles = V.parc(spark, d).filter("label IN (4, 43)")
    return C.wmh_totals(C.wmh_ventricle_distance(V.prob(spark, d), ventricles, DIMS, 0.8, subjects=V.subjects(spark, d)))


@query("pvs_bg_dwm", sql(f"""SELECT subject_id, count(*) FILTER (NOT bg AND n > 6) AS dwm_clusters, coalesce(sum(n) FILTER (NOT bg AND n > 6), 0)::BIGINT AS dwm_voxels,
 count(*) FILTER (bg) AS bg_clusters, coalesce(sum(n) FILTER (bg), 0)::BIGINT AS bg_voxels, count(*) FILTER (bg OR n > 6) AS total_clusters,
 coalesce(sum(n) FILTER (bg OR n > 6), 0)::BIGINT AS total_voxels FROM subjects LEFT JOIN (SELECT subject_id, cluster_id, count(*) AS n, count(label)*2 > count(*) AS bg
 FROM cc LEFT JOIN (SELECT * FROM parc WHERE label IN (10, 11, 12, 49, 51, 2, 50)) USING ({VOX}) GROUP BY ALL) USING (subject_id) GROUP BY 1""", **VENT))
def pvs_bg_dwm(spark, d):
    basal = V.parc(spark, d).filter("label IN (10, 11, 12, 49, 51, 2, 50)")
    return C.pvs_bg_dwm(V.prob(spark, d), basal, DIMS, 0.8, subjects=V.subjects(spark, d))


PLOT = dict(**region_views("pvs"), sizes="SELECT subject_id, cluster_id, region, sz * 1.5::DOUBLE AS vol FROM census WHERE region IS NOT NULL",
            limits="""SELECT subject_id, region, count(*) AS n, greatest(quantile_cont(vol, 0.75) + 3 * (quantile_cont(vol, 0.75) - quantile_cont(vol, 0.25)), quantile_cont(vol, 0.95)) AS top
 FROM sizes GROUP BY 1, 2""")


@query("census_plot_data", sql("SELECT subject_id, cluster_id, region, vol AS volume_mm3, vol > top AS is_extreme, n < 10 AS few_clusters FROM sizes JOIN limits USING (subject_id, region)", **PLOT))
def census_plot_data(spark, d):
    return C.census_plot_data(_census(spark, d), 1.5)


@query("extreme_threshold", sql("SELECT subject_id, region, n AS n_clusters, round(top, 6) AS extreme_above FROM limits", **PLOT))
def extreme_threshold(spark, d):
    rows = _census(spark, d).filter("region IS NOT NULL").withColumn("vol", F.col("cluster_size") * 1.5)
    return C.extreme_threshold(rows, ["subject_id", "region"], "vol").withColumn("extreme_above", F.round("extreme_above", 6))


@query("fold_ensemble", sql(f"SELECT {VOX}, round(sum(v) / 3, 6) AS v FROM folds SEMI JOIN mask USING ({VOX}) WHERE v >= 0.2 GROUP BY ALL"))
def fold_ensemble(spark, d):
    kept = V.folds(spark, d).filter("v >= 0.2")
    return models.fold_ensemble(kept, 3, V.mask(spark, d)).withColumn("v", F.round("v", 6))


@query("hilo_ensemble", sql(f"""SELECT {VOX} FROM folds GROUP BY ALL HAVING round(coalesce(sum(v) FILTER (fold < 1), 0) / 1, 9) > 0.9
 OR round(coalesce(sum(v) FILTER (fold >= 1), 0) / 2, 9) > 0.9"""))
def hilo_ensemble(spark, d):
    return models.hilo_ensemble(V.folds(spark, d), 3, 0.9)


def _box_mean(dense, fold):
    """Mean of the 27 voxels around each, in thousandths to be exact, plus a constant: what is empty is not zero."""
    whole = np.pad(np.rint(dense[..., 0].astype(float) * 1000), 1)
    return sum(whole[a:a + dense.shape[0], b:b + dense.shape[1], c:c + dense.shape[2]] for a in range(3) for b in range(3) for c in range(3)) / 27000 + 0.002 * (fold + 1)


@query("predict_volumes", sql(f"""SELECT g.subject_id, fold, g.i, g.j, g.k, round(coalesce(sum(p.p), 0) / 27000 + 0.002 * (fold + 1), 9) AS v
 FROM grid g CROSS JOIN (VALUES (0::INT), (1::INT)) t(fold) LEFT JOIN around p ON p.subject_id = g.subject_id AND p.i = g.i AND p.j = g.j AND p.k = g.k GROUP BY g.subject_id, fold, g.i, g.j, g.k""",
 around="""SELECT subject_id, (i + a)::INT AS i, (j + b)::INT AS j, (k + c)::INT AS k, p FROM prob, range(-1, 2) x(a), range(-1, 2) y(b), range(-1, 2) z(c)"""))
def predict_volumes(spark, d):
    """A fixed small model over tiles with a halo; every tile of every participant is predicted."""
    channel = V.prob(spark, d).select("subject_id", "i", "j", "k", F.col("v").alias("c1"))
    out = models.predict_volumes(channel, _box_mean, 2, DIMS, (6, 6, 4), 1, subjects=V.subjects(spark, d))
    return out.withColumn("v", F.round("v", 9))


PRED = {"pred": f"SELECT {VOX} FROM prob WHERE p > 800"}


@query("voxel_scores", sql(f"""SELECT subject_id, tp, fp, fn, round(tp / (tp + fn), 6) AS sensitivity, round(tp / (tp + fp), 6) AS precision, round(2*tp / (2*tp + fp + fn), 6) AS f1 FROM (
 SELECT subject_id, count(*) FILTER (t = 1 AND q = 1) AS tp, count(*) FILTER (t IS NULL) AS fp, count(*) FILTER (q IS NULL) AS fn
 FROM (SELECT *, 1 AS t FROM truth) FULL JOIN (SELECT *, 1 AS q FROM pred) USING ({VOX}) GROUP BY 1)""", **PRED))
def voxel_scores(spark, d):
    return _r(scoring.voxel_scores(V.truth(spark, d), high(spark, d)))


def _r(df):
    return df.withColumns({c: F.round(c, 6) for c in ("sensitivity", "precision", "f1")})


def score_views(levels: str, **options) -> dict[str, str]:
    """Overlap tables of true and predicted components per threshold; ``options`` are those of the component views."""
    return dict(
        lv=f"SELECT * FROM (VALUES {levels}) t(threshold)",
        tru=f"SELECT threshold, {VOX} FROM truth, lv", prd=f"SELECT threshold, {VOX} FROM prob JOIN lv ON v > threshold",
        **cc_views("tru", keys="threshold", name="tc", **options), **cc_views("prd", keys="threshold", name="pc", **options),
        ts="SELECT threshold, subject_id, cluster_id AS t_id, count(*) AS t_size FROM tc GROUP BY ALL", ps="SELECT threshold, subject_id, cluster_id AS p_id, count(*) AS p_size FROM pc GROUP BY ALL",
        shared=f"SELECT threshold, subject_id, t_id, p_id, count(*) AS n FROM (SELECT threshold, {VOX}, cluster_id AS t_id FROM tc) FULL JOIN (SELECT threshold, {VOX}, cluster_id AS p_id FROM pc) USING (threshold, {VOX}) GROUP BY ALL",
        pairs="SELECT * FROM shared LEFT JOIN ts USING (threshold, subject_id, t_id) LEFT JOIN ps USING (threshold, subject_id, p_id)",
        flt="SELECT * FROM (VALUES (0), (2)) t(cluster_filter)",
        fp0="SELECT *, coalesce(t_size > cluster_filter, false) AS tok, coalesce(p_size > cluster_filter, false) AS pok FROM pairs, flt",
        vox="""SELECT threshold, subject_id, cluster_filter, coalesce(sum(n) FILTER (tok AND pok), 0)::BIGINT AS tp, coalesce(sum(n) FILTER (NOT tok AND pok), 0)::BIGINT AS fp,
 coalesce(sum(n) FILTER (tok AND NOT pok), 0)::BIGINT AS fn FROM fp0 GROUP BY ALL""",
        clu="""SELECT threshold, subject_id, cluster_filter, count(DISTINCT CASE WHEN tok AND p_id IS NOT NULL THEN t_id END) AS tp, count(DISTINCT CASE WHEN tok THEN t_id END) AS nt,
 count(DISTINCT CASE WHEN pok THEN t_id END) AS tp2, count(DISTINCT CASE WHEN pok THEN p_id END) - count(DISTINCT CASE WHEN pok AND t_id IS NOT NULL THEN p_id END) AS fp FROM fp0 GROUP BY ALL""",
        clur="""SELECT *, nt - tp AS fn, CASE WHEN tp > 0 THEN tp / nt WHEN nt = 0 AND fp = 0 THEN 1 ELSE 0 END AS se,
 CASE WHEN tp2 > 0 THEN tp2 / (tp2 + fp) WHEN nt = tp AND fp = 0 THEN 1 ELSE 0 END AS pr FROM clu""",
        scores="""SELECT threshold::DOUBLE AS threshold, subject_id, cluster_filter, 'Voxel' AS output_type, tp, fp, fn,
 round(CASE WHEN tp + fp + fn = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE tp / (tp + fn) END, 6) AS sensitivity, round(CASE WHEN tp + fp + fn = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE tp / (tp + fp) END, 6) AS precision,
 round(CASE WHEN tp + fp + fn = 0 THEN 1 WHEN tp = 0 THEN 0 ELSE 2*tp / (2*tp + fp + fn) END, 6) AS f1 FROM vox UNION ALL
 SELECT threshold::DOUBLE, subject_id, cluster_filter, 'Cluster', tp, fp, fn, round(se, 6), round(pr, 6), round(CASE WHEN se + pr > 0 THEN 2*se*pr / (se + pr) ELSE 0 END, 6) FROM clur""")


@query("cluster_scores", sql("SELECT subject_id, sensitivity, precision, f1, tp, fp, fn FROM scores WHERE output_type = 'Cluster' AND cluster_filter = 2", **score_views("(0.8)")))
def cluster_scores(spark, d):
    return _r(scoring.cluster_scores(V.truth(spark, d), high(spark, d), DIMS, 2))


@query("score_sweep", sql("SELECT * FROM scores", **score_views("(0.8), (0.85), (0.9)")))
def score_sweep(spark, d):
    return _r(scoring.score_sweep(V.truth(spark, d), V.prob(spark, d), DIMS, [0.8, 0.85, 0.9], [0, 2]))


HD = dict(
    **PRED, **cc_views("truth", name="tc"), **cc_views("pred", name="pc"),
    tk=f"SELECT * FROM tc SEMI JOIN (SELECT subject_id, cluster_id FROM tc SEMI JOIN pred USING ({VOX})) USING (subject_id, cluster_id)",
    pk=f"SELECT * FROM pc SEMI JOIN (SELECT subject_id, cluster_id FROM pc SEMI JOIN truth USING ({VOX})) USING (subject_id, cluster_id)",
    **{f"{n}r": f"SELECT s.* FROM {n}k s WHERE (SELECT count(*) FROM {n}k o WHERE o.subject_id = s.subject_id AND abs(o.i-s.i) + abs(o.j-s.j) + abs(o.k-s.k) = 1) < 6" for n in "tp"},
    gaps=" UNION ALL ".join(f"SELECT a.subject_id, sqrt(min((a.i-b.i)**2 + (a.j-b.j)**2 + (a.k-b.k)**2)) AS d FROM {a}r a JOIN {b}r b ON a.subject_id = b.subject_id GROUP BY a.subject_id, a.id" for a, b in ("tp", "pt")))


@query("hd95", sql("SELECT subject_id, round(quantile_cont(d, 0.95), 6) AS hd95 FROM gaps GROUP BY 1", **HD))
def hd95(spark, d):
    return scoring.hd95(V.truth(spark, d), high(spark, d), DIMS).withColumn("hd95", F.round("hd95", 6))


