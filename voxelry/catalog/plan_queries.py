"""Queries that run whole plans, and the operators around them."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cohort, models
from ..plans import cohort_run, preprocess
from ..plans.settings import Settings
from ..sources import layout
from . import recipe as V
from .cluster_queries import STATS, region_views, rounded
from .cohort_queries import FENCES
from .recipe import DIMS
from .registry import query
from .source_queries import FILES, model_files
from .sqltext import VOX, components as cc_views, sql

SETTINGS = Settings(thresholds={"pvs": 0.8, "wmh": 0.8, "cmb": 0.9, "lac": 0.9}, min_sizes={"pvs": 2, "wmh": 2, "cmb": 1, "lac": 1}, cropped_dims=DIMS)


@query("binarise_prediction", sql(f"SELECT DISTINCT {VOX} FROM folds WHERE fold = 1 AND v > 0.7 UNION SELECT {VOX} FROM folds WHERE fold = 2 AND v > 0.7"))
def binarise_prediction(spark, d):
    """With a hook of the user's own: a voxel counts if one of the last two folds says so."""
    def last_two(folds, threshold):
        return folds.filter((F.col("fold") > 0) & (F.col("v") > threshold)).select("subject_id", "i", "j", "k").distinct()

    return models.binarise_prediction(V.folds(spark, d), 0.7, last_two)


@query("predict_biomarker", sql(f"""SELECT g.subject_id, g.i, g.j, g.k, round((coalesce(p.v, 0) + coalesce(p.v, 0) / 2) / 2, 9) AS v FROM mask g JOIN prob p USING ({VOX})
 WHERE p.v / 2 >= 0.001"""))
def predict_biomarker(spark, d):
    """The mean of two folds inside the brain mask; values below 0.001 never leave the model."""
    def halves(dense, fold):
        return dense[..., 0].round(3).astype(float).round(3) / (fold + 1)

    maps = cohort_run.predict_biomarker([V.prob(spark, d)], V.mask(spark, d), halves, 2, SETTINGS)
    return maps.filter("v > 0.001").withColumn("v", F.round("v", 9))


def _cohort(spark, d, **options):
    p = V.prob(spark, d)
    return cohort_run.run_cohort({"pvs": p, "cmb": p}, V.mask(spark, d), SETTINGS, V.subjects(spark, d), V.derived(spark, d), **options)


PVS = region_views("pvs")
CMB = dict(over="SELECT * FROM prob WHERE v > 0.9", **cc_views("over", name="oc"),
           over_sized=f"SELECT subject_id, cluster_id, count(*) AS sz, count(*) - count(one) AS n_out FROM oc LEFT JOIN (SELECT *, 1 AS one FROM mask) m USING ({VOX}) GROUP BY ALL",
           over_kept="SELECT * FROM over_sized WHERE sz >= 1 AND n_out <= 0.25 * sz")


@query("run_cohort", sql(f"""SELECT 'pvs' AS biomarker, * FROM stats UNION ALL SELECT 'cmb', s.subject_id, 'Whole brain', {STATS}
 FROM subjects s LEFT JOIN over_kept k ON k.subject_id = s.subject_id GROUP BY s.subject_id""", **PVS, **CMB))
def run_cohort(spark, d):
    """Region statistics of two biomarkers from one run; of the second the whole brain."""
    stats = _cohort(spark, d).stats.filter("biomarker = 'pvs' OR region = 'Whole brain'")
    return rounded(stats)


@query("run_cohort_failed_qc", sql("SELECT subject_id, array_to_string(list_sort(list(DISTINCT metric)), ',') AS metrics FROM (SELECT subject_id, metric FROM beyond UNION ALL "
                                   "SELECT subject_id, metric FROM qc_rows WHERE metric LIKE '%norm_peak' AND (value > 1 OR value < 0)) GROUP BY 1",
                                   **FENCES))
def run_cohort_failed_qc(spark, d):
    failed = _cohort(spark, d, qc=V.qc(spark, d)).failed_qc
    return failed.select("subject_id", F.array_join("metrics", ",").alias("metrics"))


@query("pick_file", sql("""SELECT s.subject_id, s.acq, CASE WHEN len(p) > 2 THEN p[3] END AS path FROM (SELECT l_suppkey AS subject_id, l_returnflag AS acq,
 list_sort(list('/scans/' || l_orderkey || '/' || l_linenumber)) AS p FROM lineitem WHERE l_quantity < 6 GROUP BY 1, 2) s"""))
def pick_file(spark, d):
    """The third file of a conversion, where there are as many."""
    files = V.table(spark, d, "lineitem").filter("l_quantity < 6").select(
        F.col("l_suppkey").alias("subject_id"), F.col("l_returnflag").alias("acq"), F.concat(F.lit("/scans/"), "l_orderkey", F.lit("/"), "l_linenumber").alias("path"))
    return layout.pick_file(files, 2)


@query("report_provenance", sql("""SELECT s.folder AS biomarker, s.n AS min_size, string_agg(f.name || ':' || f.md5, ' ' ORDER BY f.name, f.md5) AS files, max(f.name) AS url
 FROM (SELECT folder, count(*) AS n FROM files GROUP BY 1) s LEFT JOIN (SELECT * FROM files WHERE doc_id % 30 < 20) f ON f.folder = s.folder GROUP BY 1, 2""", **FILES))
def report_provenance(spark, d):
    """Parameters of a biomarker stay in the report where its model files are not known."""
    files = model_files(spark, d)
    known = files.filter("doc_id % 30 < 20").select(F.col("folder").alias("biomarker"), "name", "md5", F.col("name").alias("url"))
    parameters = files.groupBy(F.col("folder").alias("biomarker")).agg(F.count("*").alias("min_size"))
    out = cohort.report_provenance(known, parameters)
    return out.select("biomarker", "min_size", F.when(F.size("files") > 0, F.array_join(F.transform("files", lambda f: F.concat_ws(":", f["name"], f["md5"])), " ")).alias("files"), "url")


@query("brain_segmentation_premasked", sql(f"SELECT {VOX} FROM prob WHERE v > 0"))
def brain_segmentation_premasked(spark, d):
    return preprocess.brain_segmentation("premasked", DIMS, SETTINGS, image=V.prob(spark, d))[1]


@query("brain_segmentation_custom", sql(f"SELECT {VOX} FROM derived WHERE label > 0"))
def brain_segmentation_custom(spark, d):
    return preprocess.brain_segmentation("custom", DIMS, SETTINGS, labels=V.derived(spark, d))[1]
