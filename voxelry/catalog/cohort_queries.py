"""Queries of quality control."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import cohort
from ..session import ensure_checkpoint_dir
from ..streaming.qc_stream import qc_stream as start_stream
from . import recipe as V
from .geometry_queries import rigid_transforms
from .recipe import DIMS
from .registry import query
from .sqltext import sql
from .voxel_queries import BINS

METRICS = ("brain_mask_size", "main_norm_peak", "flair_norm_peak", "rotation_flair_reg")
LONG = {"qc_rows": " UNION ALL ".join(f"SELECT subject_id, '{m}' AS metric, {m}::DOUBLE AS value FROM qc" for m in METRICS)}
FENCES = dict(
    **LONG,
    quart="SELECT metric, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM qc_rows GROUP BY 1",
    beyond="""SELECT subject_id, metric, value, q1 - 1.5*(q3-q1) AS low, q3 + 1.5*(q3-q1) AS high FROM qc_rows JOIN quart USING (metric)
 WHERE (value < q1 - 1.5*(q3-q1) OR value > q3 + 1.5*(q3-q1)) AND (SELECT count(*) FROM qc) >= 10""")


@query("qc_row", sql("""SELECT subject_id, n AS brain_mask_size, round(lo + bin * (hi - lo) / 64, 6) AS main_norm_peak, round(degrees(abs(a)) + degrees(abs(b)), 6) AS rotation_flair_reg,
 round(sqrt(b*b*10000 + a*a*2500 + 2.25), 6) AS translation_flair_reg FROM (SELECT subject_id, count(*) AS n FROM mask GROUP BY 1) JOIN (SELECT * FROM best WHERE rn = 1) USING (subject_id)
 JOIN (SELECT s_suppkey AS subject_id, s_acctbal/100000 AS a, s_nationkey::DOUBLE/500 AS b FROM supplier) USING (subject_id)""", **BINS))
def qc_row(spark, d):
    out = cohort.qc_row(V.mask(spark, d), {"main": V.prob(spark, d)}, DIMS, {"flair": rigid_transforms(spark, d)})
    return out.withColumns({c: F.round(c, 6) for c in ("main_norm_peak", "rotation_flair_reg", "translation_flair_reg")})


@query("qc_join_latest", sql("""SELECT o_custkey AS subject_id, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS total, max(o_orderdate)::DATE IS NOT NULL AS dated
 FROM orders GROUP BY 1"""))
def qc_join_latest(spark, d):
    """Each order counts as a re-appended measurement of its customer."""
    rows = V.table(spark, d, "orders").select(F.col("o_custkey").alias("subject_id"), F.col("o_orderdate").alias("append_date"),
                                              F.col("o_orderkey").alias("position"), F.col("o_totalprice").alias("total"))
    return cohort.qc_latest(rows, position=("position",)).select("subject_id", "total", F.lit(True).alias("dated"))


@query("qc_outliers", sql("SELECT subject_id, metric, round(value, 6) AS value, round(low, 6) AS low, round(high, 6) AS high FROM beyond", **FENCES))
def qc_outliers(spark, d):
    return cohort.qc_outliers(V.qc(spark, d)).withColumns({c: F.round(c, 6) for c in ("value", "low", "high")}).select("subject_id", "metric", "value", "low", "high")


PEAKS = "metric LIKE '%_norm_peak' AND (value > 1 OR value < 0)"


@query("qc_peak_range", sql(f"SELECT subject_id, metric, value FROM qc_rows WHERE {PEAKS}", **LONG))
def qc_peak_range(spark, d):
    return cohort.qc_peak_range(V.qc(spark, d))


@query("qc_failed", sql(f"""SELECT subject_id, array_to_string(list_sort(list(DISTINCT metric)), ',') AS metrics FROM (SELECT subject_id, metric FROM beyond
 UNION ALL SELECT subject_id, metric FROM qc_rows WHERE {PEAKS}) GROUP BY 1""", **FENCES))
def qc_failed(spark, d):
    return cohort.qc_failed(V.qc(spark, d)).withColumn("metrics", F.array_join("metrics", ","))


POP = dict(
    joined="""SELECT subject_id, brain_mask_size, main_norm_peak, false AS is_population FROM qc UNION ALL
 SELECT subject_id, brain_mask_size, main_norm_peak, true FROM population_qc""",
    jr="SELECT subject_id, is_population, 'brain_mask_size' AS metric, brain_mask_size::DOUBLE AS value FROM joined UNION ALL SELECT subject_id, is_population, 'main_norm_peak', main_norm_peak FROM joined",
    jq="SELECT metric, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM jr GROUP BY 1")


@query("qc_with_population", sql("SELECT * FROM joined", **POP))
def qc_with_population(spark, d):
    return cohort.qc_with_population(V.qc(spark, d), V.population_qc(spark, d))


@query("qc_failed_population", sql(f"""SELECT subject_id, is_population, array_to_string(list_sort(list(DISTINCT metric)), ',') AS metrics FROM jr JOIN jq USING (metric)
 WHERE value < q1 - 1.5*(q3-q1) OR value > q3 + 1.5*(q3-q1) OR ({PEAKS}) GROUP BY 1, 2""", **POP))
def qc_failed_population(spark, d):
    both = cohort.qc_with_population(V.qc(spark, d), V.population_qc(spark, d))
    return cohort.qc_failed(both).withColumn("metrics", F.array_join("metrics", ","))


def site_qc(spark, d):
    """Every order is a participant of the site of its customer."""
    return V.table(spark, d, "orders").select(F.col("o_orderkey").alias("subject_id"), F.col("o_custkey").alias("site"),
                                              (F.col("o_totalprice") / 200000).alias("main_norm_peak"))


SITES = dict(site_rows="SELECT o_orderkey AS subject_id, o_custkey AS site, o_totalprice / 200000 AS value, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders",
             site_q="SELECT site, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM site_rows GROUP BY 1")


@query("qc_small_cohort", sql("SELECT subject_id, site, 'main_norm_peak' AS metric, round(value, 9) AS value, false AS is_outlier FROM site_rows WHERE n < 10", **SITES))
def qc_small_cohort(spark, d):
    return cohort.qc_small_cohort(site_qc(spark, d), ["site"]).withColumn("value", F.round("value", 9))


@query("qc_outliers_by_site", sql("""SELECT subject_id, site, 'main_norm_peak' AS metric, round(value, 9) AS value FROM site_rows JOIN site_q USING (site)
 WHERE n >= 10 AND (value < q1 - 1.5*(q3-q1) OR value > q3 + 1.5*(q3-q1))""", **SITES))
def qc_outliers_by_site(spark, d):
    return cohort.qc_outliers(site_qc(spark, d), ["site"]).select("subject_id", "site", "metric", F.round("value", 9).alias("value"))


ARRIVE = dict(
    first_in="SELECT user_id AS subject_id, arg_min(value / 20, (ts, event_id)) AS main_norm_peak FROM events GROUP BY 1",
    popq="SELECT quantile_cont(main_norm_peak, 0.25) AS q1, quantile_cont(main_norm_peak, 0.75) AS q3 FROM population_qc")


@query("qc_stream", sql("""SELECT subject_id, round(main_norm_peak, 6) AS main_norm_peak, CASE WHEN main_norm_peak < q1 - 1.5*(q3-q1) OR main_norm_peak > q3 + 1.5*(q3-q1)
 OR main_norm_peak > 1 OR main_norm_peak < 0 THEN 'main_norm_peak' ELSE '' END AS failed FROM first_in, popq""", **ARRIVE))
def qc_stream(spark, d):
    """Users arrive with their first event and are judged against the population of customers."""
    ensure_checkpoint_dir(spark)
    shared = spark.sparkContext._jsc.sc().getCheckpointDir().get()
    place = f"{shared}/qc-stream-{uuid.uuid4().hex}"
    schema = V.table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    arrivals = events.select(F.col("user_id").alias("subject_id"), (F.col("value") / 20).alias("main_norm_peak"), "ts", "event_id")
    start_stream(arrivals, V.population_qc(spark, d), f"{place}/store", f"{place}/progress", ("ts", "event_id")).awaitTermination()
    stored = spark.read.parquet(f"{place}/store")
    return stored.select("subject_id", F.round("main_norm_peak", 6).alias("main_norm_peak"), F.array_join("failed", ",").alias("failed"))
