"""Volumes derived from the driver's tables, once as Spark plans and once as SQL text.

Every supplier is a participant, so the number of volumes grows with the tables; every line item is a sample of the
participant's map. All arithmetic is on integers, so both engines give the same rows. See FIXTURES.md.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.joins import shuffled_join
from ..functions.matrix import pack
from ..session import cut_lineage, scatter

DIMS = (12, 12, 8)
NI, NJ, NK = DIMS

# --- fixed values: label blocks of the two parcellation-like volumes -------------------------------------------------
PARC_CODES = [2, 41, 2, 41, 4, 43, 2, 41, 10, 49, 2, 41, 12, 51, 1035, 2035, 1003, 2003, 2, 41, 11, 50, 77, 1008, 2001, 16, 17]
ISLAND_CODES = [251, 14, 1002]
DERIVED_CODES = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 21, 22, 23, 24, 25, 26, 27, 28, 29, 30, 31, 32,
                 33, 34, 35, 36, 37, 40, 41, 42, 43, 44, 45, 46, 47, 50, 51, 52, 53, 54, 55, 56, 57, 60, 78, 79, 80, 88, 89, 90]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prob(spark: SparkSession, d: str) -> DataFrame:
    """Sparse probability map in thousandths (``p``) and as a fraction (``v``)."""
    rows = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("subject_id"), (F.col("l_partkey") % NI).cast("int").alias("i"),
        (F.col("l_orderkey") % NJ).cast("int").alias("j"),
        ((F.expr(f"l_orderkey div {NJ}") + F.col("l_linenumber")) % NK).cast("int").alias("k"),
        (F.col("l_partkey") * 31 + F.col("l_orderkey") * 17 + F.col("l_linenumber") * 7).alias("s"))
    # tasks of about a million samples, whatever the session's number of partitions: hash tables then do not grow with the tables
    summed = scatter(rows, "subject_id", "i", "j", "k", each=1).groupBy("subject_id", "i", "j", "k").agg((F.sum("s") % 1000).alias("p"))
    return summed.filter("p > 0").withColumn("v", F.col("p").cast("double") / 1000)


def truth(spark: SparkSession, d: str) -> DataFrame:
    """A second, correlated mask for scoring."""
    return prob(spark, d).filter("(p > 800 AND (p + i) % 5 <> 0) OR p BETWEEN 780 AND 790").select("subject_id", "i", "j", "k")


def subjects(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select(F.col("s_suppkey").alias("subject_id"))


def grid(spark: SparkSession, d: str) -> DataFrame:
    out = scatter(subjects(spark, d), each=NI * NJ * NK)
    for a, n in zip("ijk", DIMS):
        out = out.withColumn(a, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return out


def _codes(values: list[int]):
    return F.array(*map(F.lit, values))


def parc(spark: SparkSession, d: str) -> DataFrame:
    """FreeSurfer-like blocks, arranged differently for every participant, with islands where the map says so."""
    p = prob(spark, d).select("subject_id", "i", "j", "k", "p")
    rows = shuffled_join(grid(spark, d), p, how="left")
    block = F.expr("(i div 4) * 9 + (j div 4) * 3 + k div 3 + subject_id * 5") % len(PARC_CODES)
    island = F.get(_codes(ISLAND_CODES), (F.col("subject_id") % 3).cast("int"))
    label = F.when(F.coalesce("p", F.lit(1)) % 23 == 0, island).otherwise(F.get(_codes(PARC_CODES), block.cast("int")))
    return rows.select("subject_id", "i", "j", "k", label.alias("label"))


def parc_table(spark: SparkSession, d: str) -> DataFrame:
    """The label blocks as a stored table, for rules that read them many times."""
    return cut_lineage(parc(spark, d))


def derived(spark: SparkSession, d: str) -> DataFrame:
    """All codes of the derived parcellation in blocks of 2x2x2."""
    block = F.expr("((i div 2) * 24 + (j div 2) * 4 + k div 2) * 7 + subject_id") % len(DERIVED_CODES)
    return grid(spark, d).withColumn("label", F.get(_codes(DERIVED_CODES), block.cast("int")))


def mask(spark: SparkSession, d: str) -> DataFrame:
    return grid(spark, d).filter("i BETWEEN 1 AND 10 AND j BETWEEN 1 AND 9 AND k BETWEEN 1 AND 6 - subject_id % 2")


def folds(spark: SparkSession, d: str) -> DataFrame:
    rows = prob(spark, d).withColumn("fold", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return rows.select("subject_id", "fold", "i", "j", "k", (((F.col("p") + F.col("fold") * 37) % 1000).cast("double") / 1000).alias("v"))


def images(spark: SparkSession, d: str) -> DataFrame:
    """Scan headers from the suppliers: voxel sizes, a slightly skewed affine, an orientation."""
    s = table(spark, d, "supplier")
    key, nation, cents = F.col("s_suppkey"), F.col("s_nationkey").cast("double"), F.floor(F.col("s_acctbal"))
    rows = s.select(
        key.alias("subject_id"), F.lit(NI).alias("ni"), F.lit(NJ).alias("nj"), F.lit(NK).alias("nk"),
        (F.lit(0.75) + nation / 50).alias("vx"), (F.lit(1.25) - nation / 100).alias("vy"), (F.lit(1.0) + (key % 3).cast("double") / 4).alias("vz"),
        (F.when(key % 3 == 0, 0.0).when(key % 3 == 1, 0.001).otherwise(0.03)).alias("skew"),
        F.get(F.array(*map(F.lit, ["RAS", "LPS", "ASR", "SRP", "PIL"])), (key % 5).cast("int")).alias("orient"),
        cents.cast("double").alias("shift"))
    skew, zero, one = F.col("skew"), F.lit(0.0), F.lit(1.0)
    affine = pack([[F.col("vx"), skew * F.col("vy"), zero, F.lit(-10.0) - F.col("shift") / 1000],
                   [zero, F.col("vy"), zero, F.lit(-12.0)],
                   [zero, zero, -F.col("vz"), F.lit(4.0) + F.col("shift") / 2000],
                   [zero, zero, zero, one]])
    return rows.select("subject_id", "ni", "nj", "nk", "vx", "vy", "vz", affine.alias("affine"), "orient")


def qc(spark: SparkSession, d: str) -> DataFrame:
    """Quality measures per participant."""
    li = table(spark, d, "lineitem")
    return li.groupBy(F.col("l_suppkey").alias("subject_id")).agg(
        F.count("*").alias("brain_mask_size"), F.round(F.avg("l_discount") * 20, 6).alias("main_norm_peak"),
        F.round(F.avg("l_tax") * 25, 6).alias("flair_norm_peak"), F.round(F.stddev_samp("l_quantity"), 6).alias("rotation_flair_reg"))


def population_qc(spark: SparkSession, d: str) -> DataFrame:
    """The measures of an earlier study, from the orders of each customer."""
    o = table(spark, d, "orders")
    return o.groupBy((F.col("o_custkey") + 1_000_000).alias("subject_id")).agg(
        (F.count("*") * 50).alias("brain_mask_size"), F.round(F.avg("o_totalprice") / 250000, 6).alias("main_norm_peak"),
        F.round(F.max("o_totalprice") / 1000, 6).alias("other_measure"))


def _sql_codes(values: list[int]) -> str:
    return "[" + ",".join(map(str, values)) + "]"


CELLS = f"""SELECT s_suppkey AS subject_id, a.i::INT AS i, b.j::INT AS j, c.k::INT AS k
FROM supplier, range({NI}) a(i), range({NJ}) b(j), range({NK}) c(k)"""

#: name -> SQL of the same views
VIEWS = {
    "prob": f"""SELECT *, p::DOUBLE / 1000 AS v FROM (
SELECT l_suppkey AS subject_id, (l_partkey % {NI})::INT AS i, (l_orderkey % {NJ})::INT AS j,
 ((l_orderkey // {NJ} + l_linenumber) % {NK})::INT AS k, (sum(l_partkey*31 + l_orderkey*17 + l_linenumber*7) % 1000)::BIGINT AS p
FROM lineitem GROUP BY ALL) WHERE p > 0""",
    "truth": "SELECT subject_id, i, j, k FROM prob WHERE (p > 800 AND (p + i) % 5 <> 0) OR p BETWEEN 780 AND 790",
    "subjects": "SELECT s_suppkey AS subject_id FROM supplier",
    "grid": CELLS,
    "parc": f"""SELECT g.subject_id, g.i, g.j, g.k, (CASE WHEN coalesce(p.p, 1) % 23 = 0 THEN {_sql_codes(ISLAND_CODES)}[1 + g.subject_id % 3]
 ELSE {_sql_codes(PARC_CODES)}[1 + ((g.i//4)*9 + (g.j//4)*3 + g.k//3 + g.subject_id*5) % {len(PARC_CODES)}] END)::INT AS label
FROM grid g LEFT JOIN prob p USING (subject_id, i, j, k)""",
    "derived": f"""SELECT subject_id, i, j, k, ({_sql_codes(DERIVED_CODES)}[1 + (((i//2)*24 + (j//2)*4 + k//2)*7 + subject_id) % {len(DERIVED_CODES)}])::INT AS label
FROM grid""",
    "mask": "SELECT * FROM grid WHERE i BETWEEN 1 AND 10 AND j BETWEEN 1 AND 9 AND k BETWEEN 1 AND 6 - subject_id % 2",
    "folds": "SELECT subject_id, f::INT AS fold, i, j, k, ((p + f*37) % 1000)::DOUBLE / 1000 AS v FROM prob, (VALUES (0),(1),(2)) t(f)",
    "images": f"""SELECT subject_id, ni, nj, nk, vx, vy, vz,
 [vx, skew*vy, 0.0::DOUBLE, -10.0::DOUBLE - shift/1000, 0.0::DOUBLE, vy, 0.0::DOUBLE, -12.0::DOUBLE,
  0.0::DOUBLE, 0.0::DOUBLE, -vz, 4.0::DOUBLE + shift/2000, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE] AS affine, orient
FROM (SELECT s_suppkey AS subject_id, {NI}::INT AS ni, {NJ}::INT AS nj, {NK}::INT AS nk, 0.75::DOUBLE + s_nationkey::DOUBLE/50 AS vx,
  1.25::DOUBLE - s_nationkey::DOUBLE/100 AS vy, 1.0::DOUBLE + (s_suppkey % 3)::DOUBLE/4 AS vz,
  (CASE s_suppkey % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.001 ELSE 0.03 END)::DOUBLE AS skew,
  ['RAS','LPS','ASR','SRP','PIL'][1 + s_suppkey % 5] AS orient, floor(s_acctbal)::DOUBLE AS shift FROM supplier)""",
    "qc": """SELECT l_suppkey AS subject_id, count(*) AS brain_mask_size, round(avg(l_discount)*20, 6) AS main_norm_peak,
 round(avg(l_tax)*25, 6) AS flair_norm_peak, round(stddev_samp(l_quantity), 6) AS rotation_flair_reg FROM lineitem GROUP BY 1""",
    "population_qc": """SELECT o_custkey + 1000000 AS subject_id, count(*)*50 AS brain_mask_size, round(avg(o_totalprice)/250000, 6) AS main_norm_peak,
 round(max(o_totalprice)/1000, 6) AS other_measure FROM orders GROUP BY 1""",
}
