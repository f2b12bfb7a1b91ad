"""Exact quantiles per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import scatter
from .joins import attach

#: Relative rank error of the sketch that brackets a quantile.
ACCURACY = 10_000


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                      accuracy: int = ACCURACY) -> DataFrame:
    """Linear-interpolation quantiles: ``keys`` plus ``n`` and ``q`` (array in the order of ``probs``).

    A mergeable sketch first brackets every quantile; then only the rows inside the brackets are ranked, all other
    rows are counted. A hot group is therefore reduced to about ``4 / accuracy`` of its rows before any per-group
    sort, after equal values were merged. ``df`` is read three times, so it is a table or a stage.
    """
    keys, probs = list(keys), list(probs)
    eps = 2.0 / accuracy
    lows = [max(0.0, p - eps) for p in probs]
    highs = [min(1.0, p + eps) for p in probs]
    # dealt by the number of rows: a task's hash table would grow with the files it reads
    merged = scatter(df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v")), *keys, "_v", each=1).groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    sketch = (df.filter(F.col(value).isNotNull()).groupBy(*keys)
              .agg(F.count("*").alias("n"), F.min(value).alias("_min"), F.max(value).alias("_max"),
                   F.percentile_approx(value, lows, accuracy).alias("_lo"),
                   F.percentile_approx(value, highs, accuracy).alias("_hi")))
    # below this size a sketch step is wider than one rank: bracket everything
    tiny = F.col("n") < 10 * accuracy
    brackets = sketch.select(*keys, "n", F.explode(F.array(*[
        F.struct(F.lit(t).alias("_t"), F.lit(float(p)).alias("_p"),
                 F.when(tiny, F.col("_min")).otherwise(F.col("_lo")[t]).alias("_a"),
                 F.when(tiny, F.col("_max")).otherwise(F.col("_hi")[t]).alias("_b"))
        for t, p in enumerate(probs)])).alias("_q")).select(*keys, "n", "_q.*")
    per_group = brackets.groupBy(*keys).agg(F.first("n").alias("n"), F.collect_list(F.struct("_t", "_p", "_a", "_b")).alias("_qs"))
    rows = attach(merged, per_group, on=keys, salt_by=["_v"])
    tagged = rows.select(*keys, "n", "_v", "_c", F.explode("_qs").alias("_q")).select(*keys, "n", "_v", "_c", "_q.*")
    # everything below a bracket collapses to one row (NULL, sorted first) that only carries its count
    value_or_below = F.when(F.col("_v") >= F.col("_a"), F.col("_v"))
    kept = (tagged.filter(F.col("_v") <= F.col("_b")).groupBy(*keys, "n", "_t", "_p", value_or_below.alias("_v")).agg(F.sum("_c").alias("_c")))
    order = W.partitionBy(*keys, "_t").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
    ranked = kept.withColumn("_upto", F.sum("_c").over(order)).filter("_v IS NOT NULL")
    last, first = F.col("_upto"), F.col("_upto") - F.col("_c")
    pos = (F.col("n") - 1) * F.col("_p")
    hit_low = (first <= F.floor(pos)) & (F.floor(pos) < last)
    hit_high = (first <= F.ceil(pos)) & (F.ceil(pos) < last)
    picked = (ranked.filter(hit_low | hit_high).groupBy(*keys, "_t")
              .agg(F.first("n").alias("n"), F.first("_p").alias("_p"), F.min("_v").alias("_x"), F.max("_v").alias("_y")))
    frac = (F.col("n") - 1) * F.col("_p") - F.floor((F.col("n") - 1) * F.col("_p"))
    point = picked.withColumn("_z", F.col("_x") + (F.col("_y") - F.col("_x")) * frac)
    return (point.groupBy(*keys).agg(F.first("n").alias("n"),
                                     F.array_sort(F.collect_list(F.struct("_t", "_z"))).alias("_zs"))
            .select(*keys, "n", F.transform("_zs", lambda z: z["_z"]).alias("q")))
