"""Quality control of participants as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.cohort import MIN_COHORT, metric_columns, qc_bounds
from ..schema import SUBJECT
from ..session import cut_lineage


def first_arrivals(arrivals: DataFrame, order: Sequence[str]) -> DataFrame:
    """The first row of each subject ever: what was seen is keyed state of the stream, so a batch costs what arrives in it."""
    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for part in parts:
            both = part if best is None else pd.concat([best, part])
            best = both.sort_values(list(order), kind="stable").head(1)
        if not state.exists:
            state.update((True,))
            yield best

    return arrivals.groupBy(SUBJECT).applyInPandasWithState(run, arrivals.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)


def judge(batch: DataFrame, bounds: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """``batch`` with the sorted list ``failed`` of the measures outside the population's fences or, for peaks of
    normalised images, outside [0, 1]. ``bounds`` has one row per measure."""
    limits = {r.metric: (r.low, r.high) for r in bounds.collect()}
    checks = []
    for m in metrics:
        v = F.col(m).cast("double")
        bad = F.lit(False)
        if m in limits:
            bad = (v < limits[m][0]) | (v > limits[m][1])
        if m.endswith("_norm_peak"):
            bad = bad | (v > 1) | (v < 0)
        checks.append(F.when(F.coalesce(bad, F.lit(False)), F.lit(m)))
    return batch.withColumn("failed", F.array_sort(F.array_compact(F.array(*checks))))


def qc_stream(arrivals: DataFrame, population: DataFrame, store: str, checkpoint: str, order: Sequence[str],
              on_batch: Callable[[int], None] | None = None) -> StreamingQuery:
    """Judge arriving rows against a stored population and append them to ``store``, each subject once.

    A batch is written to its own folder, overwritten if the batch is retried, so a restart neither loses nor repeats
    rows. The fences come from the population alone. The only state is the set of subjects seen so far, kept by key; it needs no watermark, as
    a subject must never be judged twice.
    """
    metrics = [m for m in metric_columns(arrivals) if m not in order]
    known = population.select(SUBJECT, *[m for m in metrics if m in population.columns])
    if known.count() < MIN_COHORT:  # too few to judge by, as in a batch; peaks keep their fixed range
        known = known.limit(0)
    bounds = cut_lineage(qc_bounds(known))

    def run(batch: DataFrame, number: int) -> None:
        judge(batch, bounds, metrics).write.mode("overwrite").parquet(f"{store}/batch_id={number}")
        if on_batch is not None:
            on_batch(number)

    return (first_arrivals(arrivals, order).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
