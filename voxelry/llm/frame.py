"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Prefix of helper columns.
OWN = "_llm_"
#: Rows of an Arrow batch that are turned into Python strings at once.
ROWS = 256


def refuse(df: DataFrame, *results: str) -> None:
    """Fail early if a column of the input would clash with a helper or a result column (names compare as Spark's do)."""
    taken = [c for c in df.columns if c.lower().startswith(OWN) or c.lower() in {r.lower() for r in results}]
    if taken:
        raise ValueError(f"the operator defines {taken}; rename these input columns first")


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only the given columns, under their own names."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def text_rows(batches: Iterator[pa.Array], rows: int = ROWS) -> Iterator[tuple[int, list[str | None]]]:
    """Small lists of texts, each with the number of the Arrow batch it is from."""
    for k, batch in enumerate(batches):
        for at in range(0, len(batch), rows):
            yield k, batch.slice(at, rows).to_pylist()


def per_text(make: Callable[[], Callable[[list[str | None]], Sequence[dict | tuple]]], ddl: str,
             schema: pa.DataType) -> Callable[[Column | str], Column]:
    """A column function over texts: ``make`` runs once in a task and returns what turns a list of texts into rows of ``schema``.

    Only the text column travels to Python, in Arrow batches whose bytes Spark bounds; lists of 256 texts are worked on at
    a time. The result is marked as non-deterministic, so that no filter pulls a second evaluation below a projection.
    """
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            out: list = []
            for at in range(0, len(batch), ROWS):
                out.extend(work(batch.slice(at, ROWS).to_pylist()))
            yield pa.array(out, schema)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, ddl).asNondeterministic()


def crc_part(column: str, parts: int) -> Column:
    """``crc32`` of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(F.col(f"`{column}`").cast("string")) % parts
