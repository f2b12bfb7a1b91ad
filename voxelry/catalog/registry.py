"""Registry of the queries and their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, text: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``text`` is the SQL that has to give the same rows."""
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if text is not None:
            ORACLES[name] = text
        return fn
    return add


def r6(column: Column | str, name: str) -> Column:
    return F.round(column, 6).alias(name)


def affine_columns(name: str = "affine") -> list[Column]:
    """The twelve upper entries of an affine as ``a00`` … ``a23``."""
    return [F.round(F.col(name)[4 * r + c], 6).alias(f"a{r}{c}") for r in range(3) for c in range(4)]


def affine_sql(name: str = "affine") -> str:
    return ", ".join(f"round({name}[{4 * r + c + 1}], 6) AS a{r}{c}" for r in range(3) for c in range(4))
