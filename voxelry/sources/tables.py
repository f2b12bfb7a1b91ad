"""Result tables: append, write, read back."""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schema import SUBJECT
from ..session import small_files, staged

#: Characters of files whose rows a task sends on together.
TOGETHER = 1 << 22


def dated(rows: DataFrame, date: str | None = None) -> DataFrame:
    """Rows with the day they are appended on."""
    day: Column = F.current_date() if date is None else F.to_date(F.lit(date))
    return rows.withColumn("append_date", day)


def append_with_date(rows: DataFrame, path: str, date: str | None = None) -> None:
    """Append to a stored table; each job adds its own files, so concurrent appends lose nothing."""
    dated(rows, date).write.mode("append").parquet(path)


def appended(stored: DataFrame, rows: DataFrame, date: str | None = None) -> DataFrame:
    """The table after an append, missing columns filled with NULL."""
    return stored.unionByName(dated(rows, date), allowMissingColumns=True)


def with_decimals(df: DataFrame, digits: int = 2) -> DataFrame:
    """Fractions as text with a fixed number of decimals, for the CSV edge only."""
    def shown(name: str, kind: str) -> Column:
        cell = F.col(f"`{name}`")
        if kind not in ("double", "float"):
            return cell
        return F.when(cell.isNotNull(), F.format_string(f"%.{digits}f", F.bround(cell, digits))).alias(name)

    return df.select(*[shown(c, t) for c, t in df.dtypes])


def write_results(df: DataFrame, path: str, form: str = "parquet", partition: str | None = None, digits: int | None = None) -> None:
    """Write a result table as parquet, csv or json, optionally one folder per value of ``partition``."""
    out = df if digits is None else with_decimals(df, digits)
    writer = out.write.mode("overwrite")
    if partition:
        writer = writer.partitionBy(partition)
    writer.option("header", "true").format(form).save(path)


def csv_rows(text: str) -> Iterator[tuple[list[str], list[str | None]]]:
    """Header and cells of every line of a file; quoted cells may hold commas, quotes and line ends. Blank lines are no rows, empty cells are
    None, cells beyond the header are left out, missing ones are None. Of columns whose names differ by case only, the first counts."""
    csv.field_size_limit(sys.maxsize)
    lines = (cells for cells in csv.reader(io.StringIO(text.removeprefix("\ufeff"), newline="")) if cells)
    head = [name.strip() for name in next(lines, [])]
    known = [name.lower() for name in head]
    places = [n for n, name in enumerate(known) if name and known.index(name) == n]
    names = [head[n] for n in places]
    for cells in lines:
        yield names, [cells[n] or None if n < len(cells) else None for n in places]


def read_subject_csvs(spark: SparkSession, glob: str, pattern: str = r"/([^/]+)/[^/]+\.csv$") -> DataFrame:
    """One table from one CSV per participant, tagged with the participant from the path.

    Files may have different columns, whose names are compared without regard to case (of several spellings the first in byte order stays); a
    column that a file lacks, or an empty cell, is NULL. The
    files are read once, by the tasks, and their rows staged with the header they belong to; only the distinct names of columns come to the
    driver. Columns are in the order of their first place in a header; one that is named like the tag gets ``_in_file`` at its end.
    """
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], 0
            for subject, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                found += [(subject, *row) for row in csv_rows(text)]
                held += len(text)
                if held >= TOGETHER:
                    yield as_batch(found)
                    found, held = [], 0
            if found:
                yield as_batch(found)

    def as_batch(found: list[tuple[str, list[str], list[str | None]]]) -> pa.RecordBatch:
        texts = pa.list_(pa.string())
        return pa.RecordBatch.from_arrays([pa.array([row[n] for row in found], kind) for n, kind in enumerate((pa.string(), texts, texts))],
                                          names=[SUBJECT, "names", "cells"])

    with small_files(spark):
        files = spark.read.text(glob, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_path"), pattern, 1).alias(SUBJECT), "value")
        rows = staged(files.mapInArrow(parsed, f"`{SUBJECT}` string, names array<string>, cells array<string>"), "subject-csvs")
    heads = rows.select("names").distinct().select(F.posexplode("names").alias("place", "name"))
    columns = (heads.groupBy(F.lower("name").alias("key")).agg(F.min("place").alias("place"), F.min("name").alias("name"))
               .orderBy("place", "key").collect())
    keys = F.transform("names", F.lower)
    return rows.select(SUBJECT, *[F.get("cells", F.array_position(keys, c.key).cast("int") - 1).alias(f"{c.name}_in_file" if c.key == SUBJECT else c.name) for c in columns])


def read_segmentation_tables(spark: SparkSession, volumes_glob: str, qc_glob: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Volume and quality tables that a segmentation tool left per participant."""
    return read_subject_csvs(spark, volumes_glob), None if qc_glob is None else read_subject_csvs(spark, qc_glob)
