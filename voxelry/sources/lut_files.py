"""Region lookup tables in the formats imaging tools write."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Numbered, trimmed lines of one small file."""
    whole = spark.read.option("wholetext", "true").text(path)
    return whole.select(F.posexplode(F.split("value", r"\r?\n")).alias("pos", "line")).withColumn("line", F.trim("line"))


def _finish(rows: DataFrame) -> DataFrame:
    """(label, region), the last entry of a name wins."""
    return rows.groupBy("region").agg(F.max_by("label", "pos").alias("label")).select("label", "region")


def read_lut(spark: SparkSession, path: str) -> DataFrame:
    """Lookup table as (label, region): .json, .tsv (BIDS), .lut and .xml (FSL), .txt (FreeSurfer)."""
    kind = os.path.splitext(path)[-1]
    readers = {".json": _json, ".tsv": _tsv, ".lut": _lut, ".txt": _txt, ".xml": _xml}
    if kind not in readers:
        raise ValueError(f"unknown lookup table format {kind!r}")
    return _finish(readers[kind](spark, path))


def _is_number(c: Column) -> Column:
    return c.rlike(r"^-?\d+$")


def _json(spark: SparkSession, path: str) -> DataFrame:
    """Names to numbers, or numbers (as JSON keys) to names."""
    whole = spark.read.option("wholetext", "true").text(path)
    pairs = whole.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,string>"))).alias("pos", "e"))
    key, value = F.col("e.key"), F.col("e.value")
    good = _is_number(value) | _is_number(key)
    if pairs.filter(~good).limit(1).count():
        raise ValueError("a lookup table pairs names with whole numbers")
    return pairs.select("pos", F.when(_is_number(value), value).otherwise(key).cast("int").alias("label"),
                        F.when(_is_number(value), key).otherwise(value).alias("region"))


def _tsv(spark: SparkSession, path: str) -> DataFrame:
    rows = _lines(spark, path).filter("line <> ''").withColumn("_c", F.split("line", "\t+"))
    header = rows.orderBy("pos").first()["_c"]
    name = header.index("abbreviation" if "abbreviation" in header else "name")
    return rows.filter(F.col("line") != "\t".join(header)).filter(_is_number(F.trim(F.col("_c")[header.index("index")]))).select(
        "pos", F.trim(F.col("_c")[header.index("index")]).cast("int").alias("label"), F.col("_c")[name].alias("region"))


def _words(spark: SparkSession, path: str) -> DataFrame:
    rows = _lines(spark, path).withColumn("_w", F.split("line", " +"))
    return rows.filter(F.col("_w")[0].rlike(r"^\d+$"))


def _lut(spark: SparkSession, path: str) -> DataFrame:
    """Number, three colours, and the rest of the line as the name."""
    name = F.array_join(F.slice("_w", F.lit(5), F.size("_w")), " ")
    return _words(spark, path).select("pos", F.col("_w")[0].cast("int").alias("label"), name.alias("region"))


def _txt(spark: SparkSession, path: str) -> DataFrame:
    return _words(spark, path).select("pos", F.col("_w")[0].cast("int").alias("label"), F.col("_w")[1].alias("region"))


def _xml(spark: SparkSession, path: str) -> DataFrame:
    schema = "_index int, _VALUE string"
    rows = spark.read.format("xml").option("rowTag", "label").schema(schema).load(path)
    return rows.select(F.monotonically_increasing_id().alias("pos"), F.col("_index").alias("label"), F.col("_VALUE").alias("region"))
