"""Readers of landed files: folder trees, object maps, paged listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def folder_documents(spark: SparkSession, root: str, name: str, sections: list[str] | None = None) -> DataFrame:
    """(language, section, folder, path, text) of each file ``name`` at root/language/section/folder."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", name).text(root, wholetext=True).withColumn("path", F.input_file_name())
    parts = F.split("path", "/")
    out = files.select(F.element_at(parts, -4).alias("language"), F.element_at(parts, -3).alias("section"), F.element_at(parts, -2).alias("folder"), "path", F.col("value").alias("text"))
    return out if sections is None else out.where(F.col("section").isin(sections))


def file_facts(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, length, modificationTime), contents unread."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length", "modificationTime")


def object_rows(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON object used as a map: (key, value) rows."""
    return df.select(F.explode(F.from_json(column, f"map<string,{schema}>")).alias("key", "value"))


def listing_rows(df: DataFrame, column: str) -> DataFrame:
    """A JSON array of arrays whose first row is the header: (position, cells)."""
    return df.select(F.posexplode(F.from_json(column, "array<array<string>>")).alias("position", "cells")).where("position > 0")


def json_rows(df: DataFrame, column: str, schema: str) -> DataFrame:
    """df with value (the parsed object) and unreadable (true for broken documents, whose value is null)."""
    parsed = F.from_json(column, f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    out = df.withColumn("_v", parsed)
    broken = F.col("_v._broken").isNotNull() | F.col("_v").isNull()
    return out.withColumn("unreadable", broken).withColumn("value", F.when(~broken, F.col("_v"))).drop("_v")


def quoted_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Quoted CSV with doubled quotes and line ends inside quotes; rows with too few fields are dropped."""
    reader = spark.read.schema(f"{schema}, _short string").option("header", "true").option("quote", '"').option("escape", '"').option("multiLine", "true")
    return reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_short").csv(path).where("_short is null").drop("_short")
