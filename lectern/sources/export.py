"""Ordered exports: files that, put one behind the other in the order of their names, are the sorted table."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.rows import numbered


def folder(spark: SparkSession, name: str) -> str:
    """A folder for what is landed or exported on the way: in spark.checkpoint.dir; where that is unset, one of our own if all runs on this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{(shared or tempfile.mkdtemp(prefix='spark-lectern-')).rstrip('/')}/{name}"


def write_ordered(df: DataFrame, path: str, *order: Column, kind: str = "parquet", files: int | None = None) -> None:
    """Writes df sorted by order, by many tasks: each sorts a range, and files are numbered as the ranges are. files: how many; else as Spark finds fit."""
    df.repartitionByRange(*([files] if files else []), *order).sortWithinPartitions(*order).write.format(kind).save(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """An ordered Parquet export with position, from 1: file by file, row by row."""
    rows = spark.read.parquet(path)
    placed = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return numbered(placed, [], F.col("_file"), F.col("_row"), name="position").select("position", *rows.columns)
