"""Greedy deduplication by two keys, exact and without a driver loop over rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.family import cut


def greedy_two_keys(df: DataFrame, order: str, first: str, second: str, taken: DataFrame | None = None) -> DataFrame:
    """df with accepted: false if either key was seen in taken (column key) or in an earlier accepted row.

    The order column is unique. Null keys match nothing. Each round accepts the
    undecided rows that come first for both of their keys, then rejects the rows
    that share a key with an accepted one; the result is that of one scan in
    order. Rounds grow with the longest chain of rows that wait for one another
    (short in practice), and every round touches undecided rows only.
    """
    open_rows = df.select(F.col(order).alias("o"), F.col(first).alias("a"), F.col(second).alias("b"))
    if taken is not None:
        seen = taken.select("key").where("key is not null").distinct()
        for side in ("a", "b"):
            open_rows = open_rows.join(seen.withColumnRenamed("key", side), side, "left_anti").select("o", "a", "b")
    open_rows = cut(open_rows)
    accepted = open_rows.select("o").limit(0)
    while not open_rows.isEmpty():
        # a key's first row; both columns hold keys of one kind, so they are ranked together
        keys = open_rows.select("o", F.explode(F.array("a", "b")).alias("key")).where("key is not null")
        firsts = keys.groupBy("key").agg(F.min("o").alias("m"))
        held = open_rows
        for side in ("a", "b"):
            held = held.join(firsts.select(F.col("key").alias(side), F.col("m").alias(f"m_{side}")), side, "left")
        leads = (F.coalesce("m_a", "o") == F.col("o")) & (F.coalesce("m_b", "o") == F.col("o"))
        held = cut(held.select("o", "a", "b", leads.alias("lead")))
        now = held.where("lead")
        accepted = accepted.unionByName(now.select("o"))
        gone = now.select(F.explode(F.array("a", "b")).alias("key")).where("key is not null").distinct()
        rest = held.where("not lead").select("o", "a", "b")
        for side in ("a", "b"):
            rest = rest.join(gone.withColumnRenamed("key", side), side, "left_anti").select("o", "a", "b")
        open_rows = cut(rest)
    marks = cut(accepted).select(F.col("o").alias(order), F.lit(True).alias("_ok"))
    return df.join(marks, order, "left").select(*df.columns, F.coalesce("_ok", F.lit(False)).alias("accepted"))
