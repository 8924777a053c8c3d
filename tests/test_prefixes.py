"""Joins by prefix against every pair, and how a frequent string is spread."""

import random

from pyspark.sql import functions as F

from lectern.operators import match


def _fits(w, v, least=8):
    if not w or not v:
        return False
    return w == v if len(w) < least else w.startswith(v) or v.startswith(w)


def test_prefix_join_against_every_pair(spark, monkeypatch):
    monkeypatch.setattr(match, "BLOCK", 4)
    rng = random.Random(9)
    long = "".join(rng.choice("abc é") for _ in range(300))
    make = lambda: rng.choice([None, "", long[: rng.choice([1, 7, 8, 9, 31, 63, 64, 65, 66, 200, 300])], "".join(rng.choice("ab") for _ in range(rng.randrange(1, 12))), long[:64] + rng.choice("xyz") * rng.randrange(3)])
    ours, theirs = [(i % 60, make()) for i in range(80)], [(i % 90 if i % 7 else None, make()) for i in range(120)]
    left, right = spark.createDataFrame(ours, "item long, w string"), spark.createDataFrame(theirs, "doc long, n string")
    got = match.prefix_join(left, "w", right, "n")
    assert got.columns == ["item", "w", "doc", "n"]
    want = [(*a, *b) for a in ours for b in theirs if _fits(a[1], b[1])]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want)) and len(want) > 500


def test_rows_of_one_string_are_spread(spark):
    rows = spark.createDataFrame([(i, "a frequent first line") for i in range(1500)], "id long, s string")
    got = match.prefix_join(rows.toDF("item", "w"), "w", rows.toDF("doc", "n"), "n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with larger tables
    try:
        tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sum(tasks) == 1500**2 and max(tasks) < 0.5 * sum(tasks)
