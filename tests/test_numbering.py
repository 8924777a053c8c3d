"""Numbering under hot keys, voices, stanzas, attribution and the stream of latest rows, by small cases."""

import random

from pyspark.sql import functions as F

from lectern.functions import records as R
from lectern.operators import match, rows, sequence
from lectern.streaming import latest


def test_numbered_spreads_a_hot_key(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # or so few rows are one partition
    try:
        spread_hot_key(spark)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def spread_hot_key(spark):
    rng = random.Random(3)
    given = [(rng.choice(["hot", "hot", "hot", None, "a", "b"]), i) for i in rng.sample(range(100_000), 5_000)]
    df = spark.createDataFrame(given, "k string, i long").repartition(7)
    for descending in (False, True):
        order = F.col("i").desc() if descending else F.col("i")
        got = {(r["k"], r["i"]): r["n"] for r in rows.numbered(df, ["k"], order).collect()}
        want = {}
        for k in {k for k, _ in given}:
            for n, i in enumerate(sorted((i for key, i in given if key == k), reverse=descending), 1):
                want[k, i] = n
        assert got == want
    dealt = df.repartitionByRange(F.asc_nulls_first("k"), F.col("i")).withColumn("p", F.spark_partition_id())
    assert dealt.where("k = 'hot'").select("p").distinct().count() > 2


def test_numbered_ties_and_empty(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, i long")
    assert sorted(r["n"] for r in rows.numbered(df, ["k"], F.col("i")).collect()) == [1, 2, 3]
    assert rows.numbered(df.limit(0), ["k"], F.col("i")).count() == 0


def test_first_and_rest(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "k string, i int")
    got = sorted(map(tuple, rows.first_and_rest(df, ["k"], 2, F.col("i")).select("k", "i", "more").collect()))
    assert got == [("a", 0, 3), ("a", 1, 3), ("b", 1, 0)]


def test_voice_groups(spark):
    given = [(1, "x"), (2, None), (3, "y"), (4, None), (5, "x"), (6, None), (7, None)]
    df = spark.createDataFrame([(u, i, v) for u in (1, 2) for i, v in given], "u int, i int, v string")
    out = sequence.voice_groups(df, "u", ["i"], F.col("v"), F.when(F.col("u") == 2, F.lit("y")))
    assert sorted(map(tuple, out.select("u", "i", "group").collect())) == [(1, 2, 1), (1, 6, 2), (1, 7, 2), (2, 4, 1)]


def test_stanzas(spark):
    body = "Verse 1\nfirst\nsecond\r\n\r\nChorus\nall\n \n\n\n\nVerse 2"
    got = spark.createDataFrame([(body,), ("",), (None,)], "b string").select(R.stanzas(F.col("b")).alias("s")).collect()
    assert [(s["label"], s["lines"]) for s in got[0]["s"]] == [("Verse 1", ["first", "second"]), ("Chorus", ["all"]), ("Verse 2", [])]
    assert got[1]["s"] == [] and got[2]["s"] is None


def test_attributions(spark):
    registry = spark.createDataFrame([("s", "Source", "http://s", True), ("t", "Other", "", False)], "key string, name string, url string, required boolean")
    given = [(1, "One", {"tune": "t", "text": "s"}, True), (2, "Two", {"text": "s", "tune": "gone"}, False), (3, "Three", None, False)]
    df = spark.createDataFrame(given, "id int, title string, sources map<string,string>, public boolean")
    out = match.attributions(df, "id", "title", "sources", "public", registry, "key", "name", "url", "required", {"text": "Text", "tune": "Tune"})
    one, two, three = out.orderBy("id").collect()
    assert one["rendered"] == "One — sources & attribution\n\nText: Source — http://s (attribution required)\nTune: Other\n\nLicense: Public domain.\n" and one["error"] is None
    assert two["rendered"] is None and two["error"] == "unknown source gone for tune"
    assert three["rendered"] == "Three — sources & attribution\n\n\nLicense: own terms.\n"


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    source, folder = f"{tmp_path}/source", f"{tmp_path}/out"

    def arrive(given):
        spark.createDataFrame(given, "k int, at int, v string").write.mode("append").parquet(source)
        stream = spark.readStream.schema("k int, at int, v string").parquet(source)
        latest.log_changes(stream, "k", F.col("at"), ["v"], folder).trigger(availableNow=True).start().awaitTermination()
        log = spark.read.schema("k int, v string, batch long").parquet(f"{folder}/log")
        return sorted(map(tuple, latest.current(log, "k", ["v"]).collect())), {r["k"] for r in log.where(f"batch = {log.agg(F.max('batch')).first()[0]}").collect()}

    assert arrive([(1, 1, "a"), (2, 1, "b"), (1, 2, "c")]) == ([(1, "c"), (2, "b")], {1, 2})
    # a late row changes nothing, a new one its key alone
    state, touched = arrive([(2, 5, "d"), (2, 0, "z")])
    assert state == [(1, "c"), (2, "d")] and touched == {2}
