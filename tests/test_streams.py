"""Documents against streams: each row on its own, rows with equal ids together."""

from pyspark.sql import functions as F

from lectern.operators import align
from lectern.plans import alignment
from lectern.plans.registry import QUERIES, Tables

TEXTS = [
    (1, "One two three. Four five\nsix seven eight nine ten eleven. A"), (2, "Zwölf Boxkämpfer jagen Viktor. . \n\nEva quer über den großen Sylter Deich!"),
    (3, "first. second half"), (3, "third one. fourth. fifth"), (None, "no id here. at all"), (None, "nor here"), (4, None), (5, ""), (6, "... \n"), (7, "a. b. c. d. e. f. g"),
]


def _documents(spark, path, rows):
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{path}/documents.parquet")
    return Tables(spark, str(path))


def test_sentences_of_a_row_stay_with_it(spark, tmp_path):
    t = _documents(spark, tmp_path / "a", TEXTS)
    plain = alignment._sentences(t).groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("n", "words", "heard"))).alias("s"))
    listed = lambda df: sorted(((r["doc_id"], [tuple(x) for x in r["s"]]) for r in df.collect()), key=str)
    assert listed(alignment._said_of_documents(t)) == listed(plain)
    assert len(QUERIES["stream_alignment"](spark, str(tmp_path / "a")).collect()) == 5
    # Without equal ids no text is written or dealt out, and no sentence worked out twice.
    _documents(spark, tmp_path / "b", [r for r in TEXTS if r[0] not in (None, 3)])
    found = QUERIES["stream_alignment"](spark, str(tmp_path / "b"))
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString() and "ExistingRDD" not in found._jdf.queryExecution().executedPlan().toString()
    assert found._jdf.queryExecution().optimizedPlan().toString().count("[.\n]+") == 1


def test_slices_of_a_batch(spark, monkeypatch):
    t = Tables(spark, "/root/testdata/sf0.001")
    whole = {r["doc_id"]: r for r in align.aligned_streams(alignment._streams(t), "lines", "streams").collect()}
    table = alignment._streams(t).select("doc_id", "lines", F.map_entries("streams").alias("streams")).toArrow().combine_chunks()
    monkeypatch.setattr(align, "HELD", 20_000)
    held = []
    streamed = align._streamed
    monkeypatch.setattr(align, "_streamed", lambda a, b: held.append(len(a)) or streamed(a, b))
    found = align._in_slices(table["lines"].chunk(0), table["streams"].chunk(0)).to_pylist()
    assert len(held) > 3 and sum(held) == len(whole)
    for doc, r in zip(table["doc_id"].to_pylist(), found, strict=True):
        w = whole[doc]
        assert (r["accepted"], r["failed_line"], r["cost"], [tuple(p.values()) for p in r["placed"]]) == (w["accepted"], w["failed_line"], w["cost"], [tuple(p) for p in w["placed"]])
