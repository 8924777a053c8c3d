"""Every operator and pipeline stage on rows without ids, equal ids, ties, empty tables and columns whose names clash."""

import brute
import corpus_pipeline
import public_tokenizers as P
import pytest
from lectern.llm import bytebpe, cotrain, decontaminate, divergence, htmlmain, langid, linequality, neardup, phrases, reshard, substring, tokencount

GOOD = " ".join(f"word{i}" for i in range(80))
OTHER = " ".join(f"other{i}" for i in range(70))
ROWS = [(None, GOOD, "en", "a", 1), (1, GOOD, "en", "a", 1), (1, OTHER, None, None, 2), (1, "", "en", "b", 0), (2, None, None, "b", None), (None, None, None, None, None), (3, "½ ² Ⅷ ① 12", "fr", "b", 9), (None, f"{OTHER} end", "en", "a", 5), (4, f"{GOOD} tail", "en", "a", 6), (4, f"{GOOD} tail", "en", "a", 6)]
NAMES = "bad gone h block at cuts doc host same kept digest ids n_tokens repeats label node text_"
#: Rows that an operator must return, one for each of its input.
PER_ROW = {
    "decontamination": lambda d, spark: decontaminate.report(d, spark.createDataFrame([(1, GOOD), (None, OTHER), (None, None)], "item_id long, text string")),
    "language": lambda d, spark: langid.report(d, P.path("piece_bpe_32k.model")),
    "bpe": lambda d, spark: bytebpe.round_trip_report(d, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN),
    "near_duplicates": lambda d, spark: neardup.near_duplicates(d),
    "main_text": lambda d, spark: htmlmain.report(d, page_id="doc_id", url="source", html_column="text"),
    "substring": lambda d, spark: substring.removal_report(d),
    "classifier": lambda d, spark: cotrain.scored(d, spark.createDataFrame([(1, 1, 0), (None, 0, 1), (4, 0, 1), (4, 1, 1)], "doc_id long, quality int, toxic int")),
    "token_counts": lambda d, spark: tokencount.report(d, P.path("byte_bpe_50k.json")),
    "line_quality": lambda d, spark: linequality.judged(d),
}


@pytest.fixture(scope="module")
def frame(spark):
    clash = NAMES.split()
    return spark.createDataFrame([(*r, *range(len(clash))) for r in ROWS], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` int" for c in clash)).repartition(3)


@pytest.fixture(scope="module")
def sf(spark, frame, tmp_path_factory):
    """A folder with the tables that the stages read."""
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame([(1, " ".join(OTHER.split()[:12])), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    frame.write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_for_each(spark, frame, name):
    out = PER_ROW[name](frame, spark)
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r[0]) for r in ROWS)
    assert PER_ROW[name](frame.where("false"), spark).count() == 0


@pytest.mark.parametrize("name", [n for n in PER_ROW if n not in ("near_duplicates", "substring", "classifier", "language")])
def test_a_row_s_result_is_its_text_s(spark, frame, name):
    """Equal texts get equal results, whatever their ids are."""
    out = PER_ROW[name](frame.select("doc_id", "text", "lang", "source").withColumn("source", frame.source), spark)
    rows = [tuple(r) for r in out.drop("source").collect()]
    assert rows.count(next(r for r in rows if r[0] == 4)) == 2


def test_letters_only_make_a_language(spark, frame):
    out = {(r["doc_id"], r["lang_pred"]) for r in PER_ROW["language"](frame, spark).collect()}
    assert (3, "und") in out and (2, "und") in out and (4, "en") in out


def test_substring_of_rows_without_ids(spark, frame):
    """Rows without an id come last, and their common windows go as others do."""
    out = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"]) for r in PER_ROW["substring"](frame, spark).collect())
    assert out == sorted([("1", 80, 0), ("1", 70, 0), ("1", 0, 0), ("2", 0, 0), ("3", 5, 0), ("4", 81, 80), ("4", 81, 80), ("None", 80, 80), ("None", 71, 70), ("None", 0, 0)])


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, frame, sf, stage):
    function = dict(corpus_pipeline.STAGES)[stage]
    out = function(spark, frame, sf)
    if stage != "encoding":
        assert out.columns == frame.columns
    texts = sorted(str(r["text"]) for r in out.collect()) if stage != "encoding" else out.count()
    mine = lambda keep: sorted(str(r[1]) for i, r in enumerate(ROWS) if i in keep)
    expected = {
        "quality": mine({0, 1, 2, 7, 8, 9}),
        "near_duplicates": mine({1, 2, 3, 4, 5, 6}),
        "decontamination": mine({0, 1, 3, 4, 5, 6, 8, 9}),
        "repeated_passages": sorted([GOOD, OTHER, "", "None", "None", ROWS[6][1], "end", "tail", "tail"]),
        "encoding": len(ROWS),
    }
    assert texts == expected[stage]
    assert function(spark, frame.where("false"), sf).count() == 0


def test_pipeline_and_reshard_run_on_them(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() >= 1
    placed = reshard.plan(spark, f"{sf}/documents.parquet").collect()
    assert sorted(str(r["doc_id"]) for r in placed) == sorted(str(r[0]) for r in ROWS)


def test_brute_versions_agree_on_base_figures(spark, frame):
    got = sorted(str(tuple(r)[1:7]) for r in linequality.judged(frame).collect())
    assert got == sorted(str(brute.base_figures(r[1])) for r in ROWS)


def test_reports_that_are_not_by_row(spark, frame):
    """Phrases and divergences of rows without ids, with equal ids and clashing names."""
    assert phrases.collocations(frame, least=3).where("lang = 'en' and phrase = 'word0 word1 word2 word3'").count() == 1
    audited = divergence.audit(frame, least_docs=1)
    assert {(r["lang"], r["source"]) for r in audited.where("part = 'pair'").select("lang", "source").collect()} == {("en", "a"), ("en", "b"), ("", ""), ("", "b")}
