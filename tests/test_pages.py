"""Page functions on small markup, and the extraction job by hand."""

from pyspark.sql import functions as F

from lectern.functions import pages as P
from lectern.functions import records as R
from lectern.functions import text as X
from lectern.plans import extraction
from lectern.plans.registry import QUERIES, Tables

SF = "/root/testdata/sf0.001"
PAGE = '<p>1 One<br>two</p><p class="chorus">Glo<b>ry</b><br/>be</p><p>Chorus:</p><p> </p><p>Refrain<br>Other</p><p>2 Three</p>'


def test_paragraphs(spark):
    df = spark.createDataFrame([(PAGE,), ("<p class='x'>a</p>",), ("",), (None,)], "h string").select(P.paragraphs(F.col("h")).alias("p"))
    got = df.select(P.verses(F.col("p")).alias("v"), P.chorus(F.col("p")).alias("c"), R.stanza_text(P.verses(F.col("p")), P.chorus(F.col("p"))).alias("t")).collect()
    assert got[0]["v"] == ["One\ntwo", "Three"] and got[0]["c"] == "Glory\nbe"
    assert got[0]["t"] == "Verse 1\nOne\ntwo\n\nChorus\nGlory\nbe\n\nVerse 2\nThree"
    assert got[1]["v"] == ["a"] and got[1]["c"] is None and got[1]["t"] == "Verse 1\na" and got[2]["t"] == "" and got[3]["t"] is None


def test_credits_and_alternate(spark):
    page = '<link rel="alternate" href="/en/x.htm" hreflang="en"><a class="xlat-en" href="/bio/t">Tr. Ans</a>, <a href="/bio/a">Au <b>Thor</b></a>'
    r = spark.createDataFrame([(page,)], "h string").select(P.credits(F.col("h")).alias("c"), P.alternate(F.col("h"), "en").alias("e"), P.alternate(F.col("h"), "fr").alias("f")).first()
    assert (r["c"]["author"], r["c"]["translator"], r["e"], r["f"]) == ("Au Thor", "Tr. Ans", "/en/x.htm", None)


def test_extraction_job(spark):
    got = {r["page_id"]: r for r in QUERIES["extraction_job"](spark, SF).collect()}
    pages = Tables(spark, SF).pages.count()
    assert len(got) == pages and all((r["body"] is not None) == (r["outcome"] == "accepted") for r in got.values())
    stanzas = {r["page_id"]: r["body"] for r in QUERIES["page_stanzas"](spark, SF).collect()}
    keyed = spark.createDataFrame([(k, r["title"], stanzas[k]) for k, r in got.items()], "i long, t string, b string")
    keyed = keyed.select("i", X.key_unicode(F.col("t")).alias("a"), X.key_unicode(X.first_line(F.col("b"))).alias("b")).orderBy("i").collect()
    had = Tables(spark, SF).documents.select(X.key_unicode(F.split_part("text", F.lit("\n"), F.lit(1))).alias("k"))
    seen = {r["k"] for r in had.collect()} - {None, ""}
    for r in keyed:
        if got[r["i"]]["outcome"] in ("accepted", "duplicate"):
            keys = {r["a"], r["b"]} - {None, ""}
            assert (got[r["i"]]["outcome"] == "accepted") == (not keys & seen)
            if got[r["i"]]["outcome"] == "accepted":
                seen |= keys


def test_extraction_outcomes_and_records(spark):
    def page(title, first, credit="", more=""):
        return f"<html lang='fr'><html lang=\"French\"><head><title>{title}</title>{more}</head><body><article><p>{first}<br>two</p></article><p id=\"credits\">{credit}</p></body></html>"

    tr = '<span lang="en">Old Song</span> <a href="/bio/a">Au Thor (1700-1750)</a> 1740, <a class="xlat-en" href="/bio/t">Tr Ans</a>, {}'
    rows = [
        page("A", "one", more="<p>Copyright 1990</p>"), page("B", "two b", more="<p class=\"public-domain\">&copy; 1990</p>"), page("C", "three", tr.format(1931)),
        page("C", "four", tr.format(1930)), page("C", "five", tr.format(1950)), page("D", "six", '<a href="/bio/x">X Y</a>', '<link rel="alternate" href="/htm/o.htm" hreflang="en">'),
        page("", "seven"), "<html><title>E</title><p>x</p>", page("F", ""), page("G", "eight", more="<!-- &copy; 1990 -->"),
    ]
    rows[8] = rows[8].replace("<br>two", "")
    pages = spark.createDataFrame([(i, "u", h) for i, h in enumerate(rows)], "page_id long, url string, html string")
    catalogue = spark.createDataFrame([("Old song", 1700, "joy", "Eb", 90, "3/4"), ("Other", 1600, "x", "C", 60, None)], "title string, year int, themes string, key string, bpm int, meter string")
    index = spark.createDataFrame([("o.htm", "OTHER")], "page string, english string")
    got = {r["page_id"]: r for r in extraction.extracted(pages, catalogue, index).collect()}
    assert [got[i]["outcome"] for i in range(10)] == ["notice", "accepted", "year", "accepted", "duplicate", "accepted", "no title", "no corpus", "no stanzas", "accepted"]
    fields = ("writer", "year", "parent", "relation", "themes", "key", "bpm", "meter")
    assert tuple(got[3][c] for c in fields) == ("Au Thor · tr. Tr Ans", 1930, "Old song", "French translation · tr. Tr Ans, 1930", "joy", "Eb", 90, "3/4")
    assert tuple(got[5][c] for c in fields) == ("X Y", 1600, "Other", "French original · X Y", "x", "C", 60, None)
    assert (got[1]["writer"], got[1]["parent"], got[2]["writer"]) == ("Anonymous", None, None)
    # What the catalogue has, by title or first line, counts as seen, for pages behind the year limit too.
    seen = spark.createDataFrame([("b", "x"), ("y", "SIX"), ("c", None)], "title string, first string")
    got = {r["page_id"]: r["outcome"] for r in extraction.extracted(pages, catalogue, index, seen).collect()}
    assert [got[i] for i in range(10)] == ["notice", "duplicate", "duplicate", "duplicate", "duplicate", "duplicate", "no title", "no corpus", "no stanzas", "accepted"]
