"""Queries on whole pages: stanzas, links and the extraction job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import pages as P
from lectern.functions import records as R
from lectern.functions import text as X
from lectern.operators import dedupe, family
from lectern.plans import records
from lectern.plans.registry import Tables, query

_ARTICLE = (r"(?is)<article>(.*?)</article>", r"(?is)<body>(.*)</body>")


@query()
def page_stanzas(t: Tables) -> DataFrame:
    found = t.pages.select("page_id", P.paragraphs(R.main_block(F.col("html"), _ARTICLE)).alias("p"))
    return found.select("page_id", F.size("p").alias("n"), R.stanza_text(P.verses(F.col("p")), P.chorus(F.col("p"))).alias("body"))


@query("""with l as (select page_id, regexp_extract_all(html, 'href="(/[^"]*)"', 1) as l from pages) select page_id, case when page_id % 2 = 0 then l[1] else list_filter(l, lambda x: ends_with(x, 'e'))[1] end as link from l""")
def chosen_links(t: Tables) -> DataFrame:
    wish = F.when(F.col("page_id") % 2 == 1, F.lit("e"))
    return t.pages.select("page_id", P.chosen_link(F.col("html"), 'href="(/[^"]*)"', wish).alias("link"))


@query("""select event_id, json_extract(props, '$.k')::bigint as first, event_id as second, 2 as n from events""")
def embedded_fragments(t: Tables) -> DataFrame:
    page = F.concat(F.lit("<script>x="), "props", F.lit(';y={"k": '), F.col("event_id").cast("string"), F.lit("};z={broken</script>"))
    found = t.events.select("event_id", P.fragments(page, r"\{[^{}<]*\}", "k bigint").alias("f"))
    return found.select("event_id", F.get("f", F.lit(0))["k"].alias("first"), F.get("f", F.lit(1))["k"].alias("second"), F.size("f").alias("n"))


_COMMENT = r"(?s)<!--.*?-->"
# What a notice of rights, a mark of free text, a credit and a translator's link look like.
NOTICE_MARK = r"(?i)(©|&copy;)\s*(19|20)[0-9]{2}|copyright\s+(19|20)[0-9]{2}|arrangement\s*(©|&copy;)"
_FREE = r'(?i)class="public-domain"'
_CREDIT = r'(?is)<p id="(?:lyrics|credits|words)">(.*?)</p>'
_TRANSLATED = r'(?is)<a\s[^>]*class="[^"]*xlat-en[^>]*>.*?</a>\s*,?\s*((?:1[5-9]|20)[0-9]{2})?'
#: Fields that an accepted page takes from its parent.
INHERITED = ["themes", "key", "bpm", "meter"]


def _fields(pages: DataFrame) -> DataFrame:
    """What each page says of itself.

    A page is read once: its raw pieces are written narrow, and all that is made of a piece starts from it.
    Spark would work a piece out again at each place that uses it.
    """
    h = family.cut(pages.select("page_id", "url", F.regexp_replace("html", _COMMENT, "").alias("h")))
    shown = F.regexp_replace(F.regexp_replace("h", r"(?is)<script.*?</script>", ""), "<[^>]+>", " ")
    d = h.select(
        "page_id", "url", F.regexp_extract("h", _CREDIT, 1).alias("c"), R.main_block(F.col("h"), _ARTICLE).alias("block"), F.col("h").rlike(_FREE).alias("free"), shown.rlike(NOTICE_MARK).alias("notice"),
        X.page_title(F.col("h")).alias("title"), F.regexp_extract("h", r'(?i)<meta name="keywords" content="([^"]*)"', 1).alias("keywords"),
        F.substring_index(P.alternate(F.col("h"), "en"), "/", -1).alias("alternate"),
        F.coalesce(R.or_null(F.regexp_extract("h", r'(?i)<html[^>]*\blang="([^"]*)"', 1)), F.lit("?")).alias("language"),
        F.regexp_extract("h", r'(?is)<div class="marquee">(.*?)</div>', 1).alias("marquee"),
    )
    d = family.cut(d.withColumn("p", P.paragraphs(F.col("block"))).withColumn("corpus", F.col("block").isNotNull()).drop("block"))
    d = d.withColumn("by", P.credits(F.col("c")))
    named = X.visible(F.split_part("keywords", F.lit(","), F.lit(1)))
    own = X.visible(F.regexp_extract("c", r'(?is)<span lang="[a-z-]+">(.*?)</span>', 1))
    return d.select(
        "page_id", "url", "free", "notice", "title", "corpus", "alternate", "language",
        R.stanza_text(P.verses(F.col("p")), P.chorus(F.col("p"))).alias("body"),
        F.coalesce(R.or_null(R.without_dates(F.col("by.author"))), R.or_null(named)).alias("author"),
        R.or_null(R.without_dates(F.col("by.translator"))).alias("translator"),
        X.year_of(X.visible(F.col("c"))).alias("author_year"),
        R.or_null(F.regexp_extract("c", _TRANSLATED, 1)).cast("int").alias("translated_year"),
        R.or_null(own).alias("original"),
        F.col("c").rlike(r'(?i)class="xlat-unk"').alias("unknown"),
        R.or_null(F.trim(F.split_part(X.visible(F.col("marquee")), F.lit("@"), F.lit(2)))).alias("scripture"),
    )


def _key(c: str):
    return R.or_null(X.key_unicode(F.col(c)))


def extracted(pages: DataFrame, catalogue: DataFrame, index: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """One outcome for every page, the first test that fails in order, and the record of the accepted ones.

    catalogue: (title, year and the INHERITED fields), one row a title key. index: (page, english), titles of the
    English pages by file name. A page after the year limit keeps its keys free for later ones. seen: (title, first), what
    the catalogue already has; pages with one of these as title or first line are duplicates.
    """
    d = family.cut(_fields(pages)).withColumn("first", X.first_line(F.col("body"))).withColumn("own_year", F.coalesce("translated_year", "author_year"))
    tests = F.when(F.coalesce("notice", F.lit(False)) & ~F.col("free"), "notice").when(F.coalesce(F.col("title") == "", F.lit(True)), "no title")
    d = d.withColumn("failed", tests.when(~F.col("corpus"), "no corpus").when(F.coalesce(F.col("body") == "", F.lit(True)), "no stanzas"))
    d = d.withColumn("late", F.coalesce(F.col("own_year") > 1930, F.lit(False)) & ~F.col("free"))
    keyed = family.cut(d.where("failed is null").select("page_id", _key("title").alias("a"), _key("first").alias("b"), "late"))
    had = None if seen is None else seen.select(F.explode(F.array(_key("title"), _key("first"))).alias("key")).where("key is not null").distinct()
    marks = family.cut(dedupe.greedy_two_keys(keyed.where("not late"), "page_id", "a", "b", had).select("page_id", "a", "b", "accepted"))
    taken = marks.where("accepted").select("page_id", F.explode(F.array("a", "b")).alias("k")).where("k is not null").groupBy("k").agg(F.min("page_id").alias("m"))
    if had is not None:
        taken = taken.unionByName(had.select(F.col("key").alias("k"), F.lit(-(1 << 63)).alias("m"))).groupBy("k").agg(F.min("m").alias("m"))
    late = keyed.where("late").select("page_id", F.explode(F.array("a", "b")).alias("k")).join(taken, "k").where("m < page_id").select("page_id").distinct()
    out = d.join(marks.select("page_id", "accepted"), "page_id", "left").join(late.withColumn("seen", F.lit(True)), "page_id", "left")
    outcome = F.coalesce("failed", F.when(F.col("accepted"), "accepted").when(F.col("late") & F.col("seen").isNull(), "year").otherwise("duplicate"))
    out = out.withColumn("outcome", outcome)

    known = catalogue.select(_key("title").alias("k"), F.struct(F.col("title").alias("parent"), F.col("year").alias("parent_year"), *INHERITED).alias("found"))
    out = out.withColumn("k1", _key("original")).join(known.select(F.col("k").alias("k1"), F.col("found").alias("f1")), "k1", "left")
    english = index.select(F.col("page").alias("alternate"), _key("english").alias("k2"))
    out = out.join(english, "alternate", "left").join(known.select(F.col("k").alias("k2"), F.col("found").alias("f2")), "k2", "left")
    out = out.withColumn("f", F.coalesce("f1", "f2"))

    yes = F.col("outcome") == "accepted"
    translation = F.col("translator").isNotNull() | F.col("original").isNotNull() | F.col("unknown")
    name, year = F.when(translation, F.col("translator")).otherwise(F.col("author")), F.when(translation, F.col("translated_year")).otherwise(F.col("author_year"))
    relation = R.relation_label(F.col("f").isNotNull(), F.col("language"), translation, name, year)
    record = {
        "body": F.col("body"), "writer": X.credit(F.col("author"), F.col("translator"), "Anonymous"), "year": F.coalesce("own_year", "f.parent_year"),
        "parent": F.col("f.parent"), "relation": relation, "scripture": F.col("scripture"), **{c: F.col(f"f.{c}") for c in INHERITED},
    }
    return out.select("page_id", X.slug(F.col("title")).alias("slug"), "title", *(F.when(yes, v).alias(c) for c, v in record.items()), "outcome")


#: A credit block made of what a page says of itself: its title as the author, the end of its address as the translator of every other page.
_BLOCK = """'<a href="/bio/' || page_id || '">' || trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)) || ' <b>' || page_id || '</b></a> (' || (1500 + page_id % 500) || '), '
    || case when page_id % 2 = 0 then '<a class="xlat-en" href="/bio/t">' || regexp_extract(url, '([^/]*)$', 1) || '</a>, ' || (1500 + page_id % 540) else '<a href="/tune/x">tune</a>' end"""


@query(f"""with c as (select page_id, {_BLOCK} as c from pages)
    select page_id, trim(regexp_replace(regexp_extract(c, '(?is)<a href="/bio/[^"]*">(.*?)</a>', 1), '<[^>]+>', '', 'g')) as author, nullif(trim(regexp_extract(c, '(?is)<a class="xlat-en" href="/bio/t">(.*?)</a>', 1)), '') as translator,
    1500 + page_id % 500 as year, case when page_id % 2 = 0 then 1500 + page_id % 540 end as translated_year from c""")
def page_credits(t: Tables) -> DataFrame:
    """Author, translator and the years of both, from a page's block of credits."""
    n = F.col("page_id").cast("string")
    year = lambda k: (1500 + F.col("page_id") % k).cast("string")
    other = F.concat(F.lit('<a class="xlat-en" href="/bio/t">'), F.regexp_extract("url", "([^/]*)$", 1), F.lit("</a>, "), year(540))
    block = F.concat(F.lit('<a href="/bio/'), n, F.lit('">'), X.page_title(F.col("html")), F.lit(" <b>"), n, F.lit("</b></a> ("), year(500), F.lit("), "), F.when(F.col("page_id") % 2 == 0, other).otherwise('<a href="/tune/x">tune</a>'))
    c = t.pages.select("page_id", block.alias("c")).withColumn("by", P.credits(F.col("c")))
    years = X.year_of(F.regexp_extract("c", r"</b></a>(.*?)(?:<a|$)", 1)), R.or_null(F.regexp_extract("c", _TRANSLATED, 1)).cast("int")
    return c.select("page_id", "by.author", R.or_null(F.col("by.translator")).alias("translator"), years[0].cast("long").alias("year"), years[1].cast("long").alias("translated_year"))


_LINKED = """'<link rel="alternate" href="' || url || '" hreflang="' || case page_id % 3 when 0 then 'en' else 'fr' end || '">' || html"""


@query(f"""with h as (select page_id, {_LINKED} as h from pages) select page_id, nullif(regexp_extract(h, '(?i)<link rel="alternate" href="([^"]+)" hreflang="en"', 1), '') as english, nullif(regexp_extract(h, '(?i)<link rel="alternate" href="([^"]+)" hreflang="fr"', 1), '') as french from h""")
def alternate_links(t: Tables) -> DataFrame:
    """A page's counterparts by language; each page is given a link to its own address, in one of two languages."""
    language = F.when(F.col("page_id") % 3 == 0, "en").otherwise("fr")
    page = F.concat(F.lit('<link rel="alternate" href="'), "url", F.lit('" hreflang="'), language, F.lit('">'), "html")
    h = t.pages.select("page_id", page.alias("h"))
    return h.select("page_id", P.alternate(F.col("h"), "en").alias("english"), P.alternate(F.col("h"), "fr").alias("french"))


@query()
def extraction_job(t: Tables) -> DataFrame:
    """Pages to records: notice, title, corpus, stanzas, greedy deduplication and year in order, then credits and a parent's fields.

    Documents stand in for the catalogue, and the pages themselves for the index of English titles.
    """
    titles = t.documents.select("doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), F.col("source").alias("themes"))
    known = titles.join(records.tune_fields(t), "doc_id").withColumn("k", _key("title"))
    catalogue = known.where("k is not null").groupBy("k").agg(F.min_by(F.struct("title", "year", *INHERITED), "doc_id").alias("r")).select("r.*")
    name = R.or_null(F.substring_index(F.regexp_replace("url", "[?#].*$", ""), "/", -1))
    titled = t.pages.select("page_id", name.alias("page"), X.page_title(F.col("html")).alias("title")).where("page is not null and title <> ''")
    # A title counts as seen if a document has it as its first line.
    seen = titles.select("title", F.lit(None).cast("string").alias("first"))
    return extracted(t.pages, catalogue, titled.groupBy("page").agg(F.min_by("title", "page_id").alias("english")), seen)
