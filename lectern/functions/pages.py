"""Column functions on web pages: stanzas, credits, links, embedded fragments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels that stand alone above a chorus.
CHORUS = r"(?i)^(estribillo|coro|refrain|chorus)[:.]?$"
_PARAGRAPH = r"(?is)<p([^>]*)>(.*?)</p>"
#: Who may be named in a credit: a link to a biography.
_LINK = r"(?is)<a\s([^>]*)>(.*?)</a>"


def lines_of(block: Column) -> Column:
    """Text lines of a block of markup, split at line breaks, without tags and empty lines."""
    parts = F.split(F.regexp_replace(block, r"(?i)<br\s*/?>", "\n"), "\n")
    return F.filter(F.transform(parts, lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, "<[^>]+>", ""), r"\s+", " "))), lambda x: x != "")


def paragraphs(block: Column) -> Column:
    """array of (lines, chorus): the paragraphs with text, without those that are a label only."""
    attributes, bodies = (F.regexp_extract_all(block, F.lit(_PARAGRAPH), g) for g in (1, 2))
    all_of = F.zip_with(attributes, bodies, lambda a, b: F.struct(lines_of(b).alias("lines"), a.rlike(r'(?i)class="[^"]*chorus').alias("marked")))
    labelled = F.transform(all_of, lambda p: F.struct(
        F.when(F.get(p["lines"], F.lit(0)).rlike(CHORUS), F.slice(p["lines"], F.lit(2), F.size(p["lines"]))).otherwise(p["lines"]).alias("lines"),
        (p["marked"] | F.coalesce(F.get(p["lines"], F.lit(0)).rlike(CHORUS), F.lit(False))).alias("chorus"),
    ))
    return F.filter(labelled, lambda p: F.size(p["lines"]) > 0)


def verses(found: Column) -> Column:
    """The verse texts of paragraphs, leading numbers dropped."""
    text = lambda p: F.array_join(F.transform(p["lines"], lambda x: F.regexp_replace(x, r"^[0-9]+\s+", "")), "\n")
    return F.transform(F.filter(found, lambda p: ~p["chorus"]), text)


def chorus(found: Column) -> Column:
    """The first chorus of paragraphs, or null."""
    return F.array_join(F.try_element_at(F.filter(found, lambda p: p["chorus"]), F.lit(1))["lines"], "\n")


def credits(block: Column) -> Column:
    """(author, translator): texts of the first biography link without and with a translator's class."""
    attributes, texts = (F.regexp_extract_all(block, F.lit(_LINK), g) for g in (1, 2))
    links = F.zip_with(attributes, texts, lambda a, x: F.struct(a.alias("a"), F.trim(F.regexp_replace(x, "<[^>]+>", "")).alias("x")))
    author = F.filter(links, lambda k: k["a"].contains("/bio/") & ~k["a"].rlike(r'class="[^"]*xlat'))
    translator = F.filter(links, lambda k: k["a"].rlike(r'class="[^"]*xlat-en'))
    return F.struct(F.try_element_at(author, F.lit(1))["x"].alias("author"), F.try_element_at(translator, F.lit(1))["x"].alias("translator"))


def chosen_link(page: Column, pattern: str, wish: Column) -> Column:
    """The first link (group 1 of pattern) that ends with wish if there is a wish, else the first of all."""
    links = F.regexp_extract_all(page, F.lit(pattern), 1)
    wished = F.try_element_at(F.filter(links, lambda x: x.endswith(wish)), F.lit(1))
    return F.when(wish.isNull(), F.try_element_at(links, F.lit(1))).otherwise(wished)


def alternate(page: Column, language: str) -> Column:
    """The page's counterpart in another language, or null."""
    return F.nullif(F.regexp_extract(page, rf'(?i)<link rel="alternate" href="([^"]+)" hreflang="{language}"', 1), F.lit(""))


def fragments(page: Column, pattern: str, schema: str) -> Column:
    """Embedded JSON objects (group 0 of pattern), parsed; broken ones are dropped."""
    found = F.transform(F.regexp_extract_all(page, F.lit(pattern), 0), lambda x: F.from_json(x, schema))
    return F.filter(found, lambda x: x.isNotNull())
