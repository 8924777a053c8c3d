"""Column functions on names, keys, lines and pages; all stay inside the JVM."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Combining accents.
_MARKS = "[\u0300-\u036f]"
_is_mark = re.compile(_MARKS).fullmatch


def _letters() -> dict[str, str]:
    """Letters to their bases without combining accents, by Unicode's canonical decompositions."""
    bases = {}
    for c in map(chr, range(0xC0, 0xFFFF)):
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not _is_mark(x))
        if len(base) == 1 and base != c:
            bases[c] = base
    return bases


_BASES = _letters()
#: White space as scripts mean it, the no-break space included.
_SPACE = r"[\s\x{00A0}]+"


def stable_id(title: Column, salt: str) -> Column:
    """The first 11 characters of the URL-safe base64 of a salted SHA-1."""
    digest = F.base64(F.unhex(F.sha1(F.concat(F.lit(salt), title))))
    return F.substring(F.translate(digest, "+/", "-_"), 1, 11)


def _dashes(c: Column) -> Column:
    return F.regexp_replace(c, r"^-+|-+$", "")


def slug(c: Column) -> Column:
    """Composed, lower case, apostrophes dropped, other runs of non-letters to one dash; 'untitled' if nothing is left."""
    out = _dashes(F.regexp_replace(F.regexp_replace(F.lower(composed(c)), "['’ʼ]", ""), r"[^\p{L}\p{M}\p{N}]+", "-"))
    return F.when(out == "", F.lit("untitled")).otherwise(out)


def ascii_slug(c: Column, keep_apostrophes: bool) -> Column:
    """Folded to ASCII; apostrophes become dashes or vanish."""
    c = F.lower(fold(c))
    c = c if keep_apostrophes else F.regexp_replace(c, "['’]", "")
    return _dashes(F.regexp_replace(c, "[^a-z0-9]+", "-"))


def fold(c: Column) -> Column:
    """Letters without combining accents, whether composed or not."""
    return F.regexp_replace(F.translate(c, "".join(_BASES), "".join(_BASES.values())), _MARKS + "+", "")


def composed(c: Column) -> Column:
    """Unicode's composed form (NFC), Hangul and Indic vowels included.

    By the Unicode library that Spark brings along, inside the JVM; texts below the first combining mark are composed already and are not passed to it.
    """
    nfc = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))
    return F.when(c.rlike(r"[^\x{0000}-\x{02FF}]"), nfc).otherwise(c)


# The patterns of the keys, of names, topics and excerpts below.
_NOBODY = r"(?i)trad\.?|anonymous|unknown|\d+(st|nd|rd|th) c|century|various"
#: What a text on a person of this trade says, and what a free licence is called.
PERSONISH = r"(?i)hymn|compos|minist|poet|writer|pastor|clerg|music|evangel|preach|priest|monk|reformer|theolog|missionar|bishop|author"
FREE_LICENCE = r"(?i)public domain|^pd|cc0"
#: Entities of page text, in the order in which they are decoded; soft hyphens go.
_ENTITIES = (("\u00ad", ""), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#039;", "'"), ("&apos;", "'"), ("&rsquo;", "’"), ("&#8217;", "’"), ("&amp;", "&"))


def key_ascii(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), "['’,!().\"]", ""), "[^a-z0-9]+", " "))


def key_folded(c: Column) -> Column:
    return key_ascii(F.regexp_replace(fold(c), "[¡¿?]", ""))


def key_unicode(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(fold(c)), r"[^\p{L}\p{M}\p{N}]+", " "))


def key_without_entities(c: Column) -> Column:
    return key_ascii(F.regexp_replace(c, r"&#?\w+;", " "))


def word_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def uninverted(c: Column) -> Column:
    """'Rose, The' to 'The Rose'."""
    return F.regexp_replace(c, "^(.+), (The|A|An)$", "$2 $1")


def person_list(c: Column) -> Column:
    """'Last, First (1800-1850); Unknown' to 'First Last', several joined by ' & '."""
    names = F.transform(F.split(c, ";"), lambda n: F.trim(F.regexp_replace(n, r"\s*\([^)]*\)", "")))
    names = F.filter(names, lambda n: ~F.lower(n).isin("", "none", "unknown", "anonymous", "traditional"))
    return F.array_join(F.transform(names, lambda n: F.regexp_replace(n, r"^([^,]+),\s*(.+)$", "$2 $1")), " & ")


def topics(c: Column, most: int = 3) -> Column:
    """Up to three '{...}' parts without brackets and commas."""
    found = F.regexp_extract_all(c, F.lit(r"\{([^}]*)\}"), 1)
    found = F.transform(found, lambda t: F.trim(F.regexp_replace(t, r"\([^)]*\)|\[[^\]]*\]", "")))
    return F.array_join(F.slice(F.filter(found, lambda t: (t != "") & ~t.contains(",")), 1, most), ",")


def without_chords(c: Column) -> Column:
    return F.regexp_replace(c, r"\[[^\]]*\]", "")


def first_line(body: Column, labels: str = "Verse|Chorus|Refrain|Bridge|Coro") -> Column:
    """The first line with text that is no stanza label, without chords; null if there is none."""
    lines = F.filter(F.split(body, "\n"), lambda x: (F.trim(x) != "") & ~F.trim(x).rlike(rf"^(?:{labels})(?: \d+)?:?$"))
    return F.trim(without_chords(F.try_element_at(lines, F.lit(1))))


def visible(page: Column) -> Column:
    """Page text without comments, scripts, styles and tags; white space collapsed."""
    c = F.regexp_replace(page, r"(?is)<!--.*?-->|<(script|style)\b.*?</\1>", " ")
    c = F.regexp_replace(c, "<[^>]*>", " ")
    for entity, plain in _ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def stripped(page: Column, *, quotes: bool = False, curly: bool = False) -> Column:
    """A piece of a page without tags (nothing stands in for them) and soft hyphens; entities decoded, white space collapsed.

    quotes: <q> and </q> are quotation marks; curly: right single quotes are decoded too.
    """
    c = F.regexp_replace(page, "</?q>", '"') if quotes else page
    c = F.replace(F.regexp_replace(c, "<[^>]+>", ""), F.lit("\u00ad"), F.lit(""))
    for entity, plain in (("&nbsp;", " "), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(plain))
    c = F.replace(F.regexp_replace(c, "&#0?39;|&apos;", "'"), F.lit("&quot;"), F.lit('"'))
    c = F.regexp_replace(c, "&#8217;|&rsquo;", "’") if curly else c
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def without_suffix(body: Column, suffix: Column) -> Column:
    """body without the first occurrence of an empty line and the suffix; as it is without a suffix."""
    tail = F.concat(F.lit("\n\n"), suffix)
    at = F.call_function("instr", body, tail)
    cut = F.concat(F.substring(body, F.lit(1), at - 1), F.substring(body, at + F.char_length(tail), F.char_length(body)))
    return F.when(at > 0, cut).otherwise(body)


def first_year(*texts: Column) -> Column:
    """The first year (1000 to 2029) of the first text that has one."""
    found = [F.nullif(F.regexp_extract(t, r"(?<![0-9A-Za-z_])(1[0-9]{3}|20[0-2][0-9])(?![0-9A-Za-z_])", 1), F.lit("")) for t in texts]
    return F.coalesce(*found).cast("int")


def bare_name(credit: Column) -> Column:
    """The first name of a credit, without what stands in brackets."""
    return F.trim(F.regexp_replace(F.split_part(credit, F.lit("·"), F.lit(1)), r"\(.*?\)", ""))


def is_person(name: Column) -> Column:
    """Whether a name may be looked up: two words at least, and no tradition, century or anonymous crowd."""
    return ~name.rlike(_NOBODY) & (F.size(F.split(name, " ")) >= 2)


def page_title(page: Column) -> Column:
    return F.trim(F.regexp_extract(page, r"(?is)<title>(.*?)</title>", 1))


def year_of(c: Column) -> Column:
    """A year from 1500 to 2099, or null."""
    found = F.regexp_extract(c, r"(?:^|[^0-9])((?:1[5-9]|20)[0-9]{2})(?:[^0-9]|$)", 1)
    return F.nullif(found, F.lit("")).cast("int")


def credit(author: Column, translator: Column, default: str = "Unknown") -> Column:
    """'author · tr. translator', either alone, or the default."""
    return F.coalesce(F.nullif(F.concat_ws(" · ", F.nullif(author, F.lit("")), F.concat(F.lit("tr. "), F.nullif(translator, F.lit("")))), F.lit("")), F.lit(default))


def excerpt(c: Column, most: int = 320) -> Column:
    """At most 320 characters, white space collapsed: up to the last sentence end that follows no initial, else up to the last word."""
    c = F.trim(F.regexp_replace(c, _SPACE, " "))
    head = F.substring(c, 1, most)
    sentence = F.regexp_extract(head, r"(?s)^(.*(?<![ .][A-Z])[.!?])(?:\s|$)", 1)
    word = F.concat(F.regexp_replace(head, r"(?s)\s+\S*$", ""), F.lit("…"))
    return F.when(F.char_length(c) <= most, c).when(sentence != "", sentence).otherwise(word)


def clamped_tempo(beats: Column, numerator: Column, denominator: Column) -> Column:
    return F.greatest(F.lit(40), F.least(F.lit(200), F.round(beats * numerator / denominator * 4).cast("int")))


def first_item(c: Column, separator: str) -> Column:
    """What stands before the first separator, trimmed; null if that is empty."""
    return F.nullif(F.trim(F.split_part(c, F.lit(separator), F.lit(1))), F.lit(""))


def after_mark(c: Column, mark: str) -> Column:
    """What follows the first mark, trimmed; null without one or if nothing follows."""
    at = F.instr(c, mark)
    return F.when(at > 0, F.nullif(F.trim(c.substr(at + len(mark), F.char_length(c))), F.lit("")))


def or_default(c: Column, default: object) -> Column:
    """The default for null and empty values."""
    return F.coalesce(F.nullif(c, F.lit("")) if isinstance(default, str) else c, F.lit(default))


def joined_path(*parts: Column) -> Column:
    """Parts joined by slashes; null if any is null."""
    return F.concat(*[x for part in parts for x in (F.lit("/"), part)][1:])
