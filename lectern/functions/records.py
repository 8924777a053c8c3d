"""Column functions on record fields: headers, credits, keys and tempo, stanzas, chords; all stay inside the JVM."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Edits of a lyric line, in their order.
LINE_EDITS = (
    (r"^w:\s*", ""),
    (r"^[0-9]+\.\s*~?\s*", ""),
    (r"![A-Za-z0-9_]+!", ""),
    (r"[*_|\\]", ""),
    (r"~", " "),
    (r"([A-Za-z])-\s+", r"$1"),
    (r"([,.;:!?])-\s*", r"$1 "),
    (r"\s+", " "),
    (r"\s+([,.;:!?])", r"$1"),
)
# Life dates behind a name.
LIFE_DATES = r"\s*\((?:b\. )?[0-9]{4}[-–]?[0-9?]*\)"
# Spanish names of books.
BOOKS_ES = {
    "Genesis": "Génesis", "Exodus": "Éxodo", "Deuteronomy": "Deuteronomio", "Joshua": "Josué", "Psalm": "Salmos", "Psalms": "Salmos",
    "Proverbs": "Proverbios", "Isaiah": "Isaías", "Jeremiah": "Jeremías", "Ezekiel": "Ezequiel", "Daniel": "Daniel",
    "Matthew": "Mateo", "Mark": "Marcos", "Luke": "Lucas", "John": "Juan", "Acts": "Hechos", "Romans": "Romanos",
    "Galatians": "Gálatas", "Ephesians": "Efesios", "Philippians": "Filipenses", "Colossians": "Colosenses",
    "Hebrews": "Hebreos", "James": "Santiago", "Revelation": "Apocalipsis", "Song": "Cantares",
}
# Names of the twelve pitch classes, and chord qualities as intervals above the root, in order of choice.
SHARPS = "C C# D D# E F F# G G# A A# B".split()
FLATS = "C Db D Eb E F Gb G Ab A Bb B".split()
QUALITIES = (((0, 4, 7, 10), "7"), ((0, 3, 7, 10), "m7"), ((0, 4, 7, 11), "maj7"), ((0, 4, 7), ""), ((0, 3, 7), "m"), ((0, 3, 6), "dim"), ((0, 4, 8), "aug"))
# Names that stand for no person.
NO_PERSON = r"(?i)trad\.?|anonymous|unknown|[0-9]+(st|nd|rd|th) c|century|various"


def or_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def tag_value(text: Column, tag: str) -> Column:
    """The rest of the first line ``TAG: value``; null if there is none or it is empty."""
    return or_null(F.trim(F.regexp_extract(text, rf"(?m)^{tag}:[ \t]*(.*)$", 1)))


def header_block(fields: Mapping[str, Column], body: Column) -> Column:
    """``{name: value}`` lines of the fields that are not empty, a blank line, the body."""
    lines = [F.when(v != "", F.concat(F.lit(f"{{{name}: "), v, F.lit("}"))) for name, v in fields.items()]
    return F.concat_ws("\n", *lines, F.lit(""), F.coalesce(body, F.lit("")))


_HEAD = r"^((?:\{[^\n]*(?:\n|$))*)"


def header_map(text: Column) -> Column:
    """Leading ``{name: value}`` lines as a map; the last of equal names wins, malformed lines count for nothing."""
    head = F.regexp_extract(text, _HEAD, 1)
    part = r"(?m)^\{([^:}\n]+):([^}\n]*)\}$"
    names, values = (F.transform(F.regexp_extract_all(head, F.lit(part), g), lambda x: F.trim(x)) for g in (1, 2))
    pairs = F.arrays_zip(names.alias("k"), values.alias("v"))
    keys = F.transform(pairs, lambda p: p["k"])
    last = F.filter(pairs, lambda p, i: ~F.array_contains(F.slice(keys, i + 2, F.size(keys)), p["k"]))
    return F.map_from_entries(last)


def header_body(text: Column) -> Column:
    """What follows the leading directives, without one blank line before and one line end after it."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, _HEAD, ""), r"^\n", ""), r"\n\z", "")


def clean_line(c: Column) -> Column:
    for pattern, to in LINE_EDITS:
        c = F.regexp_replace(c, pattern, to)
    return F.trim(c)


def without_dates(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, LIFE_DATES, ""))


def first_author(c: Column) -> Column:
    """The name before a translator's credit, without parentheses."""
    return F.trim(F.regexp_replace(F.split_part(c, F.lit("·"), F.lit(1)), r"\([^)]*\)", ""))


def is_person(name: Column) -> Column:
    """Two words at least, and no stand-in such as 'traditional'."""
    return ~name.rlike(NO_PERSON) & (F.size(F.split(name, " ")) >= 2)


def translated_reference(c: Column, books: Mapping[str, str] = BOOKS_ES) -> Column:
    """'1 John 4' with the book's name looked up; unknown books stay."""
    table = F.create_map(*[F.lit(x) for pair in books.items() for x in pair])
    shape = r"^([0-9]?\s*)([A-Za-z]+)(.*)$"
    book = F.try_element_at(table, F.regexp_extract(c, shape, 2))
    return F.coalesce(F.trim(F.concat(F.regexp_extract(c, shape, 1), book, F.regexp_extract(c, shape, 3))), c)


def musical_key(c: Column) -> Column:
    """'Eb minor' as 'Ebm'; C if there is none."""
    tonic = F.regexp_extract(c, r"^([A-Ga-g][#b]?)\s*(?:[mM](?![A-Za-z])|[mM][iI][nN])?", 1)
    minor = c.rlike(r"^[A-Ga-g][#b]?\s*(?:[mM](?![A-Za-z])|[mM][iI][nN])")
    return F.when(tonic != "", F.concat(tonic, F.when(minor, F.lit("m")).otherwise(F.lit("")))).otherwise(F.lit("C"))


def meter(c: Column) -> Column:
    return F.when(c.rlike(r"^[0-9]+/[0-9]+$"), c)


def relation_label(has_parent: Column, language: Column, translated: Column, name: Column, year: Column) -> Column:
    """'French translation · tr. X, 1850' or 'French original · X, 1850'; null without a parent."""
    who = F.when(or_null(name).isNotNull(), F.concat(F.when(translated, F.lit(" · tr. ")).otherwise(F.lit(" · ")), name))
    when = F.concat(F.lit(", "), year.cast("string"))
    kind = F.when(translated, F.lit(" translation")).otherwise(F.lit(" original"))
    return F.when(has_parent, F.concat(language, kind, F.coalesce(who, F.lit("")), F.coalesce(when, F.lit(""))))


def stanza_text(verses: Column, chorus: Column) -> Column:
    """Numbered verses with the chorus behind the first one, or the chorus alone."""
    block = F.concat(F.lit("Chorus\n"), or_null(chorus))
    numbered = F.transform(verses, lambda v, i: F.concat(F.lit("Verse "), (i + 1).cast("string"), F.lit("\n"), v))
    parts = F.concat(F.slice(numbered, 1, 1), F.array(block), F.slice(numbered, F.lit(2), F.greatest(F.size(numbered), F.lit(1))))
    return F.array_join(F.array_compact(parts), "\n\n")


def stanzas(body: Column) -> Column:
    """The stanzas of a body, as an array of (label, lines): blocks between empty lines, the first line of each is its label; blocks without a word are none."""
    blocks = F.filter(F.split(body, r"\r?\n\s*\r?\n"), lambda b: F.trim(b) != "")
    lines = lambda b: F.split(b, r"\r?\n")
    return F.transform(blocks, lambda b: F.struct(F.trim(F.get(lines(b), F.lit(0))).alias("label"), F.filter(lines(b), lambda line, i: (i > 0) & (F.trim(line) != "")).alias("lines")))


def chord_name(pitches: Column, bass: Column, flats: Column) -> Column:
    """Name of a set of pitch classes (0 to 11): the quality that holds them all, rather on the bass, rather with few notes; else null."""

    def on(root: Column) -> Column:
        above = F.transform(pitches, lambda p: F.pmod(p - root, F.lit(12)).cast("int"))
        fits = []
        for i, (intervals, suffix) in enumerate(QUALITIES):
            whole = F.size(F.array_except(above, F.array(*[F.lit(x) for x in intervals]))) == 0
            fits.append(F.when(whole, F.struct((root != bass).alias("off"), F.lit(len(intervals)).alias("notes"), root.cast("int").alias("root"), F.lit(i).alias("at"), F.lit(suffix).alias("suffix"))))
        return F.array_compact(F.array(*fits))

    best = F.array_min(F.flatten(F.transform(pitches, on)))
    names = F.when(flats, F.array(*map(F.lit, FLATS))).otherwise(F.array(*map(F.lit, SHARPS)))
    return F.concat(F.get(names, best["root"]), best["suffix"])


def annotated_line(words: Column) -> Column:
    """words: array of arrays of (chord, syllable) as '[C]Glo[G]ry be'."""
    syllables = lambda w: F.array_join(F.transform(w, lambda s: F.concat(F.coalesce(F.concat(F.lit("["), s["chord"], F.lit("]")), F.lit("")), s["syllable"])), "")
    return F.array_join(F.transform(words, syllables), " ")


def has_magic(content: Column, magic: bytes) -> Column:
    """Whether binary content begins with magic."""
    return F.hex(F.substring(content, 1, len(magic))) == magic.hex().upper()


def main_block(page: Column, patterns: Sequence[str]) -> Column:
    """The first group of the first pattern that matches; null if none does."""
    return F.coalesce(*[or_null(F.regexp_extract(page, p, 1)) for p in patterns])


def label_map(page: Column, pattern: str) -> Column:
    """Group 1 to group 2 of every match as a map; the first of equal labels wins."""
    labels, values = (F.regexp_extract_all(page, F.lit(pattern), g) for g in (1, 2))
    pairs = F.arrays_zip(labels.alias("k"), values.alias("v"))
    return F.map_from_entries(F.filter(pairs, lambda p, i: F.array_position(labels, p["k"]) == i + 1))


def first_failing(*tests: tuple[str, Column], passed: str = "accepted") -> Column:
    """The name of the first test whose condition holds (null counts as no), or passed."""
    out = F.lit(passed)
    for name, fails in reversed(tests):
        out = F.when(fails, F.lit(name)).otherwise(out)
    return out
