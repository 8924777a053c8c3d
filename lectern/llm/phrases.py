"""Phrase collocation mining after Toivonen: a sample proposes, full passes count exactly until nothing is missing.

A phrase of two to four words is a candidate from ``LEAST`` occurrences in its
language. Its parts are at least as common, so a phrase need only be counted if
the phrases without its first and without its last word are common.

1. *Sample.* All phrases of one to three words of a share of the documents are
   counted; those that occur ``SAMPLE_LEAST`` times there are proposed. (One of
   four words is no part of a longer one, so it need not be proposed.)
2. *Full pass.* Over all texts every occurring phrase is counted whose two
   parts are proposed: the proposed phrases themselves and their negative
   border (all single words, and every phrase that isn't proposed but whose
   parts are).
3. *Expansion.* If a phrase of the border is common after all, the proposals
   were short. It is added to them, and another pass counts what may be counted
   now and was not before. Passes end when no border phrase is common: then
   every common phrase has been counted, whatever the sample was.

Proposals reach the tasks as a bit table of a fixed size (``BITS``), so what is
broadcast doesn't grow with the corpus. A false positive only has more phrases
counted; the same table decides in every pass what was counted before. Counts
are exact: within a task phrases are told apart by the numbers of their words,
between tasks by their text.

Defined results: null texts are empty, a null language counts as ``und``; a
text's pieces end at punctuation and line ends, and no phrase crosses them;
words may hold anything else but spaces and tabs. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm import kit, spans

BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Words are runs of anything but spaces, tabs and the ends of pieces.
WORD = kit.word_class(b" \t" + BREAKS)
_ENDS = ~kit.word_class(BREAKS)
CHUNK = 6 << 20
#: Rows that a task hands on at once.
ROWS = 1 << 16
LONGEST, LEAST, TOP, SHARE = 4, 30, 2000, 80
#: One document in SAMPLE is in the sample; phrases are proposed from SAMPLE_LEAST occurrences there.
SAMPLE, SAMPLE_LEAST = 16, 2
#: Size of the bit table: 16 MB for any corpus.
BITS = 1 << 27
_PRIME = np.uint64(0x9E3779B97F4A7C15)
#: Candidates that one task of the first ranking may hold.
RANKED = 100_000


def _word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word of an array of bytes."""
    texts = words.cast(pa.large_binary())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    body = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return kit._range_hashes(kit._BYTE_CODES[body], ends[:-1] - ends[0], ends[1:] - ends[0])


def _start(lang: str) -> np.uint64:
    return kit.mixed(_word_hashes(pa.array([lang.encode()], pa.binary())))[0]


def _then(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all but its last word and that of its last word."""
    return kit.mixed(prefix * _PRIME + word)


def _bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of the table that stand for a phrase."""
    return (h & np.uint64(BITS - 1)).astype(np.int64), (h >> np.uint64(32) & np.uint64(BITS - 1)).astype(np.int64)


def _holds(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), bool)
    for at in _bits(h):
        out &= (table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out


def _phrases(data: bytes, lang: str, now: np.ndarray | None, before: np.ndarray | None, longest: int = LONGEST) -> Iterator[tuple[pa.Array, int, np.ndarray]]:
    """(phrases, number of words, occurrences) of a buffer of texts in lower case.

    now: the table of proposals, None for all phrases; before: that of the last pass, whose phrases are left out.
    """
    starts, ends = spans.word_spans(data, WORD)
    if not len(starts):
        return
    ids, words = spans.numbered(spans.slices(data, starts, ends))
    hashes = _word_hashes(words)
    lengths = np.diff(np.frombuffer(words.cast(pa.large_binary()).buffers()[1], np.int64)[: len(words) + 1])
    # All words with one space after each: phrases are slices of it.
    offsets = np.concatenate([[0], np.cumsum(lengths[ids] + 1)])
    spaced = np.full(offsets[-1], 0x20, np.uint8)
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths[ids] + 1)
    inside = np.ones(offsets[-1], bool)
    inside[offsets[1:] - 1] = False
    spaced[inside] = np.frombuffer(data, np.uint8)[at[inside]]
    spaced = spaced.tobytes()
    cuts = np.cumsum(_ENDS[np.frombuffer(data, np.uint8)])
    joined = cuts[starts[1:]] == cuts[ends[:-1] - 1]

    # By position: the number of the phrase that starts there, -1 if it isn't followed up; by number: its hash.
    number, of = ids, _then(np.full(len(words), _start(lang)), hashes)
    if before is None:
        yield spans.as_text(words), 1, np.bincount(ids, minlength=len(words))
    member = _member(now, of)
    earlier = None if before is None else _holds(before, of)
    for n in range(2, longest + 1):
        # A phrase of n words at p: both its parts are there and proposed.
        head, tail = number[:-1], number[1:]
        p = np.flatnonzero((head >= 0) & (tail >= 0) & joined[: len(head)])
        p = p[member[head[p]] & member[tail[p]]]
        if not len(p):
            return
        # Heads of the phrases that were counted before.
        known = None if earlier is None else earlier[head[p]] & earlier[tail[p]]
        last = ids[p + n - 1]
        which, keys = pd.factorize(head[p] * len(words) + last)
        count, first = np.bincount(which, minlength=len(keys)), np.empty(len(keys), np.int64)
        first[which[::-1]] = np.arange(len(p) - 1, -1, -1)
        of = _then(of[keys // len(words)], hashes[keys % len(words)])
        new = np.arange(len(keys)) if known is None else np.flatnonzero(~known[first])
        if len(new):
            q = p[first[new]]
            yield spans.as_text(spans.slices(spaced, offsets[q], offsets[q + n] - 1)), n, count[new]
        number = np.full(len(head), -1, np.int64)
        number[p] = which
        member = _member(now, of)
        # What was not counted before can't have led to anything then.
        earlier = None if known is None else _holds(before, of) & known[first]


def _member(table: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    return np.ones(len(h), bool) if table is None else _holds(table, h)


def _counted(now, before, longest: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [None if x is None else x.value for x in (now, before)]
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = kit.column_bytes(batch, "text")
            for lang in dict.fromkeys(langs.tolist()):
                for data, _, _ in spans.buffers([texts[i] for i in np.flatnonzero(langs == lang)], CHUNK):
                    for found, n, count in _phrases(data, lang, *tables, longest):
                        for lo in range(0, len(found), ROWS):
                            some, rows = found.slice(lo, ROWS), min(ROWS, len(found) - lo)
                            columns = [pa.repeat(pa.scalar(lang, pa.string()), rows), pa.repeat(pa.scalar(n, pa.int8()), rows), some, pa.array(count[lo : lo + ROWS], pa.int64())]
                            yield pa.RecordBatch.from_arrays(columns, ["lang", "words", "phrase", "f"])
            kit.release()

    return work


def _counts(texts: DataFrame, now=None, before=None, longest: int = LONGEST) -> DataFrame:
    """(lang, words, phrase, f): exact counts over texts (lang, text) of the phrases that the tables let through.

    Rows are counts by buffer already, mostly of different phrases, so they are dealt as they are and summed once.
    """
    rows = texts.mapInArrow(_counted(now, before, longest), "lang string, words byte, phrase string, f long")
    return rows.repartition("lang", "words", "phrase").groupBy("lang", "words", "phrase").agg(F.sum("f").alias("f"))


def phrase_hashes(langs: list[str], phrases: list[bytes]) -> np.ndarray:
    """The hash of each phrase in its language, as the passes work it out word by word."""
    starts = {lang: _start(lang) for lang in set(langs)}
    split = [p.split(b" ") for p in phrases]
    out = np.array([starts[lang] for lang in langs], np.uint64)
    for n in range(max(map(len, split), default=0)):
        has = np.flatnonzero([len(s) > n for s in split])
        out[has] = _then(out[has], _word_hashes(pa.array([split[i][n] for i in has], pa.binary())))
    return out


def _words_of_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        h = phrase_hashes(batch.column(0).to_pylist(), kit.column_bytes(batch, "phrase"))
        at = np.unique(np.concatenate(_bits(h)))
        word = at >> 6
        cells, first = np.unique(word, return_index=True)
        packed = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first) if len(cells) else np.empty(0, np.uint64)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(packed.view(np.int64))], ["cell", "bits"])


def bit_table(proposed: DataFrame, old: np.ndarray | None = None) -> np.ndarray:
    """The bit table of proposals (lang, phrase), with the bits of old: at most BITS / 64 rows reach the driver."""
    cells = proposed.select("lang", "phrase").mapInArrow(_words_of_table, "cell long, bits long").groupBy("cell").agg(F.bit_or("bits").alias("bits"))
    out = np.zeros(BITS // 64, np.int64)
    for batch in cells.toArrow().to_batches():
        out[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    out = out.view(np.uint8)
    return out if old is None else out | old


def _outside(table):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            missing = ~_holds(table.value, phrase_hashes(batch.column(0).to_pylist(), kit.column_bytes(batch, "phrase")))
            yield batch.filter(pa.array(missing))

    return work


def frequent(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = LEAST, sample: int = SAMPLE, sample_least: int = SAMPLE_LEAST) -> tuple[DataFrame, DataFrame, int]:
    """(lang, words, phrase, f) of all phrases with least occurrences; (lang, n) words of each language; full passes that it took."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    part = texts.where(F.pmod(F.xxhash64("text", F.lit(12)), F.lit(sample)) == 0)
    # A phrase of the longest length is no part of a longer one: it need not be proposed.
    table = bit_table(_counts(part, longest=LONGEST - 1).where(F.col("f") >= sample_least))
    found, sizes, passes, before = None, None, 0, None
    while True:
        passes += 1
        now = spark.sparkContext.broadcast(table)
        counts = _counts(texts, now, before)
        if found is None:
            # Every word is counted in the first pass, so its words give each language's size.
            whole = kit.written(counts.where((F.col("f") >= least) | (F.col("words") == 1)), "phrase-counts")
            sizes = whole.where("words = 1").groupBy("lang").agg(F.sum("f").alias("n"))
            found = new = whole.where(F.col("f") >= least)
        else:
            new = kit.written(counts.where(F.col("f") >= least), "phrase-counts")
            found = found.unionByName(new)
        missed = kit.written(new.where(F.col("words") < LONGEST).mapInArrow(_outside(now), new.schema), "border-failures")
        if missed.isEmpty():
            return found, sizes, passes
        before, table = now, bit_table(missed, table)


def _points(a: Column, both: Column) -> Column:
    """floor(2000000 * a / both), exact."""
    return F.call_function("div", a.cast("decimal(20,0)") * F.lit(2_000_000), both.cast("decimal(20,0)"))


def _inner(words: Column, n: int) -> Column:
    """All runs of at least two words, but the whole."""
    return F.array(*(F.array_join(F.slice(words, at + 1, size), " ") for size in range(2, n) for at in range(n - size + 1)))


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", top: int = TOP, least: int = LEAST, sample: int = SAMPLE, sample_least: int = SAMPLE_LEAST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's strongest phrases."""
    found, sizes, _ = frequent(docs, text=text, lang=lang, least=least, sample=sample, sample_least=sample_least)
    rows = found.where("words > 1").withColumn("w", F.split("phrase", " "))
    # A string of words without separators in them: splitting at spaces gives the words back.
    cuts = F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda k: F.struct(k.alias("k"), F.array_join(F.slice("w", F.lit(1), k), " ").alias("head"), F.array_join(F.slice("w", k + 1, F.size("w")), " ").alias("rest"))))
    cut = rows.select("lang", "phrase", "words", F.col("f").alias("a"), cuts.alias("c")).select("lang", "phrase", "words", "a", "c.*")
    for side, name in (("head", "l"), ("rest", "r")):
        cut = cut.join(found.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    worst = F.min(F.struct(_points(F.col("a"), F.col("l") + F.col("r")).alias("score"), "k", "l", "r")).alias("worst")
    scored = cut.groupBy("lang", "phrase", "words", "a").agg(worst).select("lang", "phrase", "words", "a", "worst.l", "worst.r", "worst.score")
    longer = found.where("words > 2").withColumn("w", F.split("phrase", " "))
    inner = longer.select("lang", "f", F.explode(F.when(F.col("words") == 3, _inner(F.col("w"), 3)).otherwise(_inner(F.col("w"), 4))).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("over"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = scored.join(inner, ["lang", "phrase"], "left").where(F.col("over").isNull() | (wide("over") * 100 < wide("a") * SHARE))
    kept = kit.written(kept.select("lang", "phrase", "a", "l", "r", "score"), "collocations")
    # Ranked in shares of bounded size first, so that no task holds a language.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shares = 1 + kept.count() // RANKED
    some = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    some = some.withColumn("place", F.row_number().over(Window.partitionBy("lang", "share").orderBy(*order))).where(F.col("place") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
s AS (SELECT row_number() OVER () AS id, lang, piece FROM (SELECT lang, unnest(regexp_extract_all(t, '[^.,;:!?\x0A-\x0D]+')) AS piece FROM d)),
w AS (SELECT id, lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM s),
u AS (SELECT id, lang, unnest(w) AS x, unnest(generate_series(1, len(w))) AS p FROM w),
v4 AS (SELECT lang, x, lead(x) OVER o AS x2, lead(x, 2) OVER o AS x3, lead(x, 3) OVER o AS x4 FROM u WINDOW o AS (PARTITION BY id ORDER BY p)),
g AS (SELECT lang, 1 AS k, x AS phrase FROM v4 UNION ALL SELECT lang, 2, x || ' ' || x2 FROM v4 WHERE x2 IS NOT NULL UNION ALL SELECT lang, 3, x || ' ' || x2 || ' ' || x3 FROM v4 WHERE x3 IS NOT NULL UNION ALL SELECT lang, 4, x || ' ' || x2 || ' ' || x3 || ' ' || x4 FROM v4 WHERE x4 IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
e AS (SELECT lang, k, phrase, a, w, unnest(generate_series(1, k - 1)) AS cut FROM c),
v AS (SELECT e.lang, e.k, e.phrase, e.a, e.cut, x.f AS l, y.f AS r, CAST((2000000 * CAST(e.a AS HUGEINT)) // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM e JOIN f x ON x.lang = e.lang AND x.phrase = array_to_string(list_slice(e.w, 1, e.cut), ' ') JOIN f y ON y.lang = e.lang AND y.phrase = array_to_string(list_slice(e.w, e.cut + 1, e.k), ' ')),
b AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, array_to_string(list_slice(w, p, p + z - 1), ' ') AS phrase, max(a) AS over FROM (SELECT lang, w, a, z, unnest(generate_series(1, k - z + 1)) AS p FROM c, (VALUES (2), (3)) AS x(z) WHERE z < k) GROUP BY ALL),
o AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.over IS NULL OR 100 * CAST(i.over AS HUGEINT) < 80 * CAST(b.a AS HUGEINT)),
r AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, score FROM o)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, r.score FROM r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
"""
