"""Quality rules with cross-document line frequency.

Each text's base figures are computed on its own. Lines are then normalised
(ASCII lower case, runs of ASCII white space to one space, trimmed), hashed,
and counted by the distinct documents of a host that hold them. A line that
over ``least_docs`` documents and over ``share`` of its host's documents hold
is boilerplate and is removed; a document that keeps under ``least_words``
words, or under ``least_kept`` of its words, is depleted and rejected.
``judged`` reports this for each row; ``cleaned`` does it: rejected rows go,
and the others lose their boilerplate lines.

Exact copies count as one document of their host, so a much-copied text does
not become its own boilerplate. Counting is grouped by (host, line) with
partial sums; a line that a third of all documents hold costs one row a task.

Defined results: a null text has no words; a null host is a host of its own;
lines without a word are never counted nor removed; rows with equal ids, or
without one, are judged and removed each by its own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import kit

LEAST_WORDS, LEAST_DOCS, SHARE, LEAST_KEPT = 50, 20, 0.1, 0.5
SYMBOLS = b"#*$%&|<>"
_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_CONTINUES = bytes(range(0x80, 0xC0))


def normalised_line(line: bytes) -> bytes:
    return b" ".join(line.translate(kit.LOWER).split())


def line_hash(line: bytes) -> int:
    """64 bits of a normalised line, as Spark's xxhash64 gives them."""
    h = xxhash.xxh64_intdigest(line, seed=42)
    return h - (1 << 64) if h >> 63 else h


def repeated_words(words: np.ndarray) -> int:
    """Words in three-word windows that a text holds twice or more."""
    h = kit.window_hashes(words, 3)
    if len(h) < 2:
        return 0
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(words), bool)
    at = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
    for j in range(3):
        twice[at + j] = True
    return int(twice.sum())


def base_figures(text: bytes, words: np.ndarray) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return (
        len(words),
        len(text.translate(None, _SPACES + _CONTINUES)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


_STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    line_type = pa.list_(pa.struct([("line", pa.int64()), ("words", pa.int64())]))
    for batch in batches:
        for part, texts in kit.cut(batch, "text"):
            words, counts = kit.word_hashes(texts)
            ends = np.cumsum(counts)
            stats, lines = [], []
            for t, a, b in zip(texts, (ends - counts).tolist(), ends.tolist(), strict=True):
                stats.append(base_figures(t or b"", words[a:b]))
                held: dict[int, int] = {}
                for line in (t or b"").split(b"\n"):
                    if normal := normalised_line(line):
                        h = line_hash(normal)
                        held[h] = held.get(h, 0) + normal.count(b" ") + 1
                lines.append([{"line": h, "words": n} for h, n in held.items()])
            cols = list(zip(*stats, strict=True))
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("host"), *(pa.array(c, pa.int64()) for c in cols), part.column("same"), pa.array(lines, line_type)], ["doc", "host", *_STATS, "same", "lines"])


def figures(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """(row, doc, host, base figures, same, lines) for each row, as a table in the shared folder."""
    pairs = docs.select(F.col(doc_id).alias("doc"), F.col(host).cast("string").alias("host"), kit.text_digest(text).alias("same"), F.col(text).alias("text"))
    lines = T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("words", T.LongType())]))
    schema = T.StructType([T.StructField("doc", docs.schema[doc_id].dataType), T.StructField("host", T.StringType()), *(T.StructField(c, T.LongType()) for c in _STATS), T.StructField("same", T.BinaryType()), T.StructField("lines", lines)])
    return kit.written(pairs.mapInArrow(kit.giving_back(_figures), schema).withColumn("row", F.monotonically_increasing_id()), "figures")


def frequent_lines(table: DataFrame, *, least_docs: int = LEAST_DOCS, share: float = SHARE) -> DataFrame:
    """(host, line, n_docs) of lines above the limits; hosts are compared null-safe as ('' , no host)."""
    one = table.groupBy("host", "same").agg(F.min("row").alias("row"))
    distinct = table.join(one.select("row"), "row", "left_semi")
    sizes = one.groupBy("host").agg(F.count("*").alias("host_docs"))
    counted = distinct.select("host", F.explode("lines.line").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= least_docs)
    return counted.join(sizes.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h"))).where(F.col("n_docs") > share * F.col("host_docs")).select("host", "line", "n_docs")


def _verdicts(docs: DataFrame, doc_id: str, text: str, host: str, least_words: int, least_kept: float, limits: dict) -> DataFrame:
    """The figures of each row with base_failed, n_line_words, kept, and its frequent lines (gone, null if none)."""
    table = figures(docs, doc_id=doc_id, text=text, host=host)
    frequent = frequent_lines(table, **limits).select(F.col("host").alias("h"), F.col("line").alias("l"))
    held = table.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.words")
    # A row's own distinct lines bound its list.
    lost = held.join(frequent, (F.col("line") == F.col("l")) & F.col("host").eqNullSafe(F.col("h"))).groupBy("row").agg(F.sum("words").alias("lost"), F.collect_list("line").alias("gone"))
    out = table.drop("lines").join(lost, "row", "left").withColumn("n_line_words", F.coalesce("lost", F.lit(0)).cast("long"))
    left = F.col("n_words") - F.col("n_line_words")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & (left >= least_words) & (left >= least_kept * F.col("n_words")))


def judged(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source", least_words: int = LEAST_WORDS, least_kept: float = LEAST_KEPT, **limits) -> DataFrame:
    """One row per document: doc_id, base figures, base_failed, n_line_words (words on removed lines), kept."""
    return _verdicts(docs, doc_id, text, host, least_words, least_kept, limits).select(F.col("doc").alias(doc_id), *_STATS, "base_failed", "n_line_words", "kept")


def _normalised(line: Column) -> Column:
    """normalised_line as a column function."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (0x41, 0x61))
    return F.array_join(F.filter(F.split(F.translate(line, upper, lower), r"[\x20\x09-\x0D]+"), lambda w: w != ""), " ")


def _without(text: Column, gone: Column) -> Column:
    """text without the lines whose hashes are in gone; lines without a word stay. Null for a null text or gone."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~F.array_contains(gone, F.xxhash64(_normalised(line))) | (_normalised(line) == "")), "\n")


def cleaned(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source", least_words: int = LEAST_WORDS, least_kept: float = LEAST_KEPT, cut_lines: bool = True, **limits) -> DataFrame:
    """docs without the rejected rows, and (cut_lines) without the frequent lines of their host. A row is told by id, host and text."""
    names = {c: kit.free_name(docs, c) for c in ("doc", "host", "same", "kept", "gone")}
    found = _verdicts(docs, doc_id, text, host, least_words, least_kept, limits).where("not kept or gone is not null").dropDuplicates(["doc", "host", "same"])
    found = found.select(*[F.col(c).alias(n) for c, n in names.items()])
    own = F.col(doc_id).eqNullSafe(F.col(names["doc"])) & F.col(host).cast("string").eqNullSafe(F.col(names["host"])) & (kit.text_digest(text) == F.col(names["same"]))
    left = docs.join(found, own, "left").where(F.coalesce(F.col(names["kept"]), F.lit(True)))
    gone = F.col(names["gone"])
    new = F.when(gone.isNotNull(), _without(F.col(text), gone)).otherwise(F.col(text)) if cut_lines else F.col(text)
    return left.select(*[new.alias(c) if c == text else F.col(c) for c in docs.columns])


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """docs without the rejected rows; the other texts stay as they are."""
    return cleaned(docs, cut_lines=False, **options)


def remove_lines(docs: DataFrame, frequent: DataFrame, *, text: str = "text", host: str = "source") -> DataFrame:
    """docs with the frequent lines (host, line) of their host cut out of their texts.

    A host has few frequent lines: over ``share`` of its documents hold each of them.
    """
    gone, name = kit.free_name(docs, "gone"), kit.free_name(docs, "host")
    by_host = frequent.groupBy(F.col("host").alias(name)).agg(F.collect_set("line").alias(gone))
    joined = docs.join(by_host, F.col(host).cast("string").eqNullSafe(F.col(name)), "left")
    return joined.select(*[F.when(F.col(gone).isNotNull(), _without(F.col(text), F.col(gone))).otherwise(F.col(text)).alias(c) if c == text else F.col(c) for c in docs.columns])
