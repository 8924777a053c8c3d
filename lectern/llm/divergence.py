"""Source divergence audit: how far the term distributions of the groups (language, source) lie apart.

Term counts by group are a matrix for each language: rows are groups, columns
the language's kept terms. It is cut into column blocks of about ``COLUMNS``
terms and bands of ``BAND`` groups; each pair of bands of a block is one task.

1. *Tree.* A task holds the block as a K2 tree: a quadtree with k = 2 whose
   levels are bitmaps (a bit for each quadrant of a quadrant that isn't empty)
   down to leaves of ``LEAF`` x ``LEAF`` cells.
2. *Joint walk.* For all pairs of row quadrants over the same columns the tree
   is walked at both places at once. Where both quadrants are empty the walk
   stops: two absent terms give a pair of groups the same price everywhere, so
   all such cells together are priced by one product, for the language as a
   whole.
3. *Leaves.* Only leaves with a term on one side are computed, as what they
   add to that price. Sums of blocks are exact integers and are added by Spark.

Terms are counted before they are shuffled, so a hot source or a common term is
a row for each task at most. A group's cells are dealt by term, so no task
holds a group.

Defined results: null text, lang and source count as ''; a group without terms
has counts of zero; a language without kept terms gives its pairs value 0 and no
terms; a source that is alone in its language has no pairs; an empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm import kit, spans

#: Terms are runs of ASCII letters and anything beyond ASCII.
TERM = kit.word_class(bytes(b for b in range(0x80) if not chr(b).isalpha()))
CHUNK = 6 << 20
#: Rows that a task hands on at once.
ROWS = 1 << 16
LEAST_DOCS, TOP_TERMS, SCALE = 10, 10, 1_000_000_000
COLUMNS, BAND, LEAF = 1024, 256, 32


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        kinds = {g: i for i, g in enumerate(dict.fromkeys(names))}
        listed = list(kinds)
        group_of = np.array([kinds[g] for g in names], np.int64)
        # One row without a term for each group, so that groups without terms are known.
        yield _rows(listed, np.arange(len(listed)), pa.nulls(len(listed), pa.string()), np.zeros(len(listed), np.int64), np.zeros(len(listed), np.int64))
        for data, bounds, first in spans.buffers(kit.column_bytes(batch, "text"), CHUNK):
            starts, ends = spans.word_spans(data, TERM)
            if not len(starts):
                continue
            doc = np.searchsorted(bounds, starts, "right") - 1
            ids, words = spans.numbered(spans.slices(data, starts, ends))
            wide = len(words)
            by_doc, n = spans.summed(doc * wide + ids, np.ones(len(ids)))
            key, total, docs = spans.summed(group_of[first + by_doc // wide] * wide + by_doc % wide, n, np.ones(len(n)))
            for lo in range(0, len(key), ROWS):
                some = slice(lo, lo + ROWS)
                yield _rows(listed, key[some] // wide, spans.as_text(words.take(pa.array(key[some] % wide))), total[some], docs[some])


def _rows(groups: list[tuple[str, str]], at: np.ndarray, terms: pa.Array, n: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    lang, source = (pa.array([g[i] for g in groups], pa.string()).take(pa.array(at)) for i in (0, 1))
    return pa.RecordBatch.from_arrays([lang, source, terms, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], ["lang", "source", "term", "n", "docs"])


def term_counts(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each group; a row with a null term for each group."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = docs.select(blank(lang).alias("lang"), blank(source).alias("source"), blank(text).alias("text"))
    rows = rows.mapInArrow(_counts, "lang string, source string, term string, n long, docs long")
    return rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class Tree:
    """A K2 tree over cells (row, column, value): bitmaps level by level, dense leaves."""

    def __init__(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n_rows: int, n_columns: int):
        self.row_blocks = max(1, -(-n_rows // LEAF))
        self.height = max(0, int(np.ceil(np.log2(max(n_rows, n_columns, 1) / LEAF))))
        r, c = rows // LEAF, columns // LEAF
        paths = np.zeros(len(rows), np.int64)
        for level in range(self.height - 1, -1, -1):
            paths = paths * 4 + 2 * (r >> level & 1) + (c >> level & 1)
        leaves, leaf = np.unique(paths, return_inverse=True)
        #: bits[l]: for each quadrant of level l that isn't empty, which of its four parts aren't; ranks number these.
        self.bits, self.ranks = [], []
        for level in range(self.height):
            nodes, parts = np.unique(leaves >> 2 * (self.height - level)), np.unique(leaves >> 2 * (self.height - level - 1))
            bits = np.zeros(4 * len(nodes), bool)
            bits[4 * np.searchsorted(nodes, parts >> 2) + (parts & 3)] = True
            self.bits.append(bits)
            self.ranks.append(np.cumsum(bits) - 1)
        self.cells = np.zeros((len(leaves), LEAF, LEAF), np.int64)
        self.cells[leaf, rows % LEAF, columns % LEAF] = values
        self.any = len(leaves) > 0

    def part(self, level: int, node: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The parts of nodes of a level (-1: empty)."""
        at = 4 * np.maximum(node, 0) + which
        return np.where((node >= 0) & self.bits[level][at], self.ranks[level][at], -1)

    def pairs(self) -> tuple[np.ndarray, ...]:
        """(leaf, leaf, row block, row block) of all pairs of row blocks a <= b with a leaf on one side at least, over the same columns."""
        start = 0 if self.any else -1
        x, y, a, b = (np.array([v], np.int64) for v in (start, start, 0, 0))
        if not self.any:
            return x[:0], y[:0], a[:0], b[:0]
        for level in range(self.height):
            found = []
            for up in range(2):
                for down in range(2):
                    for side in range(2):
                        p, q = self.part(level, x, np.full_like(x, 2 * up + side)), self.part(level, y, np.full_like(y, 2 * down + side))
                        row, other = 2 * a + up, 2 * b + down
                        # Row blocks beyond the last group are padding.
                        keep = ((p >= 0) | (q >= 0)) & (row <= other) & (other << (self.height - level - 1) < self.row_blocks)
                        found.append(np.stack([p, q, row, other])[:, keep])
            x, y, a, b = np.concatenate(found, axis=1)
        return x, y, a, b


def _divergences(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, zero: np.ndarray, n_columns: int) -> np.ndarray:
    """For each pair of groups a < b what the terms that one of them has add to the price of absent terms.

    zero: each group's p of an absent term.
    """
    n = len(zero)
    tree = Tree(rows, columns, values, n, n_columns)
    wide = -(-n // LEAF) * LEAF
    base = np.ones(wide, np.int64)
    base[:n] = zero
    out = np.zeros((wide, wide), np.int64)
    empty = np.zeros((LEAF, LEAF), np.int64)
    side = lambda leaf, block: _filled(tree.cells[leaf] if leaf >= 0 else empty, base[block * LEAF : (block + 1) * LEAF])
    for x, y, a, b in zip(*(v.tolist() for v in tree.pairs()), strict=True):
        p, q = side(x, a)[:, None, :], side(y, b)[None, :, :]
        p0, q0 = base[a * LEAF : (a + 1) * LEAF][:, None], base[b * LEAF : (b + 1) * LEAF][None, :]
        part = ((p - q) ** 2 // (p + q)).sum(axis=2) - LEAF * ((p0 - q0) ** 2 // (p0 + q0))
        out[a * LEAF : (a + 1) * LEAF, b * LEAF : (b + 1) * LEAF] += part
    return out[:n, :n]


def _filled(cells: np.ndarray, base: np.ndarray) -> np.ndarray:
    return np.where(cells > 0, cells, base[:, None])


def _block(key: tuple, table: pa.Table) -> pa.Table:
    """Sums of the pairs of groups of two bands over one block of columns."""
    lang, _, first, second = (k.as_py() for k in key)
    g, p = table.column("g").to_numpy(), table.column("p").to_numpy()
    known = table.column("term").is_valid().to_numpy()
    order = np.argsort(g[~known], kind="stable")
    groups, zero = g[~known][order], p[~known][order]
    ids, terms = spans.numbered(table.column("term").combine_chunks().filter(pa.array(known)))
    # Common terms first, so that the cells that exist lie together and large quadrants are empty.
    common = np.bincount(ids, minlength=len(terms))
    place = np.empty(len(terms), np.int64)
    place[np.argsort(-common, kind="stable")] = np.arange(len(terms))
    delta = _divergences(np.searchsorted(groups, g[known]), place[ids], p[known], zero, len(terms))
    a, b = np.triu_indices(len(groups), 1)
    band = groups // BAND
    # Pairs within a band come from the task of that band alone.
    keep = (np.minimum(band[a], band[b]) == first) & (np.maximum(band[a], band[b]) == second)
    a, b = a[keep], b[keep]
    absent = (zero[a] - zero[b]) ** 2 // (zero[a] + zero[b])
    columns = {"a": groups[a], "b": groups[b], "delta": delta[a, b], "absent": absent}
    return pa.table({"lang": pa.array([lang] * len(a), pa.string()), **{k: pa.array(v, pa.int64()) for k, v in columns.items()}})


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), exact beyond 64 bits."""
    wide = lambda c: c.cast("decimal(20,0)")
    return F.lit(1).cast("long") + F.call_function("div", (wide(n) + F.lit(2)) * F.lit(SCALE), wide(total) + F.lit(2) * wide(terms))


def _gap(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def audit(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = LEAST_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): each group's distance to the other sources of its language, and its most telling terms."""
    counts = kit.written(term_counts(docs, text=text, lang=lang, source=source), "term-counts")
    terms = counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= least_docs)
    terms = kit.written(terms.select("lang", "term", "total"), "terms")
    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    cells = kit.written(counts.where("term is not null").select("lang", "source", "term", "n").join(terms, ["lang", "term"]), "cells")
    groups = counts.where("term is null").select("lang", "source").join(cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n")), ["lang", "source"], "left").join(sizes, "lang", "left")
    of_lang = Window.partitionBy("lang")
    groups = groups.select("lang", "source", F.coalesce("group_n", F.lit(0)).alias("group_n"), F.coalesce("v", F.lit(0)).alias("v"), F.coalesce("lang_n", F.lit(0)).alias("lang_n"), (F.row_number().over(of_lang.orderBy("source")) - 1).cast("long").alias("g"), F.count("*").over(of_lang).alias("n_groups"))
    groups = kit.written(groups, "groups").withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("v") / COLUMNS)).cast("int")).withColumn("bands", F.ceil(F.col("n_groups") / BAND).cast("int"))
    priced = cells.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("group_n"), F.col("v")))
    return _told(_pairs(priced, groups), groups).unionByName(_terms(priced, top))


def _pairs(priced: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, a, b, value) for the groups a < b of each language, by number."""
    own = (F.col("g") / BAND).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("bands") - 1))
    banded = lambda df: df.select("lang", "block", "g", "term", "p", own.alias("own"), other.alias("other")).select("lang", "block", "g", "term", "p", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"))
    present = banded(priced.withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")))
    # A group's price of an absent term goes to every block; without kept terms nothing is priced and any value will do.
    absent = F.when(F.col("v") > 0, _share(F.lit(0), F.col("group_n"), F.greatest("v", F.lit(1)))).otherwise(F.lit(1))
    base = groups.withColumn("p", absent).withColumn("term", F.lit(None).cast("string")).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = present.unionByName(banded(base))
    found = dealt.groupBy("lang", "block", "first", "second").applyInArrow(_block, "lang string, a long, b long, delta long, absent long")
    return found.groupBy("lang", "a", "b").agg(F.sum("delta").alias("delta"), F.max("absent").alias("absent"))


def _told(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    names = groups.select("lang", "g", "source", "v")
    for end in ("a", "b"):
        pairs = pairs.join(names.select("lang", F.col("g").alias(end), F.col("source").alias(f"of_{end}"), F.col("v").alias(f"v_{end}")), ["lang", end])
    value = F.when(F.col("v_a") > 0, F.col("v_a") * F.col("absent") + F.col("delta")).otherwise(F.lit(0).cast("long"))
    both = F.explode(F.array(F.struct(F.col("of_a").alias("source"), F.col("of_b").alias("item")), F.struct(F.col("of_b").alias("source"), F.col("of_a").alias("item"))))
    rows = pairs.select("lang", value.alias("value"), both.alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def _terms(priced: DataFrame, top: int) -> DataFrame:
    q = _share(F.col("total"), F.col("lang_n"), F.col("v"))
    rows = priced.withColumn("q", q).where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT row, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM u GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
c AS (SELECT u.lang, u.source, u.term, count(*) AS n FROM u JOIN k ON u.lang = k.lang AND u.term = k.term GROUP BY ALL),
s AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM k GROUP BY lang),
g AS (SELECT d.lang, d.source, coalesce(max(s.v), 0) AS v, coalesce(max(s.lang_n), 0) AS lang_n FROM (SELECT DISTINCT lang, source FROM d) d LEFT JOIN s ON d.lang = s.lang GROUP BY ALL),
gn AS (SELECT g.*, coalesce((SELECT sum(n) FROM c WHERE c.lang = g.lang AND c.source = g.source), 0) AS group_n FROM g),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.n, 0) AS n, 1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2)) // (gn.group_n + 2 * gn.v) AS p, 1 + (CAST(1000000000 AS HUGEINT) * (k.total + 2)) // (gn.lang_n + 2 * gn.v) AS q
  FROM gn JOIN k ON gn.lang = k.lang LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 10
"""
