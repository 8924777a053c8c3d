"""Benchmark decontamination with training suffix arrays.

Each shard of training documents (a few megabytes of text) gets a suffix array
over its words. Every test suffix of the benchmark is binary-searched in it;
what it finds are the verbatim matches and their places, and neighbouring
finds on one diagonal join into the longest match.

The suffix array is sparse: a suffix whose first words open no test window
can't be found by any search, so it is left out before sorting. The array is
sorted to the depth of a window, which is all that a search can see.

Cost: one pass over the documents for each block of the benchmark and no
shuffle. A block has at most ``block_words`` words, so what is broadcast at a
time is bounded; a larger benchmark takes more passes.

Defined results: a null or wordless text has no words and no hits; items
without words are never found; an item with a null id marks hits but is not
listed; rows with equal ids are judged separately; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import kit

WIDTH = 10
BLOCK_WORDS = 1_000_000
_PROBE = 4
_STEP = np.uint64(0x9E3779B97F4A7C15)

SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
MATCHES = T.ArrayType(
    T.StructType([T.StructField("item_id", T.StringType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType())])
)


@dataclass(frozen=True)
class TestBlock:
    """The test suffixes of some benchmark items, cut to windows."""

    vocabulary: np.ndarray  # sorted word hashes
    windows: np.ndarray  # one row of word numbers per distinct window, 0 after its end
    lengths: np.ndarray
    probes: np.ndarray  # sorted keys of the windows' first words
    probe_words: int
    first_owner: np.ndarray  # owners of window i: first_owner[i] .. first_owner[i + 1]
    owner_item: np.ndarray
    owner_offset: np.ndarray
    item_ids: list[str | None]


def _keys(ids: np.ndarray, width: int) -> np.ndarray:
    """A key of each run of width word numbers; equal runs have equal keys."""
    n = max(0, len(ids) - width + 1)
    key = np.zeros(n, np.uint64)
    for j in range(width):
        key = key * _STEP + ids[j : j + n].astype(np.uint64) + np.uint64(1)
    return kit.mixed(key)


def test_block(items: list[tuple[object, str | None]], width: int = WIDTH) -> TestBlock:
    """Windows of the items' words: each run of width words, or the whole of a shorter item."""
    words, counts = kit.word_hashes([None if t is None else t.encode() for _, t in items], kit.WORDLIKE, lower=True)
    vocabulary, ids = np.unique(words, return_inverse=True)
    ids = np.concatenate([ids.astype(np.uint32) + 1, np.zeros(width, np.uint32)])
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.empty(0, np.int64)
    n_windows = np.where(counts == 0, 0, np.maximum(1, counts - width + 1))
    item = np.repeat(np.arange(len(counts)), n_windows)
    offset = np.arange(n_windows.sum()) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    length = np.minimum(width, counts[item])
    rows = ids[(first[item] + offset)[:, None] + np.arange(width)]
    rows[np.arange(width) >= length[:, None]] = 0
    windows, which = np.unique(rows, axis=0, return_inverse=True) if len(rows) else (rows.reshape(0, width), np.empty(0, np.int64))
    order = np.argsort(which, kind="stable")
    lengths = (windows > 0).sum(axis=1)
    probe_words = int(min(_PROBE, lengths.min())) if len(lengths) else _PROBE
    probes = np.unique(np.concatenate([_keys(w[:probe_words], probe_words) for w in windows])) if len(windows) else np.empty(0, np.uint64)
    return TestBlock(
        vocabulary, windows, lengths, probes, probe_words, np.searchsorted(which[order], np.arange(len(windows) + 1)), item[order], offset[order],
        [None if i is None else str(i) for i, _ in items],
    )


def _members(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each value is among the sorted ones, and where."""
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return (sorted_values[at] == values) if len(sorted_values) else np.zeros(len(values), bool), at


def _packed(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort in the same order."""
    rows = np.ascontiguousarray(rows.astype(">u4"))
    return rows.view(f"S{4 * rows.shape[1]}").ravel()


def occurrences(words: np.ndarray, counts: np.ndarray, block: TestBlock) -> tuple[np.ndarray, np.ndarray]:
    """Places (in words) at which windows of the block occur in a shard, and which windows."""
    empty = np.empty(0, np.int64), np.empty(0, np.int64)
    width = block.windows.shape[1]
    if not len(block.windows) or not len(words):
        return empty
    known, at = _members(block.vocabulary, words)
    ids = np.where(known, at + 1, 0).astype(np.uint32)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(len(words))  # words to the document's end
    opens, _ = _members(block.probes, _keys(ids, block.probe_words))
    suffixes = np.flatnonzero(opens)
    suffixes = suffixes[left[suffixes] >= block.probe_words]
    if not len(suffixes):
        return empty
    depth = np.arange(width)
    rows = np.concatenate([ids, np.zeros(width, np.uint32)])[suffixes[:, None] + depth]
    rows[depth >= left[suffixes][:, None]] = 0
    keys = _packed(rows)
    order = np.argsort(keys, kind="stable")
    keys, suffixes = keys[order], suffixes[order]
    lo = np.searchsorted(keys, _packed(block.windows), "left")
    last = np.where(depth >= block.lengths[:, None], np.uint32(0xFFFFFFFF), block.windows)
    n = np.searchsorted(keys, _packed(last), "right") - lo
    found = np.repeat(np.arange(len(n)), n)
    rank = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return suffixes[rank], found


def _by_document(place: np.ndarray, window: np.ndarray, counts: np.ndarray, block: TestBlock) -> dict[int, tuple[list, list]]:
    """For each document with hits: merged word spans, and the longest match with each item."""
    ends = np.cumsum(counts)
    starts = ends - counts
    delta = np.bincount(place, minlength=ends[-1] + 1) - np.bincount(place + block.lengths[window], minlength=ends[-1] + 1)
    hit = np.concatenate([[0], (np.cumsum(delta)[:-1] > 0).astype(np.int8), [0]])
    edge = np.diff(hit)
    span_a, span_b = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out: dict[int, tuple[list, list]] = {}
    # A run of covered words may touch the next document's: cut it there.
    for a, b in zip(span_a.tolist(), span_b.tolist(), strict=True):
        while a < b:
            d = int(np.searchsorted(ends, a, "right"))
            end = min(b, int(ends[d]))
            out.setdefault(d, ([], []))[0].append((a - int(starts[d]), end - int(starts[d])))
            a = end
    n = block.first_owner[window + 1] - block.first_owner[window]
    owner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.first_owner[window], n)
    place, window = np.repeat(place, n), np.repeat(window, n)
    item, diagonal, doc = block.owner_item[owner], place - block.owner_offset[owner], np.searchsorted(ends, place, "right")
    order = np.lexsort((place, diagonal, item, doc))
    place, window, item, diagonal, doc = place[order], window[order], item[order], diagonal[order], doc[order]
    new = np.ones(len(place), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] != diagonal[:-1]) | (place[1:] != place[:-1] + 1)
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, len(place))) - 1 + block.lengths[window[at]]
    best = np.lexsort((place[at], -length, item[at], doc[at]))
    seen = None
    for r in best.tolist():
        pair = (int(doc[at[r]]), int(item[at[r]]))
        if pair != seen:
            seen = pair
            out[pair[0]][1].append((block.item_ids[pair[1]], int(place[at[r]] - starts[pair[0]]), int(length[r])))
    return out


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _one_pass(docs: DataFrame, text: str, block_of, names: tuple[str, str, str], first: bool) -> DataFrame:
    schema = T.StructType([*docs.schema.fields, *([T.StructField(names[0], T.LongType()), T.StructField(names[1], SPANS), T.StructField(names[2], MATCHES)] if first else [])])
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    match_type = pa.list_(pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = block_of.value
        for batch in batches:
            for part, texts in kit.cut(batch, text):
                words, counts = kit.word_hashes(texts, kit.WORDLIKE, lower=True)
                place, window = occurrences(words, counts, block)
                found = _by_document(place, window, counts, block) if len(place) else {}
                if first:
                    spans, matches = [[] for _ in texts], [[] for _ in texts]
                else:
                    spans = [[(s["start"], s["end"]) for s in x] for x in part.column(names[1]).to_pylist()]
                    matches = [[(m["item_id"], m["start"], m["length"]) for m in x] for x in part.column(names[2]).to_pylist()]
                for d, (s, m) in found.items():
                    spans[d], matches[d] = _merged(spans[d] + s), matches[d] + m
                own = [
                    pa.array([[{"start": a, "end": b} for a, b in x] for x in spans], span_type),
                    pa.array([[{"item_id": i, "start": a, "length": n} for i, a, n in x] for x in matches], match_type),
                ]
                kept = [c for c, f in zip(part.columns, part.schema, strict=True) if f.name not in names]
                fields = [f for f in part.schema if f.name not in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(counts, pa.int64()), *own], [*(f.name for f in fields), *names])

    return docs.mapInArrow(work, schema)


def find_matches(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", width: int = WIDTH, block_words: int = BLOCK_WORDS) -> tuple[DataFrame, tuple[str, str, str]]:
    """docs with three more columns: number of words, merged hit spans (in words), longest match with each item.

    Returns the DataFrame and the names of those columns, chosen so that they clash with none of docs.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // (block_words * 6)))
    names = tuple(kit.free_name(docs, n) for n in ("n_words", "hit_spans", "matches"))
    out = docs
    for b in range(n_blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == b).collect()
        block = spark.sparkContext.broadcast(test_block([(r["item"], r["text"]) for r in rows], width))
        out = _one_pass(out, text, block, names, first=b == 0)
        if b % 4 == 3 and b + 1 < n_blocks:
            out = kit.written(out, "decontaminate")
    return out, names


def report(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row per document: words, hit words, sorted ids of the items found, longest matches, verdict."""
    found, (n_words, spans, matches) = find_matches(docs.select(doc_id, text), benchmark, text=text, **options)
    return found.select(
        F.col(doc_id),
        F.col(n_words).alias("n_words"),
        F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]).alias("n_hit"),
        F.sort_array(F.array_distinct(F.filter(F.transform(matches, lambda m: m["item_id"]), lambda i: i.isNotNull()))).alias("item_ids"),
        F.col(matches).alias("matches"),
        (F.size(spans) > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """docs without those that hold a benchmark window."""
    found, names = find_matches(docs, benchmark, text=text, **options)
    return found.where(F.size(names[1]) == 0).drop(*names)
