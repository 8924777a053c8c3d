"""Substring deduplication by counted Rabin-Karp windows.

Every run of ``width`` words of every text gets a Rabin-Karp key of 96 bits: a
64-bit hash, and 32 bits of a second one over other codes of the words. Among
10^13 windows (100 TB) less than one in a thousand such corpora holds two that
share a key; a 64-bit hash alone would be shared by some millions. Words with
one 64-bit code (some hundred pairs among 10^11 different words) count as equal,
which matters only where the other words of a window are the same.
A shard (some megabytes of text) keeps each hash once, with the smallest
document that starts it there, and deals the hashes out to buckets as packed
arrays. The bucket counts the shards' entries of a hash; all but the one with
the smallest document are repeats. What repeats goes back to its document as a
list of hashes, and the document's repeated windows merge into maximal removal
intervals.

Scale: 12 bytes a word cross the network once (document numbers are byte planes
that compress), a window that fills a third of the corpus reaches its bucket
once per shard, and buckets and their tasks grow in number with the corpus.

Defined results: a null text has no words; texts shorter than a window lose
nothing; a null doc_id counts as larger than any other; rows that share a
doc_id count as one document and don't remove each other's windows, though
repeats inside one row go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import kit

WIDTH = 20
#: Bytes of text whose windows are reduced together before the shuffle.
SHARD_BYTES = 6 << 20
#: Bytes of entries that a shard hands on together.
HANDED_ON = 1 << 20
#: Bytes of text for each bucket, the fewest buckets, and buckets in a task. The number of buckets follows the input.
BUCKET_BYTES, LEAST_BUCKETS, TOGETHER = 16 << 20, 256, 4
_REPEATS = "doc long, hashes binary"


#: Turns the words' codes into others, for the second hash of a window.
_OTHER = np.uint64(0xA0761D6478BD642F)


def _window_keys(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of every run of width words: 64 bits, and 32 bits over other codes."""
    check = kit.window_hashes(kit.mixed(words ^ _OTHER), width) >> np.uint64(32)
    return kit.window_hashes(words, width), check.astype(np.uint32)


def _doc_windows(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys (hash, check) of all texts' windows, the text of each, and the word counts."""
    words, counts = kit.word_hashes(texts)
    hashes, checks = _window_keys(words, width)
    doc = np.repeat(np.arange(len(counts)), counts)[: len(hashes)]
    inside = np.repeat(np.cumsum(counts), counts)[: len(hashes)] - np.arange(len(hashes)) >= width
    return hashes[inside], checks[inside], doc[inside], counts


def _packed(hashes: np.ndarray, checks: np.ndarray) -> bytes:
    return hashes.tobytes() + checks.tobytes()


def _unpacked(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of several packed pieces, one after the other."""
    sizes = [len(x) // 12 for x in pieces]
    hashes = [np.frombuffer(x, np.uint64, n) for x, n in zip(pieces, sizes, strict=True)]
    checks = [np.frombuffer(x, np.uint32, n, 8 * n) for x, n in zip(pieces, sizes, strict=True)]
    return np.concatenate(hashes or [np.empty(0, np.uint64)]), np.concatenate(checks or [np.empty(0, np.uint32)])


def _as_before(hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """Which keys equal the one before them."""
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (checks[1:] == checks[:-1])
    return same


def _planes(values: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, so that equal high bytes lie together and compress."""
    return np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<i8").ravel()


def _ordered(hashes: np.ndarray, *then: np.ndarray) -> np.ndarray:
    """Positions in order of hashes, equal ones by the other columns; only hashes that repeat are sorted by these."""
    order = np.argsort(hashes)
    h = hashes[order]
    same = h[1:] == h[:-1]
    tied = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False)) if len(h) else np.empty(0, np.int64)
    order[tied] = order[tied][np.lexsort((*(x[order[tied]] for x in reversed(then)), h[tied]))]
    return order


def _entries(hashes: np.ndarray, checks: np.ndarray, docs: np.ndarray, buckets: int, salt: int) -> Iterator[dict]:
    """A shard's rows: its smallest document of each key by bucket, and what it has already found to repeat.

    Arrays are replaced one by one, so that a shard is held little more than once.
    """
    order = _ordered(hashes, checks, docs)
    hashes = hashes[order]
    checks = checks[order]
    docs = docs[order]
    del order
    same = _as_before(hashes, checks)
    start, again = np.flatnonzero(~same), np.flatnonzero(same)
    # Later windows of the smallest document are its own affair; later documents are repeats.
    again = again[docs[again] != docs[again - 1]]
    again = again[docs[again] != docs[start[np.searchsorted(start, again, "right") - 1]]]
    if len(again):
        yield {"bucket": salt % buckets, "decided": True, "hashes": _planes(hashes[again]), "checks": checks[again].tobytes(), "docs": _planes(docs[again])}
    hashes = hashes[start]
    checks = checks[start]
    docs = docs[start]
    del same, start, again
    # By the leading bits, so that the high bytes of a bucket's hashes are alike and compress; a bucket's keys lie together.
    first = ((np.arange(buckets, dtype=np.uint64) << np.uint64(32)) + np.uint64(buckets - 1)) // np.uint64(buckets) << np.uint64(32)
    bounds = np.append(np.searchsorted(hashes, first), len(hashes))
    for bucket in np.flatnonzero(np.diff(bounds)).tolist():
        own = slice(bounds[bucket], bounds[bucket + 1])
        order = np.argsort(docs[own], kind="stable")
        yield {"bucket": bucket, "decided": False, "hashes": _planes(hashes[own][order]), "checks": checks[own][order].tobytes(), "docs": _planes(docs[own][order])}


_ENTRY = pa.schema([("bucket", pa.int64()), ("decided", pa.bool_()), ("hashes", pa.binary()), ("checks", pa.binary()), ("docs", pa.binary())])


def _batches(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
    """Rows of _entries in batches of about HANDED_ON bytes."""
    some, held = [], 0
    for row in rows:
        some.append(row)
        held += sum(len(row[c]) for c in ("hashes", "checks", "docs"))
        if held >= HANDED_ON:
            yield pa.RecordBatch.from_pylist(some, _ENTRY)
            some, held = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, _ENTRY)


def _taken(pieces: list[np.ndarray]) -> np.ndarray:
    """The pieces in one array; the list is empty then."""
    out = np.concatenate(pieces)
    pieces.clear()
    return out


def _shard_entries(width: int, buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, checks, docs, held = [], [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            salt = next((int(x[0] >> np.uint64(8)) for x in hashes if len(x)), 0)
            if hashes:
                yield from _batches(_entries(_taken(hashes), _taken(checks), _taken(docs), buckets, salt))

        for batch in batches:
            for part, texts in kit.cut(batch, "text"):
                h, c, doc, _ = _doc_windows(texts, width)
                hashes.append(h)
                checks.append(c)
                docs.append(part.column("doc").to_numpy(zero_copy_only=False)[doc])
                del h, c, doc
                held += sum(len(t or b"") for t in texts)
                if held >= SHARD_BYTES:
                    yield from flush()
                    held = 0
        yield from flush()

    return kit.giving_back(work)


def _by_doc(hashes: np.ndarray, checks: np.ndarray, docs: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(docs, kind="stable")
    hashes, checks, docs = hashes[order], checks[order], docs[order]
    at = np.flatnonzero(np.diff(docs, prepend=docs[:1] - 1)) if len(docs) else np.empty(0, np.int64)
    ends = [*at[1:].tolist(), len(docs)]
    return pa.RecordBatch.from_arrays(
        [pa.array(docs[at], pa.int64()), pa.array([_packed(hashes[a:b], checks[a:b]) for a, b in zip(at.tolist(), ends, strict=len(at) > 0)], pa.binary())], ["doc", "hashes"]
    )


def _bucket_repeats(table: pa.Table) -> pa.Table:
    """All entries of a bucket but the smallest document of each key, by document."""

    def entries(decided: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        part = table.filter(pc.equal(table.column("decided"), decided)).select(["hashes", "checks", "docs"])
        n = (pc.sum(pc.binary_length(part.column("checks"))).as_py() or 0) // 4
        hashes, checks, docs, at = np.empty(n, np.int64), np.empty(n, np.uint32), np.empty(n, np.int64), 0
        for row in range(part.num_rows):  # piece by piece into their places
            h, c, d = (column[row].as_buffer() for column in part.columns)
            to = slice(at, at := at + len(c) // 4)
            hashes[to], checks[to], docs[to] = _from_planes(h), np.frombuffer(c, np.uint32), _from_planes(d)
        return hashes.view(np.uint64), checks, docs

    h, c, d = entries(False)
    if len(h):
        order = _ordered(h, c)
        h = h[order]
        c = c[order]
        d = d[order]
        del order
        start = np.flatnonzero(~_as_before(h, c))
        later = d != np.repeat(np.minimum.reduceat(d, start), np.diff(np.append(start, len(h))))
        h, c, d = h[later], c[later], d[later]
    out = [np.concatenate(x) for x in zip(entries(True), (h, c, d), strict=True)]
    return pa.Table.from_batches([_by_doc(*out)])


def _number(doc_id: str, text: str):
    """A row's document number: its id, or a large one by its text."""
    return F.coalesce(F.col(doc_id).cast("long"), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text), 2))


def repeated_windows(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc, hashes): for each document the windows that also start in a smaller document, as packed keys."""
    pairs = docs.select(_number(doc_id, text).alias("doc"), F.col(text).alias("text"))
    size = pairs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(max(LEAST_BUCKETS, size // BUCKET_BYTES))
    entries = pairs.mapInArrow(_shard_entries(width, buckets), "bucket long, decided boolean, hashes binary, checks binary, docs binary")
    found = entries.repartition(buckets // TOGETHER, "bucket").groupBy("bucket").applyInArrow(_bucket_repeats, _REPEATS)
    return found.groupBy("doc").agg(F.collect_list("hashes").alias("hashes"))


def _intervals(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _among(hashes: np.ndarray, checks: np.ndarray, other_hashes: np.ndarray, other_checks: np.ndarray) -> np.ndarray:
    """Which keys are among the others."""
    h, c = np.concatenate([hashes, other_hashes]), np.concatenate([checks, other_checks])
    order = _ordered(h, c)
    run = np.empty(len(h), np.int64)
    run[order] = np.cumsum(~_as_before(h[order], c[order]))
    asked = np.zeros(len(h) + 1, bool)
    asked[run[len(hashes) :]] = True
    return asked[run[: len(hashes)]]


def removed_words(texts: list[bytes | None], repeats: list[list[bytes] | None], width: int) -> Iterator[tuple[int, np.ndarray | None]]:
    """For each text its number of words and which of them are covered by a repeated window (None: none are)."""
    hashes, checks, doc, counts = _doc_windows(texts, width)
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    # The first start of each window inside its own text; the others repeat it.
    order = _ordered(hashes, checks, doc, np.arange(len(hashes)))
    again = np.zeros(len(hashes), bool)
    if len(hashes):
        again[order[1:]] = _as_before(hashes[order], checks[order])[1:] & (doc[order[1:]] == doc[order[:-1]])
    for i, n in enumerate(counts.tolist()):
        own = slice(bounds[i], bounds[i + 1])
        gone = again[own]
        if repeats[i] and len(gone):
            gone = gone | _among(hashes[own], checks[own], *_unpacked(repeats[i]))
        if not gone.any():
            yield n, None
            continue
        at = np.flatnonzero(gone)
        delta = np.bincount(at, minlength=n + 1) - np.bincount(at + width, minlength=n + 1)
        yield n, np.cumsum(delta)[:n] > 0


def kept_words(text: bytes, removed: np.ndarray | None) -> bytes:
    """The words that stay, joined by one space."""
    words = text.split()
    if removed is not None:
        a, b = _intervals(~removed)
        words = [w for x, y in zip(a.tolist(), b.tolist(), strict=True) for w in words[x:y]]
    return b" ".join(words)


def _joined(docs: DataFrame, doc_id: str, text: str, width: int) -> tuple[DataFrame, str]:
    name = kit.free_name(docs, "repeats")
    found = kit.written(repeated_windows(docs, doc_id=doc_id, text=text, width=width), "repeats")
    key = kit.free_name(docs, "repeats_doc")
    found = found.select(F.col("doc").alias(key), F.col("hashes").alias(name))
    return docs.join(found, _number(doc_id, text) == F.col(key), "left").drop(key), name


def removal_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: n_words, n_removed, removal intervals [start, end) in words, hash of the kept words."""
    joined, name = _joined(docs.select(doc_id, text), doc_id, text, width)
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kit.cut(batch, text):
                rows = []
                for t, (n, gone) in zip(texts, removed_words(texts, part.column(name).to_pylist(), width), strict=True):
                    a, b = _intervals(gone) if gone is not None else ((), ())
                    rows.append((n, int(gone.sum()) if gone is not None else 0, [{"start": int(x), "end": int(y)} for x, y in zip(a, b, strict=True)], hashlib.sha256(kept_words(t or b"", gone)).hexdigest()))
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([part.column(doc_id), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], span), pa.array(cols[3])], [doc_id, "n_words", "n_removed", "removed", "kept_sha256"])

    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([docs.schema[doc_id], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed", spans), T.StructField("kept_sha256", T.StringType())])
    return joined.mapInArrow(kit.giving_back(work), schema)


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """docs with repeated passages cut out of their texts; texts that lose nothing stay as they are, those that lose every word go."""
    joined, name = _joined(docs, doc_id, text, width)
    columns = docs.columns
    at = columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kit.cut(batch, text):
                new, alive = [], []
                for t, (_, gone) in zip(texts, removed_words(texts, part.column(name).to_pylist(), width), strict=True):
                    new.append(t if gone is None else kept_words(t, gone))
                    alive.append(gone is None or not gone.all())
                cols = [c for c, f in zip(part.columns, part.schema, strict=True) if f.name != name]
                cols[at] = pa.array(new, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(cols, columns).filter(pa.array(alive))

    return joined.mapInArrow(kit.giving_back(work), docs.schema)
