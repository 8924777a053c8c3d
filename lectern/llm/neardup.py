"""Near-duplicate detection with bottom-k sketches of one hash function.

Documents are sets of five-word shingles, hashed to 64 bits. Documents with
equal sets form one class with one number; all further work is on classes. A
sketch is the k smallest hashes of a set.

1. *Inverted lists.* Two sets with Jaccard similarity 0.75 share most of their
   sketches: at least ``least_shared(k)`` values, but for a chance below 1e-6
   (sketches of at most k values are whole sets, where this is certain). So
   each set enters only the lists of its ``k - least_shared(k) + 1`` rarest
   values (the prefix filter); values of passages that many documents share
   fall away. Rarity is a table of 2**20 counters, the same size for any corpus.
2. *Overlaps.* A list of up to ``SHORT`` sets gives its pairs. A longer one
   is compared with its smallest member, its hub, on which a group of copies
   hangs. Long lists with one hub form a group.
3. *Union-sketch estimate.* The k smallest of two sketches together are a
   uniform sample of the union; pairs whose sample lies clearly below the
   threshold are dropped.
4. *Exact check.* The full shingle sets of the remaining pairs are compared.
5. *Groups left apart.* Where a group is not yet one component (many pages of
   one template, say), its members get further lists: by the prefix filter on
   their full sets, which is exact, within bands of set size that narrow it.
   Each member enters as many lists as a part of its own words; what the
   members have in common falls away again. Steps 2 to 4 repeat on these.
   Long lists remain only where many sets have over 0.83 of their shingles in
   common and yet lie below the threshold; their members are compared block by
   block, exactly, and only links that join components come out.

Linked classes become components by minimum label propagation with pointer
jumping, in tables in the shared folder. A number that many rows point to is
looked up through a bounded broadcast, so no task gets all rows of a hub.

Defined results: null and wordless texts have an empty set and stand alone; a
text of one to four words is one shingle; rows with equal ids are judged each
by its own text; a row with a null id belongs to its group but is never its
smallest id, and is kept only if no row of its group has an id.
"""

from __future__ import annotations

import bisect
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import kit

SHINGLE, SKETCH = 5, 64
#: Similar from 100 * intersection >= THRESHOLD * union.
THRESHOLD = 75
SHORT, BLOCK = 12, 128
SLOTS = 1 << 20
#: Sizes of full sets are told apart by bands of this ratio.
BAND = 1.05
#: A number is hot if it has over LEAST_HOT rows and over 1 / MOST_HOT of all rows; so there are at most MOST_HOT hot ones.
LEAST_HOT, MOST_HOT = 256, 10_000


def least_shared(size: int) -> int:
    """Sketch values that similar sets share at least: 5.2 standard deviations below the mean."""
    return max(1, int(0.75 * size - 5.2 * (size * 0.1875) ** 0.5))


def least_estimated(sample: int) -> int:
    """Shared values of a union sample from which a pair goes on to the exact check."""
    return int(0.75 * sample - 5.2 * (sample * 0.1875) ** 0.5)


def shingle_sets(texts: list[bytes | None], width: int = SHINGLE) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words, counts = kit.word_hashes(texts, lower=True)
    windows = kit.window_hashes(words, width)
    at = 0
    for n in counts.tolist():
        if n >= width:
            yield np.unique(windows[at : at + n - width + 1])
        elif n:
            yield kit.window_hashes(words[at : at + n], n)
        else:
            yield np.empty(0, np.uint64)
        at += n


def _sketches(k: int, width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kit.cut(batch, "text"):
                n, same, sketch = [], [], []
                for s in shingle_sets(texts, width):
                    n.append(len(s))
                    same.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sketch.append(s[:k].tobytes())
                yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("digest"), pa.array(n, pa.int64()), pa.array(same, pa.binary()), pa.array(sketch, pa.binary())], ["doc", "digest", "n", "same", "sketch"])

    return work


def sketches(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = SKETCH, width: int = SHINGLE) -> DataFrame:
    """(doc, digest, n, same, sketch): digest of the text, set size, fingerprint of the set, its k smallest hashes packed."""
    pairs = docs.select(F.col(doc_id).cast("long").alias("doc"), kit.text_digest(text).alias("digest"), F.col(text).alias("text"))
    return pairs.mapInArrow(kit.giving_back(_sketches(k, width)), "doc long, digest binary, n long, same binary, sketch binary")


def _slot(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)


def _slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SLOTS, np.int64)
    for batch in batches:
        joined = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
        total += np.bincount(_slot(joined), minlength=SLOTS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["slot", "n"])


def _rarity(reps: DataFrame, what: str = "sketch"):
    """Broadcast counters of packed values: bounded by SLOTS."""
    rows = reps.select(what).mapInArrow(_slot_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    table = np.zeros(SLOTS, np.int64)
    for b in rows.toArrow().to_batches():
        table[b.column(0).to_numpy()] = b.column(1).to_numpy()
    return reps.sparkSession.sparkContext.broadcast(table)


def _prefixes(rarity):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = rarity.value
        for batch in batches:
            out = []
            for raw in batch.column(1).to_pylist():
                s = np.frombuffer(raw, np.uint64)
                common = counts[_slot(s)]
                keep = len(s) - least_shared(len(s)) + 1
                order = np.lexsort((s, common))[:keep]
                # A counter of one is a value that no other set has.
                out.append(s[order[common[order] > 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["doc", "values"])

    return work


def inverted_lists(reps: DataFrame) -> DataFrame:
    """(value, doc) for the rarest sketch values of each set."""
    out = reps.select("doc", "sketch").mapInArrow(_prefixes(_rarity(reps)), "doc long, values array<long>")
    return out.select("doc", F.explode("values").alias("value"))


def _bands(largest: int) -> list[int]:
    """Smallest set size of each band, up to one beyond the largest size."""
    out = [1]
    while out[-1] <= largest:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * BAND)))
    return out


def full_prefixes(values: np.ndarray, counts: np.ndarray, edges: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """List keys of a set, and its side in each (0: both, 1: the larger, 2: the smaller band): a similar set has a key with it.

    values: its hashes, counts: how common each is, edges: the bands. For a pair of bands similar sets share so
    many values at least that both have one of them among their rarest; that value and the bands are the key.
    """
    n = len(values)
    order = np.lexsort((values, counts))
    values, common = values[order], counts[order] > 1
    own = bisect.bisect_right(edges, n) - 1
    keys, sides = [], []
    for other in range(bisect.bisect_right(edges, -(-n * THRESHOLD // 100)) - 1, len(edges) - 1):
        if THRESHOLD * edges[other] > 100 * n:
            break
        shared = -(-THRESHOLD * (edges[own] + edges[other]) // (100 + THRESHOLD))
        prefix = max(0, n - shared + 1)
        bands = np.uint64(max(own, other) << 20 | min(own, other))
        keys.append(kit.mixed(values[:prefix][common[:prefix]] + kit.mixed(np.array([bands]))))
        sides.append(np.full(len(keys[-1]), (own > other) + 2 * (own < other), np.int8))
    return np.concatenate(keys).view(np.int64), np.concatenate(sides)


def _full_prefixes(rarity, edges: list[int]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = rarity.value
        for batch in batches:
            done, keys = 0, []
            for row in range(batch.num_rows):
                s = np.frombuffer(batch.column(1)[row].as_buffer(), np.uint64)
                keys.append(full_prefixes(s, counts[_slot(s)], edges))
                if row + 1 == batch.num_rows or sum(len(k) for k, _ in keys) > 200_000:
                    lists = [pa.array(x, pa.list_(kind)) for x, kind in zip(zip(*keys, strict=True), (pa.int64(), pa.int8()), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(keys)), *lists], ["doc", "values", "sides"])
                    done, keys = row + 1, []

    return work


def full_lists(sets: DataFrame) -> DataFrame:
    """(value, doc, side) for the rarest values of full sets (doc, set), by pairs of bands of set size."""
    largest = (sets.agg(F.max(F.octet_length("set"))).first()[0] or 8) // 8
    out = sets.select("doc", "set").mapInArrow(_full_prefixes(_rarity(sets, "set"), _bands(largest)), "doc long, values array<long>, sides array<byte>")
    return out.select("doc", F.explode(F.arrays_zip("values", "sides")).alias("x")).select("doc", F.col("x.values").alias("value"), F.col("x.sides").alias("side"))


def _banded_pairs(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs across the sides of lists (value, doc, side) of which one side is short; (hub, doc) for the other lists."""
    larger, smaller = F.col("side") != 2, F.col("side") != 1
    sizes = lists.groupBy("value").agg(F.count_if(larger).alias("larger"), F.count_if(smaller).alias("smaller"), F.count("*").alias("size"), F.min("doc").alias("hub"))
    sizes = sizes.where("larger > 0 and smaller > 0 and size > 1").withColumn("turned", F.col("larger") < F.col("smaller"))
    rows = lists.join(sizes, "value")
    brief = rows.where(F.least("larger", "smaller") <= SHORT)
    few = brief.where(F.when(F.col("turned"), larger).otherwise(smaller)).groupBy("value").agg(F.collect_list("doc").alias("few"))
    many = brief.where(F.when(F.col("turned"), smaller).otherwise(larger))
    # At most SHORT pairs for each row of a list.
    pairs = many.join(few, "value").select("doc", F.explode("few").alias("other")).where("doc <> other")
    long = rows.where(F.least("larger", "smaller") > SHORT).select("hub", "doc").distinct()
    return pairs.select(F.least("doc", "other").alias("a"), F.greatest("doc", "other").alias("b")).distinct(), long


def _estimate(x: bytes, y: bytes, k: int) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = np.concatenate([a, b])
    both.sort(kind="mergesort")
    twin = both[1:] == both[:-1]
    # The k smallest of the union; a value that both have counts once.
    rank = np.arange(1, len(both)) - np.cumsum(twin)
    union = len(both) - int(twin.sum())
    if len(a) < k and len(b) < k:  # whole sets: no estimate
        return 100 * int(twin.sum()) >= THRESHOLD * union
    sample = min(k, union)
    return int(twin[rank < sample].sum()) >= least_estimated(sample)


def _estimated(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = [_estimate(a, b, k) for a, b in zip(x, y, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


def _alike(x: bytes, y: bytes) -> bool:
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= THRESHOLD * (len(a) + len(b) - shared)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, x in kit.cut(batch, "set_a"):
            keep = [_alike(a, b) for a, b in zip(x, part.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _full_sets(width: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in kit.cut(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.array([s.tobytes() for s in shingle_sets(texts, width)], pa.binary())], ["doc", "set"])

    return work


def _with(pairs: DataFrame, table: DataFrame, what: str) -> DataFrame:
    """pairs (a, b) with what of both ends."""
    out = pairs
    for end in ("a", "b"):
        out = out.join(table.select(F.col("doc").alias(end), F.col(what).alias(f"{what}_{end}")), end)
    return out.select("a", "b", f"{what}_a", f"{what}_b")


def _likely(pairs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) that the estimate of their union leaves."""
    return kit.written(_with(pairs, reps, "sketch").mapInArrow(kit.giving_back(_estimated(k)), "a long, b long"), "candidates")


def _similar(candidates: DataFrame, sets: DataFrame) -> DataFrame:
    """The candidates (a, b) whose full sets are similar."""
    return kit.written(_with(candidates, sets, "set").mapInArrow(kit.giving_back(_confirmed), "a long, b long"), "links")


def _star(members: DataFrame) -> DataFrame:
    return members.where(F.col("doc") != F.col("hub")).select(F.col("hub").alias("a"), F.col("doc").alias("b"))


def _list_pairs(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs of short lists; (hub, doc) for long ones, where lists with the same smallest member fall together."""
    sizes = lists.groupBy("value").agg(F.count("*").alias("size"), F.min("doc").alias("hub")).where("size > 1")
    rows = lists.join(sizes, "value")
    short = rows.where(F.col("size") <= SHORT).groupBy("value").agg(F.sort_array(F.collect_set("doc")).alias("docs"))
    # A short list has at most SHORT members, so its pairs are bounded by a constant.
    pairs = short.select(F.explode(F.expr("flatten(transform(docs, (x, i) -> transform(slice(docs, i + 2, size(docs)), y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b")
    return pairs.distinct(), rows.where(F.col("size") > SHORT).select("hub", "doc").distinct()


class _Index:
    """Which of some sorted sets hold a value."""

    def __init__(self, sets: list[np.ndarray]):
        lengths = np.array([len(s) for s in sets])
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], np.repeat(np.arange(len(sets)), lengths)[order]
        self.n = len(sets)

    def shared(self, one: np.ndarray) -> np.ndarray:
        """Number of values of one that each set holds."""
        lo, hi = np.searchsorted(self.flat, one, "left"), np.searchsorted(self.flat, one, "right")
        n = hi - lo
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        return np.bincount(self.owner[at], minlength=self.n)

    def up_to(self, most: np.uint64) -> np.ndarray:
        """Number of each set's values that are not above most."""
        return np.bincount(self.owner[: np.searchsorted(self.flat, most, "right")], minlength=self.n)


def _block_links(k: int):
    """Links between the members of two blocks of a group, as few as join their components."""

    def work(table: pa.Table) -> pa.Table:
        docs, labels, side = (table.column(c).to_numpy() for c in ("doc", "label", "block"))
        out: list[tuple[int, int]] = []
        if len(np.unique(labels)) > 1:
            sketch, full = ([np.frombuffer(x, np.uint64) for x in table.column(c).to_pylist()] for c in ("sketch", "set"))
            left, right = (np.flatnonzero(side == table.column(c)[0].as_py()) for c in ("i", "j"))
            root = {x: x for x in labels.tolist()}

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = x = root[root[x]]
                return x

            if len(left) and len(right):
                sketches_of, sets_of = _Index([sketch[r] for r in right]), _Index([full[r] for r in right])
                size, limit = np.array([len(full[r]) for r in right]), np.array([_limit(sketch[r], k) for r in right])
                for x in left.tolist():
                    top = _limit(sketch[x], k)
                    shared = sketches_of.shared(sketch[x])
                    # The union's sample: all values up to the smaller of both sketches' ends.
                    mine = np.searchsorted(sketch[x], limit, "right")
                    sample = np.where(limit <= top, mine + np.array([len(sketch[r]) for r in right]), len(sketch[x]) + sketches_of.up_to(top)) - shared
                    likely = (shared >= 0.75 * sample - 5.2 * np.sqrt(sample * 0.1875)) & (labels[right] != labels[x])
                    if not likely.any():
                        continue
                    both = sets_of.shared(full[x])
                    for y in np.flatnonzero(likely & (100 * both >= THRESHOLD * (len(full[x]) + size - both))).tolist():
                        r, s = find(int(labels[x])), find(int(labels[right[y]]))
                        if r != s:
                            root[max(r, s)] = min(r, s)
                            out.append((int(docs[x]), int(docs[right[y]])))
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return work


def _limit(sketch: np.ndarray, k: int) -> np.uint64:
    """Up to where a sketch knows its set: its last value, or everything if it is the whole set."""
    return sketch[-1] if len(sketch) >= k else np.uint64(0xFFFFFFFFFFFFFFFF)


def _placed(members: DataFrame, labels: DataFrame) -> DataFrame:
    """(hub, doc, label) of the groups that are not one component."""
    placed = members.join(labels, members.doc == labels.node, "left").select("hub", "doc", F.coalesce("label", "doc").alias("label"))
    apart = placed.groupBy("hub").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("size")).where("lo < hi")
    return placed.join(apart.select("hub", "size"), "hub")


def _block_pairs(placed: DataFrame, reps: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """Links inside groups between members that are not yet in one component, by pairs of blocks."""
    rows = placed.withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
    dealt = rows.select("hub", "doc", "label", "block", F.explode(F.expr("sequence(0, blocks - 1)")).alias("with"))
    dealt = dealt.select("hub", "doc", "label", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))
    dealt = dealt.join(reps.select("doc", "sketch"), "doc").join(sets, "doc")
    return dealt.groupBy("hub", "i", "j").applyInArrow(_block_links(k), "a long, b long")


def looked_up(rows: DataFrame, key: str, table: DataFrame, name: str, sizes: DataFrame | None = None) -> DataFrame:
    """rows with the column name: table's value (key, value) for the key, or null; rows must be a written table.

    Hot keys are looked up in a broadcast of at most MOST_HOT rows, the others by a join in which hot rows and
    rows without a key are spread. sizes: (key, count) of the rows, where known.
    """
    limit = max(LEAST_HOT, rows.count() // MOST_HOT)
    sizes = rows.groupBy(F.col(key).alias("key")).count() if sizes is None else sizes
    hot = F.broadcast(sizes.where(F.col("count") > limit).select("key"))
    known = F.broadcast(table.join(hot, "key", "left_semi").select(F.col("key").alias("hot_key"), F.col("value").alias("hot_value"), F.lit(True).alias("is_hot")))
    out = rows.join(known, F.col(key) == F.col("hot_key"), "left")
    elsewhere = F.col(key).isNull() | F.col("is_hot")
    # The table has salt 0 alone, so rows with another find nothing there.
    out = out.withColumn("salt", F.when(elsewhere, 1 + F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 30))).otherwise(F.lit(0)))
    out = out.withColumn("key", F.col(key)).join(table.withColumn("salt", F.lit(0).cast("long")), ["key", "salt"], "left")
    return out.select(*rows.columns, F.coalesce("hot_value", "value").alias(name))


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable over the edges (a, b), for all nodes with an edge.

    Each round every node takes the smallest label among its neighbours, then
    its label's label; rounds grow with the logarithm of the longest path.
    """
    both = kit.written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = kit.written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = looked_up(both, "b", labels.select(F.col("node").alias("key"), F.col("label").alias("value")), "far").groupBy(F.col("a").alias("node")).agg(F.min("far").alias("near"))
        step = kit.written(labels.join(near, "node").select("node", F.least("label", "near").alias("next"), F.col("label").alias("old")), "steps")
        step = looked_up(step, "next", step.select(F.col("node").alias("key"), F.col("next").alias("value")), "far")
        step = kit.written(step.select("node", F.least(F.coalesce("far", "next"), "next").alias("label"), "old"), "labels")
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            return labels


def _judged(docs: DataFrame, doc_id: str, text: str, k: int, width: int) -> DataFrame:
    """(doc, digest, n, component, kept) for every row of docs."""
    rows = kit.written(sketches(docs, doc_id=doc_id, text=text, k=k, width=width), "sketches")
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "digest")).alias("first")
    classes = rows.where("same is not null").groupBy("same").agg(first, F.count("*").alias("copies")).select("same", "copies", F.col("first.doc").alias("rep"), F.col("first.digest").alias("digest"))
    # Numbers rise with the smallest id, so the smallest number of a component has its smallest id.
    classes = kit.written(classes.orderBy(F.col("rep").asc_nulls_last()).withColumn("node", F.monotonically_increasing_id()), "classes")
    of_class = (rows.same == classes.same) & (rows.digest == classes.digest) & rows.doc.eqNullSafe(classes.rep)
    reps = kit.written(rows.join(classes, of_class).dropDuplicates(["node"]).select(F.col("node").alias("doc"), "n", "sketch"), "reps")
    pairs, members = _list_pairs(inverted_lists(reps))
    members = kit.written(members, "members")
    candidates = _likely(pairs.unionByName(_star(members)), reps, k)
    needed = candidates.select(F.explode(F.array("a", "b")).alias("node")).unionByName(members.select(F.col("doc").alias("node"))).distinct()
    needed = classes.join(needed, "node").select("node", "rep", F.col("digest").alias("of"))
    texts = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    # A shuffle join at every size: the number of candidates grows with the corpus.
    found = texts.join(needed.hint("merge"), F.col("id").eqNullSafe(F.col("rep")) & (kit.text_digest("text") == F.col("of"))).select(F.col("node").alias("doc"), "text")
    sets = kit.written(found.dropDuplicates(["doc"]).mapInArrow(kit.giving_back(_full_sets(width)), "doc long, set binary"), "sets")
    edges = _similar(candidates, sets)
    labels = components(edges)
    apart = kit.written(_placed(members, labels), "apart")
    if not apart.isEmpty():
        labels = _joined_groups(apart, labels, edges, reps, sets, k)
    found = kit.written(classes.join(labels, "node", "left").select("node", "same", "rep", F.coalesce("label", "node").alias("label")), "found")
    found = looked_up(found, "label", classes.select(F.col("node").alias("key"), F.col("rep").alias("value")), "component")
    narrow = rows.select("doc", "digest", "n", "same")
    out = looked_up(narrow, "same", found.select(F.col("same").alias("key"), F.col("component").alias("value")), "component", classes.select(F.col("same").alias("key"), F.col("copies").alias("count")))
    out = out.select("doc", "digest", "n", F.when(F.col("same").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component"))
    return out.withColumn("kept", F.coalesce(F.col("doc") == F.col("component"), F.col("component").isNull()))


def _joined_groups(apart: DataFrame, labels: DataFrame, edges: DataFrame, reps: DataFrame, sets: DataFrame, k: int) -> DataFrame:
    """Labels after the members of groups that are not one component have been compared too."""
    own = kit.written(apart.select("doc", "label").distinct(), "own")
    pairs, members = _banded_pairs(full_lists(sets.join(own, "doc", "left_semi")))
    members = kit.written(members, "members")
    pairs = _with(pairs.unionByName(_star(members)), own, "label").where("label_a <> label_b").select("a", "b")
    edges = kit.written(edges.unionByName(_similar(_likely(pairs, reps, k), sets)), "all-links")
    labels = components(edges)
    more = kit.written(_block_pairs(_placed(members, labels), reps, sets, k), "rest")
    return labels if more.isEmpty() else components(edges.unionByName(more))


def near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = SKETCH, width: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    return _judged(docs, doc_id, text, k, width).select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), "kept")


def keep_one(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", k: int = SKETCH, width: int = SHINGLE) -> DataFrame:
    """docs without the rows that near_duplicates doesn't keep; a row is told by its id and text."""
    gone, digest = kit.free_name(docs, "gone"), kit.free_name(docs, "digest")
    verdict = _judged(docs, doc_id, text, k, width).where("not kept").select(F.col("doc").alias(gone), F.col("digest").alias(digest)).distinct()
    return docs.join(verdict, F.col(doc_id).cast("long").eqNullSafe(F.col(gone)) & (kit.text_digest(text) == F.col(digest)), "left_anti")
