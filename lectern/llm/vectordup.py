"""Embedding near-duplicates: a navigable small-world graph for each shard, every shard searched, links verified.

1. *Classes.* Equal vectors form one class with one number; all further work is
   on classes, so copies cost a count. Vectors of different lengths never meet.
2. *Shards.* Classes are dealt by a hash into ``SHARDS`` shards, or more where
   these would be over ``MOST_SHARD`` rows. One task builds a shard's graph (see ``smallworld``) and
   searches it with the shard's own vectors; this gives the links inside the
   shard and its own components.
3. *Searches.* For each pair of shards one task searches the graph of the second
   with all vectors of the first, and counts a link for both its ends. So every
   vector meets every shard once.
4. *Audits.* Before a task searches, some of its queries, and queries planted at
   the link limit beside some vectors of the shard, are also compared with the
   whole shard. The beam is doubled until it finds ``RECALL`` of their links; if
   it would reach a quarter of the shard, the shard is scanned instead.
5. *Dense groups.* A query whose links fill its beam lies in a dense group;
   it is compared with the whole shard in blocks. So no link of a group is lost
   and pairs are counted where they are found; they are never rows of a table.
6. *Cosines* of what a beam holds are checked in double precision.
7. *Components.* A task reports which of its shards' own components meet, once
   each. These edges and those of the shards are united.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing; rows with equal ids are judged each by its own
vector; a row with a null id belongs to its group but is never its smallest id,
and is kept only if no row of its group has an id. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm import kit, neardup
from lectern.llm.smallworld import M0, Graph, M

LINKED = 0.9
#: There are SHARDS shards, fewer where they would be under LEAST_SHARD rows, more where they would be over MOST_SHARD.
SHARDS, LEAST_SHARD, MOST_SHARD = 4, 512, 65_536
BEAM, RECALL, AUDITED = 32, 0.97, 128
#: Queries side by side; rows of a scan.
BLOCK, SCANNED = 256, 64
#: Single precision may be off by so much.
SLACK = 1e-4


def _raw(kind: np.dtype):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, dims, raw = batch.column(1), [], []
            for row in range(batch.num_rows):
                v = vectors[row].values
                one = None if v is None or len(v) == 0 or v.null_count else v.to_numpy(zero_copy_only=False).astype(kind)
                good = one is not None and bool(np.isfinite(one).all() and one.any())
                dims.append(len(one) if good else None)
                # Adding zero turns a negative zero into a positive one.
                raw.append((one + kind.type(0)).tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())], ["vec", "dim", "raw"])

    return work


def units(raw: list[bytes], kind: str) -> np.ndarray:
    """The vectors in double precision, of length one."""
    x = np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Shard:
    """Numbers, copies and unit vectors of a shard, its graph, and the smallest row of each row's component in it."""

    def __init__(self, nodes: np.ndarray, copies: np.ndarray, x: np.ndarray, graph: Graph | None, labels: np.ndarray | None):
        self.nodes, self.copies, self.x, self.graph, self.labels = nodes, copies, x, graph, labels

    def packed(self) -> dict[str, object]:
        sizes = [[at, *np.flatnonzero((e >= 0).any(axis=1) | (at == 0)).tolist()] for at, e in enumerate(self.graph.layers)]
        layers = [(np.array(s[1:], np.int32).tobytes(), self.graph.layers[s[0]][s[1:]].tobytes()) for s in sizes]
        return {"members": [m for m, _ in layers], "edges": [e for _, e in layers], "entry": self.graph.entry}

    @classmethod
    def read(cls, row: dict, kind: str, searched: bool) -> Shard:
        nodes, copies, labels = (np.frombuffer(row[c], np.int64) for c in ("nodes", "copies", "labels"))
        x = units([row["raw"]], kind) if len(nodes) == 1 else None
        if x is None:
            wide = len(row["raw"]) // len(nodes)
            x = units([row["raw"][i : i + wide] for i in range(0, len(row["raw"]), wide)], kind)
        graph = None
        if searched:
            layers = []
            for level, (members, edges) in enumerate(zip(row["members"], row["edges"], strict=True)):
                at, width = np.frombuffer(members, np.int32), M if level else M0
                layer = np.full((len(nodes), width), -1, np.int32)
                layer[at] = np.frombuffer(edges, np.int32).reshape(len(at), width)
                layers.append(layer)
            graph = Graph(x.astype(np.float32), layers, row["entry"])
        return cls(nodes, copies, x, graph, labels)


def _scan(x: np.ndarray, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) of all links, by comparing with every row."""
    for lo in range(0, len(q), SCANNED):
        rows, ids = np.nonzero(q[lo : lo + SCANNED] @ x.T >= LINKED)
        yield rows + lo, ids


def _beamed(shard: Shard, q: np.ndarray, ef: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) of the links that beams of width ef find; dense queries are compared with every row."""
    for lo in range(0, len(q), BLOCK):
        part = q[lo : lo + BLOCK]
        ids, sims = shard.graph.search(part.astype(np.float32), ef)
        dense = sims[:, -1] >= LINKED - SLACK
        rows, at = np.nonzero((sims >= LINKED - SLACK) & ~dense[:, None])
        near = ids[rows, at]
        right = np.einsum("nd,nd->n", part[rows], shard.x[near]) >= LINKED
        yield rows[right] + lo, near[right]
        some = np.flatnonzero(dense)
        for rows, near in _scan(shard.x, part[some]):
            yield some[rows] + lo, near


def _planted(shard: Shard, chosen: np.ndarray) -> np.ndarray:
    """Queries at the link limit from chosen rows, in directions that follow from their numbers."""
    base = shard.x[chosen]
    way = np.random.default_rng(int(shard.nodes[0]) & 0x7FFFFFFF).normal(size=base.shape)
    way -= np.einsum("nd,nd->n", way, base)[:, None] * base
    size = np.sqrt((way * way).sum(axis=1, keepdims=True))
    return (LINKED + 1e-9) * base + np.sqrt(1 - LINKED**2) * way / np.maximum(size, 1e-30)


def beam_width(shard: Shard, q: np.ndarray) -> tuple[int, float]:
    """The narrowest beam (by doubling) that passes the audit, and its recall; 0 if the shard is to be scanned."""
    pick = lambda n: np.unique(np.linspace(0, n - 1, min(AUDITED, n)).astype(np.int64))
    sample = np.concatenate([q[pick(len(q))], _planted(shard, pick(len(shard.x)))])
    wide = len(shard.x)
    true = np.concatenate([rows * wide + ids for rows, ids in _scan(shard.x, sample)])
    ef = BEAM
    while 4 * ef <= wide:
        found = np.concatenate([rows * wide + ids for rows, ids in _beamed(shard, sample, ef)])
        recall = np.isin(true, found).mean() if len(true) else 1.0
        if recall >= RECALL:
            return ef, float(recall)
        ef *= 2
    return 0, 1.0


def links(shard: Shard, q: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, row) of the links of q with the shard, part by part."""
    ef, _ = beam_width(shard, q)
    yield from _beamed(shard, q, ef) if ef else _scan(shard.x, q)


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """label with the components of a and b united; label[x] <= x leads to the smallest row."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        low, high = np.minimum(x[apart], y[apart]), np.maximum(x[apart], y[apart])
        np.minimum.at(label, high, low)
        while (label[label] != label).any():
            label = label[label]


_SHARD = "dim int, shard int, nodes binary, copies binary, raw binary, labels binary, own binary, members array<binary>, edges array<binary>, entry int"


def _build(kind: str):
    def work(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        nodes, copies = (table.column(c).to_numpy().astype(np.int64) for c in ("node", "copies"))
        raw = table.column("raw").to_pylist()
        x = units(raw, kind)
        shard = Shard(nodes, copies, x, Graph.built(x.astype(np.float32), nodes), None)
        label, own = np.arange(len(nodes)), np.zeros(len(nodes), np.int64)
        for rows, ids in links(shard, x):
            other = rows != ids
            rows, ids = rows[other], ids[other]
            own += np.bincount(rows, copies[ids], len(nodes)).astype(np.int64)
            label = _united(label, rows, ids)
        row = {"dim": key[0].as_py(), "shard": key[1].as_py(), "nodes": nodes.tobytes(), "copies": copies.tobytes(), "raw": b"".join(raw), "labels": label.astype(np.int64).tobytes(), "own": own.tobytes()} | shard.packed()
        kinds = {"dim": pa.int32(), "shard": pa.int32(), "members": pa.list_(pa.binary()), "edges": pa.list_(pa.binary()), "entry": pa.int32()}
        return pa.table({c: pa.array([v], kinds.get(c, pa.binary())) for c, v in row.items()})

    return work


_FOUND = "node long, links long, other long"


def _found(node: np.ndarray, count: np.ndarray, one: np.ndarray, other: np.ndarray) -> pa.Table:
    """Links by node, and edges (node, other) without links."""
    has = count > 0
    return pa.table({"node": np.concatenate([node[has], one]), "links": np.concatenate([count[has], np.zeros(len(one), np.int64)]), "other": pa.array([None] * int(has.sum()) + other.tolist(), pa.int64())})


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            nodes, labels, own = (np.frombuffer(row[c], np.int64) for c in ("nodes", "labels", "own"))
            at = np.flatnonzero(labels != np.arange(len(nodes)))
            yield from _found(nodes, own, nodes[at], nodes[labels[at]]).to_batches()


def _pair(kind: str):
    def work(table: pa.Table) -> pa.Table:
        rows = {r["shard"]: r for r in table.to_pylist()}
        first, second = Shard.read(rows[min(rows)], kind, False), Shard.read(rows[max(rows)], kind, True)
        mine, theirs, met = np.zeros(len(first.nodes), np.int64), np.zeros(len(second.nodes), np.int64), [np.empty(0, np.int64)]
        for q, x in links(second, first.x):
            mine += np.bincount(q, second.copies[x], len(mine)).astype(np.int64)
            theirs += np.bincount(x, first.copies[q], len(theirs)).astype(np.int64)
            met.append(np.unique(first.labels[q] * len(theirs) + second.labels[x]))
        one, other = np.divmod(np.unique(np.concatenate(met)), len(theirs))
        return _found(np.concatenate([first.nodes, second.nodes]), np.concatenate([mine, theirs]), first.nodes[one], second.nodes[other])

    return work


def _sharded(classes: DataFrame, kind: str, least: int, most: int) -> DataFrame:
    """One row a shard: its classes, its graph and what it found in itself."""
    sizes = classes.groupBy("dim").agg(F.count("*").alias("size")).withColumn("shards", F.greatest(F.ceil(F.col("size") / most), F.least(F.lit(SHARDS), F.ceil(F.col("size") / least))).cast("int"))
    dealt = classes.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    n = sizes.agg(F.sum("shards")).first()[0] or 1
    dealt = dealt.select("dim", "shard", "node", "copies", "raw").repartition(min(2 * n, 10_000), "dim", "shard")
    return kit.written(dealt.groupBy("dim", "shard").applyInArrow(_build(kind), _SHARD), "shards")


def _searched(shards: DataFrame, kind: str) -> DataFrame:
    """(node, links, other) of all pairs of shards."""
    listed = shards.select("dim", "shard")
    of = listed.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("others"))
    n = shards.count()
    dealt = shards.join(of, "dim").withColumn("with", F.explode(F.expr("filter(others, x -> x <> shard)")))
    dealt = dealt.withColumn("first", F.least("shard", "with")).withColumn("second", F.greatest("shard", "with"))
    graph = lambda c: F.when(F.col("shard") == F.col("second"), F.col(c))
    dealt = dealt.select("dim", "first", "second", "shard", "nodes", "copies", "raw", "labels", *(graph(c).alias(c) for c in ("members", "edges", "entry")))
    # A partition for each pair, as one pair is work for a minute.
    dealt = dealt.repartition(min(max(1, n * (n - 1)), 100_000), "dim", "first", "second")
    return dealt.groupBy("dim", "first", "second").applyInArrow(_pair(kind), _FOUND)


def linked(vectors: DataFrame, *, vec_id: str = "vec_id", embedding: str = "embedding", least_shard: int = LEAST_SHARD, most_shard: int = MOST_SHARD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors."""
    kind = "float32" if vectors.schema[embedding].dataType.elementType.typeName() == "float" else "float64"
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec"), F.col(embedding).cast(f"array<{'float' if kind == 'float32' else 'double'}>").alias("v"))
    rows = rows.mapInArrow(_raw(np.dtype(kind)), "vec long, dim int, raw binary").withColumn("digest", F.unhex(F.md5("raw")))
    rows = kit.written(rows, "vectors")
    first = F.min(F.struct(F.col("vec").isNull().alias("none"), "vec")).alias("first")
    classes = rows.where("raw is not null").groupBy("digest").agg(first, F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("raw").alias("raw"))
    # Numbers rise with the smallest id, so the smallest number of a component has its smallest id.
    classes = classes.select("digest", "copies", "dim", "raw", F.col("first.vec").alias("rep")).orderBy(F.col("rep").asc_nulls_last()).withColumn("node", F.monotonically_increasing_id())
    classes = kit.written(classes, "vector-classes")
    shards = _sharded(classes.select("node", "copies", "dim", "raw"), kind, least_shard, most_shard)
    found = shards.select("nodes", "labels", "own").mapInArrow(_own, _FOUND).unionByName(_searched(shards, kind))
    found = kit.written(found, "vector-links")
    counts = found.where("links > 0").groupBy("node").agg(F.sum("links").alias("links"))
    labels = neardup.components(found.where("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    told = classes.select("node", "digest", "copies", "rep").join(labels, "node", "left").join(counts, "node", "left")
    told = kit.written(told.select("digest", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("label", "node").alias("label")), "vector-verdicts")
    told = neardup.looked_up(told, "label", classes.select(F.col("node").alias("key"), F.col("rep").alias("value")), "component")
    told = kit.written(told, "vector-components")
    value = F.struct("component", "links").alias("value")
    out = neardup.looked_up(rows.select("vec", "digest"), "digest", told.select(F.col("digest").alias("key"), value), "x", told.select(F.col("digest").alias("key"), F.col("copies").alias("count")))
    component = F.when(F.col("digest").isNull(), F.col("vec")).otherwise(F.col("x.component"))
    out = out.select(F.col("vec").alias(vec_id), F.coalesce("x.links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(vec_id) == F.col("component_id"), F.col("component_id").isNull()))
