"""Vector near-duplicates against all pairs in double precision."""

import brute
import numpy as np
import pytest
from lectern.llm import smallworld, vectordup

SCHEMA = "vec_id long, embedding array<float>, label int"


def rows_of(x, start=0):
    return [(start + i, [float(v) for v in row], 0) for i, row in enumerate(x)]


def clustered(n, dim=24, seed=5):
    """Unrelated vectors, pairs near the limit, chains, and one group of a third of all rows."""
    rng = np.random.default_rng(seed)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    alone, centre = unit(rng.normal(size=(n // 2, dim))), unit(rng.normal(size=dim))
    dense = unit(centre + 0.035 * rng.normal(size=(n // 3, dim)))
    near = []
    for v in alone[: n // 6]:
        way = rng.normal(size=dim)
        way = unit(way - way @ v * v)
        c = rng.uniform(0.85, 0.99)
        near.append(c * v + np.sqrt(1 - c * c) * way)
    x = np.concatenate([alone, dense, np.array(near)])
    return x[rng.permutation(len(x))].astype(np.float32)


def result(df):
    return sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in df.collect())


def recall(mine, true):
    both = {v: n for v, n, *_ in true}
    assert all(n <= both[v] for v, n, *_ in mine)
    return sum(n for _, n, *_ in mine) / sum(both.values()) if sum(both.values()) else 1.0


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    true = brute.vector_links([(r["vec_id"], r["embedding"]) for r in df.collect()])
    mine = result(vectordup.linked(df))
    assert [r[0] for r in mine] == [r[0] for r in true] and recall(mine, true) > 0.99


def test_shards_pairs_and_a_dense_group(spark):
    """Several shards, one group of a third of the rows, links on both sides of the limit, exact copies of one vector."""
    x = clustered(1500)
    rows = rows_of(np.concatenate([x, np.repeat(x[:1], 400, axis=0)]))
    true = brute.vector_links([r[:2] for r in rows])
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    mine = result(vectordup.linked(df, least_shard=300, most_shard=300))
    assert recall(mine, true) > 0.99
    assert sum(a[2:] == b[2:] for a, b in zip(mine, true, strict=True)) > 0.99 * len(true)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, None, 1), (1, [], 1), (2, [0.0, 0.0], 1), (3, [nan, 1.0], 1), (4, [inf, 1.0], 1), (5, [None, 1.0], 1), (6, [1.0, 0.0], 1), (6, [0.0, 1.0], 1), (7, [2.0, 0.0], 1), (None, [0.0, 3.0], 1), (None, None, 1), (None, [5.0], 1), (8, [1.0], 1), (9, [-0.0, 1.0], 1), (10, [1e-30, 0.0], 1)]
    df = spark.createDataFrame([(*r, 7, 8) for r in rows], SCHEMA + ", node int, component int")
    got = [tuple(r) for r in vectordup.linked(df).select("vec_id", "n_links", "component_id", "kept").collect()]
    want = [(0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 2, 6, True), (6, 2, 6, True), (7, 2, 6, False), (None, 2, 6, False), (None, 0, None, True), (None, 1, 8, False), (8, 1, 8, True), (9, 2, 6, False), (10, 2, 6, False)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert vectordup.linked(df.where("false")).count() == 0
    doubles = df.select("vec_id", df.embedding.cast("array<double>").alias("embedding"))
    assert sorted(map(str, (tuple(r) for r in vectordup.linked(doubles).collect()))) == sorted(map(str, want))


def test_graph_finds_every_vector_and_the_audit_widens():
    x = vectordup.units([v.tobytes() for v in clustered(1200)], "float32")
    graph = smallworld.Graph.built(x.astype(np.float32), np.arange(len(x)))
    assert len(graph.layers) > 1
    assert all((layer[layer >= 0] < len(x)).all() and layer.shape[1] <= smallworld.M0 for layer in graph.layers)
    shard = vectordup.Shard(np.arange(len(x)), np.ones(len(x), np.int64), x, graph, None)
    ef, found = vectordup.beam_width(shard, x)
    assert ef and found >= vectordup.RECALL
    # A graph whose edges are gone fails its audit at every width, and the shard is scanned.
    for layer in graph.layers:
        layer[:] = -1
    assert vectordup.beam_width(shard, x) == (0, 1.0)
    rows = np.concatenate([r for r, _ in vectordup.links(shard, x)])
    assert np.array_equal(np.bincount(rows, minlength=len(x)), (x @ x.T >= 0.9).sum(axis=1))


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_small_shards_are_whole(n):
    x = vectordup.units([v.tobytes() for v in clustered(60)[:n]], "float32")
    graph = smallworld.Graph.built(x.astype(np.float32), np.arange(n))
    ids, _ = graph.search(x.astype(np.float32), n)
    assert all(i in row for i, row in enumerate(ids))
