"""Decontamination, near duplicates, repeated passages and line quality against brute force."""

import brute
import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from lectern.llm import decontaminate, linequality, neardup, queries, substring

ITEMS = [(1, "fox jumps over the lazy dog while seven wizards mix jolly potions"), (2, "ONE"), (None, "quiet harbour town at dawn and sing extra words here now"), (3, ""), (4, None), (5, "brown fox jumps over the lazy dog while seven wizards mix")]


def got(df, *cols):
    return {r[0]: tuple(r)[1:] for r in df.select("doc_id", *cols).collect()}


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def digest(found):
    import pyspark.sql.functions as F

    return found.select("doc_id", "n_words", "n_hit", F.size("item_ids").alias("n"), F.sha2(F.array_join("item_ids", ","), 256), "contaminated")


def test_decontamination_matches_brute_force(spark, docs):
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = queries.op1_decontaminate(spark, SF)
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == brute.contamination(pairs(docs), items)


@pytest.mark.parametrize("block_words", [1_000_000, 5])
def test_decontamination_edges_and_blocks(spark, edges, edge_rows, block_words):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = decontaminate.report(edges, bench, block_words=block_words)
    assert {r[0]: tuple(r)[1:] for r in digest(found).collect()} == brute.contamination(edge_rows, ITEMS)
    longest = {r["doc_id"]: {m["item_id"]: (m["start"], m["length"]) for m in r["matches"]} for r in found.collect()}
    assert longest[5]["1"] == (3, 12)
    kept = decontaminate.remove_contaminated(edges, bench, block_words=block_words)
    assert kept.columns == edges.columns
    assert {r["doc_id"] for r in kept.collect()} == {d for d, x in brute.contamination(edge_rows, ITEMS).items() if not x[-1]}


def test_decontamination_of_empty_tables(spark, docs, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.report(empty, bench).count() == 0
    assert decontaminate.remove_contaminated(docs, bench).count() == docs.count()


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_near_duplicates_match_brute_force(spark, sf):
    expected = brute.near_duplicates(pairs(spark.read.parquet(f"{sf}/documents.parquet")))
    assert got(queries.op4_near_duplicates(spark, sf), "n_shingles", "component_id", "kept") == expected


def test_near_duplicate_edges(spark, edges, edge_rows, empty):
    assert got(neardup.near_duplicates(edges), "n_shingles", "component_id", "kept") == brute.near_duplicates(edge_rows)
    assert neardup.near_duplicates(empty).count() == 0
    kept = neardup.keep_one(edges)
    assert kept.columns == edges.columns and kept.count() == sum(x[2] for x in brute.near_duplicates(edge_rows).values())


def test_long_lists_and_null_ids(spark):
    """A big group of near copies around different centres, joined only through members that are not the smallest."""
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        words = list(base)
        for j in range(0, 40, 8):
            words[(i * 7 + j * 5) % 200] = f"edit{i}_{j}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:100] + [f"own{i}_{j}" for j in range(100)])) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(neardup.near_duplicates(frame), "n_shingles", "component_id", "kept") == brute.near_duplicates(rows)
    nulls = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (None, "z"), (7, "a b c d e f")], "doc_id long, text string")
    out = sorted((tuple(r) for r in neardup.near_duplicates(nulls).collect()), key=str)
    assert out == sorted([(None, 2, 7, False), (7, 2, 7, True), (7, 2, 7, True), (None, 1, None, True)], key=str)


def test_template_groups_stay_linear(spark, monkeypatch):
    """Many pages that share four fifths of their words and are not similar, and a near copy of every tenth."""
    base = " ".join(f"t{i}" for i in range(160))
    own = lambda i, other: " ".join(f"own{i}_{j}" if j != other else f"new{i}" for j in range(40))
    rows = [(i, f"{base} {own(i, None)}") for i in range(600)] + [(1000 + i, f"{base} {own(i, 20)}") for i in range(0, 600, 10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    made = {}
    lists, blocks = neardup.full_lists, neardup._block_pairs

    def counted_lists(sets):
        out = lists(sets)
        made["lists"] = made.get("lists", 0) + out.count()
        return out

    def counted_blocks(placed, *rest):
        made["blocks"] = made.get("blocks", 0) + placed.count()
        return blocks(placed, *rest)

    monkeypatch.setattr(neardup, "full_lists", counted_lists)
    monkeypatch.setattr(neardup, "_block_pairs", counted_blocks)
    assert got(neardup.near_duplicates(frame), "n_shingles", "component_id", "kept") == brute.near_duplicates(rows)
    assert 0 < made["lists"] < 100 * len(rows) and made["blocks"] == 0


def test_full_prefixes_share_a_key_in_similar_sets():
    import numpy as np

    rng = np.random.default_rng(4)
    edges = neardup._bands(400)
    counts = lambda s: (s % np.uint64(7)).astype(int) + 2
    for _ in range(2000):
        n = int(rng.integers(1, 200))
        a = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > rng.random() * 0.3], rng.integers(0, 1 << 40, int(rng.integers(0, 1 + n // 4))).astype(np.uint64)]))
        if len(b) and neardup._alike(a.tobytes(), b.tobytes()):
            (x, p), (y, q) = (neardup.full_prefixes(s, counts(s), edges) for s in (a, b))
            _, i, j = np.intersect1d(x, y, return_indices=True)
            assert any({p[k], q[m]} in ({0}, {1, 2}) for k, m in zip(i, j))


def test_near_duplicates_of_equal_ids_and_clashing_names(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, "another text that is not like it at all"), (2, f"{text} end"), (None, f"{text} stop"), (None, None), (3, ""), (None, f"q {text[3:]} x y"), (5, None)]
    frame = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, gone int, digest int, same int")
    out = sorted((tuple(r)[0:1] + tuple(r)[2:] for r in neardup.near_duplicates(frame).collect()), key=str)
    assert out == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False), (None, None, True), (3, 3, True), (None, 1, False), (5, 5, True)], key=str)
    kept = neardup.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((tuple(r)[:2] for r in kept.collect()), key=str) == sorted([rows[0], rows[1], rows[4], rows[5], rows[7]], key=str)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_repeats_match_brute_force(spark, sf):
    expected = brute.repeats(pairs(spark.read.parquet(f"{sf}/documents.parquet")))
    assert got(queries.op6_repeated_passages(spark, sf), "n_words", "n_removed", "kept_sha256") == expected


def test_repeat_edges(spark, edges, edge_rows, empty):
    expected = brute.repeats(edge_rows)
    assert got(substring.removal_report(edges.repartition(5)), "n_words", "n_removed", "kept_sha256") == expected
    assert substring.removal_report(empty).count() == 0
    kept = {r["doc_id"]: r["text"] for r in substring.remove_repeats(edges).collect()}
    assert set(kept) == {d for d, x in expected.items() if x[1] < max(1, x[0])}
    assert all(kept[d] == t for d, t in edge_rows if d in kept and not expected[d][1])
    spans = {r["doc_id"]: r["removed"] for r in substring.removal_report(edges).collect()}
    assert [(s["start"], s["end"]) for s in spans[8]] == [(0, 3 * 22 + 3)] or sum(s["end"] - s["start"] for s in spans[8]) == expected[8][1]
    nulls = spark.createDataFrame([(None, "q " * 30), (3, "q " * 30)], "doc_id long, text string")
    assert {r[0]: r[1] for r in substring.removal_report(nulls).select("doc_id", "n_removed").collect()} == {None: 30, 3: 29}


def _repeats_in_process(rows, shards, buckets=8):
    """The functions that tasks run, one after the other: shards, buckets, documents."""
    entries = []
    for shard in shards:
        h, c, doc, _ = substring._doc_windows([t.encode() for _, t in shard], substring.WIDTH)
        entries += substring._entries(h, c, np.array([d for d, _ in shard])[doc], buckets, 3)
    found = {}
    for b in range(buckets):
        mine = [e for e in entries if e["bucket"] == b]
        if mine:
            for r in substring._bucket_repeats(pa.Table.from_pylist(mine, substring._ENTRY)).to_pylist():
                found.setdefault(r["doc"], []).append(r["hashes"])
    texts = [t.encode() for _, t in rows]
    removed = substring.removed_words(texts, [found.get(d) for d, _ in rows], substring.WIDTH)
    return {d: (n, int(gone.sum()) if gone is not None else 0, brute.sha(substring.kept_words(t, gone).decode())) for (d, _), t, (n, gone) in zip(rows, texts, removed, strict=True)}


def test_windows_that_share_a_hash_stay_apart(monkeypatch):
    rng = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in rng.integers(0, 50, 60))
    rows = [(d, " ".join(f"w{i}" for i in rng.integers(0, 3000, rng.integers(5, 90))) + (f" {passage} {passage}" if d % 7 == 0 else "")) for d in range(120)]
    expected = brute.repeats(rows)
    shards = [rows[i::4] for i in range(4)]
    assert _repeats_in_process(rows, shards) == expected
    whole = substring._window_keys

    def narrowed(words, width):  # 16 values of the first hash for some 6,000 windows
        hashes, checks = whole(words, width)
        return (hashes >> np.uint64(60)) << np.uint64(60), checks

    monkeypatch.setattr(substring, "_window_keys", narrowed)
    assert _repeats_in_process(rows, shards) == expected
    monkeypatch.setattr(substring, "_window_keys", lambda w, n: (narrowed(w, n)[0], narrowed(w, n)[1] * np.uint32(0)))
    assert _repeats_in_process(rows, shards) != expected  # without the second hash, other windows count as repeats


def test_a_shard_is_held_little_more_than_once():
    """Entries leave in batches of some megabytes at most, and the shard's arrays are not copied many times over."""
    import tracemalloc

    rng = np.random.default_rng(6)
    words = np.array([f"w{i:04}" for i in range(5000)])
    texts = [" ".join(words[rng.integers(0, 5000, 600)]) for _ in range(2200)]
    batch = pa.RecordBatch.from_pydict({"doc": pa.array(range(len(texts)), pa.int64()), "text": texts})
    del texts
    list(substring._shard_entries(substring.WIDTH, 64)(iter([batch.slice(0, 400)])))  # tables of powers
    windows, largest = 0, 0
    tracemalloc.start()
    for out in substring._shard_entries(substring.WIDTH, 64)(iter([batch])):
        windows += sum(len(x) // 4 for x in out.column("checks").to_pylist())
        largest = max(largest, out.nbytes)
        del out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert windows > 1_200_000
    assert largest < 3 << 20 and peak < 70 << 20, (largest, peak)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_line_quality_matches_brute_force(spark, sf):
    rows = [(r["doc_id"], r["source"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = queries.op10_line_quality(spark, sf)
    assert got(out, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == {d: brute.base_figures(t) for d, _, t in rows}
    assert {d: x[0] for d, x in got(out, "kept").items()} == brute.line_verdicts(rows)


def test_line_quality_edges(spark, edges, edge_rows, empty):
    out = linequality.judged(edges)
    assert got(out, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == {d: brute.base_figures(t) for d, t in edge_rows}
    assert linequality.judged(empty).count() == 0
    body = [" ".join(f"b{i}_{j}" for j in range(60)) for i in range(40)]
    line = " ".join(f"menu{j}" for j in range(80))
    rows = [(i, None if i % 2 else "h", f"{line}\n{b}" if i < 30 else b) for i, b in enumerate(body)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, text string")
    verdict = {d: x[0] for d, x in got(linequality.judged(frame, least_docs=10), "kept").items()}
    assert verdict == brute.line_verdicts(rows, least_docs=10) == {i: i >= 30 for i in range(40)}
    table = linequality.figures(frame)
    cleaned = linequality.remove_lines(frame, linequality.frequent_lines(table, least_docs=10))
    assert {r["doc_id"]: r["text"] for r in cleaned.collect()} == dict(enumerate(body))
    assert linequality.keep_good(frame, least_docs=10).count() == 10
    # rows without an id, or with one id and different texts, go or stay each by its own text
    good, bad = " ".join(f"g{j}" for j in range(80)), "short"
    rows = [(1, "h", good), (1, "h", bad), (None, "h", good + " x"), (None, None, bad), (2, None, f"{line}\n \n{good} y\n")]
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "doc_id long, source string, text string, bad int, gone int, h int, same int")
    assert sorted(r["text"] for r in linequality.keep_good(frame).collect()) == sorted([good, good + " x", rows[4][2]])
    assert linequality.cleaned(frame, least_docs=1, share=0.6).columns == frame.columns
    assert linequality.cleaned(frame.where("false")).count() == 0


def test_cleaned_texts_match_brute_force(spark):
    menu = ["Home  Page", "home page", "\tHOME\x0bpage ", "About"]
    rows = [(i, "ab"[i % 2] if i % 7 else None, "\n".join([menu[i % 4], " ".join(f"w{i}_{j}" for j in range(55 + i % 3)), "", "\u00a0", menu[(i + 1) % 4], "end"])) for i in range(90)]
    frame = spark.createDataFrame([(*r, 0, 0) for r in rows], "doc_id long, source string, text string, doc int, kept int")
    for cut in (5, 20):
        expected = brute.cleaned_texts(rows, least_docs=cut)
        assert got(linequality.cleaned(frame, least_docs=cut), "text") == {d: (t,) for d, t in expected.items()}
        table = linequality.figures(frame)
        assert got(linequality.remove_lines(frame, linequality.frequent_lines(table, least_docs=cut)), "text").items() >= got(linequality.cleaned(frame, least_docs=cut), "text").items()
    assert any(t != r[2] for r, t in zip(rows, brute.cleaned_texts(rows, least_docs=5).values()))
