"""Stanzas from streams, the structure of passes, timed documents and attempts, by small cases."""

import random
import time

from pyspark.sql import functions as F

from lectern.operators import align, audit, timing


def test_stream_stanzas(spark):
    # two streams; the first one's last word is shared; a third document has one stream, which keeps its shared word once
    data = [("a", 1, 1, 0.0, 1.0, False), ("a", 1, 2, 1.0, 1.0, False), ("a", 1, 3, 9.0, 1.0, True), ("a", 2, 4, 0.0, 1.0, False), ("b", 2, 5, 0.0, 1.0, True), (None, 1, 6, 0.0, 1.0, True), ("a", None, 7, 0.0, 1.0, False), ("a", 1, 8, None, 1.0, True)]
    df = spark.createDataFrame(data, "song string, v int, id int, at double, n double, s boolean")
    got = {tuple(r) for r in timing.stream_stanzas(df, "song", "v", "id", "at", "n", F.col("s")).collect()}
    assert got == {("a", 1, 1, 0), ("a", 1, 2, 0), ("a", 1, 3, 1), ("a", 2, 4, 0), ("a", 2, 3, 0), ("b", 1, 5, 0)}
    assert timing.stream_stanzas(df.limit(0), "song", "v", "id", "at", "n", F.col("s")).count() == 0


def structure(onsets, ticks, starts, passes, span, unit):
    """The least (start, rank of period) among all candidates that hold, by the rule."""
    if not onsets or not ticks:
        return None, None, None
    starts = sorted({0.0, *(starts or [])})
    steps = [starts[i + 1] - starts[i] for i in range(len(starts) - 1)]
    held = []
    for start in starts:
        for period in set(steps) if passes > 1 else {0.0}:
            end = start + (passes - 1) * period + onsets[-1]
            runs = [align.monotone_match([start + k * period + o for o in onsets], ticks, unit) for k in range(passes)]
            if (passes == 1 or period >= onsets[-1]) and end <= span + 3 * unit and all(r is not None for r in runs):
                held.append((start, -steps.count(period), period, runs))
    return (lambda h: (h[0], h[2], h[3]))(min(held)) if held else (None, None, None)


def test_pass_structure(spark):
    rng, data = random.Random(5), [(-1, None, [1.0], [1.0], 1, 9.0), (-2, [0.0], [], None, 2, 9.0), (-3, [0.0], [4.0], None, 1, 9.0)]
    for i in range(150):
        some = lambda n, hi: sorted({float(rng.randrange(hi)) for _ in range(n)})
        onsets, ticks = some(rng.randrange(1, 4), 20), some(rng.randrange(1, 60), 200)
        data.append((i, onsets, ticks, some(rng.randrange(0, 8), 150), rng.choice([1, 2, 3]), ticks[-1]))
    df = spark.createDataFrame(data, "i int, o array<double>, t array<double>, s array<double>, n int, span double")
    got = timing.pass_structure(df, "o", "t", "s", F.col("n"), F.col("span"), F.lit(8)).collect()
    want = {i: structure(o, t, s, n, span, 8.0) for i, o, t, s, n, span in data}
    assert {r["i"]: (r["start"], r["period"], r["matched"]) for r in got} == want
    assert 20 < sum(v[0] is not None for v in want.values()) < 145


def test_pass_structure_of_thousands_of_starts(spark):
    """Five thousand starts, all their distances, none or the last of which holds: seconds and no list of candidates."""
    rng = random.Random(11)
    starts = sorted(rng.sample(range(1, 4_000_000), 5000))
    ticks = sorted(rng.sample(range(4_000_000), 3000))
    onsets = [0.0, 40.0, 95.0, 160.0, 300.0]
    base, period = float(starts[4990]), float(starts[4991] - starts[4990])
    onsets = [o * period / 301 for o in onsets]
    planted = sorted({*map(float, ticks), *(base + n * period + o for n in (0, 1) for o in onsets)})
    df = spark.createDataFrame([(1, onsets, planted, [float(s) for s in starts]), (2, onsets, [float(t) for t in ticks], [float(s) for s in starts])], "i int, o array<double>, t array<double>, s array<double>")
    began = time.time()
    got = {r["i"]: r for r in timing.pass_structure(df, "o", "t", "s", F.lit(2), F.lit(5e6), F.lit(3.0)).collect()}
    assert time.time() - began < 60 and got[1]["start"] is not None and got[1]["start"] <= base
    for r in got.values():
        if r["start"] is not None:
            assert r["matched"] == [align.monotone_match([r["start"] + n * r["period"] + o for o in onsets], planted if r["i"] == 1 else [float(t) for t in ticks], 3.0) for n in (0, 1)]


def test_timed_documents(spark):
    words = [("a", 1, "Verse 1", 1, 0, 0, "one", 0, 0, 100), ("a", 1, "Verse 1", 1, 0, 1, "two", 100, 200, 50), ("a", 2, "Chorus", None, 0, 0, "all", 300, 300, 100), ("a", 3, "Verse 2", 2, 0, 0, "next", 0, 0, 100), ("gap", 1, "Verse 2", 2, 0, 0, "x", 0, 0, 1)]
    words += [(k, 1, "Verse 1", None, 0, i, "w", i * 100, i * 100, 10) for k in ("late", "back", "lost") for i in (0, 1)]
    w = spark.createDataFrame(words, "k string, stanza int, label string, verse int, line int, pos int, text string, first long, last long, hold long")
    passes = [("a", p, o, (p - 1) * 1000 + o) for p in (1, 2) for o in (0, 100, 200, 300)] + [("gap", 1, 0, 0), ("lost", 1, 0, 0)]
    passes += [(k, 1, o, t) for k, ts in (("late", (0, 9000)), ("back", (500, 100))) for o, t in zip((0, 100), ts)]
    p = spark.createDataFrame(passes, "k string, pass int, onset long, tick long")
    tempos = spark.createDataFrame([("a", 1000, 1_000_000)], "k string, at long, tempo long")
    spans = spark.createDataFrame([("a", 2000), ("gap", 10), ("late", 10), ("back", 9000), ("lost", 10), ("none", 100)], "k string, span long")
    got = {r["k"]: r for r in timing.timed_documents(w, p, tempos, spans, "k", 100).collect()}
    assert {k: r["outcome"] for k, r in got.items()} == {"a": "timed", "gap": "verses", "late": "past end", "back": "falling", "lost": "unmatched", "none": "unmatched"}
    assert got["a"]["duration"] == 15.0 and got["late"]["stanzas"] is None
    plain = [(s["pass"], s["label"], [[(x["t"], x["d"], x["text"]) for x in line] for line in s["lines"]]) for s in got["a"]["stanzas"]]
    assert plain == [
        (1, "Verse 1", [[(0.0, 0.5, "one"), (0.5, 0.75, "two")]]),
        (1, "Chorus", [[(1.5, 0.5, "all")]]),
        (2, "Verse 2", [[(5.0, 1.0, "next")]]),
        (2, "Chorus", [[(8.0, 1.0, "all")]]),
    ]


def test_first_success(spark):
    data = [(1, 1, "a", None, 10), (1, 2, "b", None, 20), (2, 1, "a", "no a", None), (2, 2, "b", None, None), (3, 1, "a", "no a", 1), (3, 2, "b", "no b", 2)]
    df = spark.createDataFrame(data, "k int, p int, m string, e string, v int")
    got = {tuple(r) for r in timing.first_success(df, "k", "p", "m", "e", ["v"]).collect()}
    assert got == {(1, "a", None, 10), (2, "b", None, None), (3, "skipped", "no b", None)}


def test_render_errors(spark):
    held = spark.createDataFrame([(1, {"text": "x", "art": "y", "other": "z"}), (2, {"text": "k"}), (3, None), (4, {"art": None, "text": "q"})], "id int, s map<string,string>")
    known = spark.createDataFrame([("k",)], "key string")
    got = {tuple(r) for r in audit.render_errors(held, "id", "s", known, "key", ["text", "art"]).collect()}
    assert got == {(1, 'provenance.text references unknown source "x"; provenance.art references unknown source "y"'), (4, 'provenance.text references unknown source "q"')}
