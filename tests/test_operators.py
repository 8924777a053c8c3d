"""Operators that SQL can't express, against brute force."""

import difflib
import json
import random
from functools import cache

from pyspark.sql import functions as F

from lectern.functions import records as R
from lectern.operators import align, dedupe, match, rows, segments, sequence, similar
from lectern.plans import alignment, catalogue  # noqa: F401
from lectern.plans.registry import QUERIES, Tables
from lectern.sources import landed

SF = "/root/testdata/sf0.001"
RANK = {"g": 0, "m": 1, "l": 2, "w": 3}


def cheapest(source, target):
    """The best alignment by plain recursion over all edits."""

    @cache
    def best(i, j):
        if i == len(source):
            return 0, (), j
        tried = [(best(i + 1, j), 1, "l")]
        if j < len(target):
            tried += [(best(i + 1, j + 1), int(source[i] != target[j]), "m"), (best(i, j + 1), 1, "w")]
        if j + 1 < len(target) and source[i] == target[j] + target[j + 1]:
            tried.append((best(i + 1, j + 2), 0, "g"))
        return min(((c + more, ((RANK[e], e), *edits), end) for (c, edits, end), more, e in tried), key=lambda x: x[:2])

    cost, edits, end = best(0, 0)
    return cost, end, "".join(e for _, e in edits)


def fitting(source, target):
    """The same, or nulls if it costs more than a line may."""
    found = cheapest(source, target)
    return found if found[0] <= max(1, len(source) // 5) else (None, None, None)


def test_align_words():
    rng = random.Random(5)
    for _ in range(400):
        source = [rng.choice(["a", "b", "ab", "c", "ca"]) for _ in range(rng.randrange(6))]
        target = [rng.choice(["a", "b", "ab", "c"]) for _ in range(rng.randrange(8))]
        assert align.align_words(source, target) == fitting(tuple(source), tuple(target))
    # Long lines near the limit, with words lost, added, split and joined.
    for _ in range(150):
        source = [rng.choice(["a", "b", "ab", "c", "ca", "d", "e"]) for _ in range(rng.randrange(10, 45))]
        target = [w for x in source for w in (rng.choice([[], [x, "z"], ["z"], [x[:1], x[1:]]]) if rng.random() < 0.15 else [x]) if w]
        target = target[: len(source) + align.SLACK]
        assert align.align_words(source, target) == fitting(tuple(source), tuple(target))


def test_line_alignment(spark):
    t = Tables(spark, SF)
    given = {(r["doc_id"], r["n"]): r for r in alignment._sentences(t).collect()}
    got = QUERIES["line_alignment"](spark, SF).collect()
    assert len(got) == len(given) and any(r["cost"] for r in got) and any("g" in (r["edits"] or "") for r in got) and not all(r["fits"] for r in got)
    for r in random.Random(1).sample(got, 300):
        g = given[r["doc_id"], r["n"]]
        if len(g["words"]) < 80:
            want = fitting(tuple(g["words"]), tuple(g["heard"][: len(g["words"]) + align.SLACK]))
            assert (r["cost"], r["consumed"], r["edits"]) == want and r["fits"] == (want[0] is not None)


def test_document_alignment(spark):
    given = {}
    for r in alignment._sentences(Tables(spark, SF)).orderBy("doc_id", "n").collect():
        given.setdefault(r["doc_id"], []).append(r)
    got = {r["doc_id"]: r for r in QUERIES["document_alignment"](spark, SF).collect()}
    assert got.keys() == given.keys() and len({r["accepted"] for r in got.values()}) == 2
    for doc in sorted(given)[:60]:
        stream, at, cost, failed = [w for r in given[doc] for w in r["heard"]], 0, 0, None
        for n, r in enumerate(given[doc]):
            c, used, _ = align.align_words(r["words"], stream[at : at + len(r["words"]) + align.SLACK])
            if c is None:
                failed = n
                break
            at, cost = at + used, cost + c
        assert (got[doc]["accepted"], got[doc]["failed_line"], got[doc]["cost"], got[doc]["consumed"]) == (failed is None, failed, cost, at)


def placed_by_hand(lines, streams):
    """The whole rule for one document, each line tried by plain recursion."""
    cursor, cost, placed = dict.fromkeys(streams, 0), 0, []
    for number, (own, words) in enumerate(lines):
        def at(k, start, words=words):
            return cheapest(tuple(words), tuple(streams[k][start : start + len(words) + align.SLACK]))

        may = [k for k in sorted(streams) if own in (None, k)]
        choices = [(c, k, cursor[k], cursor[k] + used) for k in may for c, used, _ in [at(k, cursor[k])] if c <= max(1, len(words) // 5)]
        choices = choices or [(0, k, i, i + used) for k in may for i in range(len(streams[k])) for c, used, _ in [at(k, i)] if c == 0][:1]
        if not choices:
            return False, number, cost, placed
        c, k, start, end = min(choices, key=lambda x: x[:2])
        cost, cursor[k] = cost + c, end
        placed.append((k, start, end))
    return True, None, cost, placed


def test_aligned_streams(spark):
    rng = random.Random(8)
    given = []
    for doc in range(300):
        lines = [(rng.choice([1, 2, None]), [rng.choice(["a", "b", "ab", "c", "d"]) for _ in range(rng.randrange(5))]) for _ in range(rng.randrange(5))]
        streams = {k: [w for own, words in lines if own in (None, k) for w in words if rng.random() < 0.85] for k in (1, 2) if rng.random() < 0.9}
        if rng.random() < 0.3:
            streams = {k: v[len(v) // 2 :] + v[: len(v) // 2] for k, v in streams.items()}
        given.append((doc, lines, streams))
    given.append((300, None, None))
    df = spark.createDataFrame(given, "doc int, lines array<struct<stream:int,words:array<string>>>, streams map<int,array<string>>")
    got = {r["doc"]: r for r in align.aligned_streams(df, "lines", "streams").collect()}
    assert len({got[d]["accepted"] for d in got}) == 2
    for doc, lines, streams in given:
        r = got[doc]
        assert (r["accepted"], r["failed_line"], r["cost"], [tuple(p) for p in r["placed"]]) == placed_by_hand(lines or [], streams or {})


def test_stream_alignment(spark):
    given = alignment._streams(Tables(spark, SF)).collect()
    got = {r["doc_id"]: r for r in QUERIES["stream_alignment"](spark, SF).collect()}
    assert len(got) == len(given) and len({r["accepted"] for r in got.values()}) == 2
    short = [g for g in given if sum(len(x["words"]) for x in g["lines"]) < 400 and max(len(x["words"]) for x in g["lines"]) < 80]
    for g in short[:25]:
        r = got[g["doc_id"]]
        want = placed_by_hand([(x["stream"], x["words"]) for x in g["lines"]], g["streams"])
        assert (r["accepted"], r["failed_line"], r["cost"]) == want[:3] and [tuple(p.values()) for p in json.loads(r["placed"])] == want[3]
    assert len(short) > 20


def common(a, b):
    """Length of the longest common subsequence, by the plain table."""
    row = [0] * (len(b) + 1)
    for x in a:
        above, row = row, [0]
        for j, y in enumerate(b, 1):
            row.append(above[j - 1] + 1 if x == y else max(above[j], row[-1]))
    return row[-1]


def test_common_lengths():
    rng = random.Random(6)
    make = lambda n, letters="abcd": "".join(rng.choice(letters) for _ in range(n))
    pairs = [("", ""), ("", "a"), ("a", ""), ("é漢😀", "漢x😀é"), ("a" * 64, "a" * 64), ("a" * 65, "a" * 200), ("ab" * 100, "ba" * 130)]
    pairs += [(make(rng.randrange(200)), make(rng.randrange(200))) for _ in range(150)] + [(make(n, "xy"), make(n + 3, "xy")) for n in (62, 63, 64, 127, 128, 129, 400)]
    assert similar.common_lengths([a for a, _ in pairs], [b for _, b in pairs]).tolist() == [common(a, b) for a, b in pairs]


def test_texts_agree(spark):
    rng = random.Random(4)
    pairs = [("abc", "xxabcx"), ("abcd", "abxd----------"), ("", "a"), (None, "a"), ("a", None), ("hallelujah", "halleluiahamen"), ("zzzz", "abab"), ("", ""), ("a", ""), ("résumé", "resumé"), (None, None)]
    for _ in range(200):
        a = "".join(rng.choice("abcde") for _ in range(rng.randrange(1, 140)))
        pairs.append((a, "".join(c if rng.random() < 0.8 else rng.choice(["", "x", c + "y"]) for c in a)))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    for r in similar.texts_agree(df, "a", "b").collect():
        a, b = pairs[r["i"]]
        front = None if a is None or b is None else b[: len(a) + 10]
        assert r["agree"] == (bool(a) and b is not None and (a in b or 2.0 * common(a, front) / (len(a) + len(front)) > 0.8))
        # What the ratio of matching blocks accepts is never refused.
        if a and b and difflib.SequenceMatcher(None, a, front).ratio() > 0.8:
            assert r["agree"]
    for r in similar.titles_agree(df, "a", "b").collect():
        a, b = pairs[r["i"]]
        assert r["titled"] == (a is not None and b is not None and (a == b or 2.0 * common(a, b) / (len(a) + len(b)) >= 0.85))


def test_replaced_letters_are_refused(spark):
    """Texts of which three letters in ten are others are different texts."""
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    text = lambda: "".join(rng.choice(letters) for _ in range(60))
    wrong = [(i, a, "".join(rng.choice(letters) if rng.random() < 0.3 else c for c in a)) for i in range(300) for a in [text()]]
    agree = similar.texts_agree(spark.createDataFrame(wrong, "i int, a string, b string"), "a", "b").where("agree").count()
    assert agree < 30


def phrase_end(items, start, long, gap, most):
    """Where the phrase from start ends, by the rule: the first end that a long item or a gap makes, if it comes in time."""
    n = len(items)
    after_long = (e for e in range(start + 3, n + 1) if items[e - 1][1] >= long)
    before_gap = (e for e in range(start + 2, n) if items[e][0] - sum(items[e - 1]) > gap)
    end = min([*after_long, *before_gap], default=n)
    if end <= start + most and (end < n or n - start < most or items[n - 1][1] >= long):
        return end
    if n - start < most:
        return n
    inner = range(start + 2, start + most - 1)
    return 1 + min(inner, key=lambda j: (-items[j][1], j))


def segments_of(items, long, gap, most):
    """Lengths of all phrases."""
    ends = [0]
    while ends[-1] < len(items):
        ends.append(phrase_end(items, ends[-1], long, gap, most))
    return [b - a for a, b in zip(ends, ends[1:])]


def test_phrases(spark):
    rng, data, want = random.Random(3), [], {}
    for key in range(30):
        at, items = 0.0, []
        for _ in range(rng.randrange(1, 90)):
            length = rng.choice([0.5, 1.0, 1.5, 2.0]) if key % 2 else rng.choice([0.5, 1.0])
            items.append((at, length))
            at += length + rng.choice([0, 0, 0, 0, 0.5] if key % 3 else [0])
        data += [(key, i, a, n) for i, (a, n) in enumerate(items)]
        want[key] = segments_of(items, 1.9, 0.05, 12)
    got = align.phrases(spark.createDataFrame(data, "k int, i int, at double, len double"), "k", "i", "at", "len")
    sizes = got.groupBy("k", "phrase").count().orderBy("k", "phrase").collect()
    for key, lengths in want.items():
        assert [r["count"] for r in sizes if r["k"] == key] == lengths


def test_hot_keys_are_cut_by_many_tasks(spark, monkeypatch):
    """Short stretches, keys of every size about them, and runs that never end by themselves: as one walk cuts them."""
    rng, data, want = random.Random(7), [], {}
    for key in range(40):
        at, items = 0.0, []
        for _ in range(rng.choice([1, 29, 30, 31, 60, 61, 90, 200, 333])):
            length = rng.choice([0.5, 1.0, 1.5] if key % 4 else [0.5, 1.0, 2.0])
            items.append((at, length))
            at += length + rng.choice([0, 0, 0, 0, 0.5] if key % 3 else [0])
        data += [(f"k{key}", i, a, n) for i, (a, n) in enumerate(items)]
        want[f"k{key}"] = segments_of(items, 1.9, 0.05, 12)
    df = spark.createDataFrame(data, "k string, i int, at double, len double").repartition(5)
    cut = align.phrases(df, "k", "i", "at", "len", stretch=30).collect()
    assert len(cut) == len(data)
    for key, lengths in want.items():
        assert [p for _, p in sorted((r["i"], r["phrase"]) for r in cut if r["k"] == key)] == [p for p, n in enumerate(lengths) for _ in range(n)]


def test_a_million_items_of_one_key(spark):
    hot = spark.range(0, 1_000_000, 1, 8).selectExpr("'hot' as k", "id as i", "cast(id * 1.0 + (id % 977 = 0)::int * 0.4 as double) as at", "cast(case when id % 1013 = 0 then 2.5 else 0.5 + (id % 7) / 14 end as double) as len")
    # Spark would gather so small a table in one task.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    out = segments.dealt_phrases(hot.withColumnsRenamed({"k": "_key", "at": "_at", "len": "_len"}), "i", (1.9, 0.9, 12)).cache()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_task = out.withColumn("t", F.spark_partition_id()).groupBy("t").count()
    sizes = out.groupBy("phrase").agg(F.count("*").alias("n"), F.max("i").alias("hi"), F.min("i").alias("lo")).where("n <> hi - lo + 1 or n > 12")
    assert sizes.count() == 0 and out.count() == 1_000_000 and per_task.count() > 4
    first = out.where("i < 3000").orderBy("i").collect()
    whole = segments_of([(r["at"], r["len"]) for r in hot.where("i < 4000").orderBy("i").collect()], 1.9, 0.9, 12)
    assert [r["phrase"] for r in first] == [p for p, n in enumerate(whole) for _ in range(n)][:3000]


def test_monotone_match():
    rng = random.Random(9)
    for _ in range(500):
        ticks = sorted({float(rng.randrange(400)) for _ in range(rng.randrange(1, 40))})
        wanted = sorted({float(rng.randrange(300)) for _ in range(rng.randrange(1, 6))})
        shift, want = 0.0, []
        for w in wanted:
            near = [t for t in ticks if w + shift - 3 <= t <= w + shift + 72]
            best = min(near, key=lambda t: abs(t - w - shift), default=None)  # noqa: B023
            if best is None or abs(best - w - shift) > 24:
                want = None
                break
            want.append(best)
            shift = best - w
        assert align.monotone_match(wanted, ticks, 24.0) == want


def test_onset_match_rows(spark):
    got = QUERIES["onset_match"](spark, SF).collect()
    assert any(r["matched"] for r in got) and all(not r["matched"] or len(r["matched"].split(",")) == r["n"] for r in got)


def test_greedy_two_keys(spark):
    rng = random.Random(2)
    data = [(i, rng.choice([None, *"abcdefghij"]), rng.choice([None, *"klmnopqrs", "a"])) for i in range(60)] + [(100 + i, "hot", f"h{i % 3}") for i in range(40)]
    df = spark.createDataFrame(data, "o long, x string, y string")
    taken = spark.createDataFrame([("b",), (None,)], "key string")
    seen, want = {"b"}, {}
    for o, x, y in data:
        keys = {x, y} - {None}
        want[o] = not keys & seen
        if want[o]:
            seen |= keys
    got = dedupe.greedy_two_keys(df, "o", "x", "y", taken).collect()
    assert {r["o"]: r["accepted"] for r in got} == want
    assert dedupe.greedy_two_keys(df.where("false"), "o", "x", "y").count() == 0


def test_free_names(spark):
    data = [(1, "a"), (2, "a"), (3, "a"), (4, "a-3"), (5, "b"), (6, "b"), (7, "a")]
    taken = spark.createDataFrame([("a",), ("a-5",), ("b-2",)], "name string")
    got = rows.free_names(spark.createDataFrame(data, "i int, name string"), "name", taken, F.col("i")).orderBy("i")
    assert [r["unique_name"] for r in got.collect()] == ["a-2", "a-4", "a-6", "a-3", "b", "b-3", "a-7"]


def test_header_round_trip(spark):
    raw = "{title: X}\n{bad}\n{key: G}\n{title: Y }\n\nVerse 1\n{not: head}\n\n"
    r = spark.createDataFrame([(raw,), ("plain",), ("",), (None,)], "t string").select(R.header_map(F.col("t")).alias("m"), R.header_body(F.col("t")).alias("b")).collect()
    assert r[0]["m"] == {"title": "Y", "key": "G"} and r[0]["b"] == "Verse 1\n{not: head}\n"
    assert r[1]["m"] == {} and r[1]["b"] == "plain" and r[2]["b"] == "" and r[3]["b"] is None


def test_sources(spark, tmp_path):
    for section, name in (("public", "one"), ("public", "two"), ("other", "three")):
        folder = tmp_path / "en" / section / name
        folder.mkdir(parents=True)
        (folder / "song.json").write_text('{"id": "%s"}' % name)
    got = landed.folder_documents(spark, str(tmp_path), "song.json", ["public"]).orderBy("folder").collect()
    assert [(r["language"], r["section"], r["folder"], r["text"]) for r in got] == [("en", "public", "one", '{"id": "one"}'), ("en", "public", "two", '{"id": "two"}')]
    assert landed.file_facts(spark, str(tmp_path), "*.json").count() == 3
    path = tmp_path / "list.csv"
    path.write_bytes(b'a,b,c\r\n"x ""q""","line\nend",3\r\nshort,row\r\n1,2,3\r\n')
    got = landed.quoted_csv(spark, str(path), "a string, b string, c string").collect()
    assert [tuple(r) for r in got] == [('x "q"', "line\nend", "3"), ("1", "2", "3")]


def test_contained_words(spark):
    rng = random.Random(4)
    make = lambda n: "".join(rng.choice("abc") for _ in range(n))
    texts = [(i, None if i == 3 else " ".join(make(rng.randrange(1, 7)) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    wanted = [(i, None if i == 5 else [make(rng.randrange(1, 6)) for _ in range(i % 7)]) for i in range(80)]
    got = match.contained_words(spark.createDataFrame(wanted, "i long, w array<string>"), "i", "w", spark.createDataFrame(texts, "d long, t string"), "d", "t")
    fits = lambda w, t: t is not None and 5 * sum(x in t for x in w) >= 4 * len(w)
    expected = {i: min(hits) for i, w in wanted if w is not None and (hits := [d for d, t in texts if fits(w, t)])}
    assert {r["i"]: r["d"] for r in got.collect()} == expected and 10 < len(expected) < 75


def test_title_containment_is_selective(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["title_containment"](spark, sf).count()
    assert 0 < found < spark.read.parquet(f"{sf}/benchmark.parquet").count()


def test_accents_and_defaults(spark):
    import unicodedata

    from lectern.functions import text as X

    words = ["Őrült āb", "Ế ế x", "naïve ø ß Ñ", "Ångström", "plain", "", None, "ἄλφα ёж"]
    rows = [(w and unicodedata.normalize(form, w),) for w in words for form in ("NFC", "NFD")]
    out = spark.createDataFrame(rows, "x string").select("x", X.fold(F.col("x")).alias("f"), X.composed(F.col("x")).alias("c"), X.slug(F.col("x")).alias("s"), X.key_folded(F.col("x")).alias("k")).collect()
    for r in out:
        if r["x"] is not None:
            assert r["c"] == unicodedata.normalize("NFC", r["x"])
            assert r["f"] == "".join(c for c in unicodedata.normalize("NFD", r["x"]) if not "\u0300" <= c <= "\u036f")
    assert out[0]["s"] == out[1]["s"] == "őrült-āb" and out[0]["k"] == out[1]["k"] == "orult ab"
    one = spark.createDataFrame([(" a , b", "x@ y ", "", None)], "a string, b string, c string, d int")
    got = one.select(X.first_item(F.col("a"), ","), X.after_mark(F.col("b"), "@"), X.first_item(F.col("c"), ","), X.after_mark(F.col("a"), "@"), X.or_default(F.col("c"), "z"), X.or_default(F.col("d"), 90), X.joined_path(F.col("a"), F.col("d").cast("string"))).first()
    assert tuple(got) == ("a", "y", None, None, "z", 90, None)


def test_seconds_are_rounded_once(spark):
    points = spark.createDataFrame([(1, 325_274_499)], "k int, at long")
    tempos = spark.createDataFrame([(1, 10**9, 500_000)], "k int, at long, tempo int")
    out = sequence.piecewise_seconds(points, tempos, "k", "at", "tempo", 500_000).first()
    assert out["seconds"] == 325_274_499 * 500_000 / (500_000 * 1_000_000)


def test_lookups(spark):
    left = spark.createDataFrame([(1, "a", "l1"), (2, "alias", "l1"), (3, None, "l2"), (4, "none", None)], "id int, key string, link string")
    target = spark.createDataFrame([("a", 10), ("b", 20)], "name string, value int")
    aliases = spark.createDataFrame([("alias", "b")], "alias string, name string")
    assert {r["id"]: r["value"] for r in match.by_alias(left, "key", aliases, target, "name").collect()} == {1: 10, 2: 20, 3: None, 4: None}
    index = spark.createDataFrame([("l1", "b"), ("l2", "gone")], "link string, name string")
    assert {r["id"]: r["value"] for r in match.two_hop(left, "key", "link", index, target, "name").collect()} == {1: 10, 2: 20, 3: None, 4: None}
    few = spark.createDataFrame([(1, i, t) for i, t in enumerate(["x", "ax", "ay", "az"])], "id int, at int, text string")
    wanted = spark.createDataFrame([(1, "a"), (2, "a")], "id int, w string")
    assert {r["id"]: r["hit"] for r in match.contained_first(wanted, "id", "w", few, "text", F.col("at")).collect()} == {1: "ax", 2: None}
    assert {r["id"]: r["hit"] for r in match.contained_first(wanted.where("id = 1"), "id", "w", few, "text", F.col("at"), most=1).collect()} == {1: None}


def test_pages_stop_at_the_first_short_one(spark):
    rows_ = spark.createDataFrame([(p, i) for p, n in enumerate([3, 3, 2, 3]) for i in range(n)], "page int, i int")
    assert rows.until_short_page(rows_, "page", 3).count() == 8
    assert rows.until_short_page(rows_, "page", 2).count() == 11
    assert rows.until_short_page(rows_.where("false"), "page", 2).count() == 0


def test_locale_order_puts_accents_and_case_last(spark):
    names = ["zebra", "Émile", "emile", "eagle", "Zulu"]
    df = spark.createDataFrame([(n, 1) for n in names], "n string, g int")
    out = rows.ordered_export(df, ["g"], F.collate("n", "UNICODE"))
    assert [r["n"] for r in out.orderBy("position").collect()] == ["eagle", "emile", "Émile", "zebra", "Zulu"]
    assert [r["n"] for r in rows.ordered_export(df, ["g"], F.col("n")).orderBy("position").collect()] == sorted(names)


def test_first_rows_are_limited_before_the_shuffle(spark):
    plan = rows.first_per_key(spark.range(100).selectExpr("id % 3 as k", "id"), ["k"], F.col("id"))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Partial") > plan.index("WindowGroupLimit")


def test_audit_of_fields_names_and_family_assets(spark):
    from lectern.operators import audit

    base = dict(folder="a/X", name="X", section="public-domain", directory="en", unreadable=False, submitted=False, fields=list(audit.REQUIRED), id="A" * 11, title="t", writer=None, language="en", license="PD", license_source=None, music_key=None, meter="4/4", bpm=90,
                work_ref="w", writer_ref="p", parent=None, body="b", header={"title": "t", "time": "4/4", "tempo": "90"}, provenance={"text": "s", "tune": "s"}, assets=[])
    records = [base, base | dict(folder="a/x", name="x", id="B" * 11, work_ref=None, fields=["id", "title"], header={}, provenance={"timing": "s"}),
               base | dict(folder="a/y", name="y", id="C" * 11, provenance={"timing": "s"}), base | dict(folder="a/z", name="z", id="D" * 11, submitted=True, fields=["id", "title", "language", "license"])]
    schema = "folder string, name string, section string, directory string, unreadable boolean, submitted boolean, fields array<string>, id string, title string, writer string, language string, license string, license_source string, music_key string, meter string, bpm int, work_ref string, writer_ref string, parent string, body string, header map<string,string>, provenance map<string,string>, assets array<string>"
    order = [c.strip().split(" ")[0] for c in schema.split(", ")]
    frame = spark.createDataFrame([tuple(r[c] for c in order) for r in records], schema)
    works, writers, sources = spark.createDataFrame([("w", ["tune", "timing"])], "slug string, assets array<string>"), spark.createDataFrame([("p", True)], "slug string, portrait boolean"), spark.createDataFrame([("s",)], "key string")
    found = sorted((r["rule_id"], r["key"]) for r in audit.record_violations(frame, works, writers, sources, ["en"]).collect())
    assert found == sorted([("V2", "a/x")] * 7 + [("V10", "a/x"), ("V16", "a/x"), ("V16", "a/x"), ("V16", "a/x"), ("V19", "a/x"), ("V19", "a/y"), ("V2", "a/z")])


def test_composed_is_nfc_for_random_sequences(spark):
    import unicodedata

    from lectern.functions import text as X

    rng = random.Random(11)
    known = [c for c in map(chr, range(0x20, 0x20000)) if unicodedata.category(c) not in ("Cn", "Cs", "Co")]
    marks = [c for c in known if unicodedata.combining(c)]
    texts = [rng.choice(known) + "".join(rng.choice(marks + known) for _ in range(rng.randint(1, 3))) for _ in range(4000)]
    texts += [unicodedata.normalize("NFD", c) + "x" for c in rng.sample(known, 4000)]
    texts += ["".join(chr(rng.randint(*r)) for r in ((0x1100, 0x1112), (0x1161, 0x1175), (0x11A7, 0x11C2))) for _ in range(500)]
    out = spark.createDataFrame([(x,) for x in texts], "x string").select("x", X.composed(F.col("x")).alias("c")).collect()
    assert [r["x"] for r in out if r["c"] != unicodedata.normalize("NFC", r["x"])] == []
