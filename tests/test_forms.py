"""Second forms of operators by small cases: similarity gates, fatal checks, family actions, ordered files, trees, fallbacks."""

import os

import pytest
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import audit, family, match, rows
from lectern.plans import forms
from lectern.plans.registry import Tables
from lectern.sources import export, tree

SF = "/root/testdata/sf0.001"


def test_stripped_text(spark):
    page = '<p>a<q>b</q>&nbsp;c&amp;d &#39;e&#039;f&apos; &quot;g&quot; h­i &rsquo;j&#8217;</p>\n k  '
    one = spark.createDataFrame([(page,), (None,), ("",)], "h string")
    got = one.select(X.stripped(F.col("h")), X.stripped(F.col("h"), quotes=True), X.stripped(F.col("h"), curly=True), X.visible(F.col("h"))).collect()
    assert tuple(got[0]) == (
        'ab c&d \'e\'f\' "g" hi &rsquo;j&#8217; k', 'a"b" c&d \'e\'f\' "g" hi &rsquo;j&#8217; k', 'ab c&d \'e\'f\' "g" hi ’j’ k', 'a b c&d \'e\'f\' "g" hi ’j’ k')
    assert tuple(got[1]) == (None,) * 4 and tuple(got[2]) == ("",) * 4


def test_text_rules(spark):
    data = [("x\n\nadd\n\nadd", "add"), ("x\n\nadd", None), ("add", "add"), (None, "a"), ("x\n\n", "")]
    got = spark.createDataFrame(data, "b string, s string").select(X.without_suffix(F.col("b"), F.col("s")).alias("r")).collect()
    assert [r["r"] for r in got] == ["x\n\nadd", "x\n\nadd", "add", None, "x"]
    years = spark.createDataFrame([("in 1850", "1900"), ("no18501", "c. 1720."), ("", None), ("3000", "2029")], "w string, m string")
    assert [r[0] for r in years.select(X.first_year(F.col("w"), F.col("m"))).collect()] == [1850, 1720, None, 2029]
    names = ["Ann Lee (1800) · tr. B", "Trad. air", "Homer", "Unknown man", "3rd century monk", "Eve of X"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select(X.bare_name(F.col("n")).alias("b")).select("b", X.is_person(F.col("b"))).collect()
    assert [tuple(r) for r in got][0] == ("Ann Lee", True) and [r[1] for r in got] == [True, False, False, False, False, True]


def test_prefix_first(spark):
    names = [(1, "short"), (2, "abcdefghijkl"), (3, "abcdefghij"), (4, "abcdefghijkl"), (5, "zyxwvutsrqp")]
    wanted = [("a", "abcdefghij"), ("b", "abc"), ("c", "abcdefghijklm and more"), ("d", "zyxwvutsrqpo"), ("e", ""), ("f", None), ("g", "short"), ("h", "q")]
    got = match.prefix_first(spark.createDataFrame(wanted, "i string, w string"), "i", "w", spark.createDataFrame(names, "d long, n string"), "d", "n")
    assert {r["i"]: r["d"] for r in got.collect()} == {"a": 2, "b": 2, "c": 2, "d": 5}


def test_fallback_at_the_bar_start(spark):
    points = spark.createDataFrame([("k", 1, 5), ("k", 2, 12), ("k", 3, 10), ("k", 4, 25), ("other", 5, 7)], "k string, id int, at long")
    slices = spark.createDataFrame([("k", 4, "dim"), ("k", 9, "C"), ("k", 11, "dim"), ("k", 22, "G"), ("other", 1, "dim")], "k string, at long, v string")
    bars = spark.createDataFrame([("k", 10), ("k", 20)], "k string, at long")
    got = match.as_of_with_fallback(points, slices, bars, ["k"], "at", "v", "chord", lambda v: v == "dim")
    assert {r["id"]: r["chord"] for r in got.collect()} == {1: "dim", 2: "C", 3: "C", 4: "G", 5: "dim"} and got.columns == ["k", "id", "at", "chord"]


def test_candidates_and_stale(spark):
    df = spark.createDataFrame([("k", v, i) for i, v in enumerate([7, 7, 8, 7, 9, 8, 10])], "k string, v int, i int")
    assert [r["i"] for r in rows.top_distinct(df, ["k"], "v", 3, F.col("i")).orderBy("i").collect()] == [0, 2, 4]
    s = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (4, 5)], "k int, changed int")
    d = spark.createDataFrame([(1, 4), (2, 5), (3, 9)], "k int, made int")
    assert {r["k"] for r in rows.stale(s, d, "k", "changed", "made").collect()} == {1, 4}
    assert {r["k"] for r in rows.stale(s, d, "k", "changed", "made", F.when(F.col("k") > 2, True)).collect()} == {1, 3, 4}


def test_fatal_checks_fail_the_job(spark):
    target = spark.createDataFrame([(1,)], "t int")
    check = lambda data: audit.fatal(spark.createDataFrame(data, "k int, id string, ref int"), "k", "id", {"ref": (target, "t")}, suggestion=F.lit("wish")).select("k")
    assert check([(1, "a", 1), (2, "b", None)]).count() == 2
    for data, told in (([(1, None, 1)], "no id at 1; suggested: wish"), ([(1, "a", 1), (2, "a", 1)], "repeated id a"), ([(7, "a", 2)], "ref without target at 7")):
        with pytest.raises(Exception, match=told):
            check(data).count()


def test_counts_are_observed_on_the_way(spark, tmp_path):
    found = spark.createDataFrame([("V1", "E", "a"), ("V2", "W", "b"), ("V3", "W", "c")], "rule_id string, severity string, key string")
    out, seen = audit.observed(found, "run")
    out.write.parquet(str(tmp_path / "v"))
    assert seen.get == {"errors": 1, "warnings": 2, "failed": True}
    assert tuple(audit.verdict(found.where("severity = 'W'")).first()) == (0, 2, False)


def test_family_actions_run_once(spark):
    """Promotion, redundant copies, parents, labels, adoption into a work that exists; a second run finds nothing to do."""
    state = spark.createDataFrame([
        (1, None, None, "root", "tune"), (2, None, 1, "child", "tune"), (3, None, 1, "German original", "other"),  # new family, 3 is canonical
        (10, "w", None, "a", None), (11, None, 10, "b", "held"), (12, None, 10, "c", "own"),  # 11 and 12 are adopted
        (20, "x", None, "a", "z"), (21, "x", None, "b", "z"), (30, None, None, "alone", "q"),
    ], "k int, work string, parent int, label string, asset string")
    assets = spark.createDataFrame([("w", "held"), ("x", None)], "work string, asset string")
    rooted = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (10, 10), (11, 10), (12, 10), (20, 20), (21, 20), (30, 30)], "k int, root int")
    canonical = spark.createDataFrame([(1, 3), (10, 10), (20, 20)], "root int, canonical int")
    args = (rooted, canonical, "k", F.concat(F.lit("f"), F.col("canonical").cast("string")), F.concat("label", F.lit(" translation")))
    done = family.actions(state, assets, *args)
    assert sorted((r["k"], r["action"], r["value"]) for r in done.collect() if r["value"] is not None) == [
        (1, "relabel", "root translation"), (1, "set work", "f3"), (2, "set work", "f3"), (3, "create", "f3"), (3, "promote", "other"), (3, "set work", "f3"),
        (11, "remove", "held"), (11, "set work", "w"), (12, "set work", "w")]
    assert sorted((r["k"], r["action"]) for r in done.collect() if r["value"] is None) == [(2, "clear parent"), (3, "clear parent"), (3, "relabel"), (11, "clear parent"), (12, "clear parent")]
    new_state, new_assets = family.applied(state, assets, done, "k")
    rows_ = {r["k"]: tuple(r)[1:] for r in new_state.collect()}
    assert rows_[1] == ("f3", None, "root translation", "tune") and rows_[3] == ("f3", None, None, None) and rows_[11] == ("w", None, "b", None) and rows_[21] == ("x", None, "b", "z")
    assert {tuple(r) for r in new_assets.collect()} == {("w", "held"), ("x", None), ("f3", "other")}
    assert family.actions(new_state, new_assets, *args).count() == 0
    again, same = family.applied(new_state, new_assets, done, "k")
    assert sorted(map(str, again.collect())) == sorted(map(str, new_state.collect())) and same.count() == 3


def test_family_actions_of_the_tables_run_once(spark):
    t = Tables(spark, SF)
    state, assets, rooted, canonical = forms.family_state(t)
    args = (rooted, canonical, "o_orderkey", F.concat(F.lit("f"), F.col("canonical").cast("string")), F.concat("label", F.lit(" translation")))
    done = family.actions(state, assets, *args)
    assert {r["action"] for r in done.select("action").distinct().collect()} == {"create", "promote", "remove", "set work", "clear parent", "relabel"}
    state, assets = family.applied(state, assets, done, "o_orderkey")
    assert family.actions(state, assets, *args).count() == 0


def test_ordered_files_in_locale_order(spark, tmp_path):
    names = ["zebra", "Émile", "emile", "eagle", "Zulu", "ábc", "abd"] * 200
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "n string, i int").repartition(7)
    path = str(tmp_path / "out")
    export.write_ordered(df, path, F.collate("n", "UNICODE"), F.col("i"), files=5)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) > 1
    got = [r["n"] for r in export.read_ordered(spark, path).orderBy("position").collect()]
    assert list(dict.fromkeys(got)) == ["ábc", "abd", "eagle", "emile", "Émile", "zebra", "Zulu"] and len(got) == len(names)


def test_tree_opens_only_what_is_asked(spark, tmp_path):
    root = tmp_path / "tree"
    for where in ("en/public/one", "en/public/two", "en/private/x", "de/public/drei", "de/other/y"):
        (root / where).mkdir(parents=True)
        (root / where / "r.json").write_text('{"slug": "%s", "bio": "b"}' % where[-1])
    (root / "de/public/drei/r.json").write_bytes(b"\xff\xfe")
    (root / "en/public/empty").mkdir()
    read = lambda sections=None: tree.read_tree(spark, str(root), "r.json", sections)
    assert read().count() == 5 and sorted(r["folder"] for r in read(["public"]).collect()) == ["drei", "one", "two"]
    broken = read(["public"]).where("error is not null").collect()
    assert [(r["folder"], r["text"], r["error"]) for r in broken] == [("drei", None, "UnicodeDecodeError")]
    dims = tree.keyed_records(read(["public"]), "slug string, bio string", "slug").collect()
    assert sorted((r["slug"], r["in_folder"]) for r in dims) == [("e", "one"), ("o", "two")]
    only = read().where("language = 'en' and section in ('private', 'nowhere')")
    assert [r["folder"] for r in only.collect()] == ["x"]
    # A pushed filter leaves other folders unlisted: one that can't even be listed does no harm.
    from pyspark.sql.datasource import EqualTo, IsNotNull

    reader = tree.TreeReader({"path": str(root), "file": "r.json"})
    assert list(reader.pushFilters([EqualTo(("language",), "en"), IsNotNull(("folder",))])) == [IsNotNull(("folder",))]
    listed = []
    keep, tree._folders = tree._folders, lambda store, path: listed.append(path) or keep(store, path)
    try:
        assert [p for part in reader.partitions() for p in part.paths] == ["en/private/x", "en/public/empty", "en/public/one", "en/public/two"]
    finally:
        tree._folders = keep
    assert not any("/de" in p for p in listed)


def test_tree_round_trip(spark, tmp_path):
    data = [("en", "a", f"f{i}", f"text {i} é") for i in range(300)] + [("de", "b", "g", "")]
    df = spark.createDataFrame(data, "language string, section string, folder string, text string").repartition(4)
    tree.write_tree(df, str(tmp_path / "t"), "x.txt")
    got = tree.read_tree(spark, str(tmp_path / "t"), "x.txt")
    assert sorted((r["language"], r["section"], r["folder"], r["text"]) for r in got.collect()) == sorted(data) and got.rdd.getNumPartitions() == 2
