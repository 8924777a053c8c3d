"""Language identification, the quality classifier, main text and resharding."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from conftest import SF
from lectern.llm import cotrain, htmlmain, langid, queries, reshard

PIECES = P.path("piece_bpe_32k.model")


def test_held_out_languages(spark, docs):
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    out = queries.op2_language_id(spark, SF).collect()
    assert len(out) == len(truth)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out)
    held = [r for r in out if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in out)


def test_language_edges(spark, edges, edge_rows, empty):
    out = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.report(edges, PIECES).collect()}
    assert out[0] == out[1] == out[2] == ("und", 0.0) and out[14][0] == "und"
    assert out[5][0] == "en"
    assert langid.report(empty, PIECES).count() == 0


def test_forward_sums_all_segmentations():
    import numpy as np

    pieces = langid.Pieces.shared(PIECES)
    p = np.random.default_rng(1).random((pieces.size, 2))
    p[0] = 0

    def total(w, lang):
        return 1.0 if not w else sum(p[pieces.table([w], 0, n)[0], lang] * total(w[n:], lang) for n in range(1, min(len(w), pieces.longest) + 1))

    for word in ("the", "über", "漢x"):
        assert np.allclose(langid.log_likelihoods([word], pieces, p)[0], [np.log(total("▁" + word, k)) for k in (0, 1)])


def test_classifier_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    random.Random(5).shuffle(labels)
    test = {r["doc_id"]: r for r in labels[: len(labels) // 5]}
    seen = spark.createDataFrame([r for r in labels if r["doc_id"] not in test], "doc_id long, quality int, toxic int")
    out = {r["doc_id"]: r for r in cotrain.scored(spark.read.parquet(f"{sf}/documents.parquet"), seen).collect()}
    assert sum((out[d]["quality"] >= 0.5) == (r["quality"] == 1) for d, r in test.items()) >= 0.92 * len(test)
    assert sum((out[d]["toxic"] >= 0.5) == (r["toxic"] == 1) for d, r in test.items()) >= 0.95 * len(test)


def test_classifier_edges(spark, edges, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (5, 0, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert cotrain.scored(edges, labels).count() == edges.count()
    assert cotrain.scored(empty, labels.where("false")).count() == 0


PAGES = {
    "<html><body><nav><a>Home</a></nav><article><h1>T &amp; U</h1><p><b>One  two,\nthree.<br><p>Four.</p></article><footer>f</footer>": "T & U\nOne two, three.\nFour.",
    "<body><div class='sidebar'>Side text, long enough to matter.</div><div id=main><p>Body text is here, and it goes on.</p><p>More of it.</p></div><section class='comments'><p>First!</p></section>": "Body text is here, and it goes on.\nMore of it.",
    "<p>a<script>var x = '<p>no</p>';</script> b<!-- c --> d</p><form>Mail <input> <p>me</p></form>": "a b d",
    "<div class=cookie-notice>We use cookies, sorry.</div><main><h2>H</h2><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></main>": "H\none\ntwo\nx\ny",
    "<article>x<aside>advice</aside>y<p>z &lt;b&gt;</article><!-- open": "x\ny\nz <b>",
    "": "", "<script>never closed": "", "plain &eacute; text": "plain é text",
}


@pytest.mark.parametrize("page", PAGES)
def test_main_text(page):
    assert htmlmain.main_text(page) == PAGES[page]


_LONG = "".join(f"<p>Paragraph {i} of the body, which is long, and which goes on for a while.</p>" for i in range(30))
_BODY = "\n".join(f"Paragraph {i} of the body, which is long, and which goes on for a while." for i in range(30))
_TABLE = "".join(f"<tr><td>A long cell {i}, with words, marks and more, so that it weighs.</td></tr>" for i in range(60))
_CELLS = "\n".join(f"A long cell {i}, with words, marks and more, so that it weighs." for i in range(60))
_DL = _TABLE.replace("<tr><td>", "<dt>").replace("</td></tr>", "</dt>")
NESTED = {
    f"<article><h1>Title</h1><p>Lead.</p><div class=body>{_LONG}</div><p>Closing.</p></article>": f"Title\nLead.\n{_BODY}\nClosing.",
    f"<main><h1>Title</h1><p>By X</p><section>{_LONG}</section><p>Closing.</p></main>": f"Title\nBy X\n{_BODY}\nClosing.",
    f"<article><h1>Title</h1><p>Lead.</p><table>{_TABLE}</table><p>Closing.</p></article>": f"Title\nLead.\n{_CELLS}\nClosing.",
    f"<article><p>Lead.</p><dl>{_DL}</dl><p>Closing.</p></article>": f"Lead.\n{_CELLS}\nClosing.",
    f"<article><p>Lead.</p><figure><figcaption>{_LONG}</figcaption></figure></article>": f"Lead.\n{_BODY}",
    f"<div id=top><ul><li>Home<li>News<li>Other</ul></div><div id=post><h1>Title</h1><div>By X</div><div class=body>{_LONG}</div><h2>Last words</h2></div><div id=end><ul><li>a<li>b<li>c</ul></div>": f"Title\nBy X\n{_BODY}\nLast words",
}


@pytest.mark.parametrize("page", NESTED)
def test_main_text_of_nested_pages(page):
    assert htmlmain.main_text(page) == NESTED[page]


NAMED = {
    f"<div class='content has-sidebar'>{_LONG}</div><div class='right-sidebar'>Side text, long enough.</div>": _BODY,
    f"<div class='overflow-hidden no-comments'>{_LONG}</div>": _BODY,
    f"<article><div class='post-header'><h1>Title</h1></div>{_LONG}<div class='post-share'>Share it</div></article>": f"Title\n{_BODY}",
    f"<div class=post><div class='article-header'><h1>Title</h1></div><div class=body>{_LONG}</div></div>": f"Title\n{_BODY}",
    f"<article>{_LONG}<pre>x = 1 <span class='hljs-comment'># one</span> <i class='token comment'># two</i></pre></article>": f"{_BODY}\nx = 1 # one # two",
    f"<article><p title='the hidden gem'>Lead.</p><p title='display:none'>Next.</p>{_LONG}<p hidden>x</p><p hidden=''>x</p><p style='Display: none'>x</p></article>": f"Lead.\nNext.\n{_BODY}",
    f"<article><h2 id=cookies>Cookies</h2>{_LONG}<div id=comments>First!</div></article>": f"Cookies\n{_BODY}",
    f"<div class=widget>{_LONG}<div class=ads>Buy it.</div></div><p class=notice>End.</p>": _BODY,
    f"<div class=widget><div class=widget-body>{_LONG}</div></div>": _BODY,
    f"<main><p>Short.</p></main><div class=comments>{_LONG}</div>": "Short.",
}


@pytest.mark.parametrize("page", NAMED)
def test_main_text_and_names(page):
    assert htmlmain.main_text(page) == NAMED[page]


def test_main_text_of_given_pages(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    out = {r["page_id"]: r for r in queries.op5_main_text(spark, SF).collect()}
    for r in pages.collect():
        inner = re.search(r"(?s)<article>(.*?)(?:</article>|$)", r["html"])[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert out[r["page_id"]]["text"] == "\n".join(b for b in blocks if b)
        assert out[r["page_id"]]["n_chars"] == len(out[r["page_id"]]["text"])
    clash = pages.withColumn("text", pages.url)
    assert htmlmain.extracted(clash)[1] == "_text"
    null = spark.createDataFrame([(1, None, None)], "page_id long, url string, html string")
    assert htmlmain.report(null).first()["text"] == ""


def test_reshard_query(spark, docs):
    out = queries.op8_reshard(spark, SF).collect()
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert sorted(r["doc_id"] for r in out) == sorted(texts)
    sizes, slots = Counter(), {}
    for r in out:
        assert (r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]]))
        sizes[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(t) for t in texts.values()) + 1
    assert max(sizes.values()) - min(sizes.values()) <= 2 * largest


def test_flow_moves_as_little_as_possible():
    rng = random.Random(3)
    for _ in range(200):
        sizes, new = [rng.randrange(50) for _ in range(rng.randrange(1, 9))], rng.randrange(1, 9)
        room = reshard.even_capacities(sum(sizes), new)
        flow = reshard.min_cost_transfers(sizes, room)
        assert [sum(r) for r in flow] == sizes and [sum(c) for c in zip(*flow)] == room
        assert sum(flow[i][i] for i in range(min(len(sizes), new))) == sum(map(min, sizes, room))


def test_rewrite_touches_only_affected_shards(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 2, i, 10) for i in range(40)] + [(100, 1, 100, 0)], "doc_id int, old int, position long, size long")
    placed = reshard.assign(rows, 2, old="old", position="position", size="size")
    assert reshard.rewrite_affected(placed, str(tmp_path / "same"), old="old") == []
    placed = reshard.assign(rows, 3, old="old", position="position", size="size")
    assert reshard.rewrite_affected(placed, str(tmp_path / "more"), old="old") == [0, 1, 2]
    assert spark.read.parquet(str(tmp_path / "more")).count() == 41
    assert reshard.assign(rows.where("false"), 3, old="old", position="position", size="size").count() == 0


def _least_cost(sizes, room, costs):
    """Least cost by trying every way, unit by unit."""
    from functools import cache

    @cache
    def best(i, left, room):
        if i == len(sizes):
            return 0
        if not left:
            return best(i + 1, sizes[i + 1] if i + 1 < len(sizes) else 0, room)
        ways = [(0 if i == j else costs[i]) + best(i, left - 1, room[:j] + (r - 1,) + room[j + 1 :]) for j, r in enumerate(room) if r]
        return min(ways)

    return best(0, sizes[0], tuple(room))


def test_flow_costs_match_brute_force():
    rng = random.Random(8)
    for _ in range(150):
        sizes = [rng.randrange(4) for _ in range(rng.randrange(1, 5))]
        costs = [rng.randrange(1, 4) for _ in sizes]
        room = [rng.randrange(5) for _ in range(rng.randrange(1, 4))]
        room[0] += max(0, sum(sizes) - sum(room))
        flow = reshard.min_cost_transfers(sizes, room, costs)
        assert [sum(r) for r in flow] == sizes and all(sum(c) <= r for c, r in zip(zip(*flow), room))
        assert sum(flow[i][j] * costs[i] for i in range(len(sizes)) for j in range(len(room)) if i != j) == _least_cost(sizes, room, costs)
    assert sum(reshard.transfers([7] * 20_000, reshard.even_capacities(140_000, 300)).values()) == 140_000
    with pytest.raises(ValueError):
        reshard.transfers([2], [1])


def test_tables_of_several_files_are_rewritten(spark, tmp_path):
    rng = random.Random(9)
    rows = [(None if i % 9 == 0 else i // 2, None if i % 11 == 0 else "é" * rng.randrange(60), i) for i in range(900)]
    source = str(tmp_path / "table")
    frame = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    frame.where("slot < 500").coalesce(1).write.parquet(source)
    frame.where("slot >= 500").repartition(3).write.mode("append").parquet(source)
    for shards in (2, 4, 7):
        out = str(tmp_path / f"out{shards}")
        table, (old, shard, slot) = reshard.reshard_table(spark, source, out, shards)
        got = table.collect()
        assert sorted(((r["doc_id"], r["text"], r["slot"]) for r in got), key=str) == sorted(rows, key=str)
        sizes, slots, moved = Counter(), {}, 0
        for r in got:
            n = len((r["text"] or "").encode()) + 1
            sizes[r[shard]] += n
            slots.setdefault(r[shard], []).append(r[slot])
            moved += n * (r[shard] != r[old])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(shards))
        assert max(sizes.values()) - min(sizes.values()) <= 2 * 121 * 4
        before = Counter()
        for r in got:
            before[r[old]] += len((r["text"] or "").encode()) + 1
        least = sum(sizes.values()) - sum(min(before[k], c) for k, c in enumerate(reshard.even_capacities(sum(sizes.values()), shards)))
        assert moved <= least + 8 * 121
        assert spark.read.parquet(out).count() == sum(len(s) for s in slots.values())
    same = str(tmp_path / "same")
    table, (old, shard, _) = reshard.reshard_table(spark, f"{source}/{next(f.name for f in (tmp_path / 'table').iterdir() if f.suffix == '.parquet')}", same, 1)
    assert table.where(f"{old} <> {shard}").count() == 0 and not (tmp_path / "same").exists()


def test_reshard_keeps_clashing_columns(spark):
    rows = spark.createDataFrame([(i, 0, i, 5, -1, -2) for i in range(30)], "doc_id int, old int, position long, size long, block int, cuts int")
    placed = reshard.assign(rows, 3, old="old", position="position", size="size")
    assert placed.columns == [*rows.columns, "shard", "slot"]
    assert {tuple(r[-4:-2]) for r in placed.collect()} == {(-1, -2)}


def cut_up(word):
    """All segmentations of a word."""
    if not word:
        return [[]]
    return [[word[:n], *rest] for n in range(1, len(word) + 1) for rest in cut_up(word[n:])]


def fitted_by_hand(rows, path, rounds):
    """Expectation maximisation over listed segmentations, texts one by one."""
    pieces = langid.Pieces.shared(path)
    langs = sorted({lang for _, lang in rows})
    number = lambda piece: pieces.number.get(piece, int(len(piece) == 1))
    p = np.full((pieces.size, len(langs)), 1.0 / pieces.size)
    p[0] = 0
    for _ in range(rounds):
        counts = np.full(p.shape, langid.SMOOTHING)
        for text, lang in dict.fromkeys(rows):
            at = langs.index(lang)
            for words in langid.words_of(text):
                for w in words:
                    ways = [[number(x) for x in way] for way in cut_up(langid._EDGE + w)]
                    weights = [float(np.prod([p[i, at] for i in way])) for way in ways]
                    for way, weight in zip(ways, weights, strict=True):
                        for i in way:
                            counts[i, at] += weight / sum(weights)
        counts[0] = 0
        p = counts / counts.sum(axis=0)
    return langs, p


def test_language_fit_against_listed_segmentations(spark):
    path = PIECES
    rows = [("the cat sat", "en"), ("the cat sat", "en"), ("le chat a été", "fr"), ("a hat, the hat", "en"), ("ça va", "fr"), ("ж", "ru"), ("", "en")]
    df = spark.createDataFrame([*rows, (None, "en"), ("no language", None)], "text string, lang string")
    langs, probability = langid.fit(df, path, rounds=2)
    want_langs, want = fitted_by_hand(rows, path, 2)
    assert langs == want_langs and np.allclose(probability, want, rtol=1e-9, atol=1e-15)


def test_language_ties_go_to_the_first(spark):
    """Two languages with the same texts: the first by name, at one half."""
    path = PIECES
    df = spark.createDataFrame([("one two", "b"), ("one two", "a")], "text string, lang string")
    langs, probability = langid.fit(df, path, rounds=2)
    out, (name, score) = langid.predicted(df, langs, probability, path)
    assert {(r[name], round(r[score], 9)) for r in out.collect()} == {("a", 0.5)}
