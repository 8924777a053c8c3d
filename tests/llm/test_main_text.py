"""Main text: path ratios against a plain version, pages without semantic tags, awkward and long pages."""

import math
import random
import time
from collections import defaultdict
from html.parser import HTMLParser

import pytest
from lectern.llm import htmlmain

INLINE = {"b", "a", "i"}


class Tree(HTMLParser):
    """Text by block and path, for well-formed pages."""

    def __init__(self):
        super().__init__()
        self.path, self.blocks, self.new = [], [], True

    def handle_starttag(self, tag, attrs):
        self.path.append(f"{tag}.{dict(attrs).get('class', '')}")
        self.new |= tag not in INLINE

    def handle_endtag(self, tag):
        self.path.pop()
        self.new |= tag not in INLINE

    def handle_data(self, data):
        if data.split():
            if self.new:
                self.blocks.append([])
                self.new = False
            self.blocks[-1].append((tuple(self.path), " ".join(data.split())))


def plain_products(page):
    tree = Tree()
    tree.feed(page)
    chars, marks, nodes = defaultdict(int), defaultdict(int), defaultdict(int)
    for block in tree.blocks:
        for path, text in block:
            chars[path] += len(text)
            marks[path] += sum(text.count(c) for c in ".,;:!?")
        for path in {p for p, _ in block}:
            nodes[path] += 1
    rows = []
    for block in tree.blocks:
        size = sum(len(t) for _, t in block)
        length = sum((1 - math.exp(-chars[p] / nodes[p] / 100)) * len(t) for p, t in block) / size
        mark = sum(min(1, (marks[p] / nodes[p] + 1) / 4) * len(t) for p, t in block) / size
        rows.append((length, mark))
    out = []
    for i in range(len(rows)):
        near = [(rows[j], math.exp(-((i - j) ** 2) / 0.72)) for j in (i - 1, i, i + 1) if 0 <= j < len(rows)]
        total = sum(w for _, w in near)
        out.append(math.prod(sum(r[k] * w for r, w in near) / total for k in (0, 1)))
    return [" ".join(" ".join(t for _, t in b).split()) for b in tree.blocks], out


def random_page(rng, depth=0):
    parts = []
    for _ in range(rng.randrange(1, 5)):
        kind = rng.choice(["text", "p", "div", "ul", "links"] if depth < 3 else ["text", "p"])
        words = " ".join(rng.choice(["word", "longer word,", "end.", "so", "and more;"]) for _ in range(rng.choice([1, 3, 20, 60])))
        if kind == "text":
            parts.append(f"<p> {words} <b>bold, too</b> {words}</p>")
        elif kind == "p":
            parts.append(f"<p>{words}</p>")
        elif kind == "links":
            parts.append("<div class='top'>" + " ".join(f"<a href='/{i}'>link {i}</a>" for i in range(3)) + "</div>")
        elif kind == "ul":
            parts.append("<ul>" + "".join(f"<li>item {i}</li>" for i in range(rng.randrange(1, 4))) + "</ul>")
        else:
            parts.append(f"<div class='{rng.choice('abc')}'>{random_page(rng, depth + 1)}</div>")
    return "".join(parts)


def test_products_match_a_plain_version():
    rng = random.Random(11)
    for _ in range(300):
        page = f"<body>{random_page(rng)}</body>"
        texts, products = plain_products(page)
        reader = htmlmain._Reader(page)
        assert [b.text for b in reader.blocks] == texts
        assert htmlmain.fused_ratios(reader.blocks) == pytest.approx(products)
        # Everything here is free of votes, so what passes the threshold is content.
        level = 0.3 * max(products)
        out = htmlmain.main_text(page).split("\n")
        assert set(t for t, p in zip(texts, products) if p >= level * (1 + 1e-9)) <= set(out) <= set(texts)


STORY = "".join(f"<div>Line {i} of the story, which is long, and which goes on for a while.</div>" for i in range(9))
TEXT = "\n".join(f"Line {i} of the story, which is long, and which goes on for a while." for i in range(9))
MENU = "<div><a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a></div>"
PLAIN = {
    f"<body>{MENU}{STORY}<div>© 2024 Example, all rights reserved.</div></body>": TEXT,
    f"<div>{MENU}<div><h1>Title</h1>{STORY}</div><div><a>Terms of use</a> <a>Contact</a></div></div>": f"Title\n{TEXT}",
    f"<div class='content no-sidebar'>{STORY}</div>": TEXT,
    f"<article><div class='entry-header'><h1>Title</h1></div>{STORY}</article>": f"Title\n{TEXT}",
    f"<div class=ads>{STORY}</div>": TEXT,
    f"<div class=teaser><article>Read on.</article></div><div>{STORY}</div>": TEXT,
    f"<div>{STORY}</div><div class=comments><p>Nice story, thanks for it, I liked it a lot.</p></div>": TEXT,
}


@pytest.mark.parametrize("page", PLAIN)
def test_pages_without_semantic_tags(page):
    assert htmlmain.main_text(page) == PLAIN[page]


PARAGRAPH = "This paragraph is about one hundred and thirty characters long, so that it counts as a full one, with commas, and it ends like so."
BODY = "".join(f"<p>{PARAGRAPH} {i}</p>" for i in range(4))
ARTICLE = f"<article><h1>T</h1>{BODY}%s</article>"
WHOLE = "\n".join(["T", *(f"{PARAGRAPH} {i}" for i in range(4))])


@pytest.mark.parametrize("product", [0.7, 1.0])
def test_the_ratios_decide(monkeypatch, product):
    """With ratios that are all alike, nothing else keeps menus, rights, adverts, discussions and sidebars out."""
    pages = [f"<body>{MENU}{STORY}<div>© 2024 Example.</div></body>", f"<body><div class=ad>Buy it.</div><article><h1>T</h1>{STORY}</article></body>", f"<body><div class=sidebar>See also this.</div>{ARTICLE % ''}</body>", ARTICLE % "<div id=disc><p>Great piece!</p><p>Boo.</p></div>"]
    right = [htmlmain.main_text(p) for p in pages]
    monkeypatch.setattr(htmlmain, "fused_ratios", lambda found: [product] * len(found))
    assert all(htmlmain.main_text(p) != r for p, r in zip(pages, right))


def test_the_ratios_decide_on_given_pages(spark, monkeypatch):
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()]
    right = [htmlmain.main_text(p) for p in pages]
    monkeypatch.setattr(htmlmain, "fused_ratios", lambda found: [1.0] * len(found))
    assert sum(htmlmain.main_text(p) != r for p, r in zip(pages, right)) > len(pages) / 2


NAMES = "share-of-market social-history comment-worthy related-work menu-of-options notice-period tags ad-hoc header-note reply-all skip-level footer-notes promo-code sidebar-note widget-theory newsletter comments-on-law"


@pytest.mark.parametrize("name", NAMES.split())
def test_no_name_drops_a_full_paragraph(name):
    for piece in (f'<p class="{name}">{PARAGRAPH} x</p>', f'<div class="{name}"><p>{PARAGRAPH} x</p></div>', f'<section id="{name}"><p>{PARAGRAPH} x</p></section>'):
        assert htmlmain.main_text(ARTICLE % (piece + BODY)) == f"{WHOLE}\n{PARAGRAPH} x\n" + WHOLE[2:]


@pytest.mark.parametrize("piece", [
    "<div id=disc><p>Great piece!</p><p>Boo.</p></div>", "<div class=paywall><p>Log in to read more.</p></div>", f"<section class=comments><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></section>",
    f"<div class=comment-list><div><p>{PARAGRAPH}</p></div></div>", "<div class=related><a href=/a>One more story</a> <a href=/b>And another</a></div>", "<div class='share buttons'>Share it</div>", "<ul><li><a href=/t>tag</a></li></ul>",
])
def test_what_stands_behind_the_article_s_text_goes(piece):
    assert htmlmain.main_text(ARTICLE % piece) == WHOLE
    assert htmlmain.main_text(f"<body>{ARTICLE % ''}{piece}</body>") == WHOLE


@pytest.mark.parametrize("piece, text", [
    ("<ul><li>one</li><li>two</li></ul>", "one\ntwo"), ("<h2>Notes</h2><ol><li>a</li></ol>", "Notes\na"), ("<figure><figcaption>Cap.</figcaption></figure>", "Cap."), ("<blockquote>Q.</blockquote>", "Q."),
    ("<p>End.</p>", "End."), ("<table><tr><td>1</td><td>2</td></tr></table>", "1\n2"), ("<dl><dt>x</dt><dd>y</dd></dl>", "x\ny"), ("<p class=tags>End.</p>", "End."),
])
def test_short_text_of_the_article_stays(piece, text):
    assert htmlmain.main_text(ARTICLE % piece) == f"{WHOLE}\n{text}"
    assert htmlmain.main_text(ARTICLE % (piece + BODY)) == f"{WHOLE}\n{text}\n{WHOLE[2:]}"


def test_broken_markup():
    assert htmlmain.main_text("<p>one</p><p>a < b and c<d</p>") == "one\na < b and c"
    assert htmlmain.main_text('<p title="open>one</p><p>two</p>') == "one\ntwo"
    assert htmlmain.main_text("<p>one <a href='x") == "one"
    assert htmlmain.main_text("<p>&amp;lt; x</p></nothing></b>") == "&lt; x"
    assert htmlmain.main_text("<p>x<!--> y <!-- z") == "x y"


@pytest.mark.parametrize("piece", ["<a ", '<a "', '<a =">" ', "<script></script ", "<!--", "</x>", "<div>x y", "<b>x ", "<div class=ad>x. ", "<b><table></b>"])
def test_reading_is_linear(piece):
    page = "<p>" + piece * (300_000 // len(piece))
    began = time.process_time()
    htmlmain.main_text(page)
    assert time.process_time() - began < 3


def test_edge_rows(spark):
    rows = [(None, "u", f"<article>{STORY}</article>"), (1, None, None), (1, "u", "<p>same id</p>"), (2, "u", ""), (3, "u", f"<div>{STORY * 2000}</div>")]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    out = sorted(((r["page_id"], r["text"]) for r in htmlmain.report(frame).collect()), key=str)
    assert out == sorted([(None, TEXT), (1, ""), (1, "same id"), (2, ""), (3, "\n".join([TEXT] * 2000))], key=str)
    assert htmlmain.report(frame.where("false")).count() == 0
    assert htmlmain.extracted(frame)[0].count() == 5
