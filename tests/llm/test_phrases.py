"""Phrases and source divergences: against plain counting, and the cases that the given tables lack."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from lectern.llm import divergence, phrases, spans

TEXTS = [None, "", " \t ", ".,;", "one", "A b  c\td. a B c d; é É ½", "x" * 70_000, "a b c d e", "the the the the", "a\x0bb\x0cc\rd", " ".join(f"w{i % 7}" for i in range(9000)), "a b c d e", "漢字 漢字 漢字"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, (None, "en", "", "und")[i % 4], (None, "s", "")[i % 3], 1, 2, 3) for i, t in enumerate(TEXTS * 3)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n int, f int, words int").repartition(4)


def plain_phrases(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = defaultdict(Counter)
    for text, lang in rows:
        for c in ".,;:!?\n\x0b\x0c\r":
            text = (text or "").replace(c, "\n")
        for piece in text.translate(lower).split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            for k in range(1, 5):
                counts["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return counts


def plain_collocations(rows, least, top):
    out = []
    for lang, f in plain_phrases(rows).items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in candidates.items():
            inside = (q for q, b in candidates.items() if len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))))
            if next(inside, None) is None:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        n = sum(v for p, v in f.items() if len(p) == 1)
        out += [(lang, i, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("sample, sample_least", [(1, 1), (2, 2), (16, 50), (10**6, 1)])
def test_collocations_whatever_the_sample_proposes(docs, sample, sample_least):
    """With a poor or empty sample the border fails and further passes find the rest."""
    want = plain_collocations([(r["text"], r["lang"]) for r in docs.collect()], 3, 40)
    out = phrases.collocations(docs, least=3, top=40, sample=sample, sample_least=sample_least)
    assert sorted(tuple(r) for r in out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == want
    _, _, passes = phrases.frequent(docs, least=3, sample=sample, sample_least=sample_least)
    assert passes > 1 if sample == 10**6 else passes >= 1


def test_collocations_of_nothing(docs):
    assert phrases.collocations(docs.where("false")).count() == 0
    assert phrases.collocations(docs.select("text", "lang"), least=10**9).count() == 0


def test_ranking_in_shares(docs, monkeypatch):
    whole = sorted(map(tuple, phrases.collocations(docs, least=2, top=5).collect()))
    monkeypatch.setattr(phrases, "RANKED", 3)
    assert sorted(map(tuple, phrases.collocations(docs, least=2, top=5).collect())) == whole


def test_hashes_of_passes_and_of_texts_agree():
    data = "aa b  c\taa b. c aa".encode()
    table = np.zeros(phrases.BITS // 8, np.uint8)
    every = [(t.as_py(), n) for found, n, _ in phrases._phrases(data, "en", None, None) for t in found]
    assert {p for p, _ in every} == {"aa", "b", "c", "aa b", "b c", "c aa", "aa b c", "b c aa", "c aa b", "aa b c aa", "b c aa b"}
    for at in phrases._bits(phrases.phrase_hashes(["en"] * len(every), [p.encode() for p, _ in every])):
        np.bitwise_or.at(table, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))
    again = [(t.as_py(), n) for found, n, _ in phrases._phrases(data, "en", table, None) for t in found]
    assert again == every
    assert not list(phrases._phrases(data, "en", table, table))


def shares(counts, kept):
    n = sum(counts[t] for t in kept)
    return [1 + 10**9 * (counts[t] + 2) // (n + 2 * len(kept)) for t in kept]


def plain_audit(rows, least, top):
    groups, docs_of, total = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in (text or "").translate(lower)).split(" ")
        found = [t for t in found if t]
        groups[lang, source].update(found)
        docs_of[lang].update(set(found))
        total[lang].update(found)
    out = []
    for (lang, source), mine in groups.items():
        kept = [t for t in total[lang] if docs_of[lang][t] >= least]
        gap = lambda p, q: (p - q) * (p - q) // (p + q)
        own, whole = shares(mine, kept), shares(total[lang], kept)
        pairs = [(-sum(map(gap, own, shares(other, kept))), s) for (ln, s), other in groups.items() if ln == lang and s != source]
        terms = [(-gap(p, q), t) for t, p, q in zip(kept, own, whole, strict=True) if mine[t] and p > q]
        for part, listed in (("pair", pairs), ("term", terms)):
            listed.sort(key=lambda x: (x[0], x[1].encode()))
            out += [(lang, source, part, item, -v, i) for i, (v, item) in enumerate(listed, 1) if part == "pair" or i <= top]
    return sorted(out)


@pytest.mark.parametrize("least", [1, 3, 100])
def test_audit_by_plain_sums(docs, least):
    want = plain_audit([(r["text"], r["lang"], r["source"]) for r in docs.collect()], least, 4)
    got = divergence.audit(docs, least_docs=least, top=4).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(map(tuple, got)) == want
    assert divergence.audit(docs.where("false")).count() == 0


def test_audit_over_bands_and_blocks(spark, monkeypatch):
    """More groups than a band and a leaf hold, more terms than a block."""
    monkeypatch.setattr(divergence, "BAND", 40)
    monkeypatch.setattr(divergence, "COLUMNS", 100)
    rng = np.random.default_rng(3)
    rows = [(" ".join("".join(chr(97 + int(c)) for c in f"{int(v):04d}") for v in rng.zipf(1.3, 60) if v < 9000), "en", f"s{i % 90}") for i in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    monkeypatch.setattr(divergence, "_block", _block_with(40))
    got = divergence.audit(df, least_docs=1, top=2).collect()
    assert sorted(tuple(r) for r in got) == plain_audit(rows, 1, 2)


def _block_with(band):
    def work(key, table):
        from lectern.llm import divergence as d

        d.BAND = band
        return d._block(key, table)

    return work


def test_tree_walks_every_cell_once():
    rng = np.random.default_rng(1)
    rows, columns = np.divmod(np.unique(rng.integers(0, 70 * 300, 200)), 300)
    tree = divergence.Tree(rows, columns, np.ones(len(rows), np.int64), 70, 300)
    assert tree.cells.sum() == len(rows) and len(tree.bits) == tree.height == 4
    met = {(a, b, x, y) for x, y, a, b in zip(*(v.tolist() for v in tree.pairs()), strict=True)}
    blocks = {(r // 32, c // 32) for r, c in zip(rows.tolist(), columns.tolist(), strict=True)}
    assert len(met) == sum((a, c) in blocks or (b, c) in blocks for a in range(3) for b in range(a, 3) for c in range(10))
    empty = divergence.Tree(rows[:0], columns[:0], rows[:0], 5, 0)
    assert not empty.any and not len(empty.pairs()[0])


def test_spans():
    data = "Ünder  the\tsea ".encode()
    starts, ends = spans.word_spans(data, phrases.WORD)
    assert spans.as_text(spans.slices(data, starts, ends)).to_pylist() == ["Ünder", "the", "sea"]
    assert spans.numbered(pa.array([b"a", b"b", b"a"]))[0].tolist() == [0, 1, 0]
