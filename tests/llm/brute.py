"""Plain versions of the operators' results, for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def contamination(docs, items, width=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""
    windows = defaultdict(set)
    for item, text in items:
        w = ALNUM.findall((text or "").translate(LOWER))
        n = min(width, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(item)
    sizes = {len(k) for k in windows}
    out = {}
    for doc, text in docs:
        w = ALNUM.findall((text or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    found |= windows[k]
                    hit[i : i + n] = [True] * n
        ids = sorted(str(i) for i in found if i is not None)
        out[doc] = (len(w), sum(hit), len(ids), sha(",".join(ids)), any(hit))
    return out


def shingles(text):
    w = SPACED.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def near_duplicates(docs):
    """{doc_id: (n_shingles, component_id, kept)}"""
    sets = {d: shingles(t) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    shared = Counter()
    for h in holders.values():
        for i, a in enumerate(h):
            for b in h[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(s), find(d), find(d) == d) for d, s in sets.items()}


def repeats(docs, width=20):
    """{doc_id: (n_words, n_removed, kept_sha256)}; docs in order of doc_id"""
    seen, out = set(), {}
    for d, text in sorted(docs, key=lambda x: x[0]):
        w = SPACED.findall(text or "")
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            k = tuple(w[i : i + width])
            if k in seen:
                gone[i : i + width] = [True] * width
            seen.add(k)
        out[d] = (len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def base_figures(text):
    text = text or ""
    w = SPACED.findall(text)
    tri = Counter(zip(w, w[1:], w[2:]))
    rep = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i : i + 3])] > 1:
            rep |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if SPACED.search(x)]
    failed = len(w) < 50 or 100 * len(rep) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(rep), failed


def _normal(line):
    return " ".join(SPACED.findall(line.translate(LOWER)))


def frequent_lines(docs, least_docs=20, share=0.1):
    """{(host, normalised line)}; docs: (doc_id, host, text)"""
    texts = defaultdict(set)
    for _, h, t in docs:
        texts[h].add(t or "")
    frequent = set()
    for h, ts in texts.items():
        n = Counter(x for t in ts for x in {_normal(line) for line in t.split("\n")} if x)
        frequent |= {(h, x) for x, k in n.items() if k >= least_docs and k > share * len(ts)}
    return frequent


def line_verdicts(docs, least_docs=20, share=0.1, least_words=50, least_kept=0.5):
    """{doc_id: kept}"""
    frequent, out = frequent_lines(docs, least_docs, share), {}
    for d, h, t in docs:
        f = base_figures(t)
        lost = sum(len(_normal(x).split(" ")) for x in (t or "").split("\n") if _normal(x) and (h, _normal(x)) in frequent)
        out[d] = not f[5] and f[0] - lost >= least_words and f[0] - lost >= least_kept * f[0]
    return out


def cleaned_texts(docs, **limits):
    """{doc_id: text without frequent lines} of the documents that stay"""
    kept, frequent = line_verdicts(docs, **limits), frequent_lines(docs, **limits)
    return {d: t if t is None else "\n".join(x for x in t.split("\n") if (h, _normal(x)) not in frequent) for d, h, t in docs if kept[d]}


def vector_links(rows):
    """(vec_id, n_links, component_id, kept) from all pairs in double precision; rows with distinct ids and finite vectors."""
    import numpy as np

    rows = sorted(rows)
    x = np.array([v for _, v in rows], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    label = list(range(len(rows)))
    for i in range(len(rows)):
        if label[i] != i:
            continue
        stack = [i]
        while stack:
            for j in np.flatnonzero(near[stack.pop()]).tolist():
                if label[j] == j and j != i:
                    label[j] = i
                    stack.append(j)
    return [(v, int(near[i].sum()), rows[label[i]][0], label[i] == i) for i, (v, _) in enumerate(rows)]
