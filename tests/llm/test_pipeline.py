"""The pipeline against brute force, stage by stage on the smallest tables."""

import base64

import brute
import corpus_pipeline
import public_tokenizers as P
import tiktoken
from conftest import SF


def test_pipeline_matches_brute_force(spark, docs):
    rows = {r["doc_id"]: r.asDict() for r in docs.collect()}
    good = brute.cleaned_texts([(d, r["source"], r["text"]) for d, r in rows.items()])
    texts = [(d, good[d]) for d in sorted(good)]
    kept = brute.near_duplicates(texts)
    texts = [(d, t) for d, t in texts if kept[d][2]]
    cut, left = brute.repeats(texts), []
    seen = set()
    for d, t in texts:
        w = brute.SPACED.findall(t)
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            k = tuple(w[i : i + 20])
            if k in seen:
                gone[i : i + 20] = [True] * 20
            seen.add(k)
        assert cut[d][1] == sum(gone)
        if not all(gone) or not w:
            left.append((d, " ".join(x for x, g in zip(w, gone) if not g) if any(gone) else t))
    items = [(r[0], r[1]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = brute.contamination(left, items)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    tik = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {d: (tik.encode_ordinary(t), brute.sha(t)) for d, t in left if not bad[d][-1]}
    got = {r["doc_id"]: (list(r["ids"]), r["decoded_sha256"]) for r in corpus_pipeline.run(spark, SF).collect()}
    assert got == expected


def test_stages_keep_columns(spark, docs, empty):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, empty, SF).count() == 0
