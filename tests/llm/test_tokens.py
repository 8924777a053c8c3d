"""Byte-level BPE and token counts against the libraries."""

import base64
import time

import brute
import public_tokenizers as P
import pytest
import tiktoken
from conftest import EDGE_TEXTS, SF
from hypothesis import given, settings
from hypothesis import strategies as st
from lectern.llm import bytebpe, queries, tokencount
from tokenizers import Tokenizer

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
TIK = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
HF = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
BPE = bytebpe.ByteBpe.shared(PATH, P.PATTERN)
COUNTS = tokencount.Counts.shared(P.path("byte_bpe_50k.json"))


def packed(ids):
    return b"".join(i.to_bytes(4, "little") for i in ids)


def texts(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def test_bpe_query_matches_the_library(spark):
    out = {r[0]: tuple(r)[1:] for r in queries.op3_byte_bpe(spark, SF).collect()}
    assert out == {d: (len(i := TIK.encode_ordinary(t)), brute.sha(packed(i)), brute.sha(t)) for d, t in texts(spark)}


def test_bpe_edges(spark, edges, edge_rows, empty):
    out = {r[0]: tuple(r)[1:] for r in bytebpe.round_trip_report(edges, PATH, P.PATTERN).collect()}
    assert out == {d: (len(i := TIK.encode_ordinary(t or "")), brute.sha(packed(i)), brute.sha(t or "")) for d, t in edge_rows}
    ids, name = bytebpe.encoded(edges, PATH, P.PATTERN)
    back, plain = bytebpe.decoded(ids, PATH, P.PATTERN, ids=name)
    assert {r["doc_id"]: bytes(r[plain]).decode() for r in back.collect()} == {d: t or "" for d, t in edge_rows}
    assert bytebpe.round_trip_report(empty, PATH, P.PATTERN).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\t\r\x0b\x1c\x1f\x85  ab'sZé漢9!<|>…😀"), max_size=60))
def test_bpe_and_counts_on_any_text(text):
    assert BPE.encode(text) == packed(TIK.encode_ordinary(text))
    assert BPE.decode(BPE.encode(text)).decode() == text
    assert COUNTS.count(text) == len(HF.encode(text, add_special_tokens=False).ids)
    assert COUNTS.count(text, chunk=8, overlap=2) == len(HF.encode(text, add_special_tokens=False).ids)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["the", "quick", "brown", "x" * 40, "12", "<|endoftext|>", "…", "\n", "don't", ""]), max_size=80))
def test_resynchronised_counts(words):
    text = " ".join(words)
    for chunk, overlap in ((20, 3), (64, 8), (6, 3)):
        assert COUNTS.resynchronised(text, chunk, overlap) == len(HF.encode(text, add_special_tokens=False).ids)


def test_count_query_matches_the_library(spark, edges, edge_rows, empty):
    out = {r[0]: tuple(r)[1:] for r in queries.op9_token_counts(spark, SF).collect()}
    assert out == {d: (len(t.encode()), n := len(HF.encode(t, add_special_tokens=False).ids), n > 512) for d, t in texts(spark)}
    out = {r[0]: r[2] for r in tokencount.report(edges, P.path("byte_bpe_50k.json")).collect()}
    assert out == {d: len(HF.encode(t or "", add_special_tokens=False).ids) for d, t in edge_rows}
    assert tokencount.report(empty, P.path("byte_bpe_50k.json")).count() == 0
    long = " ".join(t for t in EDGE_TEXTS if t) * 12
    assert COUNTS.resynchronised(long) == len(HF.encode(long, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" \n\tab1'sé漢字。，.,(½<|>😀"), max_size=120), st.sampled_from([(8, 2), (20, 5), (5, 4)]))
def test_splices_anywhere(text, sizes):
    assert COUNTS.resynchronised(text, *sizes) == len(HF.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("piece", ["漢字仮名", "漢字。仮名、", "aGVsbG8xMjM0", "0123456789", "don't", " ", "<|endoftext|>", "ß"])
def test_long_texts_take_about_the_library_s_time(piece):
    text = piece * (600_000 // len(piece))
    encode = lambda: len(HF.encode_batch_fast([text], add_special_tokens=False)[0])
    encode()
    began = time.process_time()
    expected = encode()
    library = time.process_time() - began
    began = time.process_time()
    assert COUNTS.resynchronised(text) == expected
    assert time.process_time() - began < 2 * library + 1
