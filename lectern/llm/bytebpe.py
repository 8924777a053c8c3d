"""Byte-level BPE through a sentencepiece model serialised from a rank file.

The rank file's byte strings become pieces by mapping each byte to one
printable character. A piece's score is its negative rank, so sentencepiece
merges in rank order; the normaliser is the identity. Pre-tokens are encoded
one by one; decoding maps pieces back to bytes.

A rank file may hold a token that its own merges can't build; a pre-token that
is itself a token is therefore looked up first.

Pre-tokens repeat, so each worker keeps the ids of those it has met (up to
``CACHE``). A text is cut before single spaces between two other characters:
no pre-token crosses such a place, so each part is encoded by itself.

Defined results: a null text is empty; decoding unknown or null ids raises.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lectern.llm import kit

CACHE = 400_000


def byte_characters() -> list[str]:
    """A printable character for each byte: itself where it prints, else one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file by rank; the ranks have no gaps."""
    with open(path, "rb") as f:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, f.read().splitlines()))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("the ranks have gaps")
    return [t for _, t in pairs]


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | 2) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    return _varint(number << 3) + _varint(value)


def serialised_model(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece ids are the ranks; the unknown piece comes last."""
    # Fixed values of the public sentencepiece model format: field numbers and enumerations.
    pieces, trainer, normaliser = 1, 2, 3
    piece, score, kind, unknown = 1, 2, 3, 2
    model_type, bpe, vocab_size, unk_id, bos_id, eos_id, pad_id, byte_fallback = 3, 2, 4, 40, 41, 42, 43, 35
    name, dummy_prefix, extra_spaces, escape_spaces = 1, 3, 4, 5
    minus_one = (1 << 64) - 1
    chars = byte_characters()
    out = bytearray()
    for rank, token in enumerate(tokens):
        out += _field(pieces, _field(piece, "".join(chars[b] for b in token).encode()) + _field(score, float(-rank)))
    out += _field(pieces, _field(piece, b"<unk>") + _field(score, 0.0) + _field(kind, unknown))
    out += _field(trainer, _field(model_type, bpe) + _field(vocab_size, len(tokens) + 1) + _field(byte_fallback, 0) + _field(unk_id, len(tokens)) + _field(bos_id, minus_one) + _field(eos_id, minus_one) + _field(pad_id, minus_one))
    out += _field(normaliser, _field(name, b"identity") + _field(dummy_prefix, 0) + _field(extra_spaces, 0) + _field(escape_spaces, 0))
    return bytes(out)


#: Every white space but the space itself.
_OTHER_SPACES = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]


def independent_parts(text: str) -> list[str] | None:
    """text cut before each single space between other characters; None if other spaces occur."""
    first, *rest = text.split(" ")
    if not first or "" in rest or any(c in text and (f" {c}" in text or f"{c} " in text) for c in _OTHER_SPACES):
        return None
    return [first, *[" " + x for x in rest]]


class ByteBpe:
    """Encoder and decoder of one vocabulary; build it once per worker with ``shared``."""

    _shared: dict[tuple[str, str], ByteBpe] = {}

    def __init__(self, path: str, pattern: str):
        import sentencepiece

        self.tokens = read_ranks(path)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialised_model(self.tokens))
        self.pattern = regex.compile(pattern)
        self.rank = {t: i for i, t in enumerate(self.tokens)}
        self.table = dict(enumerate(byte_characters()))
        back = {c: b for b, c in self.table.items()}
        self.bytes_of = [bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(self.tokens))]
        self.cache: dict[str, bytes] = {}

    @classmethod
    def shared(cls, path: str, pattern: str) -> ByteBpe:
        if (path, pattern) not in cls._shared:
            cls._shared[path, pattern] = cls(path, pattern)
        return cls._shared[path, pattern]

    def _fill(self, parts: set[str]) -> None:
        """Encodes parts that the cache lacks, all pre-tokens in one call, as calls are dear."""
        new = [p for p in parts if p not in self.cache]
        if not new:
            return
        if len(self.cache) + len(new) > CACHE:
            self.cache.clear()
            new = list(parts)
        cuts = [self.pattern.findall(p) for p in new]
        packed, rest = {}, []
        for m in set(chain.from_iterable(cuts)):
            rank = self.rank.get(m.encode())
            if rank is None:
                rest.append(m)
            else:
                packed[m] = struct.pack("<I", rank)
        ids = self.model.encode([m.encode().decode("latin-1").translate(self.table) for m in rest], num_threads=1) if rest else []
        packed |= {m: struct.pack(f"<{len(i)}I", *i) for m, i in zip(rest, ids, strict=True)}
        self.cache.update((p, b"".join(map(packed.__getitem__, c))) for p, c in zip(new, cuts, strict=True))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers."""
        cuts = [independent_parts(t) or self.pattern.findall(t) for t in texts]
        wanted = set(chain.from_iterable(cuts))
        if len(wanted) <= CACHE // 2:
            self._fill(wanted)
            return [b"".join(map(self.cache.__getitem__, c)) for c in cuts]
        return [b"".join(self._slices(c)) for c in cuts]

    def _slices(self, parts: list[str], step: int = CACHE // 4) -> Iterator[bytes]:
        """Ids of a text with more distinct parts than the cache should hold, slice by slice."""
        for at in range(0, len(parts), step):
            some = parts[at : at + step]
            self._fill(set(some))
            yield b"".join(map(self.cache.__getitem__, some))

    def encode(self, text: str) -> bytes:
        """Ids of one text."""
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that encoded ids stand for."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I")))


def _rows(path: str, pattern: str, text: str, emit, out_schema: pa.Schema, keep: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(path, pattern)
        for batch in batches:
            for part, texts in kit.cut(batch, text):
                own = list(zip(*(emit(bpe, ids) for ids in bpe.encode_all([(t or b"").decode() for t in texts])), strict=True))
                cols = [part.column(part.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*cols, *(pa.array(x, f.type) for x, f in zip(own, out_schema, strict=True))], [*keep, *out_schema.names])
        # the worker lives on and may serve another operator next
        bpe.cache.clear()
        kit.release()

    return work


def encoded(docs: DataFrame, path: str, pattern: str, *, text: str = "text") -> tuple[DataFrame, str]:
    """docs with a column of token ids (array of int); returns the frame and that column's name."""
    import numpy as np

    name = kit.free_name(docs, "ids")
    schema = pa.schema([(name, pa.list_(pa.int32()))])
    work = _rows(path, pattern, text, lambda bpe, ids: (np.frombuffer(ids, np.int32),), schema, docs.columns)
    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])), name


def decoded(tokens: DataFrame, path: str, pattern: str, *, ids: str = "ids") -> tuple[DataFrame, str]:
    """tokens with a binary column of the bytes that each row's ids stand for (null ids: null)."""
    name = kit.free_name(tokens, "decoded")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe.shared(path, pattern)
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            raw = [None if r is None else b"".join(map(bpe.bytes_of.__getitem__, r)) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], [*batch.schema.names, name])

    return tokens.mapInArrow(work, T.StructType([*tokens.schema.fields, T.StructField(name, T.BinaryType())])), name


def round_trip_report(docs: DataFrame, path: str, pattern: str, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: number of tokens, hash of the ids, hash of the bytes they decode to."""
    schema = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    work = _rows(path, pattern, text, lambda bpe, ids: (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()), schema, [doc_id])
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return docs.select(doc_id, text).mapInArrow(work, T.StructType([docs.schema[doc_id], *fields]))


def encoded_and_verified(docs: DataFrame, path: str, pattern: str, *, text: str = "text") -> tuple[DataFrame, tuple[str, str]]:
    """docs with token ids and the hash of the bytes they decode to, in one Python step; returns those columns' names too."""
    import numpy as np

    names = (kit.free_name(docs, "ids"), kit.free_name(docs, "decoded_sha256"))
    schema = pa.schema([(names[0], pa.list_(pa.int32())), (names[1], pa.string())])
    work = _rows(path, pattern, text, lambda bpe, ids: (np.frombuffer(ids, np.int32), hashlib.sha256(bpe.decode(ids)).hexdigest()), schema, docs.columns)
    return docs.mapInArrow(work, T.StructType([*docs.schema.fields, T.StructField(names[0], T.ArrayType(T.IntegerType())), T.StructField(names[1], T.StringType())])), names
