"""Words of many texts at once, as spans of one buffer and as exact numbers within it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from lectern.llm import kit


def word_spans(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each word starts and ends; table: by byte value, True in words."""
    edge = np.diff(table[np.frombuffer(data, np.uint8)].astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def slices(data: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """data[start:end] of each pair as one array of bytes."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    body = np.frombuffer(data, np.uint8)[at]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(body)])


def as_text(words: pa.Array) -> pa.Array:
    """Bytes as strings; cuts at ASCII bytes never split a character."""
    return words.cast(pa.large_string()).cast(pa.string())


def numbered(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The number of each word, and the distinct words by number: exact, without hashes."""
    coded = words.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def buffers(texts: list[bytes | None], limit: int) -> Iterator[tuple[bytes, np.ndarray, int]]:
    """Texts in lower case joined by line feeds, about limit bytes at a time: buffer, where each text starts, number of the first."""
    done = 0
    for group in kit.grouped(texts, limit):
        yield b"\n".join(t or b"" for t in group).translate(kit.LOWER), np.cumsum([0, *(len(t or b"") + 1 for t in group)]), done
        done += len(group)


def summed(keys: np.ndarray, *weights: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, and the sum of each weight over them (sums below 2**53)."""
    found, at = np.unique(keys, return_inverse=True)
    return found, *(np.bincount(at, w, len(found)).astype(np.int64) for w in weights)
