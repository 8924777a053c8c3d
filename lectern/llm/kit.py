"""Small shared helpers: scratch tables, Arrow batches and vectorised word hashing.

Words are hashed from UTF-8 bytes with numpy, so a task never holds a Python
object per word. All hashes are 64 bit and the same on every machine.
"""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are hashed together.
GROUP_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S30, _S27, _S31 = np.uint64(30), np.uint64(27), np.uint64(31)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the whole word."""
    x = (x ^ (x >> _S30)) * _M1
    x = (x ^ (x >> _S27)) * _M2
    return x ^ (x >> _S31)


_BYTE_CODES = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept and doubled as needed."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        have = np.empty(size, np.uint64)
        have[0] = 1
        done = 1
        while done < size:
            have[done : 2 * done] = have[:done] * np.uint64(pow(base, done, 1 << 64))
            done *= 2
        _powers[base] = have
    return have[:n]


def _range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rabin-Karp hash of codes[start:end] for each pair, from one prefix sum."""
    n = len(codes)
    prefix = np.empty(n + 1, np.uint64)
    prefix[0] = 0
    np.cumsum(codes * _power_table(_BASE, n), out=prefix[1:])
    spans = (prefix[ends] - prefix[starts]) * _power_table(_INVERSE, n + 1)[starts]
    return mixed(spans + (ends - starts).astype(np.uint64) * _ODD)


def word_class(separators: bytes) -> np.ndarray:
    """A lookup by byte value that is True for all bytes but the separators."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words are runs of anything but ASCII white space.
SPACED = word_class(bytes([0x20, *range(0x09, 0x0E)]))
#: Words are runs of ASCII letters, digits and anything beyond ASCII.
WORDLIKE = word_class(bytes(b for b in range(0x80) if not chr(b).isalnum()))
#: Lower-cases A-Z and leaves every other byte alone.
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def _hashed(data: bytes, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start offset and hash of each word of data."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff(table[raw].astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out = np.empty(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + GROUP_BYTES)))
        a, b = int(starts[lo]), int(ends[hi - 1])
        out[lo:hi] = _range_hashes(_BYTE_CODES[raw[a:b]], starts[lo:hi] - a, ends[lo:hi] - a)
        lo = hi
    return starts, out


def word_hashes(texts: list[bytes | None], table: np.ndarray = SPACED, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, text after text, and the number of words of each text."""
    hashes, counts = [], []
    for group in grouped(texts):
        data = b"\n".join(t or b"" for t in group)
        starts, found = _hashed(data.translate(LOWER) if lower else data, table)
        bounds = np.cumsum([0, *(len(t or b"") + 1 for t in group)])
        hashes.append(found)
        counts.append(np.diff(np.searchsorted(starts, bounds)))
    if not hashes:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp hash of every run of width words."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    at = np.arange(n)
    return _range_hashes(words, at, at + width)


def _stretches(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive rows [a, b) of about limit bytes; a longer row stands alone."""
    a, held = 0, 0
    for i, size in enumerate(sizes):
        if i > a and held + size > limit:
            yield a, i
            a, held = i, 0
        held += size
    if sizes:
        yield a, len(sizes)


def grouped(texts: list[bytes | None], limit: int = GROUP_BYTES) -> Iterator[list[bytes | None]]:
    """Consecutive texts in groups of about limit bytes; a longer text stands alone."""
    for a, b in _stretches([len(t or b"") for t in texts], limit):
        yield texts[a:b]


def column_bytes(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def cut(batch: pa.RecordBatch, name: str, limit: int = GROUP_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of a batch that hold about limit bytes of the named text column; only a slice's texts are Python objects."""
    column = batch.column(batch.schema.get_field_index(name)).cast(pa.binary())
    for a, b in _stretches(pc.fill_null(pc.binary_length(column), 0).to_pylist(), limit):
        yield batch.slice(a, b - a), column.slice(a, b - a).to_pylist()


def release() -> None:
    """Gives Arrow memory that a worker no longer needs back to the system."""
    pa.default_memory_pool().release_unused()


def give_back() -> None:
    """All memory that a worker has freed: Arrow's, and what glibc keeps until it is asked; other C libraries have no such call."""
    release()
    if trim := getattr(ctypes.pythonapi, "malloc_trim", None):
        trim(0)


def giving_back(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """work for mapInArrow, after which the worker, which waits for other tasks, gives back what it has freed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        give_back()

    return task


def free_name(df: DataFrame, wish: str) -> str:
    """A column name that df doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def text_digest(text: str) -> Column:
    """128 bits of a text column; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


_own: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: spark.checkpoint.dir; where that is unset, one of our own if all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="spark-lectern-")
    return _own[app]


#: Spark's setting that drops a query's shuffle files when the query ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writing: Counter = Counter()
_before: dict[str, str | None] = {}
_lock = threading.Lock()


@contextlib.contextmanager
def _cleaning_up(spark: SparkSession) -> Iterator[None]:
    """Holds the setting on while any write of the application runs, and puts it back after the last."""
    app = spark.sparkContext.applicationId
    with _lock:
        if not _writing[app]:
            _before[app] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _writing[app] += 1
    try:
        yield
    finally:
        with _lock:
            _writing[app] -= 1
            if not _writing[app]:
                if (before := _before.pop(app)) is None:
                    spark.conf.unset(_CLEANUP)
                else:
                    spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: cuts the lineage and survives lost executors.

    The shuffle files of the write are dropped when it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"
    with _cleaning_up(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
