"""Alignment of word sequences, phrase segmentation and monotone matching."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.family import cut
from lectern.operators.segments import STRETCH, dealt_phrases

#: Target words beyond the line's own number that an alignment may use.
SLACK = 4
#: A verdict of one alignment: cost, target words consumed, edits ('g' glue, 'm' match, 'l' skip source word, 'w' skip target word).
ALIGNED = "cost int, consumed int, edits string"


#: Nulls where a line doesn't fit.
Verdict = tuple[int | None, int | None, str | None]
#: Cells of the tables that one call fills together.
CELLS = 1 << 22
#: Bytes of documents in Arrow that become Python objects together; those take about six times as much.
HELD = 1 << 24


def most_cost(words: int) -> int:
    """What a line of so many words may cost at most to fit: a fifth of them, or 1."""
    return max(1, words // 5)


def _same_shape(source: np.ndarray, target: np.ndarray, glued: np.ndarray) -> list[Verdict]:
    """Alignments of equally long lines (one a row) of word codes; glued: codes of each target word joined with the next.

    Only a band of diagonals is filled. A diagonal is the number of target words ahead of the source words;
    falling by one costs 1, and the end lies on the last diagonal at most, so whatever costs no more
    than a line may cost never leaves the band.
    """
    lines, n = source.shape
    m = target.shape[1]
    most, far = most_cost(n), np.int32(1 << 20)
    low, high = -most, max(0, m - n) + most
    diagonals = np.arange(low, high + 1)
    at = np.arange(len(diagonals), dtype=np.int32)
    # Target words and glued pairs by place, with room for places outside.
    room = n + len(diagonals) + 2
    words, pairs = np.full((lines, 2 * room), -2, np.int64), np.full((lines, 2 * room), -2, np.int64)
    words[:, room : room + m] = target
    pairs[:, room : room + glued.shape[1]] = glued
    inside = lambda i: (i + diagonals >= 0) & (i + diagonals <= m)
    below = np.broadcast_to(np.where(inside(n), np.int32(0), far), (lines, len(diagonals)))
    steps = np.empty((n, lines, len(diagonals)), np.int8)
    outside = np.full((lines, 1), far)
    for i in range(n - 1, -1, -1):
        word, here = source[:, i : i + 1], room + i + low
        span = slice(here, here + len(diagonals))
        match = below + (words[:, span] != word)
        match[:, i + diagonals >= m] = far
        glue = np.where(pairs[:, span] == word, np.concatenate([below[:, 1:], outside], axis=1), far)
        skip = np.concatenate([outside, below[:, :-1]], axis=1) + 1
        best = np.where(inside(i), np.minimum(np.minimum(match, glue), skip), far)
        # skipping target words costs one each: a running minimum from the right
        cost = np.minimum.accumulate((best + at)[:, ::-1], axis=1)[:, ::-1] - at
        steps[i] = np.select([glue == cost, match == cost, skip == cost], [0, 1, 2], 3)
        below = cost
    out = []
    for line in range(lines):
        total = int(below[line, -low])
        if total > most:
            out.append((None, None, None))
            continue
        i = j = 0
        edits = []
        while i < n:
            step = int(steps[i, line, j - i - low])
            edits.append("gmlw"[step])
            i += step != 3
            j += (2, 1, 0, 1)[step]
        out.append((total, j, "".join(edits)))
    return out


def align_many(pairs: list[tuple[list[str], list[str]]]) -> list[Verdict]:
    """(cost, consumed, edits): the cheapest alignment of all source words with a prefix of the target, for each pair; nulls if it costs too much to fit.

    A match costs 0 or, if the words differ, 1; one source word may stand for two
    target words glued together at no cost; skipping a word on either side costs 1.
    Ties prefer g, m, l, w, in this order, from the front. Lines of one shape are
    computed together, in a band as wide as what a line may cost.
    """
    out: list[Verdict] = [(None, None, None)] * len(pairs)
    shapes: dict[tuple[int, int], list[int]] = {}
    for at, (source, target) in enumerate(pairs):
        if source == target[: len(source)]:
            out[at] = (0, len(source), "m" * len(source))
        elif len(source) - len(target) <= most_cost(len(source)):  # each word too few costs one
            shapes.setdefault((len(source), len(target)), []).append(at)
    codes: dict[str, int] = {}
    for (n, m), rows in shapes.items():
        size = max(1, CELLS // ((n + 1) * (2 * most_cost(n) + max(0, m - n) + 1)))
        for lo in range(0, len(rows), size):
            part = rows[lo : lo + size]
            source = np.array([[codes.setdefault(w, len(codes)) for w in pairs[r][0]] for r in part], np.int64).reshape(len(part), n)
            target = np.array([[codes.setdefault(w, len(codes)) for w in pairs[r][1]] for r in part], np.int64).reshape(len(part), m)
            glued = np.array([[codes.get(x + y, -1) for x, y in pairwise(pairs[r][1])] for r in part], np.int64).reshape(len(part), max(0, m - 1))
            for r, verdict in zip(part, _same_shape(source, target, glued), strict=True):
                out[r] = verdict
    return out


def align_words(source: list[str], target: list[str]) -> Verdict:
    return align_many([(source, target)])[0]


def _aligned(source: pd.Series, target: pd.Series) -> pd.DataFrame:
    given = [s is not None and t is not None for s, t in zip(source, target, strict=True)]
    found = iter(align_many([(list(s), list(t)) for s, t, ok in zip(source, target, given, strict=True) if ok]))
    return pd.DataFrame([next(found) if ok else (None, None, None) for ok in given], columns=["cost", "consumed", "edits"])


def aligned_lines(df: DataFrame, source: str, target: str) -> DataFrame:
    """df with cost, consumed, edits and fits of each line: source words against the first len + 4 target words.

    Lines that equal the front of their target are settled without Python.
    fits: cost is at most a fifth of the source words, or 1; a line that doesn't fit has nulls.
    """
    n = F.size(source)
    same = F.slice(F.col(target), F.lit(1), F.greatest(n, F.lit(1))) == F.col(source)
    verdict = F.pandas_udf(_aligned, ALIGNED)
    easy = df.where(same).withColumn("_v", F.struct(F.lit(0).alias("cost"), n.alias("consumed"), F.repeat(F.lit("m"), n).alias("edits")))
    hard = df.where(~F.coalesce(same, F.lit(False))).withColumn("_v", verdict(F.col(source), F.slice(F.col(target), F.lit(1), n + SLACK)))
    both = easy.unionByName(hard)
    return both.select(*df.columns, "_v.cost", "_v.consumed", "_v.edits", F.when(n >= 0, F.col("_v.cost").isNotNull()).alias("fits"))


def _documents(lines: pd.Series, stream: pd.Series) -> pd.DataFrame:
    """The n-th lines of all documents of a batch are aligned together, then the next ones."""
    ours = [[] if x is None else [list(line) for line in x] for x in lines]
    theirs = [[] if x is None else list(x) for x in stream]
    at, total, failed = [0] * len(ours), [0] * len(ours), [None] * len(ours)
    number, active = 0, [d for d, x in enumerate(ours) if x]
    while active:
        pairs = [(ours[d][number], theirs[d][at[d] : at[d] + len(ours[d][number]) + SLACK]) for d in active]
        for d, (cost, consumed, _) in zip(active, align_many(pairs), strict=True):
            if cost is None:
                failed[d] = number
            else:
                at[d], total[d] = at[d] + consumed, total[d] + cost
        number += 1
        active = [d for d in active if failed[d] is None and len(ours[d]) > number]
    rows = [(f is None, f, t, a) for f, t, a in zip(failed, total, at, strict=True)]
    return pd.DataFrame(rows, columns=["accepted", "failed_line", "cost", "consumed"])


def aligned_documents(df: DataFrame, lines: str, stream: str) -> DataFrame:
    """df with accepted, failed_line (from 0), cost and consumed: the lines of a document against one stream, each from where the last one ended.

    The first line that doesn't fit rejects its document.
    """
    verdict = F.pandas_udf(_documents, "accepted boolean, failed_line int, cost int, consumed int")
    return df.withColumn("_v", verdict(F.col(lines), F.col(stream))).select(*df.columns, "_v.*")


def _starts(stream: list[str]) -> dict[str, list[int]]:
    """Where each word of a stream begins, be it one word or two glued together."""
    out: dict[str, list[int]] = {}
    for i, (word, after) in enumerate(zip(stream, [*stream[1:], ""], strict=False)):
        out.setdefault(word, []).append(i)
        if after:
            out.setdefault(word + after, []).append(i)
    return out


def _exact_place(words: list[str], stream: list[str], starts: dict[str, list[int]]) -> tuple[int, int] | None:
    """(start, consumed) of the first place of a stream where a line stands without any edit but glue; words aren't empty."""
    for start in starts.get(words[0], ()):
        at, end = start, min(len(stream), start + len(words) + SLACK)
        for word in words:
            if at < end and stream[at] == word:
                at += 1
            elif at + 1 < end and stream[at] + stream[at + 1] == word:
                at += 2
            else:
                break
        else:
            return start, at - start
    return None


def _bounds(a: pa.Array) -> list[int]:
    """Where each list of a begins in a.flatten(), and the end."""
    return np.cumsum([0, *pc.fill_null(pc.list_value_length(a), 0).to_pylist()]).tolist()


def _numbered_words(a: pa.Array) -> list[list[tuple[int | None, list[str] | None]] | None]:
    """Python's form of lists of (number, words); from flat arrays, as Arrow is slow with nested ones."""
    number, words = a.flatten().flatten()
    flat, at = words.flatten().to_numpy(zero_copy_only=False).tolist(), _bounds(words)
    pairs = [(k, flat[lo:hi] if there else None) for k, there, (lo, hi) in zip(number.to_pylist(), words.is_valid().to_pylist(), pairwise(at), strict=True)]
    return [pairs[lo:hi] if there else None for there, (lo, hi) in zip(a.is_valid().to_pylist(), pairwise(_bounds(a)), strict=True)]


def _streamed(lines: pa.Array, streams: pa.Array) -> list[dict]:
    """A verdict of each document."""
    ours = [[(k, w or []) for k, w in x or []] for x in _numbered_words(lines)]
    theirs = [{k: w for k, w in sorted(x or [], key=lambda e: e[0]) if w is not None} for x in _numbered_words(streams)]
    cursor, total, failed, placed = [dict.fromkeys(t, 0) for t in theirs], [0] * len(ours), [None] * len(ours), [[] for _ in ours]
    begun: dict[tuple[int, int], dict[str, list[int]]] = {}
    number, active = 0, [d for d, x in enumerate(ours) if x]
    while active:
        # Every stream that a line may be in is tried from its cursor; the lines of all documents together.
        tried = [(d, k) for d in active for k in theirs[d] if ours[d][number][0] is None or ours[d][number][0] == k]
        pairs = [(ours[d][number][1], theirs[d][k][cursor[d][k] : cursor[d][k] + len(ours[d][number][1]) + SLACK]) for d, k in tried]
        best: dict[int, tuple[int, int, int, int]] = {}
        for (d, k), (cost, used, _) in zip(tried, align_many(pairs), strict=True):
            if cost is not None and (d not in best or cost < best[d][0]):
                best[d] = (cost, k, cursor[d][k], used)
        for d, k in tried:
            if d not in best:  # then the line has words, as one without any fits at its cursor
                if (d, k) not in begun:
                    begun[d, k] = _starts(theirs[d][k])
                if place := _exact_place(ours[d][number][1], theirs[d][k], begun[d, k]):
                    best[d] = (0, k, *place)
        for d in active:
            if d in best:
                cost, k, start, used = best[d]
                total[d] += cost
                cursor[d][k] = start + used
                placed[d].append({"stream": k, "start": start, "end": start + used})
            else:
                failed[d] = number
        number += 1
        active = [d for d in active if failed[d] is None and len(ours[d]) > number]
    return [{"accepted": f is None, "failed_line": f, "cost": t, "placed": at} for f, t, at in zip(failed, total, placed, strict=True)]


#: What _streamed returns, for Spark and for Arrow.
_PLACED = "accepted boolean, failed_line int, cost int, placed array<struct<stream:int,start:int,end:int>>"
_PLACED_ARROW = pa.struct([("accepted", pa.bool_()), ("failed_line", pa.int32()), ("cost", pa.int32()), ("placed", pa.list_(pa.struct([("stream", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])))])


def _in_slices(lines: pa.Array, streams: pa.Array) -> pa.Array:
    """_streamed of a batch, of which only some documents at a time become Python objects: as many as HELD bytes of words hold, or one."""
    size = [a.nbytes + b.nbytes for a, b in ((lines.slice(i, 1), streams.slice(i, 1)) for i in range(len(lines)))]
    out, lo = [pa.array([], _PLACED_ARROW)], 0
    while lo < len(size):
        hi, held = lo + 1, size[lo]
        while hi < len(size) and held + size[hi] <= HELD:
            hi, held = hi + 1, held + size[hi]
        out.append(pa.array(_streamed(lines.slice(lo, hi - lo), streams.slice(lo, hi - lo)), _PLACED_ARROW))
        lo = hi
    return pa.concat_arrays(out)


def aligned_streams(df: DataFrame, lines: str, streams: str) -> DataFrame:
    """df with accepted, failed_line (from 0), cost and placed, the stretch of words that each line takes.

    lines: array of (stream, words); streams: map of number to words. A line goes to its own stream, or without
    one to the stream where it costs least (the smallest number of those alike), from where that stream's
    last line ended. A line that fits nowhere is looked for from the start of its streams, where it must
    stand exactly; the first line that isn't found rejects its document.
    """
    verdict = F.arrow_udf(_in_slices, _PLACED)
    typed = F.transform(F.col(lines), lambda x: F.struct(x["stream"].cast("int").alias("stream"), x["words"].alias("words")))
    return df.withColumn("_v", verdict(typed, F.map_entries(F.col(streams).cast("map<int,array<string>>")))).select(*df.columns, "_v.*")


class _Phrases:
    """Where phrases end, item by item; at most a phrase is held."""

    def __init__(self, long: float, gap: float, most: int):
        self.long, self.gap, self.most = long, gap, most
        self.held: list[tuple] = []
        self.number = 0

    def add(self, item: tuple, ready: list[tuple]) -> None:
        """item: (row, start, length). Settled rows go to ready with their phrase's number."""
        if len(self.held) >= 2 and item[1] - (self.held[-1][1] + self.held[-1][2]) > self.gap:
            self.end(len(self.held), ready)
        elif len(self.held) >= self.most:
            self.split(ready)
        self.held.append(item)
        if item[2] >= self.long and len(self.held) >= 3:
            self.end(len(self.held), ready)

    def split(self, ready: list[tuple]) -> None:
        """Ends the phrase behind the first of its longest items, short of both ends."""
        inner = [length for _, _, length in self.held[2:-1]]
        self.end(3 + inner.index(max(inner)), ready)

    def finish(self, ready: list[tuple]) -> None:
        if len(self.held) >= self.most:
            self.split(ready)
        self.end(len(self.held), ready)

    def end(self, n: int, ready: list[tuple]) -> None:
        ready += [(row, self.number) for row, _, _ in self.held[:n]]
        del self.held[:n]
        self.number += n > 0


def phrases(df: DataFrame, key: str, row: str, at: str, length: str, *, long: float = 1.9, gap: float = 0.05, most: int = 12, stretch: int = STRETCH) -> DataFrame:
    """(key, row, phrase): items of a key, in order of time then row, cut into phrases from 0.

    A phrase ends after a long item if it has three items, before a gap if it
    has two; at ``most`` items it is cut behind its longest item. Keys stream
    through sorted partitions: a task holds one phrase. Keys of over ``stretch``
    items are cut by many tasks instead.
    """
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    items = df.select(key, row, F.col(at).cast("double").alias("_at"), F.col(length).cast("double").alias("_len")).where(F.col(key).isNotNull())
    hot = cut(items.groupBy(F.col(key).alias("_hot")).count().where(F.col("count") > stretch).select("_hot"))
    if not hot.isEmpty():
        of_hot = F.col(key) == F.col("_hot")
        dealt = dealt_phrases(items.join(hot, of_hot, "left_semi").select(F.col(key).alias("_key"), row, "_at", "_len"), row, (long, gap, most), stretch)
        rest = phrases(items.join(hot, of_hot, "left_anti"), key, row, "_at", "_len", long=long, gap=gap, most=most, stretch=stretch)
        return rest.unionByName(dealt.select(F.col("_key").alias(key), row, "phrase"))

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state, current = None, None
        for batch in batches:
            out = []
            for k, r, t, n in batch.itertuples(index=False, name=None):
                ready: list[tuple] = []
                if state is None or k != current:
                    if state is not None:
                        state.finish(ready)
                        out += [(current, *x) for x in ready]
                        ready = []
                    state, current = _Phrases(long, gap, most), k
                state.add((r, t, n), ready)
                out += [(k, *x) for x in ready]
            yield pd.DataFrame(out, columns=[key, row, "phrase"])
        if state is not None:
            ready = []
            state.finish(ready)
            yield pd.DataFrame([(current, *x) for x in ready], columns=[key, row, "phrase"])

    return items.repartition(key).sortWithinPartitions(key, "_at", row).mapInPandas(work, f"{key} {types[key]}, {row} {types[row]}, phrase int")


def monotone_match(wanted: list[float], ticks: list[float], unit: float) -> list[float] | None:
    """The tick for each wanted time, earlier ones shifting the later; null if one is over a unit off.

    Looks from an eighth of a unit before to three units behind the expected time; ties go to the earlier tick.
    """
    shift, out = 0.0, []
    for w in wanted:
        expected = w + shift
        lo = bisect_left(ticks, expected - unit / 8)
        hi = bisect_left(ticks, expected)
        near = [t for t in (ticks[lo:hi][-1:] + ticks[hi : hi + 1]) if t <= expected + 3 * unit]
        if not near or min(abs(t - expected) for t in near) > unit:
            return None
        best = min(near, key=lambda t: (abs(t - expected), t))
        out.append(best)
        shift = best - w
    return out


def matched_onsets(df: DataFrame, wanted: str, ticks: str, unit: Column) -> DataFrame:
    """df with matched: for each time of the array wanted the tick it falls on, null if a pass can't be followed. Both arrays ascend."""

    @F.pandas_udf("array<double>")
    def verdict(w: pd.Series, t: pd.Series, u: pd.Series) -> pd.Series:
        return pd.Series([None if a is None or b is None else monotone_match(list(a), list(b), c) for a, b, c in zip(w, t, u, strict=True)], dtype=object)

    return df.withColumn("matched", verdict(F.col(wanted).cast("array<double>"), F.col(ticks).cast("array<double>"), unit.cast("double")))
