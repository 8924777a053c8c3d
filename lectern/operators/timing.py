"""Timed documents: stanzas from word streams, structure of passes, words in seconds, attempts in order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.operators.align import monotone_match, phrases
from lectern.operators.match import wildcard_join
from lectern.operators.sequence import piecewise_seconds


def stream_stanzas(words: DataFrame, key: str, verse: str, row: str, at: str, length: str, shared: Column, *, long: float = 1.9, gap: float = 0.05, most: int = 12) -> DataFrame:
    """(key, stanza, row, line): each stream (verse) of a key as a stanza, cut into lines from 0 as by ``phrases``.

    Stanzas count the streams from 1, in order. The shared words of stream 1 are
    sung by the later streams too. Rows without key, stream or time are left out.
    """
    given = words.where(F.col(key).isNotNull() & F.col(verse).isNotNull() & F.col(at).isNotNull())
    streams = given.select(key, verse).distinct().withColumn("stanza", F.row_number().over(Window.partitionBy(key).orderBy(verse)))
    own = given.join(streams, [key, verse]).select(key, "stanza", row, at, length)
    refrain = given.where((F.col(verse) == 1) & shared).select(key, row, at, length)
    again = streams.where(F.col(verse) != 1).join(refrain, key).select(key, "stanza", row, at, length)
    unit = F.struct(F.col(key), F.col("stanza"))
    sung = own.unionByName(again).select(F.to_json(unit).alias("_unit"), row, at, length)
    cut = phrases(sung, "_unit", row, at, length, long=long, gap=gap, most=most)
    types = {f.name: f.dataType.simpleString() for f in given.schema}
    cut = cut.withColumn("_unit", F.from_json("_unit", f"`{key}` {types[key]}, stanza int"))
    return cut.select(F.col("_unit")[key].alias(key), F.col("_unit.stanza").alias("stanza"), row, F.col("phrase").alias("line"))


class _Ticks:
    """Follows many passes over one row of ticks at once, as ``monotone_match`` follows one."""

    def __init__(self, ticks: list[float], onsets: list[float], unit: float):
        self.ticks, self.onsets, self.unit = np.array(ticks, np.float64), onsets, unit
        self.padded = np.concatenate([self.ticks, [np.inf]])

    def fits(self, begins: np.ndarray) -> np.ndarray:
        """Which passes can be followed to their last onset; a pass that is lost is not looked at again."""
        live, shift = np.arange(len(begins)), np.zeros(len(begins))
        for onset in self.onsets:
            if not len(live):
                break
            wanted = begins[live] + onset
            expected = wanted + shift
            behind = np.searchsorted(self.ticks, expected)
            early, late = self.padded[np.maximum(behind - 1, 0)], self.padded[behind]
            before = np.where((behind > 0) & (early >= expected - self.unit / 8), expected - early, np.inf)
            after = np.where(late <= expected + 3 * self.unit, late - expected, np.inf)
            near = np.minimum(before, after) <= self.unit
            best = np.where(before <= after, early, late)
            live, shift = live[near], (best - wanted)[near]
        out = np.zeros(len(begins), bool)
        out[live] = True
        return out


def _structure(onsets: list[float] | None, ticks: list[float] | None, starts: list[float] | None, passes: int | None, span: float | None, unit: float | None) -> dict:
    """The first start, and then the commonest period, whose passes can all be followed.

    A start is looked at only if its first pass can be followed; its periods are
    then tried together, pass by pass. So memory is one number a period, and the
    search ends at the first start that has one.
    """
    none = {"start": None, "period": None, "matched": None}
    if not onsets or not ticks or not passes or passes < 1 or span is None or unit is None:
        return none
    begins = np.unique(np.array([0.0, *(starts or [])]))
    if passes == 1:
        periods = np.zeros(1)
    else:
        found, often = np.unique(np.diff(begins), return_counts=True)
        # No list can have a shorter one.
        found, often = found[found >= onsets[-1]], often[found >= onsets[-1]]
        periods = found[np.lexsort((found, -often))]
    follow, end = _Ticks(ticks, onsets, unit), span + 3 * unit
    for start in begins[follow.fits(begins)].tolist():
        open_ = periods[start + (passes - 1) * periods + onsets[-1] <= end]
        for n in range(1, passes):
            open_ = open_[follow.fits(start + n * open_)]
        if len(open_):
            period = float(open_[0])
            return {"start": start, "period": period, "matched": [monotone_match([start + n * period + o for o in onsets], ticks, unit) for n in range(passes)]}
    return none


def pass_structure(df: DataFrame, onsets: str, ticks: str, starts: str, passes: Column, span: Column, unit: Column) -> DataFrame:
    """df with start, period and matched (a list of ticks a pass): where each pass of the onsets begins.

    Candidates are every start (0 too) with every distance of neighbouring starts, the
    commonest first, then the shorter; a period may not be under the last onset, and the
    last pass may end three units behind span at most. The first candidate, by start and
    then by period, whose passes all follow the ticks is taken; nulls if there is none, or
    if onsets or ticks are null or empty. All three arrays ascend; one pass needs no period.
    Candidates are never listed: a row takes memory of its arrays, whatever their number.
    """
    number = "array<double>"
    given = [F.col(onsets).cast(number), F.col(ticks).cast(number), F.col(starts).cast(number), passes.cast("int"), span.cast("double"), unit.cast("double")]
    names = [f"_{i}" for i in range(len(given))]
    work = df.select(*df.columns, *(c.alias(name) for c, name in zip(given, names, strict=True)))
    found = pa.struct([("start", pa.float64()), ("period", pa.float64()), ("matched", pa.list_(pa.list_(pa.float64())))])
    n = len(df.columns)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in range(n, n + len(names))), strict=True)
            out = pa.array([_structure(*row) for row in rows], found)
            columns = [*batch.columns[:n], *out.flatten()]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:n], "start", "period", "matched"])

    schema = StructType([*df.schema.fields, *StructType.fromDDL("start double, period double, matched array<array<double>>").fields])
    return work.mapInArrow(follow, schema)


def timed_documents(words: DataFrame, passes: DataFrame, tempos: DataFrame, spans: DataFrame, key: str, per_beat: int) -> DataFrame:
    """(key, outcome, duration, stanzas): each document's words in seconds, by pass, stanza and line.

    words: key, stanza, label, verse (null: sung in every pass), line, pos, text, first and
    last (onset of the first and last note) and hold (ticks the last note lasts). passes:
    key, pass (from 1), onset, tick. tempos: key, at, tempo. spans: key, span (last tick).
    Outcomes, the first that holds: 'verses' (their numbers are not 1 to the number of
    passes), 'unmatched' (a word has no tick in its pass, or there are no passes), 'falling'
    (a word starts before the one before it), 'past end' (the last word starts over a second
    behind the end), 'timed'. Only timed documents have stanzas. Documents are the keys of spans.
    """
    runs = passes.select(key, "pass").distinct()
    verses = words.groupBy(key).agg(F.array_sort(F.collect_set(F.col("verse").cast("int"))).alias("_verses"))
    counts = runs.groupBy(key).agg(F.count("*").cast("int").alias("_runs"))
    docs = spans.select(key, "span").join(verses, key, "left").join(counts, key, "left")
    sung = wildcard_join(runs, words, [key], "pass", "verse")
    for end in ("first", "last"):
        sung = sung.join(passes.select(key, "pass", F.col("onset").alias(end), F.col("tick").alias(f"_{end}")), [key, "pass", end], "left")

    def seconds(points: DataFrame, at: Column, name: str) -> DataFrame:
        timed = piecewise_seconds(points.withColumn("at", at.cast("decimal(18,0)")), tempos.withColumn("at", F.col("at").cast("decimal(18,0)")), key, "at", "tempo", per_beat)
        return timed.withColumnRenamed("seconds", name).drop("at")

    sung = seconds(seconds(sung, F.col("_first"), "_from"), F.col("_last") + F.col("hold"), "_to")
    opening = F.min("first").over(Window.partitionBy(key, "pass", "stanza"))
    sung = sung.withColumn("_open", opening).withColumn("_t", F.round("_from", 3)).withColumn("_d", F.round(F.col("_to") - F.col("_from"), 3))
    order = [F.col(c) for c in ("pass", "_open", "stanza", "line", "pos")]
    sung = sung.withColumn("_falls", F.coalesce(F.lag("_t").over(Window.partitionBy(key).orderBy(*order)) > F.col("_t"), F.lit(False)))

    word = F.struct("pos", F.col("_t").alias("t"), F.col("_d").alias("d"), "text")
    lines = sung.groupBy(key, "pass", "_open", "stanza", "label", "line").agg(
        F.sort_array(F.collect_list(word)).alias("_w"), F.bool_or("_falls").alias("_falls"), F.bool_or(F.col("_t").isNull() | F.col("_d").isNull()).alias("_lost")
    )
    plain = F.transform("_w", lambda w: F.struct(w["t"].alias("t"), w["d"].alias("d"), w["text"].alias("text")))
    line = F.struct("line", plain.alias("words"))
    stanzas = lines.groupBy(key, "pass", "_open", "stanza", "label").agg(F.sort_array(F.collect_list(line)).alias("_l"), F.bool_or("_falls").alias("_falls"), F.bool_or("_lost").alias("_lost"))
    stanza = F.struct("pass", "_open", "stanza", "label", F.transform("_l", lambda x: x["words"]).alias("lines"))
    whole = stanzas.groupBy(key).agg(F.sort_array(F.collect_list(stanza)).alias("_all"), F.bool_or("_falls").alias("_falls"), F.bool_or("_lost").alias("_lost"))

    docs = seconds(docs, F.col("span"), "_end").join(whole, key, "left")
    final = F.element_at(F.element_at(F.element_at("_all", -1)["lines"], -1), -1)["t"]
    numbered = (F.size("_verses") == 0) | (F.col("_verses") == F.sequence(F.lit(1), F.greatest(F.lit(1), F.coalesce("_runs", F.lit(0)))))
    outcome = (
        F.when(~F.coalesce(numbered, F.lit(True)), "verses").when(F.col("_all").isNull() | F.col("_lost"), "unmatched").when(F.col("_falls"), "falling").when(final > F.col("_end") + 1, "past end").otherwise("timed")
    )
    kept = F.transform("_all", lambda s: F.struct(s["pass"].alias("pass"), s["label"].alias("label"), s["lines"].alias("lines")))
    docs = docs.withColumn("outcome", outcome)
    return docs.select(key, "outcome", F.round("_end", 3).alias("duration"), F.when(F.col("outcome") == "timed", kept).alias("stanzas"))


def first_success(attempts: DataFrame, key: str, priority: str, mode: str, error: str, values: list[str]) -> DataFrame:
    """(key, outcome, error, values): the first attempt of a key, by priority, that has no error.

    outcome is its mode; where every attempt failed it is 'skipped', with the error of the last attempt and null values.
    """
    won = F.min_by(F.struct(F.lit(True).alias("ok"), mode, *values), F.when(F.col(error).isNull(), F.col(priority)))
    best = attempts.groupBy(key).agg(won.alias("_w"), F.max_by(error, priority).alias("_e"))
    ok = F.coalesce(F.col("_w.ok"), F.lit(False))
    return best.select(key, F.when(ok, F.col("_w")[mode]).otherwise("skipped").alias("outcome"), F.when(~ok, F.col("_e")).alias("error"), *[F.when(ok, F.col("_w")[v]).alias(v) for v in values])
