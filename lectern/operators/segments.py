"""Cutting a key with very many items into phrases, by many tasks at once.

What a phrase cutter holds is always the items just before a place, so its
whole state is their number, 0 to ``most``. A key is dealt into stretches; one
task works out, for every number that may be held when its stretch begins, where
phrases end and how many items it hands on. These small tables are chained for
each key, and every stretch then knows which of its answers is the true one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.family import cut
from lectern.operators.rows import numbered

#: Items of a stretch; keys with more are dealt.
STRETCH = 1 << 16


class Walk:
    """One run over a stretch: what is held before each place, and the ends of phrases with the place that made them."""

    def __init__(self, starts: list[float], lengths: list[float], begin: int, held: int, limits: tuple[float, float, int], known: Walk | None = None):
        long, gap, most = limits
        self.starts, self.lengths, self.begin = starts, lengths, begin
        self.held: list[int] = []
        self.ends: list[tuple[int, int]] = []
        for at in range(begin, len(starts)):
            if known is not None and known.held[at - begin] == held:
                # The same state at the same place: from here on both are one.
                self.ends += [e for e in known.ends if e[0] >= at]
                self.handed = known.handed
                return
            self.held.append(held)
            if held >= 2 and starts[at] - (starts[at - 1] + lengths[at - 1]) > gap:
                self.ends.append((at, at))
                held = 0
            elif held >= most:
                self.ends.append((at, self.split(at, held)))
                held = at - self.ends[-1][1]
            held += 1
            if lengths[at] >= long and held >= 3:
                self.ends.append((at, at + 1))
                held = 0
        self.handed = held

    def split(self, at: int, held: int) -> int:
        """The place behind the first longest of the items held before at, short of both ends."""
        inner = self.lengths[at - held + 2 : at - 1]
        return at - held + 3 + inner.index(max(inner))


def _answers(limits: tuple[float, float, int]):
    most = limits[2]

    def work(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("_n")
        own, place = table.column("_own").to_pylist(), table.column("_n").to_pylist()
        out = {"held": [], "handed": [], "ends": [], "closing": []}
        if True in own:
            begin, first = own.index(True), None
            starts, lengths = table.column("_time").to_pylist(), table.column("_len").to_pylist()
            for held in range(min(most, begin) + 1):
                walk = Walk(starts, lengths, begin, held, limits, first)
                first = first or walk
                out["held"].append(held)
                out["handed"].append(walk.handed)
                # Numbers of the last items of phrases; the last phrase of a key may still have to be split.
                out["ends"].append([place[end - 1] for _, end in walk.ends])
                out["closing"].append(place[walk.split(len(starts), walk.handed) - 1] if walk.handed >= most else None)
        n = len(out["held"])
        kinds = {"held": pa.int32(), "handed": pa.int32(), "ends": pa.list_(pa.int64()), "closing": pa.int64()}
        keys = {"_key": pa.repeat(key[0], n), "_r": pa.repeat(key[1], n)}
        return pa.table(keys | {c: pa.array(v, kinds[c]) for c, v in out.items()})

    return work


def _chained(key: tuple, table: pa.Table) -> pa.Table:
    """The number held at the beginning of each stretch of a key, in order."""
    held, out = 0, []
    for r, handed in sorted(zip(table.column("_r").to_pylist(), table.column("handed").to_pylist(), strict=True)):
        out.append((r, held))
        held = handed[held]
    return pa.table({"_key": pa.repeat(key[0], len(out)), "_r": pa.array([r for r, _ in out], pa.int64()), "held": pa.array([h for _, h in out], pa.int32()), "_final": pa.array([i + 1 == len(out) for i in range(len(out))], pa.bool_())})


def dealt_phrases(items: DataFrame, row: str, limits: tuple[float, float, int], stretch: int = STRETCH) -> DataFrame:
    """(_key, row, phrase) of items (_key, row, _at, _len); limits: least long item, least gap, most items."""
    kind = items.schema["_key"].dataType.simpleString()
    most = limits[2]
    placed = numbered(items.withColumnRenamed("_at", "_time"), ["_key"], F.col("_time"), F.col(row), name="_n").withColumn("_r", F.floor((F.col("_n") - 1) / stretch))
    # A stretch sees the last items before it too, as phrases may reach back so far.
    before = placed.where((F.col("_n") - 1) % stretch >= stretch - most).withColumn("_r", F.col("_r") + 1)
    seen = placed.withColumn("_own", F.lit(True)).unionByName(before.withColumn("_own", F.lit(False)))
    answers = seen.select("_key", "_r", "_n", "_time", "_len", "_own").groupBy("_key", "_r").applyInArrow(_answers(limits), f"_key {kind}, _r long, held int, handed int, ends array<long>, closing long")
    answers = cut(answers)
    tables = answers.groupBy("_key", "_r").agg(F.transform(F.sort_array(F.collect_list(F.struct("held", "handed"))), lambda x: x["handed"]).alias("handed"))
    true = tables.groupBy("_key").applyInArrow(_chained, f"_key {kind}, _r long, held int, _final boolean")
    chosen = answers.join(true, ["_key", "_r", "held"])
    last = F.when(F.col("_final") & F.col("closing").isNotNull(), F.array("closing")).otherwise(F.array().cast("array<long>"))
    ends = chosen.select("_key", F.explode(F.concat("ends", last)).alias("_n")).withColumn("_r", F.floor((F.col("_n") - 1) / stretch))
    ends = cut(ends)
    earlier = F.sum("count").over(Window.partitionBy("_key").orderBy("_r")) - F.col("count")
    offsets = placed.select("_key", "_r").distinct().join(ends.groupBy("_key", "_r").count(), ["_key", "_r"], "left").fillna(0, ["count"]).select("_key", "_r", earlier.alias("_before"))
    # Within a stretch the ends before an item are counted; the end of an item itself comes behind it.
    both = placed.select("_key", "_r", "_n", row, F.lit(0).alias("_end")).unionByName(ends.select("_key", "_r", "_n", F.lit(None).cast(items.schema[row].dataType).alias(row), F.lit(1).alias("_end")))
    counted = both.withColumn("_c", F.sum("_end").over(Window.partitionBy("_key", "_r").orderBy("_n", "_end"))).where("_end = 0")
    return counted.join(offsets, ["_key", "_r"]).select("_key", row, (F.col("_before") + F.col("_c")).cast("int").alias("phrase"))
