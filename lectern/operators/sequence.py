"""Operators on ordered events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def marker_groups(df: DataFrame, key: str, order: str, is_marker: Column) -> DataFrame:
    """group: number of markers up to and including the row; 0 before the first."""
    return df.withColumn("group", F.sum(is_marker.cast("int")).over(Window.partitionBy(key).orderBy(order)))


def voice_groups(df: DataFrame, key: str, order: list[str], marker: Column, declared: Column | None = None) -> DataFrame:
    """The rows under markers of the key's selected voice, with group: number of such markers so far, from 1.

    marker: the voice that a row switches to, null for a row that is no marker. The selected voice is the declared
    one (alike in all rows of a key), else that of the key's first marker. Rows under other voices are left out.
    """
    w = Window.partitionBy(key).orderBy(*order)
    held = df.withColumn("_marker", marker).withColumn("_voice", F.last("_marker", ignorenulls=True).over(w))
    first = F.first("_marker", ignorenulls=True).over(w)
    held = held.withColumn("_selected", first if declared is None else F.coalesce(declared, first))
    held = held.withColumn("group", F.count(F.when(F.col("_marker") == F.col("_selected"), 1)).over(w))
    return held.where((F.col("_voice") == F.col("_selected")) & F.col("_marker").isNull()).drop("_marker", "_voice", "_selected")


def changes(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Rows whose non-null value differs from the last non-null one."""
    held = df.where(F.col(value).isNotNull())
    before = F.lag(value).over(Window.partitionBy(key).orderBy(*order))
    return held.withColumn("_b", before).where(F.col("_b").isNull() | (F.col("_b") != F.col(value))).drop("_b")


def gap_segments(df: DataFrame, key: str, order: list[str], at: str, gap: int) -> DataFrame:
    """segment: grows by one where the time since the row before exceeds gap."""
    w = Window.partitionBy(key).orderBy(*order)
    broken = F.coalesce((F.col(at) - F.lag(at).over(w) > gap).cast("int"), F.lit(0))
    return df.withColumn("_b", broken).withColumn("segment", F.sum("_b").over(w)).drop("_b")


def differences(df: DataFrame, key: str, order: list[str], at: str) -> DataFrame:
    """diff: time to the next row of the key (none for the last)."""
    return df.withColumn("diff", F.lead(at).over(Window.partitionBy(key).orderBy(*order)) - F.col(at)).where("diff is not null")


def decreasing(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Per key: whether any value is below the one before."""
    drop = F.lag(value).over(Window.partitionBy(key).orderBy(*order)) > F.col(value)
    return df.withColumn("_d", F.coalesce(drop, F.lit(False))).groupBy(key).agg(F.bool_or("_d").alias("falls"))


def clamp_tail(df: DataFrame, key: str, order: list[str], at: str, is_note: Column, slack: int) -> DataFrame:
    """Times capped at the key's last note plus slack, and the step from the row before; keys without notes stay."""
    last = F.max(F.when(is_note, F.col(at))).over(Window.partitionBy(key))
    out = df.withColumn("capped", F.least(F.col(at), F.coalesce(last + slack, F.col(at))))
    return out.withColumn("delta", F.col("capped") - F.lag("capped", 1, 0).over(Window.partitionBy(key).orderBy(*order)))


def piecewise_seconds(points: DataFrame, tempos: DataFrame, key: str, at: str, tempo: str, per_beat: int, default: int = 500_000) -> DataFrame:
    """Seconds of each point under tempo changes (microseconds a beat); a change at the point itself is not applied yet."""
    w = Window.partitionBy(key).orderBy(at)
    steps = tempos.groupBy(key, at).agg(F.max(tempo).alias(tempo))
    steps = steps.withColumn("_span", F.col(at) - F.coalesce(F.lag(at).over(w), F.lit(0)))
    steps = steps.withColumn("_past", F.sum(F.col("_span") * F.coalesce(F.lag(tempo).over(w), F.lit(default))).over(w))
    steps = steps.withColumn("_step", F.struct(F.col(at).alias("at"), F.col("_past").alias("past"), F.col(tempo).alias("tempo")))
    from lectern.operators.match import as_of

    found = as_of(points, steps, [key], at, "_step", "_s", strict=True)
    micros = F.coalesce(F.col("_s.past") + (F.col(at) - F.col("_s.at")) * F.col("_s.tempo"), F.col(at) * default)
    # One division, in double: a decimal quotient would be rounded on the way.
    return found.withColumn("seconds", micros.cast("double") / F.lit(float(per_beat * 1_000_000))).drop("_s")


def running_time(df: DataFrame, key: str, order: list[str], delta: str) -> DataFrame:
    """at: the deltas summed up to the row; span: the key's last time."""
    w = Window.partitionBy(key)
    return df.withColumn("at", F.sum(delta).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))).withColumn("span", F.sum(delta).over(w))


def open_words(df: DataFrame, key: str, order: list[str], is_open: Column) -> DataFrame:
    """word: number of the word a part belongs to; a part joins the word before while that one's last part is open."""
    w = Window.partitionBy(key).orderBy(*order)
    starts = (~F.coalesce(F.lag(is_open).over(w), F.lit(False))).cast("int")
    return df.withColumn("_s", starts).withColumn("word", F.sum("_s").over(w)).drop("_s")


def merge_unvalued(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """group: rows without a value go to the valued row before them, leading ones to the first; keys without any value are dropped."""
    w = Window.partitionBy(key)
    n = F.count(value).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_n", F.count(value).over(w)).where("_n > 0").withColumn("group", F.greatest(n, F.lit(1))).drop("_n")
