"""How alike two texts are, by the longest common subsequence of their characters.

The subsequence is found bit by bit: a column of the usual table is a number
with a bit for each character of the first text, and one addition carries it
past a character of the second. All rows of a batch take their steps together,
in words of 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters of padded text that one call holds.
CELLS = 1 << 22
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _points(texts: list[str], width: int, fill: int) -> np.ndarray:
    """Code points of the texts, one a row."""
    out = np.full((len(texts), width), fill, np.int32)
    for row, t in zip(out, texts, strict=True):
        row[: len(t)] = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def _common(a: list[str], b: list[str]) -> np.ndarray:
    """Lengths of the common subsequences of texts that are alike in size."""
    long, steps = max(map(len, a)), max(map(len, b))
    lanes = max(1, -(-long // 64))
    # Paddings differ, so that they never match.
    x, y = _points(a, lanes * 64, -1), _points(b, steps, -2)
    open_ = np.full((len(a), lanes), _ALL)
    for step in range(steps):
        same = np.packbits(x == y[:, step : step + 1], axis=1, bitorder="little").view("<u8")
        hit = open_ & same
        carry = np.zeros(len(a), np.uint64)
        for lane in range(lanes):
            v, u = open_[:, lane], hit[:, lane]
            total = v + u
            moved = total + carry
            carry = ((total < v) | (moved < total)).astype(np.uint64)
            open_[:, lane] = moved | (v & ~u)
    return np.bitwise_count(~open_).sum(axis=1).astype(np.int64)


def common_lengths(a: list[str], b: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair of texts."""
    out = np.zeros(len(a), np.int64)
    # Pairs of like size together, so that padding stays small.
    order = sorted(range(len(a)), key=lambda i: (len(a[i]), len(b[i])))
    part: list[int] = []
    for i in [*order, None]:
        if part and (i is None or (len(part) + 1) * (len(a[i]) + len(b[i])) > CELLS or len(a[i]) > 2 * len(a[part[0]]) + 64):
            out[part] = _common([a[j] for j in part], [b[j] for j in part])
            part = []
        if i is not None:
            part.append(i)
    return out


def _lengths(a: pd.Series, b: pd.Series) -> pd.Series:
    given = a.notna() & b.notna()
    out = pd.Series(pd.array([pd.NA] * len(a), "Int64"), index=a.index)
    out[given] = common_lengths(a[given].tolist(), b[given].tolist())
    return out


def common_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence of two texts; null if one is null."""
    return F.pandas_udf(_lengths, "long")(a, b)


def ratio(a: Column, b: Column, common: Column) -> Column:
    """Twice the common characters over the characters of both texts; 1 for two empty texts.

    Blocks that two texts share in order make a common subsequence, so no ratio of matching blocks is above it.
    """
    both = F.char_length(a) + F.char_length(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * common / both)


def _judged(df: DataFrame, a: Column, b: Column, settled: Column, name: str, verdict) -> DataFrame:
    """df with name: settled where that is not null, else the verdict on the ratio of a and b; only open pairs reach Python."""
    work = df.withColumn("_a", a).withColumn("_b", b).withColumn("_s", settled)
    easy = work.where("_s is not null").withColumn(name, F.col("_s"))
    hard = work.where("_s is null").withColumn("_c", common_length(F.col("_a"), F.col("_b")))
    hard = hard.withColumn(name, verdict(ratio(F.col("_a"), F.col("_b"), F.col("_c"))))
    return easy.select(*df.columns, name).unionByName(hard.select(*df.columns, name))


def texts_agree(df: DataFrame, a: str, b: str, least: float = 0.8) -> DataFrame:
    """df with agree: a occurs in b, or a's ratio with b's front of len(a) + 10 characters is above least.

    An empty or null a, or a null b, agrees with nothing.
    """
    x, y = F.col(a), F.col(b)
    front = F.substring(y, F.lit(1), F.char_length(x) + 10)
    short, long = F.least(F.char_length(x), F.char_length(front)), F.char_length(x) + F.char_length(front)
    # More than all of the shorter text can't be common.
    settled = F.when(x.isNull() | y.isNull() | (x == ""), F.lit(False)).when(y.contains(x), F.lit(True)).when(2.0 * short / long <= least, F.lit(False))
    return _judged(df, x, front, settled, "agree", lambda r: r > least)


def titles_agree(df: DataFrame, a: str, b: str, least: float = 0.85) -> DataFrame:
    """df with titled: the ratio of two titles is least or more; null titles agree with nothing, two empty ones do."""
    x, y = F.col(a), F.col(b)
    short, long = F.least(F.char_length(x), F.char_length(y)), F.char_length(x) + F.char_length(y)
    settled = F.when(x.isNull() | y.isNull(), F.lit(False)).when(x == y, F.lit(True)).when(2.0 * short / long < least, F.lit(False))
    return _judged(df, x, y, settled, "titled", lambda r: r >= least)


def ratio_sql(source: str, id_: str, a: str, b: str) -> str:
    """CTEs for 'with recursive': likeness(id, common, ratio) of the columns a and b of a table, by the same walk.

    Texts of up to 120 characters are one number; longer ones are walked in words of 62 bits.
    """
    full, whole = "4611686018427387903::hugeint", f"{(1 << 120) - 1}::hugeint"
    mask = "coalesce(list_sum(list_transform(list_filter(range(length(a)), lambda p: a[p + 1] = b[j]), lambda p: (1::hugeint << p::int))), 0)::hugeint"
    step = f"lambda p, q: {{'v': ((p.v + (p.v & q.m)) & {whole}) | (p.v - (p.v & q.m)), 'm': 0::hugeint}}"
    lane = f"list_reduce(list_prepend({{'o': []::hugeint[], 'v': 0::hugeint, 'm': 0::hugeint, 'c': 0::hugeint}}, list_transform(v, lambda x, i: {{'o': []::hugeint[], 'v': x, 'm': m[i], 'c': 0::hugeint}})), lambda p, q: {{'o': list_append(p.o, ((q.v + (q.v & q.m) + p.c) & {full}) | (q.v - (q.v & q.m))), 'v': 0::hugeint, 'm': 0::hugeint, 'c': (q.v + (q.v & q.m) + p.c) >> 62}}).o"
    return f"""lcs_texts as (select {id_} as id, {a} as a, {b} as b, greatest(1, (length({a}) + 61) // 62) as lanes from {source} where {a} is not null and {b} is not null),
    lcs_short as (select id, list_reduce(list_prepend({{'v': {whole}, 'm': 0::hugeint}}, list_transform(range(1, length(b) + 1), lambda j: {{'v': 0::hugeint, 'm': {mask}}})), {step}).v as v from lcs_texts where length(a) <= 120),
    lcs_long as (select * from lcs_texts where length(a) > 120),
    lcs_chars as (select id, lanes, a[p] as c, list(p - 1) as places from (select id, lanes, a, unnest(range(1, length(a) + 1)) as p from lcs_long) group by id, lanes, a[p]),
    lcs_masks as (select id, c, list_transform(range(lanes), lambda l: coalesce(list_sum(list_transform(list_filter(places, lambda p: p // 62 = l), lambda p: (1::hugeint << (p % 62)::int))), 0)::hugeint) as m from lcs_chars),
    lcs_walk as (select id, b, 1::bigint as j, list_transform(range(lanes), lambda l: {full}) as v from lcs_long union all
        select w.id, w.b, j + 1, case when m is null then v else {lane} end from lcs_walk w left join lcs_masks k on k.id = w.id and k.c = w.b[j] where j <= length(w.b)),
    lcs_lengths as (select id, (62 * len(v) - list_sum(list_transform(v, lambda x: bit_count(x))))::bigint as common from lcs_walk where j = length(b) + 1 union all select id, (120 - bit_count(v))::bigint from lcs_short),
    likeness as (select id, common, case when length(a) + length(b) = 0 then 1 else 2.0::double * common / (length(a) + length(b)) end as ratio from lcs_lengths join lcs_texts using (id))"""
