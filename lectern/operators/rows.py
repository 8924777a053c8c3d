"""Choosing, numbering and comparing rows by key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], most: int) -> DataFrame:
    at = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_at", F.row_number().over(at)).where(F.col("_at") <= most).drop("_at")


def first_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key; reverse the order for the last one, order by time for the latest.

    Spark limits each key to its first rows before the shuffle (WindowGroupLimit), so a hot key sends a row a task.
    """
    return _rank(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    return _rank(df, keys, order, n)


def top_distinct(df: DataFrame, keys: Sequence[str], value: str, n: int, *order: Column) -> DataFrame:
    """The first n rows of each key after all but the first row of each of its values have gone."""
    return top_per_key(first_per_key(df, [*keys, value], *order), keys, n, *order)


def stale(sources: DataFrame, derived: DataFrame, key: str, changed: str, made: str, force: Column | None = None) -> DataFrame:
    """Sources whose derivative (key, made) is missing or older than their change; those that force holds for in any case."""
    out = sources.join(derived.select(key, F.col(made).alias("_made")), key, "left")
    old = F.col("_made").isNull() | (F.col("_made") < F.col(changed))
    return out.where(old if force is None else F.coalesce(force, F.lit(False)) | old).drop("_made")


def numbered(df: DataFrame, keys: Sequence[str], *order: Column, name: str = "n") -> DataFrame:
    """df with the place of a row among those of its keys, from 1; null keys are keys too.

    Rows are dealt by ranges of key and order, so a hot key is spread over many tasks: each numbers its
    own stretch, and the sizes of the stretches before it are added. Rows alike in order are numbered in any order.
    """
    from lectern.operators.family import cut

    sorted_by = [F.asc_nulls_first(F.col(k)) for k in keys]
    # Written once, as both the sizes and the rows must see the same stretches.
    dealt = cut(df.repartitionByRange(*sorted_by, *order).withColumn("_part", F.spark_partition_id()))
    sizes = dealt.groupBy(*keys, "_part").agg(F.count("*").alias("_size"))
    before = F.sum("_size").over(Window.partitionBy(*keys).orderBy("_part")) - F.col("_size")
    offsets = sizes.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_part").alias("_p"), before.alias("_before"))
    at = F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))
    same = F.col("_part") == F.col("_p")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return dealt.withColumn("_at", at).join(offsets, same).select(*df.columns, (F.col("_at") + F.col("_before")).alias(name))


def first_and_rest(df: DataFrame, keys: Sequence[str], most: int, *order: Column) -> DataFrame:
    """The first rows of each key with more: how many rows of the key are not shown."""
    counts = df.groupBy(*keys).agg(F.greatest(F.count("*") - most, F.lit(0)).alias("more"))
    return top_per_key(df, keys, most, *order).join(counts, list(keys))


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once, each once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def dangling(df: DataFrame, reference: str, target: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null reference has no target."""
    return df.where(F.col(reference).isNotNull()).join(target.select(F.col(key).alias(reference)).distinct(), reference, "left_anti")


def inherit(df: DataFrame, own: DataFrame, family: DataFrame, key: str, group: str, values: Sequence[str]) -> DataFrame:
    """Own values if there is an own row, else the group's; all values come from one side."""
    mine = own.select(F.col(key), F.struct(*values).alias("_own"))
    theirs = family.select(F.col(group), F.struct(*values).alias("_family"))
    out = df.join(mine, key, "left").join(theirs, group, "left").withColumn("_v", F.coalesce("_own", "_family"))
    side = F.when(F.col("_own").isNotNull(), "own").when(F.col("_family").isNotNull(), "family")
    return out.select(*df.columns, *(F.col(f"_v.{v}").alias(v) for v in values), side.alias("side"))


def suffixed(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """unique_name: the name, then name-2, name-3, ... in order."""
    n = F.col("_n")
    out = numbered(df, [name], *order, name="_n")
    return out.withColumn("unique_name", F.when(n == 1, F.col(name)).otherwise(F.concat_ws("-", name, n.cast("string")))).drop("_n")


def case_collisions(df: DataFrame, bucket: Sequence[str], name: str, *order: Column) -> DataFrame:
    """Rows whose name equals an earlier sibling's but for case."""
    folded = df.withColumn("_folded", F.lower(name))
    return numbered(folded, [*bucket, "_folded"], *order, name="_n").where("_n > 1").drop("_n", "_folded")


def snapshot_changes(old: DataFrame, new: DataFrame, key: str, value: str, deletes: bool = True) -> DataFrame:
    """key and action: insert, update or delete (unless additive)."""
    both = old.select(key, F.col(value).alias("_o"), F.lit(True).alias("_in_old")).join(new.select(key, F.col(value).alias("_n"), F.lit(True).alias("_in_new")), key, "full_outer")
    action = F.when(F.col("_in_old").isNull(), "insert").when(F.col("_in_new").isNull(), "delete" if deletes else None).when(~F.col("_o").eqNullSafe(F.col("_n")), "update")
    return both.select(key, action.alias("action")).where(F.col("action").isNotNull())


def carry_forward(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """All keys; new values win."""
    joined = old.select(key, F.col(value).alias("_o")).join(new.select(key, F.col(value).alias("_n")), key, "full_outer")
    return joined.select(key, F.coalesce("_n", "_o").alias(value))


def presence(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has, and which: left or right."""
    out = left.select(key).distinct().withColumn("_l", F.lit(1)).join(right.select(key).distinct().withColumn("_r", F.lit(1)), key, "full_outer")
    return out.where("_l is null or _r is null").select(key, F.when(F.col("_r").isNull(), "left").otherwise("right").alias("side"))


def stale_texts(stored: DataFrame, rendered: DataFrame, key: str, text: str) -> DataFrame:
    """Keys whose stored text is 'missing' or 'stale' against a fresh rendering."""
    both = rendered.select(key, F.col(text).alias("_new")).join(stored.select(key, F.col(text).alias("_old"), F.lit(True).alias("_there")), key, "left")
    problem = F.when(F.col("_there").isNull(), "missing").when(~F.col("_old").eqNullSafe(F.col("_new")), "stale")
    return both.select(key, problem.alias("problem")).where("problem is not null")


def until_short_page(df: DataFrame, page: str, size: int) -> DataFrame:
    """Rows of the pages up to and including the first that has fewer than size rows."""
    short = df.groupBy(page).count().where(F.col("count") < size).agg(F.min(page))
    return df.where(F.coalesce(F.col(page) <= short.scalar(), F.lit(True)))


def paired(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, outcome): 'both', 'left' or 'right' for every key of either side."""
    both = left.select(key).distinct().withColumn("_l", F.lit(1)).join(right.select(key).distinct().withColumn("_r", F.lit(1)), key, "full_outer")
    return both.select(key, F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right").otherwise("both").alias("outcome"))


def by_frequency(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values of each key with count n and rank: most frequent first, then ascending."""
    n = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    return numbered(n, keys, F.col("n").desc(), F.col(value), name="rank")


def free_names(df: DataFrame, name: str, taken: DataFrame, *order: Column) -> DataFrame:
    """unique_name: the name, name-2, name-3, ... in order, without those that are taken (column name of taken).

    Bare names of other rows count as taken, so no two rows ever get one name.
    The i-th row takes the i-th free number: each taken number moves those
    behind it by one, which an as-of lookup counts without lists of names.
    """
    from lectern.operators.match import as_of

    shape = r"(?s)^(.*)-([1-9][0-9]*)$"

    def suffixes(names: DataFrame) -> DataFrame:
        return names.where(F.col(name).rlike(shape)).select(F.regexp_extract(name, shape, 1).alias(name), F.regexp_extract(name, shape, 2).cast("long").alias("_t")).where("_t > 1")

    used = taken.select(name).where(F.col(name).isNotNull())
    numbers = suffixes(used.unionByName(df.select(name))).unionByName(used.withColumn("_t", F.lit(1).cast("long"))).distinct()
    numbers = numbered(numbers, [name], F.col("_t"), name="_j")
    steps = numbers.groupBy(name, (F.col("_t") - F.col("_j") + 1).alias("_at")).agg(F.max("_j").alias("_j"))
    ranked = numbered(df, [name], *order, name="_at")
    found = as_of(ranked, steps, [name], "_at", "_j", "_moved").withColumn("_n", F.col("_at") + F.coalesce("_moved", F.lit(0)))
    out = F.when(F.col("_n") == 1, F.col(name)).otherwise(F.concat_ws("-", name, F.col("_n").cast("string")))
    return found.withColumn("unique_name", out).drop("_at", "_moved", "_n", "_j")


def tagged_union(**sources: DataFrame) -> DataFrame:
    """All rows of sources with the same columns, with the source's name as kind."""
    tagged = [df.withColumn("kind", F.lit(kind)) for kind, df in sources.items()]
    out = tagged[0]
    for df in tagged[1:]:
        out = out.unionByName(df)
    return out


def longest_per_key(df: DataFrame, keys: Sequence[str], length: str, *order: str) -> DataFrame:
    """Of each key the row with the greatest length; the first in order of those that are alike. Reduced before the shuffle."""
    best = F.min_by(F.struct(*df.columns), F.struct((-F.col(length)).alias("_length"), *order))
    return df.groupBy(*keys).agg(best.alias("_row")).select("_row.*")


def sorted_sets(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, values): the distinct values of each key, sorted; only for keys with a bounded number of values."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_set(value)).alias("values"))


def ordered_export(df: DataFrame, group: Sequence[str], *order: Column) -> DataFrame:
    """position: place of a row in its group's export, from 1."""
    return numbered(df, group, *order, name="position")


def without_values(df: DataFrame, value: str, *unwanted: str) -> DataFrame:
    """Rows whose value is none of the unwanted ones (pseudo-authorities); null stays."""
    return df.where(F.coalesce(~F.col(value).isin(*unwanted), F.lit(True)))
