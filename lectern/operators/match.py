"""Joins by derived keys: variants, prefixes, shared tokens, containment."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def variant_join(left: DataFrame, variants: list[Column], right: DataFrame, key: str) -> DataFrame:
    """left with the row of right that its first hitting variant finds (all columns of right; null without a hit).

    variants: keys in order of priority. right: one row per key.
    """
    tried = left.withColumn("_row", F.monotonically_increasing_id())
    probes = tried.select("_row", F.posexplode(F.array(*variants)).alias("_priority", key))
    hits = probes.join(right, key).groupBy("_row").agg(F.min_by(F.struct(*right.columns), "_priority").alias("_hit"))
    out = tried.join(hits, "_row", "left")
    return out.select(*left.columns, *(F.col(f"_hit.{c}").alias(f"hit_{c}") for c in right.columns))


#: Rows of one string that are held together; two such blocks make a task's smallest piece of work, up to the square of this.
BLOCK = 256


def _blocks(df: DataFrame, name: str) -> DataFrame:
    """(_s, _block, _rows): the rows of each string that isn't empty, in blocks of about BLOCK rows, dealt by a hash of the row."""
    rows = df.where(F.col(name) != "").select(F.col(name).alias("_s"), F.struct(*df.columns).alias("_row"))
    hot = rows.groupBy("_s").count().where(F.col("count") > BLOCK).select("_s", F.ceil(F.col("count") / BLOCK).alias("_n"))
    dealt = rows.join(hot, "_s", "left").withColumn("_block", F.pmod(F.xxhash64("_row"), F.coalesce("_n", F.lit(1))))
    return dealt.groupBy("_s", "_block").agg(F.collect_list("_row").alias("_rows"))


def _prefix_pairs(a: DataFrame, b: DataFrame, least: int) -> DataFrame:
    """(_w, _v): distinct strings _w of a and _v of b of which one starts with the other; _w shorter than least only if equal.

    Long strings meet by the widest head that the shorter one has; strings of b shorter than least can
    only be prefixes, and meet _w's own.
    """
    w, v = F.col("_w"), F.col("_v")
    widths = F.array(F.lit(least), F.lit(8 * least))
    short = a.where(F.length(w) < least).join(b, w == v)
    long, names = a.where(F.length(w) >= least), b.where(F.length(v) >= least)
    widest = lambda s: F.substring(s, F.lit(1), F.array_max(F.filter(widths, lambda n: n <= F.length(s))))
    heads = lambda s: F.explode(F.transform(F.filter(widths, lambda n: n <= F.length(s)), lambda n: F.substring(s, F.lit(1), n)))
    down = long.withColumn("_p", heads(w)).join(names.withColumn("_p", widest(v)), "_p").where(w.startswith(v))
    up = long.withColumn("_p", widest(w)).join(names.withColumn("_p", heads(v)), "_p").where(v.startswith(w) & (v != w))
    starts = long.withColumn("_q", F.explode(F.transform(F.sequence(F.lit(1), F.lit(least - 1)), lambda n: F.substring(w, F.lit(1), n))))
    within = starts.join(b.where(F.length(v) < least), F.col("_q") == v)
    return short.select("_w", "_v").unionByName(down.select("_w", "_v")).unionByName(up.select("_w", "_v")).unionByName(within.select("_w", "_v"))


def prefix_join(left: DataFrame, wanted: str, right: DataFrame, name: str, least: int = 8) -> DataFrame:
    """Pairs where one string starts with the other; wanted shorter than ``least`` only if equal.

    Empty strings match nothing. Strings are compared once however many rows have them. The result has
    a row for each pair of rows, so it grows with the square of a string's rows: blocks of rows meet, and the
    pairs of blocks are dealt to as many tasks as there are shuffle partitions, so a frequent string is spread over all of them.
    """
    from lectern.operators.family import scratch, stored

    spark = left.sparkSession
    folder = f"{scratch(spark)}/prefixes-{uuid.uuid4().hex}"
    ours, theirs = stored(_blocks(left, wanted), f"{folder}/left"), stored(_blocks(right, name), f"{folder}/right")
    pairs = _prefix_pairs(ours.select(F.col("_s").alias("_w")).distinct(), theirs.select(F.col("_s").alias("_v")).distinct(), least)
    met = pairs.join(ours.select(F.col("_s").alias("_w"), F.col("_rows").alias("_l")), "_w").join(theirs.select(F.col("_s").alias("_v"), F.col("_rows").alias("_r")), "_v").select("_l", "_r")
    met = met.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.col("_l")[0], F.col("_r")[0])
    out = met.select(F.explode("_l").alias("_a"), "_r").select("_a", F.explode("_r").alias("_b"))
    return out.select(*(F.col("_a")[c].alias(c) for c in left.columns), *(F.col("_b")[c].alias(c) for c in right.columns))


def prefix_first(left: DataFrame, left_id: str, wanted: str, right: DataFrame, right_id: str, name: str, least: int = 10) -> DataFrame:
    """(left_id, right_id): the smallest right id among names of ``least`` characters or more that start with wanted, or that wanted starts with.

    Short wanted strings meet the names' first characters, of which each keeps its smallest id alone, so a
    common beginning is one row; long ones meet names by their first ``least`` characters.
    """
    a, b = F.col(wanted), F.col(name)
    names = right.where(F.char_length(name) >= least).select(F.col(right_id).alias("_r"), b)
    heads = names.select("_r", F.explode(F.transform(F.sequence(F.lit(1), F.lit(least - 1)), lambda n: F.substring(b, F.lit(1), n))).alias("_p"))
    heads = heads.groupBy("_p").agg(F.min("_r").alias("_r"))
    short = left.where((F.char_length(wanted) < least) & (a != "")).join(heads, a == F.col("_p")).select(left_id, "_r")
    # Equal names keep their smallest id too.
    firsts = names.groupBy(name).agg(F.min("_r").alias("_r")).withColumn("_p", F.substring(name, 1, least))
    long = left.where(F.char_length(wanted) >= least).withColumn("_p", F.substring(wanted, 1, least)).join(firsts, "_p").where(a.startswith(b) | b.startswith(a)).select(left_id, "_r")
    return short.unionByName(long).groupBy(left_id).agg(F.min("_r").alias(right_id))


def token_overlap(left: DataFrame, left_id: str, left_text: str, right: DataFrame, right_id: str, right_text: str, least: float = 0.5) -> DataFrame:
    """For each left row the right row with most shared distinct tokens by max(size); ties to the smallest right id.

    A right row that shares the least part of n tokens has one of any n - ceil(least * n) + 1 of them, so only
    a left row's rarest tokens are followed to the right; what is found is then counted in full.
    """
    a = left.select(F.col(left_id).alias("_l"), F.array_distinct(F.split(left_text, " ")).alias("_a")).where("_a is not null")
    b = right.select(F.col(right_id).alias("_r"), F.array_distinct(F.split(right_text, " ")).alias("_b")).where("_b is not null")
    spread = b.select("_r", F.explode("_b").alias("_token"))
    common = spread.groupBy("_token").agg(F.count("*").alias("_n"))
    # Ranked within a row's own tokens; tokens that the right side lacks come first, as they find nothing.
    ranked = a.select("_l", F.size("_a").alias("_m"), F.explode("_a").alias("_token")).join(common, "_token", "left")
    at = F.row_number().over(Window.partitionBy("_l").orderBy(F.coalesce("_n", F.lit(0)), "_token"))
    rare = ranked.withColumn("_at", at).where(F.col("_at") <= F.col("_m") - F.ceil(F.col("_m") * least) + 1).select("_l", "_token")
    pairs = rare.join(spread, "_token").select("_l", "_r").distinct().join(a, "_l").join(b, "_r")
    scored = pairs.select("_l", "_r", (F.size(F.array_intersect("_a", "_b")) / F.greatest(F.size("_a"), F.size("_b"))).alias("score")).where(F.col("score") >= least)
    best = scored.groupBy("_l").agg(F.min_by(F.struct("_r", "score"), F.struct(-F.col("score"), "_r")).alias("_x"))
    return best.select(F.col("_l").alias(left_id), F.col("_x._r").alias(right_id), F.col("_x.score").alias("score"))


def contained_words(left: DataFrame, left_id: str, words: str, right: DataFrame, right_id: str, text: str, percent: int = 80, need: Column | None = None) -> DataFrame:
    """(left_id, right_id): the smallest right id whose text contains at least percent of a left row's words (an array; parts of text words count).

    need: the number of words in place of percent. A left row that needs none takes the first of all. Words and texts are keys with
    single spaces, so a word lies within one text word: those that hold it are
    found by its first three letters. Of a row's words only the rarest few are
    followed to texts, as many as a hit can't do without; the others are looked
    up in the pairs found.
    """
    least = F.ceil(F.size(words) * percent / 100) if need is None else need
    rows = left.where(F.col(words).isNotNull()).select(F.col(left_id).alias("_l"), F.col(words).alias("_w"), least.cast("int").alias("_need"))
    texts = right.where(F.col(text).isNotNull()).select(F.col(right_id).alias("_r"), F.col(text).alias("_t"))
    held = texts.select("_r", F.explode(F.array_distinct(F.split("_t", " "))).alias("_v")).where("_v <> ''")
    starts = lambda n: F.transform(F.sequence(F.lit(1), F.length("_v")), lambda i: F.substring(F.col("_v"), i, F.lit(n)))
    grams = held.select("_v").distinct().select("_v", F.explode(F.array_distinct(F.flatten(F.array(*map(starts, (1, 2, 3)))))).alias("_g"))
    asked = rows.select(F.explode("_w").alias("_x")).distinct().withColumn("_g", F.substring("_x", 1, 3))
    within = asked.join(grams, "_g").where(F.contains("_v", F.col("_x"))).select("_x", "_v")
    spread = within.join(held.groupBy("_v").agg(F.count("*").alias("_n")), "_v").groupBy("_x").agg(F.sum("_n").alias("_n"))
    ranked = rows.where("_need > 0").select("_l", "_w", "_need", F.posexplode("_w").alias("_i", "_x")).join(spread, "_x", "left")
    ranked = ranked.withColumn("_k", F.row_number().over(Window.partitionBy("_l").orderBy(F.coalesce("_n", F.lit(0)), "_i")))
    seeds = ranked.where(F.col("_k") <= F.size("_w") - F.col("_need") + 1).select("_l", "_x").distinct()
    pairs = seeds.join(within, "_x").join(held, "_v").select("_l", "_r").distinct()
    full = pairs.join(rows, "_l").join(texts, "_r").where(F.size(F.filter("_w", lambda w: F.contains("_t", w))) >= F.col("_need"))
    first = rows.where("_need <= 0").crossJoin(texts.agg(F.min("_r").alias("_r"))).where("_r is not null")
    out = full.groupBy("_l").agg(F.min("_r").alias("_r")).unionByName(first.select("_l", "_r"))
    return out.select(F.col("_l").alias(left_id), F.col("_r").alias(right_id))


def segment_index(df: DataFrame, key: str, name: str, separator: str) -> DataFrame:
    """(segment, key): for each part of the names the smallest key that has it."""
    return df.select(key, F.explode(F.split(name, separator)).alias("segment")).where("segment <> ''").groupBy("segment").agg(F.min(key).alias(key))


def consuming_match(wanted: DataFrame, wanted_id: str, files: DataFrame, file_id: str, key: str) -> DataFrame:
    """Each file goes to the first wanted row of its key."""
    firsts = wanted.groupBy(key).agg(F.min(wanted_id).alias(wanted_id))
    return files.groupBy(key).agg(F.min(file_id).alias(file_id)).join(firsts, key)


def leftovers(wanted: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Files whose key no wanted row has: what a consuming match leaves over."""
    return files.join(wanted.select(key).distinct(), key, "left_anti")


def conditional_best(df: DataFrame, group: str, first: Column, second: Column, metric: str) -> DataFrame:
    """Largest metric among rows of the first condition, or if that is 0 or missing, of the second alone."""
    a = F.max(F.when(first, F.col(metric)))
    b = F.max(F.when(second & ~first, F.col(metric)))
    return df.groupBy(group).agg(F.coalesce(F.nullif(a, F.lit(0)), b).alias("best"))


def as_of(points: DataFrame, slices: DataFrame, keys: list[str], at: str, value: str, name: str, *, strict: bool = False) -> DataFrame:
    """points with the value of the latest slice at or (strict) before their time; one sort, no inequality join."""
    side = 1 if strict else 0
    p = points.withColumn("_side", F.lit(1 - side)).withColumn("_v", F.lit(None).cast(slices.schema[value].dataType))
    s = slices.select(*keys, at, F.lit(side).alias("_side"), F.col(value).alias("_v"))
    order = Window.partitionBy(*keys).orderBy(at, "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = p.unionByName(s, allowMissingColumns=True).withColumn(name, F.last("_v", ignorenulls=True).over(order))
    return both.where(F.col("_side") == 1 - side).drop("_side", "_v")


def as_of_with_fallback(points: DataFrame, slices: DataFrame, bars: DataFrame, keys: list[str], at: str, value: str, name: str, passing) -> DataFrame:
    """points with the slice at their time; where that is passing and the time is no bar's start, the slice at the bar's start.

    bars: keys and at, the starts of bars. A point before all bars keeps what it has. passing: a condition on a value.
    """
    found = as_of(points, slices, keys, at, value, "_first")
    found = as_of(found, bars.select(*keys, at, F.col(at).alias("_bar")), keys, at, "_bar", "_start")
    # The second lookup is at the bar's start; points without a bar have no time and find nothing.
    moved = found.withColumnRenamed(at, "_at").withColumn(at, F.col("_start"))
    again = as_of(moved.where(F.col("_start").isNotNull()), slices, keys, at, value, "_second")
    out = again.unionByName(moved.where(F.col("_start").isNull()).withColumn("_second", F.lit(None).cast(slices.schema[value].dataType)))
    late = passing(F.col("_first")) & F.col("_start").isNotNull() & (F.col("_start") != F.col("_at"))
    return out.select(*[F.col("_at").alias(c) if c == at else c for c in points.columns], F.when(late, F.col("_second")).otherwise(F.col("_first")).alias(name))


def wildcard_join(left: DataFrame, right: DataFrame, keys: list[str], wanted: str, held: str) -> DataFrame:
    """Pairs with equal keys where right's held equals left's wanted or is null; two equality joins instead of an OR."""
    right = right.drop(*[c for c in right.columns if c in left.columns and c not in keys])
    exact = left.join(right.withColumn(wanted, F.col(held)).where(F.col(held).isNotNull()), [*keys, wanted])
    free = left.join(right.where(F.col(held).isNull()), keys)
    return exact.unionByName(free)


def registry_names(df: DataFrame, key: str, sources: str, registry: DataFrame, registry_key: str, name: str, order: list[str]) -> DataFrame:
    """(key, sources): a map of assets to registry keys as 'asset: name; ...' in the given order of assets; unknown keys as '?key'."""
    asset = F.array_position(F.array(*map(F.lit, order)), F.col("_asset"))
    held = df.select(key, F.explode(sources).alias("_asset", "_source"))
    found = held.join(registry.select(F.col(registry_key).alias("_source"), F.col(name).alias("_name")), "_source", "left")
    told = F.concat_ws(": ", "_asset", F.coalesce("_name", F.concat(F.lit("?"), F.col("_source").cast("string"))))
    # A map has one entry an asset, so a row's list is as short as the list of assets.
    parts = F.sort_array(F.collect_list(F.struct(asset.alias("at"), told.alias("told"))))
    return found.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["told"]), "; ").alias("sources"))


# Phrases of attribution texts.
HEADING = " — sources & attribution"
REQUIRED = " (attribution required)"
PUBLIC_DOMAIN, OWN_TERMS = "License: Public domain.", "License: own terms."
STATED = "Public-domain source"


def attributions(df: DataFrame, key: str, title: str, sources: str, public: str, registry: DataFrame, registry_key: str, name: str, url: str, required: str, labels: dict[str, str], *, counted: Column | None = None, count_line: str = "", licence_source: Column | None = None) -> DataFrame:
    """(key, rendered, error): the attribution text of each row; where a source is unknown there is no text but an error.

    sources: map of assets to registry keys; labels: asset to label, in the order of the lines. A row without sources
    has the title, an empty line and the licence (public: whether it is in the public domain).
    count_line stands behind the sources of rows for which counted holds. licence_source: registry key of what says that a
    row is in the public domain; it is named behind the licence, and its lack in the registry is an error after those of assets.
    """
    order = F.array(*map(F.lit, labels))
    names = F.create_map(*(F.lit(x) for pair in labels.items() for x in pair))
    held = df.select(key, F.explode(sources).alias("_asset", "_source")).where(F.array_contains(order, F.col("_asset")))
    known = registry.select(F.col(registry_key).alias("_source"), F.col(name).alias("_name"), F.col(url).alias("_url"), F.col(required).alias("_required"))
    found = held.join(known, "_source", "left")
    told = F.concat(names[F.col("_asset")], F.lit(": "), "_name", F.coalesce(F.concat(F.lit(" — "), F.nullif("_url", F.lit(""))), F.lit("")), F.when(F.col("_required"), REQUIRED).otherwise(""))
    missing = F.when(F.col("_name").isNull(), F.concat(F.lit("unknown source "), F.col("_source").cast("string"), F.lit(" for "), "_asset"))
    # A row has at most one entry a label.
    parts = F.sort_array(F.collect_list(F.struct(F.array_position(order, F.col("_asset")).alias("at"), told.alias("told"), missing.alias("missing"))))
    lines = found.groupBy(key).agg(parts.alias("_parts"))
    out = df.withColumn("_ls", F.lit(None) if licence_source is None else F.when(F.col(public), licence_source))
    out = out.withColumn("_counted", F.lit(False) if counted is None else F.coalesce(counted, F.lit(False))).join(lines, key, "left")
    if licence_source is None:
        out = out.withColumn("_stated", F.lit("")).withColumn("_unstated", F.lit(None).cast("string"))
    else:
        out = out.join(registry.select(F.col(registry_key).alias("_ls"), F.col(name).alias("_ls_name")), "_ls", "left")
        out = out.withColumn("_stated", F.coalesce(F.concat(F.lit(f" {STATED}: "), "_ls_name", F.lit(".")), F.lit("")))
        out = out.withColumn("_unstated", F.when(F.col("_ls").isNotNull() & F.col("_ls_name").isNull(), F.concat(F.lit("unknown licence source "), F.col("_ls").cast("string"))))
    errors = F.filter(F.transform("_parts", lambda x: x["missing"]), lambda m: m.isNotNull())
    error = F.coalesce(F.try_element_at(errors, F.lit(1)), "_unstated")
    body = F.coalesce(F.array_join(F.transform("_parts", lambda x: F.concat(x["told"], F.lit("\n"))), ""), F.lit(""))
    licence = F.when(F.col(public), F.concat(F.lit(PUBLIC_DOMAIN), "_stated")).otherwise(OWN_TERMS)
    text = F.concat(F.col(title), F.lit(f"{HEADING}\n\n"), body, F.when(F.col("_counted"), f"{count_line}\n").otherwise(""), F.lit("\n"), licence, F.lit("\n"))
    return out.select(key, F.when(error.isNull(), text).alias("rendered"), error.alias("error"))


def by_alias(left: DataFrame, key: str, aliases: DataFrame, target: DataFrame, target_key: str) -> DataFrame:
    """left with the columns of the target that its key finds, itself or through its alias (aliases: alias, name; one row an alias)."""
    named = left.join(aliases.select(F.col("alias").alias(key), F.col("name").alias("_name")), key, "left")
    found = target.withColumnRenamed(target_key, "_key")
    out = named.join(found, F.coalesce("_name", key) == F.col("_key"), "left")
    return out.select(*left.columns, *(c for c in found.columns if c != "_key"))


def two_hop(left: DataFrame, direct: str, link: str, index: DataFrame, target: DataFrame, target_key: str) -> DataFrame:
    """left with the columns of the target found by its direct key, else by the key that the index (link, name) has for its link."""
    values = [c for c in target.columns if c != target_key]
    once = target.select(F.col(target_key).alias("_a"), F.struct(*values).alias("_one"))
    again = target.select(F.col(target_key).alias("_b"), F.struct(*values).alias("_two"))
    out = left.join(once, F.col(direct) == F.col("_a"), "left")
    out = out.join(index.select(F.col("link").alias("_link"), F.col("name").alias("_name")), (F.col(link) == F.col("_link")) & F.col("_one").isNull(), "left")
    out = out.join(again, F.col("_name") == F.col("_b"), "left").withColumn("_hit", F.coalesce("_one", "_two"))
    return out.select(*left.columns, *(F.col(f"_hit.{v}").alias(v) for v in values))


def contained_first(df: DataFrame, key: str, wanted: str, candidates: DataFrame, text: str, *order: Column, most: int = 3) -> DataFrame:
    """df with hit: the text of the first of the key's first few candidates that contains wanted, null without one."""
    from lectern.operators.rows import top_per_key

    few = top_per_key(candidates, [key], most, *order)
    listed = few.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*(o.alias(f"_{i}") for i, o in enumerate(order)), F.col(text).alias("_text")))).alias("_few"))
    hits = F.filter("_few", lambda c: c["_text"].contains(F.col(wanted)))
    return df.join(listed, key, "left").withColumn("hit", F.try_element_at(hits, F.lit(1))["_text"]).drop("_few")


def shared_lookup(df: DataFrame, label: Column, lookup: DataFrame, key: str) -> DataFrame:
    """df with the lookup's columns, found once for each distinct cleaned label and joined back to all that share it."""
    rows = df.withColumn("_clean", label)
    once = rows.select("_clean").distinct().join(lookup.withColumnRenamed(key, "_clean"), "_clean")
    return rows.join(once, "_clean", "left").drop("_clean")
