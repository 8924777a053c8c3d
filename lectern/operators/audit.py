"""Data-quality rules: violations as rows (rule_id, severity, key).

All rules on single rows are one array expression, so any number of them costs
one scan; references are resolved by left joins that leave a flag.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

#: rule_id, severity ('E' or 'W'), condition under which a row violates it.
Rule = tuple[str, str, Column]
# The shape of an id, the fields a record must have, header directives and the record's columns they repeat.
ID_SHAPE = "^[A-Za-z0-9_-]{11}$"
REQUIRED = "id title writer language license churchCount hymnalCount timeSignature provenance".split()
REQUIRED_SUBMITTED = "id title language license status".split()
DIRECTIVES = {"title": "title", "artist": "writer", "key": "music_key", "time": "meter", "tempo": "bpm"}


def row_rules(df: DataFrame, key: str, rules: Sequence[Rule]) -> DataFrame:
    """One row per violated rule; a condition that is null is no violation."""
    found = F.array_compact(F.array(*[F.when(c, F.struct(F.lit(i).alias("rule_id"), F.lit(s).alias("severity"))) for i, s, c in rules]))
    return df.select(F.col(key).cast("string").alias("key"), F.explode(found).alias("_r")).select("_r.rule_id", "_r.severity", "key")


def flagged(df: DataFrame, reference: str, target: DataFrame, key: str, flag: str) -> DataFrame:
    """df with flag: whether the reference has a target (null references: null)."""
    known = target.select(F.col(key).alias(reference)).where(F.col(reference).isNotNull()).distinct().withColumn("_hit", F.lit(True))
    out = df.join(known, reference, "left")
    return out.select(*df.columns, F.when(F.col(reference).isNotNull(), F.coalesce("_hit", F.lit(False))).alias(flag))


def repeated(df: DataFrame, bucket: Sequence[str], value: Column, key: str, flag: str) -> DataFrame:
    """df with flag: whether a row with a smaller key has the same value in the bucket.

    A group's smallest key is aggregated before the shuffle and joined back, so no task sorts a large group.
    """
    rows = df.withColumn("_value", value)
    firsts = rows.where(F.col("_value").isNotNull()).groupBy(*bucket, "_value").agg(F.min(key).alias("_first"))
    firsts = firsts.select(F.col("_value").alias("_same"), "_first", *(F.col(b).alias(f"_in_{b}") for b in bucket))
    same = F.col("_value") == F.col("_same")
    for b in bucket:
        same &= F.col(b).eqNullSafe(F.col(f"_in_{b}"))
    return rows.join(firsts, same, "left").select(*df.columns, F.coalesce(F.col(key) > F.col("_first"), F.lit(False)).alias(flag))


def record_violations(records: DataFrame, works: DataFrame, writers: DataFrame, sources: DataFrame, languages: Sequence[str]) -> DataFrame:
    """The rules on records.

    records: folder (unique), name (of the folder in its section and directory), section, directory, unreadable, submitted,
    fields (array of those that are there, null or not), id, title, writer, language, license, license_source, music_key,
    meter, bpm, work_ref, writer_ref, parent, body, header (map), provenance (map), assets (array). works: slug, assets;
    writers: slug, portrait (boolean); sources: key. An unreadable record meets V1 alone; one without a body file ends at
    V14; submitted records need other fields and no provenance. V2, V16 and V17 give a row for each field or directive.
    A family's assets count as the record's own in V19, but for timing.
    """
    c = F.col
    # only what the rules ask about the body goes through the joins
    slim = records.withColumn("_blank", F.trim("body") == "").drop("body")
    df = flagged(slim, "work_ref", works, "slug", "_work")
    df = flagged(df, "writer_ref", writers, "slug", "_writer")
    df = flagged(df, "writer_ref", writers.where("portrait"), "slug", "_portrait")
    df = flagged(df, "license_source", sources, "key", "_licensed")
    df = flagged(df, "parent", records.where("not unreadable"), "id", "_parent")
    df = flagged(df, "parent", records.where("not unreadable and work_ref is not null"), "id", "_member")
    df = repeated(repeated(df, [], c("id"), "folder", "_again"), ["directory", "section"], F.lower("name"), "folder", "_collides")
    known, read, full = c("language").isin(*languages), ~c("unreadable"), ~c("unreadable") & c("_blank").isNotNull()

    shared = works.select(c("slug").alias("work_ref"), c("assets").alias("_shared")).dropDuplicates(["work_ref"])
    df = df.join(shared, "work_ref", "left")
    owned, told = c("assets"), F.map_keys("provenance")
    held = F.array_union(owned, F.array_remove(F.coalesce("_shared", F.array().cast("array<string>")), "timing"))
    lacks = [("V2", "E", read & ~c("submitted") & ~F.array_contains("fields", f)) for f in REQUIRED]
    lacks += [("V2", "E", read & c("submitted") & ~F.array_contains("fields", f)) for f in REQUIRED_SUBMITTED]
    heads = []
    for name, field in DIRECTIVES.items():
        stated = F.try_element_at("header", F.lit(name))
        heads += [("V16", "W", full & c(field).isNotNull() & stated.isNull()), ("V17", "E", full & (stated != c(field).cast("string")))]
    first = [
        ("V1", "E", c("unreadable")),
        *lacks,
        ("V3", "E", read & ~c("id").rlike(ID_SHAPE)),
        ("V4", "E", read & c("_again")),
        ("V5", "E", read & ~c("directory").isin(*languages)),
        ("V6", "E", read & known & (c("language") != c("directory"))),
        ("V7", "E", read & ((c("license") == "PD") != (c("section") == "public-domain"))),
        ("V8", "E", read & ~c("_licensed")),
        ("V9", "E", read & c("license_source").isNotNull() & (c("license") != "PD")),
        ("V10", "E", read & c("_collides")),
        ("V11", "E", read & ~c("_work")),
        ("V13", "E", read & c("parent").isNotNull() & c("work_ref").isNotNull()),
        ("V14", "E", read & c("_blank").isNull()),
        ("V15", "E", full & c("_blank")),
        *heads,
        ("V19", "W", full & ~c("submitted") & (F.size(F.array_except(F.array_remove(told, "text"), held)) > 0)),
        ("V20", "W", full & ~c("submitted") & (F.size(F.array_except(owned, told)) > 0)),
        ("V24", "E", read & ~c("_writer")),
        ("V25", "E", read & c("_writer") & ~c("_portrait")),
        ("V26", "W", read & c("id").isNull()),
        ("V27", "W", read & ~c("_parent")),
        ("V28", "E", read & c("_member")),
    ]
    stated = df.where(full & ~c("submitted")).select("folder", F.explode("provenance").alias("asset", "source"))
    unknown = row_rules(flagged(stated, "source", sources, "key", "_known"), "folder", [("V18", "E", ~c("_known"))])
    return row_rules(df, "folder", first).unionByName(unknown)


def family_violations(works: DataFrame, records: DataFrame) -> DataFrame:
    """The rules on families. works: slug, folder, canonical; records: id, work_ref.

    A family without a canonical record ends at V31.
    """
    c = F.col
    df = flagged(works, "canonical", records, "id", "_there")
    of = records.where("id is not null").select(c("id").alias("canonical"), c("work_ref").alias("_of")).dropDuplicates(["canonical"])
    members = records.where("work_ref is not null").groupBy(c("work_ref").alias("slug")).agg(F.count("*").alias("_n"))
    df = df.join(of, "canonical", "left").join(members, "slug", "left")
    df = repeated(repeated(df, [], F.lower("folder"), "slug", "_collides"), [], c("canonical"), "slug", "_shared")
    named = c("canonical").isNotNull()
    return row_rules(df, "slug", [
        ("V29", "E", c("slug") != c("folder")),
        ("V30", "E", c("_collides")),
        ("V31", "E", ~named),
        ("V32", "E", named & ~c("_there")),
        ("V33", "E", named & c("_there") & ~c("_of").eqNullSafe(c("slug"))),
        ("V34", "E", c("_shared")),
        ("V35", "W", named & (F.coalesce("_n", F.lit(0)) < 2)),
    ])


def render_errors(df: DataFrame, key: str, sources: str, registry: DataFrame, registry_key: str, order: list[str]) -> DataFrame:
    """V23: (key, error) of rows that can't be rendered: assets, in the given order, whose source key the registry lacks; other assets are not rendered."""
    held = df.select(key, F.explode(sources).alias("_asset", "_source")).where(F.col("_asset").isin(*order) & F.col("_source").isNotNull())
    lost = held.join(registry.select(F.col(registry_key).alias("_source")), "_source", "left_anti")
    told = F.concat(F.lit("provenance."), "_asset", F.lit(' references unknown source "'), F.col("_source").cast("string"), F.lit('"'))
    # A map has one entry an asset, so a row's list is as short as the list of assets.
    parts = F.sort_array(F.collect_list(F.struct(F.array_position(F.array(*map(F.lit, order)), F.col("_asset")).alias("at"), told.alias("told"))))
    return lost.groupBy(key).agg(F.array_join(F.transform(parts, lambda x: x["told"]), "; ").alias("error"))


def fatal(df: DataFrame, key: str, record_id: str, references: dict[str, tuple[DataFrame, str]], *, suggestion: Column | None = None) -> DataFrame:
    """df, whose job fails at a row without id, at one of a repeated id, or at a reference without target.

    references: column to its target and the target's key. The checks are expressions of the rows that the
    caller writes, so nothing is read twice and nothing is collected; they hold wherever df is used. Null references are none.
    """
    at = F.concat(F.lit(" at "), F.coalesce(F.col(key).cast("string"), F.lit("?")))
    wish = F.lit("") if suggestion is None else F.concat(F.lit("; suggested: "), F.coalesce(suggestion, F.lit("?")))
    out = df.withColumn("_same", F.count("*").over(Window.partitionBy(record_id)))
    broken = F.when(F.col(record_id).isNull(), F.concat(F.lit("no id"), at, wish)).when(F.col("_same") > 1, F.concat(F.lit("repeated id "), F.col(record_id).cast("string"), at))
    for i, (column, (target, target_key)) in enumerate(references.items()):
        out = flagged(out, column, target, target_key, f"_there{i}")
        broken = broken.when(~F.col(f"_there{i}"), F.concat(F.lit(f"{column} without target"), at))
    # A filter that needs the verdict can't be dropped by column pruning.
    return out.where(F.when(broken.isNotNull(), F.raise_error(broken).cast("boolean")).otherwise(True)).select(*df.columns)


def observed(violations: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """violations, and what the job that writes them counts on the way: errors, warnings and failed; no second scan."""
    seen = Observation(name)
    errors, warnings = F.count_if(F.col("severity") == "E"), F.count_if(F.col("severity") == "W")
    return violations.observe(seen, errors.alias("errors"), warnings.alias("warnings"), (errors > 0).alias("failed")), seen


def verdict(violations: DataFrame) -> DataFrame:
    """One row: errors, warnings, and whether the run failed, which warnings alone don't make it."""
    errors = F.count_if(F.col("severity") == "E")
    return violations.agg(errors.alias("errors"), F.count_if(F.col("severity") == "W").alias("warnings"), (errors > 0).alias("failed"))


def suggested_ids(records: DataFrame, key: str, record_id: str, suggestion: Column) -> DataFrame:
    """V26: (key, suggestion) of records without id."""
    return records.where(F.col(record_id).isNull()).select(key, suggestion.alias("suggestion"))
