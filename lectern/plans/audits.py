"""The rule sets on records and families that documents, customers and parts stand in for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import audit
from lectern.plans.registry import Tables, query

_LANGUAGES = ("de", "en", "es", "fr")
_RECORDS = """r as (select doc_id, printf('%08d', doc_id) as folder, case when doc_id % 3 = 0 then 'wc' else 'public-domain' end as section, case when doc_id % 41 = 0 then 'xx' else lang end as directory, doc_id % 97 = 0 as unreadable, doc_id % 31 = 0 as submitted,
    case when doc_id % 37 = 0 then 'bad id' when doc_id % 53 <> 0 then substr(translate(to_base64(unhex(sha1('song:' || split_part(text, chr(10), 1)))), '+/', '-_'), 1, 11) end as id, nullif(split_part(text, chr(10), 1), '') as title, case when doc_id % 23 <> 0 then source end as writer,
    case when doc_id % 43 = 0 then 'fr' else lang end as language, case when doc_id % 3 = 0 and doc_id % 2 = 0 then 'CC' else 'PD' end as license, case when doc_id % 5 = 0 then 'Brand#' || (doc_id % 40) end as license_source, case when doc_id % 29 <> 0 then '4/4' end as meter,
    case when doc_id % 4 = 0 then 'f' || (doc_id % 60) end as work_ref, case when doc_id % 6 = 0 then doc_id * 2 % 400 end as writer_ref, case when doc_id % 9 = 0 then substr(translate(to_base64(unhex(sha1('song:' || source))), '+/', '-_'), 1, 11) when doc_id % 10 = 0 then 'bad id' end as parent,
    case when doc_id % 59 <> 0 then case when doc_id % 61 = 0 then '  ' else text end end as body, case when doc_id % 7 = 0 then null when doc_id % 11 = 0 then 'other' else split_part(text, chr(10), 1) end as told_title, case when doc_id % 8 = 0 then 'Brand#9x' else 'Brand#' || (doc_id % 20) end as from_source,
    case when doc_id % 2 = 0 then split_part(text, chr(10), 1) else replace(split_part(text, chr(10), 1), 'the', 'THE') end as name, case when doc_id % 5 = 0 then 'G' end as music_key, 60 + doc_id % 5 as bpm, case when doc_id % 7 <> 0 then case when doc_id % 19 = 0 then 'other' else source end end as told_artist,
    case when doc_id % 3 <> 0 then 'G' end as told_key, case when doc_id % 7 <> 0 then '4/4' end as told_time, case when doc_id % 7 <> 0 then case when doc_id % 6 = 0 then '99' else (60 + doc_id % 5)::varchar end end as told_tempo from documents)"""
_HEADS = "\n".join(
    f"""    union all select 'V16', 'W', folder from x where "full" and {field} is not null and told_{name} is null
    union all select 'V17', 'E', folder from x where "full" and told_{name} <> {field}::varchar"""
    for name, field in {"title": "title", "artist": "writer", "key": "music_key", "time": "meter", "tempo": "bpm"}.items()
)
_AUDIT = f"""with {_RECORDS}, brands as (select distinct p_brand as key from part), works as (select distinct 'f' || n_nationkey as slug, n_nationkey % 2 = 0 as with_tune from nation),
    x as (select *, row_number() over (partition by id order by folder) as again, row_number() over (partition by directory, section, lower(name) order by folder) as alike, not unreadable and body is not null as full from r), y as (select * from x where not unreadable)
    select rule_id, severity, folder as key from (select 'V1' as rule_id, 'E' as severity, folder from x where unreadable
    union all select 'V2', 'E', folder from y where id is null union all select 'V2', 'E', folder from y where not submitted and doc_id % 23 = 0 union all select 'V2', 'E', folder from y where not submitted and doc_id % 47 = 0
    union all select 'V2', 'E', folder from y where not submitted and doc_id % 29 = 0 union all select 'V2', 'E', folder from y where submitted and doc_id % 62 = 0
    union all select 'V3', 'E', folder from y where not regexp_matches(id, '^[A-Za-z0-9_-]{{11}}$')
    union all select 'V4', 'E', folder from y where id is not null and again > 1
    union all select 'V5', 'E', folder from y where directory not in ('de', 'en', 'es', 'fr')
    union all select 'V6', 'E', folder from y where language in ('de', 'en', 'es', 'fr') and language <> directory
    union all select 'V7', 'E', folder from y where (license = 'PD') <> (section = 'public-domain')
    union all select 'V8', 'E', folder from y where license_source not in (select key from brands)
    union all select 'V9', 'E', folder from y where license_source is not null and license <> 'PD'
    union all select 'V10', 'E', folder from y where name is not null and alike > 1
    union all select 'V11', 'E', folder from y where work_ref not in (select slug from works)
    union all select 'V13', 'E', folder from y where parent is not null and work_ref is not null
    union all select 'V14', 'E', folder from y where body is null
    union all select 'V15', 'E', folder from x where "full" and trim(body) = ''
{_HEADS}
    union all select 'V18', 'E', folder from x where "full" and not submitted and from_source not in (select key from brands)
    union all select 'V19', 'W', folder from x where "full" and not submitted and (doc_id % 13 = 0 and not coalesce(work_ref in (select slug from works where with_tune), false) or doc_id % 26 = 1)
    union all select 'V20', 'W', folder from x where "full" and not submitted and doc_id % 17 = 0
    union all select 'V24', 'E', folder from y where writer_ref not in (select c_custkey from customer)
    union all select 'V25', 'E', folder from y where writer_ref in (select c_custkey from customer where c_custkey % 12 = 0)
    union all select 'V26', 'W', folder from y where id is null
    union all select 'V27', 'W', folder from y where parent not in (select id from y where id is not null)
    union all select 'V28', 'E', folder from y where parent in (select id from y where id is not null and work_ref is not null))"""


def _records(t: Tables) -> DataFrame:
    n, c = F.col("doc_id"), F.col
    text = lambda x: x.cast("string")
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    told = F.when(n % 7 == 0, None).when(n % 11 == 0, "other").otherwise(title)
    heads = {"title": told, "artist": F.when(n % 7 != 0, F.when(n % 19 == 0, "other").otherwise(c("source"))), "key": F.when(n % 3 != 0, "G"), "time": F.when(n % 7 != 0, "4/4"), "tempo": F.when(n % 7 != 0, F.when(n % 6 == 0, "99").otherwise(text(60 + n % 5)))}
    lacking = {"id": (n % 53 == 0) & (n % 37 != 0), "writer": n % 23 == 0, "churchCount": n % 47 == 0, "timeSignature": n % 29 == 0, "status": n % 62 == 0}
    fields = F.array_compact(F.array(*[F.when(~lacking.get(f, F.lit(False)), f) for f in {**dict.fromkeys(audit.REQUIRED), "status": None}]))
    maker = F.when(n % 8 == 0, "Brand#9x").otherwise(F.concat(F.lit("Brand#"), text(n % 20)))
    timed = F.map_from_arrays(F.array(F.lit("text"), F.lit("timing")), F.array(maker, F.lit("Brand#1")))
    stated = F.when(n % 26 == 1, timed).when(n % 13 == 0, F.map_from_arrays(F.array(F.lit("text"), F.lit("tune")), F.array(maker, F.lit("Brand#1")))).otherwise(F.create_map(F.lit("text"), maker))
    return t.documents.select(
        F.lpad(text(n), 8, "0").alias("folder"), F.when(n % 3 == 0, "wc").otherwise("public-domain").alias("section"), F.when(n % 41 == 0, "xx").otherwise(c("lang")).alias("directory"), (n % 97 == 0).alias("unreadable"), (n % 31 == 0).alias("submitted"),
        F.when(n % 37 == 0, "bad id").when(n % 53 != 0, X.stable_id(title, "song:")).alias("id"), F.nullif(title, F.lit("")).alias("title"), F.when(n % 23 != 0, c("source")).alias("writer"), F.when(n % 43 == 0, "fr").otherwise(c("lang")).alias("language"),
        F.when((n % 3 == 0) & (n % 2 == 0), "CC").otherwise("PD").alias("license"), F.when(n % 5 == 0, F.concat(F.lit("Brand#"), text(n % 40))).alias("license_source"), F.when(n % 29 != 0, "4/4").alias("meter"), F.when(n % 4 == 0, F.concat(F.lit("f"), text(n % 60))).alias("work_ref"),
        F.when(n % 6 == 0, n * 2 % 400).alias("writer_ref"), F.when(n % 9 == 0, X.stable_id(c("source"), "song:")).when(n % 10 == 0, "bad id").alias("parent"), F.when(n % 59 != 0, F.when(n % 61 == 0, "  ").otherwise(c("text"))).alias("body"),
        F.map_filter(F.create_map(*[x for k, v in heads.items() for x in (F.lit(k), v)]), lambda k, v: v.isNotNull()).alias("header"), F.when(n % 2 == 0, title).otherwise(F.replace(title, F.lit("the"), F.lit("THE"))).alias("name"), fields.alias("fields"),
        F.when(n % 5 == 0, "G").alias("music_key"), (60 + n % 5).alias("bpm"), stated.alias("provenance"), F.when(n % 17 == 0, F.array(F.lit("text"), F.lit("art"))).otherwise(F.array(F.lit("text"))).alias("assets"),
    )


@query(_AUDIT)
def record_audit(t: Tables) -> DataFrame:
    shared = F.when(F.col("n_nationkey") % 2 == 0, F.array(F.lit("tune"), F.lit("timing"))).otherwise(F.array(F.lit("art")))
    works = t.nation.select(F.concat(F.lit("f"), F.col("n_nationkey").cast("string")).alias("slug"), shared.alias("assets"))
    writers = t.customer.select(F.col("c_custkey").alias("slug"), (F.col("c_custkey") % 12 != 0).alias("portrait"))
    return audit.record_violations(_records(t), works, writers, t.part.select(F.col("p_brand").alias("key")), _LANGUAGES)


@query("""with w as (select p_partkey as slug, p_partkey + (p_partkey % 19 = 0)::int as folder, case when p_partkey % 13 <> 0 then p_partkey * 3 // 2 end as canonical from part), m as (select o_orderkey as id, case when o_custkey % 2 = 0 then o_orderkey * 2 // 3 end as work_ref from orders),
    x as (select w.*, m.id is not null as there, m.work_ref, (select count(*) from m k where k.work_ref = w.slug) as n, row_number() over (partition by folder order by slug) as a, row_number() over (partition by canonical order by slug) as b from w left join m on m.id = w.canonical)
    select rule_id, severity, slug::varchar as key from (select 'V29' as rule_id, 'E' as severity, slug from x where slug <> folder union all select 'V30', 'E', slug from x where a > 1 union all select 'V31', 'E', slug from x where canonical is null
    union all select 'V32', 'E', slug from x where canonical is not null and not there union all select 'V33', 'E', slug from x where there and work_ref is distinct from slug union all select 'V34', 'E', slug from x where canonical is not null and b > 1 union all select 'V35', 'W', slug from x where canonical is not null and n < 2)""")
def family_audit(t: Tables) -> DataFrame:
    key = F.col("p_partkey")
    works = t.part.select(key.alias("slug"), (key + (key % 19 == 0).cast("int")).alias("folder"), F.when(key % 13 != 0, F.floor(key * 3 / 2)).alias("canonical"))
    records = t.orders.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_custkey") % 2 == 0, F.floor(F.col("o_orderkey") * 2 / 3)).alias("work_ref"))
    return audit.family_violations(works, records)
