"""Queries on lookups by alias, fallback and family, on unions, defaults, exports and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import family, match, rows
from lectern.plans.registry import Tables, query

_FIRST = "split_part(text, chr(10), 1)"


@query("""with alias as (select n_name as alias, r_name as name from nation join region on r_regionkey = n_regionkey where n_nationkey % 3 <> 0), wanted as (select s_suppkey, case when s_suppkey % 4 = 0 then r_name else n_name end as wanted from supplier join nation on n_nationkey = s_nationkey join region on r_regionkey = n_regionkey)
    select s_suppkey, r_regionkey as region from wanted left join alias on alias = wanted left join region on r_name = coalesce(name, wanted)""")
def alias_lookup(t: Tables) -> DataFrame:
    both = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    aliases = both.where("n_nationkey % 3 <> 0").select(F.col("n_name").alias("alias"), F.col("r_name").alias("name"))
    wanted = t.supplier.join(both, F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", F.when(F.col("s_suppkey") % 4 == 0, F.col("r_name")).otherwise(F.col("n_name")).alias("wanted"))
    return match.by_alias(wanted, "wanted", aliases, t.region.select("r_name", F.col("r_regionkey").alias("region")), "r_name").select("s_suppkey", "region")


@query(f"""with catalogue as (select {_FIRST} as title, min(doc_id) as original from documents join labels using (doc_id) group by 1), by_source as (select source as link, min({_FIRST}) as name from documents join labels using (doc_id) where source is not null group by 1)
    select d.doc_id, coalesce(a.original, b.original) as original from documents d left join catalogue a on a.title = split_part(d.text, chr(10), 1) left join by_source s on s.link = d.source and a.original is null left join catalogue b on b.title = s.name""")
def two_hop_lookup(t: Tables) -> DataFrame:
    """The labelled document with the same title, else the one that the source's index page names."""
    d = t.documents.withColumn("title", F.split_part("text", F.lit("\n"), F.lit(1)))
    known = d.join(t.labels.select("doc_id").distinct(), "doc_id", "left_semi")
    catalogue = known.groupBy("title").agg(F.min("doc_id").alias("original")).withColumnRenamed("title", "name_of")
    index = known.where("source is not null").groupBy(F.col("source").alias("link")).agg(F.min("title").alias("name"))
    return match.two_hop(d, "title", "source", index, catalogue, "name_of").select("doc_id", "original")


@query("""with f as (select source, min(doc_id) as canonical from documents group by source), c as (select sha256(text) as h, min(doc_id) as first_id from documents group by 1)
    select doc_id, coalesce(case when first_id <> doc_id then first_id end, case when canonical <> doc_id then canonical end) as derived from documents d left join c on h = sha256(text) left join f on f.source = d.source""")
def derived_parents(t: Tables) -> DataFrame:
    """A copy's parent is the text's first document, any other's its source's first."""
    d = t.documents.select("doc_id", "source", F.sha2("text", 256).alias("h"))
    firsts = d.where("h is not null").groupBy("h").agg(F.min("doc_id").alias("first_id"))
    d = d.join(firsts, "h", "left").withColumn("parent", F.when(F.col("first_id") != F.col("doc_id"), F.col("first_id")))
    canonical = d.where("source is not null").groupBy("source").agg(F.min("doc_id").alias("member"))
    return family.derived_parent(d, "doc_id", "parent", "source", canonical, "member").select("doc_id", "derived")


@query("select p_partkey, p_name from part where p_partkey in (select l_partkey from lineitem where l_returnflag = 'R' and l_quantity > 45)")
def families_in_use(t: Tables) -> DataFrame:
    return family.in_use(t.part.select("p_partkey", "p_name"), "p_partkey", t.lineitem.where("l_returnflag = 'R' and l_quantity > 45"), "l_partkey")


@query("""select 'document' as kind, doc_id as id, length(text) as size from documents union all select 'page', page_id, length(html) from pages union all select 'turn', conv_id, length(text) from conversations union all select 'item', item_id, length(text) from benchmark""")
def tagged_union(t: Tables) -> DataFrame:
    def sized(df: DataFrame, key: str, text: str) -> DataFrame:
        return df.select(F.col(key).alias("id"), F.char_length(text).alias("size"))

    return rows.tagged_union(document=sized(t.documents, "doc_id", "text"), page=sized(t.pages, "page_id", "html"), turn=sized(t.conversations, "conv_id", "text"), item=sized(t.benchmark, "item_id", "text"))


@query("select event_id from events where json_extract_string(props, '$.k') = '42'")
def info_filter(t: Tables) -> DataFrame:
    """Exact value of one field of the info map, no part of it."""
    info = F.from_json("props", "map<string,string>")
    return t.events.where(F.try_element_at(info, F.lit("k")) == "42").select("event_id")


@query("select o_orderkey from orders where o_orderstatus = 'O' and o_orderkey not in (select l_orderkey from lineitem where l_returnflag = 'R')")
def gap_filter(t: Tables) -> DataFrame:
    """Open orders that lack a returned line."""
    return t.orders.where("o_orderstatus = 'O'").join(t.lineitem.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti").select("o_orderkey")


@query("select source, count(*) as n from documents where source is null or source not in ('src0', 'src7') group by 1")
def authority_filter(t: Tables) -> DataFrame:
    return rows.without_values(t.documents, "source", "src0", "src7").groupBy("source").agg(F.count("*").alias("n"))


@query(f"""select doc_id, nullif(trim(split_part(text, ',', 1)), '') as head, case when strpos(text, '@') > 0 then nullif(trim(substr(text, strpos(text, '@') + 1)), '') end as tail from documents""")
def list_heads(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.first_item(F.col("text"), ",").alias("head"), X.after_mark(F.col("text"), "@").alias("tail"))


@query("""select d.doc_id, coalesce(nullif(d.lang, ''), 'Unknown') as writer, coalesce(l.quality, 90) as bpm, coalesce(nullif(case when d.n_chars % 3 = 0 then d.source else '' end, ''), '4/4') as meter from documents d left join (select distinct on (doc_id) doc_id, quality from labels order by doc_id, quality) l on l.doc_id = d.doc_id""")
def emission_defaults(t: Tables) -> DataFrame:
    one = t.labels.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    d = t.documents.join(one, "doc_id", "left")
    return d.select("doc_id", X.or_default(F.col("lang"), "Unknown").alias("writer"), X.or_default(F.col("quality"), 90).alias("bpm"), X.or_default(F.when(F.col("n_chars") % 3 == 0, F.col("source")).otherwise(""), "4/4").alias("meter"))


@query("""select doc_id, 'songs/' || lang || '/' || source || '/' || doc_id as path, 'https://video.example/watch?v=' || case when n_chars % 2 = 0 then substr(sha1(text), 1, 11) end as video from documents""")
def url_keys(t: Tables) -> DataFrame:
    video = F.concat(F.lit("https://video.example/watch?v="), F.when(F.col("n_chars") % 2 == 0, F.substring(F.sha1("text"), 1, 11)))
    return t.documents.select("doc_id", X.joined_path(F.lit("songs"), F.col("lang"), F.col("source"), F.col("doc_id").cast("string")).alias("path"), video.alias("video"))


@query("select l_orderkey, array_to_string(list_sort(list_distinct(list(l_suppkey))), ',') as suppliers from lineitem group by 1")
def distinct_lists(t: Tables) -> DataFrame:
    return rows.sorted_sets(t.lineitem, ["l_orderkey"], "l_suppkey").select("l_orderkey", F.array_join("values", ",").alias("suppliers"))


@query("select l_orderkey, l_linenumber, l_partkey from (select *, row_number() over (partition by l_orderkey order by l_quantity desc, l_linenumber, l_partkey) as r from lineitem) where r = 1")
def longest_pick(t: Tables) -> DataFrame:
    return rows.longest_per_key(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity"), ["l_orderkey"], "l_quantity", "l_linenumber", "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey")


@query(f"select doc_id, row_number() over (partition by source order by {_FIRST}, doc_id) as position from documents")
def folder_order(t: Tables) -> DataFrame:
    """Binary order of titles in each source."""
    return rows.ordered_export(t.documents, ["source"], F.split_part("text", F.lit("\n"), F.lit(1)), F.col("doc_id")).select("doc_id", "position")


@query()
def locale_export(t: Tables) -> DataFrame:
    """Titles in each source in the order that readers expect: accents and case count last."""
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return rows.ordered_export(t.documents.select("doc_id", "source", title.alias("title")), ["source"], F.collate("title", "UNICODE"), F.col("doc_id"))


@query(f"""with w as (select source, list_last(string_split(min({_FIRST}), ' ')) as wanted from documents where source is not null group by 1), few as (select *, row_number() over (partition by source order by doc_id desc) as r from documents)
    select source, wanted, first(doc_id order by r) filter (where contains(text, wanted)) as hit from w left join (select * from few where r <= 3) using (source) group by 1, 2""")
def surname_lookup(t: Tables) -> DataFrame:
    """Of each source's last three documents the first that holds the last word of its first title."""
    d = t.documents.where("source is not null")
    words = F.split(F.min(F.split_part("text", F.lit("\n"), F.lit(1))), " ")
    wanted = d.groupBy("source").agg(F.element_at(words, -1).alias("wanted"))
    found = match.contained_first(wanted, "source", "wanted", d.select("source", "text", (-F.col("doc_id")).alias("at")), "text", F.col("at"))
    return found.join(d.select("source", F.col("text").alias("hit"), "doc_id"), ["source", "hit"], "left").groupBy("source", "wanted").agg(F.max("doc_id").alias("hit"))


@query("""with l as (select s_suppkey, n_name || case when s_suppkey % 2 = 0 then ' · tr. ' || s_name else '' end as label from supplier join nation on n_nationkey = s_nationkey), c as (select n_name, count(*) as n from nation join customer on c_nationkey = n_nationkey group by 1)
    select s_suppkey, label, n from l left join c on n_name = trim(split_part(label, '·', 1))""")
def shared_lookup(t: Tables) -> DataFrame:
    label = F.concat("n_name", F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit(" · tr. "), "s_name")).otherwise(""))
    labelled = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey")).select("s_suppkey", label.alias("label"))
    counts = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))
    return match.shared_lookup(labelled, F.trim(F.split_part("label", F.lit("·"), F.lit(1))), counts, "n_name").select("s_suppkey", "label", "n")
