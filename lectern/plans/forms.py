"""Queries on second forms of operators: other text rules, other fallbacks, fatal checks, actions, ordered files and landed trees."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import audit, family, match, rows, similar
from lectern.plans import catalogue
from lectern.plans.alignment import _CANON, _canonical
from lectern.plans.catalogue import _FIRST, _ID, _KEY, _RULES, ASSETS, _title
from lectern.plans.ordered import _pointers
from lectern.plans.registry import Tables, query
from lectern.sources import export, tree

#: Pages in whose text every thirdmost common word carries what the strippers look for.
_MARKS = ((" the ", " <q>the</q>&nbsp;"), (" and ", " &rsquo;n&#8217; "), (" of ", " o­f&apos; "), (" to ", " &#039;t&#39;o&quot; "))
_MARKED = "html"
for _from, _to in _MARKS:
    _MARKED = f"replace({_MARKED}, '{_from}', '{_to}')"


def _strip_sql(c: str, quotes: bool = False, curly: bool = False) -> str:
    c = f"regexp_replace({c}, '</?q>', '\"', 'g')" if quotes else c
    c = f"replace(replace(replace(regexp_replace({c}, '<[^>]+>', '', 'g'), '­', ''), '&nbsp;', ' '), '&amp;', '&')"
    c = f"replace(regexp_replace({c}, '&#0?39;|&apos;', '''', 'g'), '&quot;', '\"')"
    c = f"regexp_replace({c}, '&#8217;|&rsquo;', '’', 'g')" if curly else c
    return f"trim(regexp_replace({c}, '[\\s\\x{{00A0}}]+', ' ', 'g'))"


@query(f"""with m as (select page_id, {_MARKED} as h from pages) select page_id, {_strip_sql("h")} as plain, {_strip_sql("h", quotes=True)} as quoted, {_strip_sql("h", curly=True)} as curly from m""")
def page_text_forms(t: Tables) -> DataFrame:
    page = F.col("html")
    for old, new in _MARKS:
        page = F.replace(page, F.lit(old), F.lit(new))
    m = t.pages.select("page_id", page.alias("h"))
    return m.select("page_id", X.stripped(F.col("h")).alias("plain"), X.stripped(F.col("h"), quotes=True).alias("quoted"), X.stripped(F.col("h"), curly=True).alias("curly"))


_QUOTED = f"translate({_FIRST}, 'vk', '''’')"


@query(f"select doc_id, regexp_replace(regexp_replace(regexp_replace(lower(strip_accents({_QUOTED})), '[''’]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from documents")
def vanishing_slugs(t: Tables) -> DataFrame:
    """Slugs in which apostrophes leave no dash; some letters of the titles are made apostrophes."""
    return t.documents.select("doc_id", X.ascii_slug(F.translate(_title(), "vk", "'’"), False).alias("slug"))


#: Letters and what stands for them: marks out of order and behind one another, Hangul by its parts, a vowel sign in two halves.
_APART = (("o", "o\u0301\u0323"), ("e", "e\u0308\u0304"), ("th", "\u1112\u1161\u11ab"), ("b", "\u0995\u09c7\u09be"), ("u", "u\u0334\u030b"))


def _apart_sql(c: str) -> str:
    for old, new in _APART:
        c = f"replace({c}, '{old}', '{new}')"
    return c


def _apart(c: Column) -> Column:
    for old, new in _APART:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


@query(f"""select doc_id, md5(nfc_normalize({_apart_sql("text")})) as composed_md5, length(nfc_normalize({_apart_sql("text")}))::bigint as n_chars,
    nfc_normalize({_apart_sql(_FIRST)}) as title from documents""")
def composed_texts(t: Tables) -> DataFrame:
    """Whole texts and titles composed, after some of their letters were taken apart."""
    text = X.composed(_apart(F.col("text")))
    return t.documents.select("doc_id", F.md5(text.cast("binary")).alias("composed_md5"), F.char_length(text).cast("long").alias("n_chars"), X.composed(_apart(_title())).alias("title"))


_OPENING = "lower(array_to_string(list_slice(string_split(text, ' '), 1, 1 + (length(text) % 3)::int), ' '))"


@query(f"""with d as (select doc_id, lower({_FIRST}) as n from documents), w as (select item_id, {_OPENING} as w from benchmark union all select 'd' || doc_id, lower({_FIRST}) from documents join labels using (doc_id))
    select item_id, min(doc_id) as doc_id from w join d on length(n) >= 10 and w <> '' and (starts_with(w, n) or starts_with(n, w)) group by 1""")
def prefix_first(t: Tables) -> DataFrame:
    """The first document whose first line is ten characters or more and opens, or is opened by, one to three words of a benchmark item or a labelled document's line."""
    words = F.array_join(F.slice(F.split("text", " "), F.lit(1), 1 + F.char_length("text") % 3), " ")
    items = t.benchmark.select("item_id", F.lower(words).alias("w"))
    lines = t.documents.join(t.labels.select("doc_id"), "doc_id").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("item_id"), F.lower(_title()).alias("w"))
    return match.prefix_first(items.select(F.col("item_id").cast("string").alias("item_id"), "w").unionByName(lines), "item_id", "w", t.documents.select("doc_id", F.lower(_title()).alias("n")), "doc_id", "n")


@query("""with v as (select event_id, user_id, ts from events where event_type = 'view'), s as (select user_id, ts, max(value) as v from events where event_type = 'purchase' group by 1, 2), b as (select distinct user_id, ts, ts as bar from events where event_type = 'signup'),
    x as (select v.*, s.v as one from v asof left join s on v.user_id = s.user_id and v.ts >= s.ts), y as (select x.*, b.bar from x asof left join b on x.user_id = b.user_id and x.ts >= b.ts),
    z as (select y.*, s.v as two from y asof left join s on y.user_id = s.user_id and y.bar >= s.ts)
    select event_id, case when one < 50 and bar is not null and bar <> ts then two else one end as held from z""")
def asof_bar_start(t: Tables) -> DataFrame:
    """A view's latest purchase; where that is small, the one that held when the user last signed up."""
    e = t.events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    slices = e.where("event_type = 'purchase'").groupBy("user_id", "at").agg(F.max("value").alias("v"))
    bars = e.where("event_type = 'signup'").select("user_id", "at").distinct()
    points = e.where("event_type = 'view'").select("event_id", "user_id", "at")
    return match.as_of_with_fallback(points, slices, bars, ["user_id"], "at", "v", "held", lambda v: v < 50).select("event_id", "held")


@query("""with f as (select l_suppkey, l_partkey, l_orderkey, l_linenumber, row_number() over (partition by l_suppkey, l_partkey order by l_orderkey, l_linenumber) as r from lineitem)
    select l_suppkey, l_partkey, l_orderkey, l_linenumber from (select *, row_number() over (partition by l_suppkey order by l_orderkey, l_linenumber) as p from f where r = 1) where p <= 10""")
def distinct_candidates(t: Tables) -> DataFrame:
    """A supplier's first ten different parts, in the order in which they were ordered."""
    found = rows.top_distinct(t.lineitem, ["l_suppkey"], "l_partkey", 10, F.col("l_orderkey"), F.col("l_linenumber"))
    return found.select("l_suppkey", "l_partkey", "l_orderkey", "l_linenumber")


@query("select o_orderkey from orders left join (select l_orderkey, max(l_shipdate) as made from lineitem group by 1) on l_orderkey = o_orderkey where made is null or made < o_orderdate + interval 60 day or o_orderpriority = '1-URGENT'")
def forced_derivatives(t: Tables) -> DataFrame:
    """Orders whose last shipment is missing or within sixty days of the order, and urgent ones in any case."""
    made = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("made"))
    due = t.orders.withColumn("due", F.col("o_orderdate") + F.expr("interval 60 days"))
    return rows.stale(due, made, "o_orderkey", "due", "made", F.col("o_orderpriority") == "1-URGENT").select("o_orderkey")


_WHOLE_LABEL = catalogue._LABELLED
_COUNTED = "Counted by line items"


@query(f"""with m as (select l_orderkey, l_returnflag as asset, min(l_suppkey) as source from lineitem group by 1, 2), s as (select * from supplier where s_suppkey % 9 <> 0),
    k as (select l_orderkey, count(*) as n, max(l_suppkey) as stated from lineitem group by 1),
    x as (select *, list_position(['R', 'A', 'N'], asset) as pos, {_WHOLE_LABEL} || ': ' || s_name || case when s_nationkey % 2 = 0 then ' — http://n' || s_nationkey else '' end || case when s_acctbal < 0 then ' (attribution required)' else '' end || chr(10) as line,
        case when s_suppkey is null then 'unknown source ' || source || ' for ' || asset end as missing from m left join s on s_suppkey = source),
    g as (select l_orderkey, string_agg(line, '' order by pos) as body, arg_min(missing, pos) filter (missing is not null) as error from x group by 1),
    o as (select o_orderkey, o_orderstatus = 'F' as public, n, body, error, case when o_orderstatus = 'F' then stated end as stated from orders left join k on k.l_orderkey = o_orderkey left join g on g.l_orderkey = o_orderkey),
    f as (select o.*, s.s_name as named, coalesce(o.error, case when stated is not null and s.s_suppkey is null then 'unknown licence source ' || stated end) as problem from o left join s on s.s_suppkey = o.stated)
    select o_orderkey, problem as error, case when problem is null then 'Order ' || o_orderkey || ' — sources & attribution' || chr(10) || chr(10) || coalesce(body, '') || case when coalesce(n > 3, false) then '{_COUNTED}' || chr(10) else '' end || chr(10)
        || case when public then 'License: Public domain.' || coalesce(' Public-domain source: ' || named || '.', '') else 'License: own terms.' end || chr(10) end as rendered from f""")
def attribution_whole(t: Tables) -> DataFrame:
    """Attribution texts with the count line of orders of over three items, and with the source that says that an order is free."""
    of = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.min("l_suppkey").alias("source"))
    held = of.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "source"))).alias("sources"))
    counts = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.max("l_suppkey").alias("stated"))
    orders = t.orders.select("o_orderkey", F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"), (F.col("o_orderstatus") == "F").alias("public"))
    orders = orders.join(held, "o_orderkey", "left").join(counts, "o_orderkey", "left")
    url = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("http://n"), F.col("s_nationkey").cast("string")))
    registry = t.supplier.where("s_suppkey % 9 <> 0").select("s_suppkey", "s_name", url.alias("url"), (F.col("s_acctbal") < 0).alias("required"))
    return match.attributions(orders, "o_orderkey", "title", "sources", "public", registry, "s_suppkey", "s_name", "url", "required", ASSETS, counted=F.col("n") > 3, count_line=_COUNTED, licence_source=F.col("stated"))


@query("""with s as (select doc_id, case when l.doc_id is not null then text || chr(10) || chr(10) || source || chr(10) || chr(10) || source else text end as body, case when l.doc_id is not null then source end as added from documents d left join labels l using (doc_id))
    select doc_id, sha256(case when added is not null and strpos(body, chr(10) || chr(10) || added) > 0 then substr(body, 1, strpos(body, chr(10) || chr(10) || added) - 1) || substr(body, strpos(body, chr(10) || chr(10) || added) + 2 + length(added)) else body end) as base from s""")
def strip_appended(t: Tables) -> DataFrame:
    """Labelled texts to which an earlier run has appended their source, twice even, lose the first of it."""
    s = t.documents.select("doc_id", "text", "source").join(t.labels.select("doc_id", F.lit(True).alias("there")), "doc_id", "left")
    added = F.when(F.col("there"), F.col("source"))
    tail = F.concat(F.lit("\n\n"), "source")
    body = F.when(F.col("there"), F.concat("text", tail, tail)).otherwise(F.col("text"))
    return s.select("doc_id", F.sha2(X.without_suffix(body, added), 256).alias("base"))


_YEARS = "nullif(regexp_extract({0}, '(?:^|[^0-9A-Za-z_])(1[0-9]{{3}}|20[0-2][0-9])(?:[^0-9A-Za-z_]|$)', 1), '')"


@query(f"""select o_orderkey, coalesce({_YEARS.format("o_comment_")}, {_YEARS.format("words")})::int as year from (select o_orderkey, 'Order no. ' || o_orderkey || ', of ' || o_orderdate as words, case when o_orderkey % 3 = 0 then 'Customer ' || o_custkey || ';' else '' end as o_comment_ from orders)""")
def year_fallback(t: Tables) -> DataFrame:
    """A year named in one line, else in another: numbers from 1000 to 2029 that stand alone."""
    words = F.concat(F.lit("Order no. "), F.col("o_orderkey").cast("string"), F.lit(", of "), F.col("o_orderdate").cast("date").cast("string"))
    first = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"), F.lit(";"))).otherwise("")
    return t.orders.select("o_orderkey", X.first_year(first, words).alias("year"))


@query(f"""with n as (select doc_id, text, trim(regexp_replace(split_part({_FIRST}, '·', 1), '\\(.*?\\)', '', 'g')) as name from documents)
    select doc_id, not regexp_matches(name, '{X._NOBODY}') and len(string_split(name, ' ')) >= 2 as person, regexp_matches(text, '{X.PERSONISH}') as trade, regexp_matches(text, '{X.FREE_LICENCE}') as free from n""")
def person_tests(t: Tables) -> DataFrame:
    """Whether a first line may be a person's name, and whether the text tells of the trade or of a free licence."""
    name = X.bare_name(_title())
    return t.documents.select("doc_id", X.is_person(name).alias("person"), F.col("text").rlike(X.PERSONISH).alias("trade"), F.col("text").rlike(X.FREE_LICENCE).alias("free"))


@query(f"select p_partkey, {_ID.format('p_name')} as suggestion from part where p_size % 5 = 0")
def suggested_ids(t: Tables) -> DataFrame:
    """Parts of some sizes count as records without id."""
    records = t.part.select("p_partkey", F.when(F.col("p_size") % 5 != 0, F.col("p_partkey")).alias("id"), "p_name")
    return audit.suggested_ids(records, "p_partkey", "id", X.stable_id(F.col("p_name"), "song:"))


@query(f"select count(*) filter (severity = 'E') as errors, count(*) filter (severity = 'W') as warnings, count(*) filter (severity = 'E') > 0 as failed from ({_RULES})")
def run_verdict(t: Tables) -> DataFrame:
    return audit.verdict(catalogue._violations(t))


@query(f"select c_custkey, {_ID.format('c_name')} as id, c_nationkey from customer")
def checked_build(t: Tables) -> DataFrame:
    """Customers as records whose build fails at a missing or repeated id, or at a nation that isn't there."""
    records = t.customer.select("c_custkey", X.stable_id(F.col("c_name"), "song:").alias("id"), "c_nationkey")
    return audit.fatal(records, "c_custkey", "id", {"c_nationkey": (t.nation, "n_nationkey")})


@query("select o_orderkey, case when c_custkey is not null then 'writers/' || lower(replace(c_name, '#', '-')) || '/portrait.jpg' end as portrait, c_mktsegment as bio from orders left join (select * from customer where c_custkey % 50 <> 0) on c_custkey = o_custkey")
def writer_columns(t: Tables) -> DataFrame:
    """Orders with the portrait path and the text of their customer as a writer; null where there is none."""
    writers = t.customer.where("c_custkey % 50 <> 0").select("c_custkey", X.slug(F.col("c_name")).alias("slug"), F.col("c_mktsegment").alias("bio"))
    found = t.orders.join(writers, F.col("o_custkey") == F.col("c_custkey"), "left")
    return found.select("o_orderkey", X.joined_path(F.lit("writers"), F.col("slug"), F.lit("portrait.jpg")).alias("portrait"), "bio")


_STATE = """s as (select o_orderkey as k, case when o_custkey % 11 = 0 then 'w' || o_orderkey end as work, o_orderstatus as label, o_orderpriority as asset from orders)"""


@query(f"""{_CANON}, {_STATE}, parents as (select k, p.parent from p), m as (select s.*, parents.parent, r.root, c.canonical from s join r using (k) join c using (root) left join parents using (k)),
    a as (select root, arg_min(work, k) filter (work is not null) as known, bool_or(work is null) as open, max(case when k = canonical then asset end) as canon from m group by 1),
    open_ as (select m.*, a.known, coalesce(a.known, 'f' || m.canonical) as new, a.canon, h.asset as held from m join a on a.root = m.root and a.open left join (select work, asset from s where work is not null) h on h.work = coalesce(a.known, 'f' || m.canonical)),
    x as (select *, known is null as created, case when known is null then canon else held end as theirs, case when k <> canonical then label || ' translation' end as relabelled from open_)
    select k as o_orderkey, 'create' as action, new as value from x where created and k = canonical
    union all select k, 'promote', asset from x where created and k = canonical and asset is not null
    union all select k, 'remove', asset from x where not (created and k = canonical and asset is not null) and asset = theirs
    union all select k, 'set work', new from x where work is null
    union all select k, 'clear parent', null from x where work is null and parent is not null
    union all select k, 'relabel', relabelled from x where work is null and canonical <> root and k in (canonical, root) and label is distinct from relabelled""")
def family_actions(t: Tables) -> DataFrame:
    """What makes works of the families of orders: names, promoted and redundant assets, cleared parents, new labels."""
    state, assets, rooted, canonical = family_state(t)
    return family.actions(state, assets, rooted, canonical, "o_orderkey", F.concat(F.lit("f"), F.col("canonical").cast("string")), F.concat("label", F.lit(" translation")))


def family_state(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Orders as records with work, parent, label and asset; the works that exist, with theirs; families."""
    rooted, canonical = _canonical(t)
    work = F.when(F.col("o_custkey") % 11 == 0, F.concat(F.lit("w"), F.col("o_orderkey").cast("string")))
    state = t.orders.select("o_orderkey", work.alias("work"), F.col("o_orderstatus").alias("label"), F.col("o_orderpriority").alias("asset")).join(_pointers(t), "o_orderkey", "left")
    assets = state.where("work is not null").select("work", "asset")
    return state, assets, rooted, canonical


@query("select (row_number() over (order by p_name, p_partkey))::bigint as position, p_name, p_partkey from part")
def ordered_files(t: Tables) -> DataFrame:
    """Parts exported as files that follow one another by name; their places when the files are read again in order."""
    path = export.folder(t.spark, f"parts-{uuid.uuid4().hex}")
    export.write_ordered(t.part.select("p_name", "p_partkey"), path, F.col("p_name"), F.col("p_partkey"))
    return export.read_ordered(t.spark, path).select("position", "p_name", "p_partkey")


@query("select n_name as language, case when s_acctbal < 0 then 'submitted' else 'public-domain' end as section, s_name as folder, s_name || ' of ' || n_name as text from supplier join nation on n_nationkey = s_nationkey where n_nationkey % 5 < 2")
def landed_tree(t: Tables) -> DataFrame:
    """Suppliers landed as a tree of folders, language by section, of which the languages of some nations are read."""
    path = export.folder(t.spark, f"tree-{uuid.uuid4().hex}")
    some = t.supplier.join(t.nation, F.col("n_nationkey") == F.col("s_nationkey"))
    section = F.when(F.col("s_acctbal") < 0, "submitted").otherwise("public-domain")
    landed = some.select(F.col("n_name").alias("language"), section.alias("section"), F.col("s_name").alias("folder"), F.concat_ws(" of ", "s_name", "n_name").alias("text"))
    tree.write_tree(landed, path, "record.txt")
    wanted = [r["n_name"] for r in t.nation.where("n_nationkey % 5 < 2").select("n_name").collect()]
    read = tree.read_tree(t.spark, path, "record.txt", ["public-domain", "submitted"])
    return read.where(F.col("language").isin(wanted)).select("language", "section", "folder", "text")


_NAME = "trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1))"
_FILE = f"translate(replace({_NAME}, ' ', '_'), 'odl', 'ut') || '-' || page_id"


@query(f"""with recursive d as (select page_id as id, {_KEY.format(_NAME)} as a, {_KEY.format(f"replace(split_part({_FILE}, '-', 1), '_', ' ')")} as b from pages),
    open as (select id, a, b from d where a <> b and 2.0::double * least(length(a), length(b)) / (length(a) + length(b)) >= 0.85), {similar.ratio_sql("open", "id", "a", "b")}
    select d.id as page_id, coalesce(a = b or ratio >= 0.85, false) as titled from d left join likeness using (id)""")
def title_identity(t: Tables) -> DataFrame:
    """Whether a page's title is what its file is named for, up to the number, but for a few letters; the names are misspelt titles."""
    title = X.page_title(F.col("html"))
    file = F.concat(F.translate(F.replace(title, F.lit(" "), F.lit("_")), "odl", "ut"), F.lit("-"), F.col("page_id").cast("string"))
    named = F.replace(F.split_part(file, F.lit("-"), F.lit(1)), F.lit("_"), F.lit(" "))
    return similar.titles_agree(t.pages.select("page_id", X.key_ascii(title).alias("a"), X.key_ascii(named).alias("b")), "a", "b").select("page_id", "titled")
