"""Queries on record fields, headers, stanzas and links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import records as R
from lectern.operators import rows
from lectern.plans.registry import Tables, query
from lectern.sources import landed

_FIRST = "split_part(text, chr(10), 1)"


def _title() -> Column:
    return F.split_part("text", F.lit("\n"), F.lit(1))


@query("""select event_id, case when event_id % 50 <> 0 then json_extract(props, '$.k')::bigint end as k, event_id % 50 = 0 as unreadable from events""")
def json_documents(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    return landed.json_rows(t.events.select("event_id", raw.alias("raw")), "raw", "k bigint").select("event_id", "value.k", "unreadable")


@query("""select k.key as key, count(*) as n, sum(json_extract(props, '$.' || k.key)::bigint)::bigint as total from events, lateral (select unnest(json_keys(props)) as key) k group by 1""")
def object_map(t: Tables) -> DataFrame:
    return landed.object_rows(t.events, "props", "bigint").groupBy("key").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("select c_mktsegment as segment, count(*) as n, min(c_name) as first_name from customer group by 1")
def listing_snapshot(t: Tables) -> DataFrame:
    raw = F.to_json(F.array(F.array(F.lit("name"), F.lit("segment")), F.array("c_name", "c_mktsegment")))
    cells = landed.listing_rows(t.customer.select(raw.alias("raw")), "raw").select(F.col("cells")[0].alias("name"), F.col("cells")[1].alias("segment"))
    return cells.groupBy("segment").agg(F.count("*").alias("n"), F.min("name").alias("first_name"))


_TAGGED = "replace(replace('X: 1' || chr(10) || text, ' the ', chr(10) || 'T: '), ' de ', chr(10) || 'L:')"


@query(f"""select doc_id, nullif(trim(regexp_extract({_TAGGED}, '(?m)^T:[ \t]*(.*)$', 1)), '') as title, nullif(trim(regexp_extract({_TAGGED}, '(?m)^L:[ \t]*(.*)$', 1)), '') as language,
    nullif(trim(regexp_extract({_TAGGED}, '(?m)^Q:[ \t]*(.*)$', 1)), '') as missing from documents""")
def tagged_text(t: Tables) -> DataFrame:
    raw = F.replace(F.replace(F.concat(F.lit("X: 1\n"), "text"), F.lit(" the "), F.lit("\nT: ")), F.lit(" de "), F.lit("\nL:"))
    tagged = t.documents.select("doc_id", raw.alias("raw"))
    return tagged.select("doc_id", *(R.tag_value(F.col("raw"), tag).alias(name) for tag, name in (("T", "title"), ("L", "language"), ("Q", "missing"))))


@query("""select stem, case when b is null then 'left' when a is null then 'right' else 'both' end as outcome from (select distinct p_name as stem, 1 as a from part where p_partkey % 2 = 0) l full join (select distinct p_name as stem, 1 as b from part where p_partkey % 3 = 0) r using (stem)""")
def paired_files(t: Tables) -> DataFrame:
    def stems(where: str, extension: str) -> DataFrame:
        files = t.part.where(where).select(F.concat("p_name", F.lit(extension)).alias("file"))
        return files.select(F.regexp_replace("file", r"\.[a-z]+$", "").alias("stem"))

    return rows.paired(stems("p_partkey % 2 = 0", ".abc"), stems("p_partkey % 3 = 0", ".mid"), "stem")


@query("""with c as (select c_custkey, c_custkey // 7 as page from customer) select c_custkey from c where page <= coalesce((select min(page) from (select page from c group by page having count(*) < 7)), page)""")
def paged_rows(t: Tables) -> DataFrame:
    c = t.customer.select("c_custkey", F.floor(F.col("c_custkey") / 7).alias("page"))
    return rows.until_short_page(c, "page", 7).select("c_custkey")


@query("""select doc_id, case when doc_id % 5 = 0 then 'missing' else 'stale' end as problem from documents where doc_id % 5 = 0 or (doc_id % 7 = 0 and text is not null)""")
def freshness_audit(t: Tables) -> DataFrame:
    fresh = t.documents.select("doc_id", F.sha2("text", 256).alias("rendered"))
    stored = t.documents.where("doc_id % 5 <> 0").select("doc_id", F.sha2(F.when(F.col("doc_id") % 7 == 0, F.concat("text", F.lit("\n"))).otherwise(F.col("text")), 256).alias("rendered"))
    return rows.stale_texts(stored, fresh, "doc_id", "rendered")


def _rendered(t: Tables) -> DataFrame:
    fields = {"title": _title(), "artist": F.col("source"), "time": F.lit(None).cast("string"), "key": F.lit(""), "lang": F.col("lang")}
    return t.documents.select("doc_id", "text", R.header_block(fields, F.col("text")).alias("rendered"))


@query(f"""select doc_id, concat_ws(chr(10), case when {_FIRST} <> '' then '{{title: ' || {_FIRST} || '}}' end, case when source <> '' then '{{artist: ' || source || '}}' end, case when lang <> '' then '{{lang: ' || lang || '}}' end, '', coalesce(text, '')) as rendered from documents""")
def header_render(t: Tables) -> DataFrame:
    return _rendered(t).select("doc_id", "rendered")


_RAW = f"""'{{artist: ' || source || '}}' || chr(10) || '{{' || translate({_FIRST}, 'okv', ':{{}}') || '}}' || chr(10) || '{{lang: first}}' || chr(10) || '{{odd}}' || chr(10) || '{{lang: ' || lang || '}}' || chr(10) || chr(10) || text"""
_PAIR = r"'^\{([^:}]+):([^}]*)\}$'"


def _sql_last(name: str) -> str:
    return f"(case when len(list_filter(head, lambda l: trim(regexp_extract(l, {_PAIR}, 1)) = '{name}')) > 0 then trim(regexp_extract(list_last(list_filter(head, lambda l: trim(regexp_extract(l, {_PAIR}, 1)) = '{name}')), {_PAIR}, 2)) end) as {name}"


@query(f"""with r as (select doc_id, string_split({_RAW}, chr(10)) as ls from documents where source is not null and lang is not null),
    n as (select *, coalesce(list_position(list_transform(ls, lambda l: not starts_with(l, '{{')), true), len(ls) + 1) - 1 as n from r), h as (select doc_id, list_slice(ls, 1, n) as head, list_slice(ls, n + 1, len(ls)) as rest from n)
    select doc_id, {_sql_last("artist")}, {_sql_last("lang")}, {_sql_last("odd")}, (select count(distinct trim(regexp_extract(l, {_PAIR}, 1))) from (select unnest(head) as l) where regexp_matches(l, {_PAIR}))::int as n, regexp_replace(regexp_replace(array_to_string(rest, chr(10)), '^\n', ''), '\n$', '') as body from h""")
def header_parse(t: Tables) -> DataFrame:
    lines = [F.concat(F.lit("{artist: "), "source", F.lit("}")), F.concat(F.lit("{"), F.translate(_title(), "okv", ":{}"), F.lit("}")), F.lit("{lang: first}"), F.lit("{odd}"), F.concat(F.lit("{lang: "), "lang", F.lit("}")), F.lit(""), F.col("text")]
    raw = t.documents.where("source is not null and lang is not null").select("doc_id", F.concat(*[x for line in lines for x in (F.lit("\n"), line)][1:]).alias("raw"))
    m = raw.select("doc_id", R.header_map(F.col("raw")).alias("m"), R.header_body(F.col("raw")).alias("body"))
    return m.select("doc_id", *(F.try_element_at("m", F.lit(k)).alias(k) for k in ("artist", "lang", "odd")), F.size("m").alias("n"), "body")


def _sql_edits(c: str) -> str:
    for pattern, to in R.LINE_EDITS:
        c = f"regexp_replace({c}, '{pattern}', '{to.replace('$1', chr(92) + '1')}', 'g')"
    return f"trim({c})"


@query(f"""select doc_id, {_sql_edits("'w: ' || doc_id || '. ~' || replace(replace(" + _FIRST + ", 'en ', 'en- '), ' th', '~!f!th')")} as line from documents""")
def clean_lines(t: Tables) -> DataFrame:
    noisy = F.replace(F.replace(_title(), F.lit("en "), F.lit("en- ")), F.lit(" th"), F.lit("~!f!th"))
    return t.documents.select("doc_id", R.clean_line(F.concat(F.lit("w: "), F.col("doc_id").cast("string"), F.lit(". ~"), noisy)).alias("line"))


_CREDIT = f"translate({_FIRST}, 'gbvz', '()·–') || ' (' || (1000 + doc_id) || '–' || doc_id % 10 || '?)' || ' (b. ' || (1500 + doc_id) || ')'"


@query(f"""select doc_id, trim(regexp_replace({_CREDIT}, '{R.LIFE_DATES}', '', 'g')) as name, trim(regexp_replace(split_part({_CREDIT}, '·', 1), '\\([^)]*\\)', '', 'g')) as author,
    not regexp_matches({_FIRST}, '{R.NO_PERSON}') and len(string_split({_FIRST}, ' ')) >= 2 as is_person from documents""")
def credit_names(t: Tables) -> DataFrame:
    n = F.col("doc_id")
    raw = F.concat(F.translate(_title(), "gbvz", "()·–"), F.lit(" ("), (n + 1000).cast("string"), F.lit("–"), (n % 10).cast("string"), F.lit("?) (b. "), (n + 1500).cast("string"), F.lit(")"))
    return t.documents.select("doc_id", R.without_dates(raw).alias("name"), R.first_author(raw).alias("author"), R.is_person(_title()).alias("is_person"))


_BOOKS = [*R.BOOKS_ES, "Tobit", "", "Second Kings"]
_REFERENCE = f"case when doc_id % 4 = 0 then (1 + doc_id % 3) || ' ' else '' end || {_BOOKS}[doc_id % {len(_BOOKS)} + 1] || ' ' || {_FIRST}"
_FOUND = "map {" + ", ".join(f"'{k}': '{v}'" for k, v in R.BOOKS_ES.items()) + "}[regexp_extract(r, '^([0-9]?\\s*)([A-Za-z]+)(.*)$', 2)]"


@query(f"""with d as (select doc_id, {_REFERENCE} as r from documents), b as (select *, {_FOUND} as book from d)
    select doc_id, coalesce(trim(regexp_extract(r, '^([0-9]?\\s*)([A-Za-z]+)(.*)$', 1) || book || regexp_extract(r, '^([0-9]?\\s*)([A-Za-z]+)(.*)$', 3)), r) as reference from b""")
def book_names(t: Tables) -> DataFrame:
    n = F.col("doc_id")
    book = F.get(F.array(*map(F.lit, _BOOKS)), (n % len(_BOOKS)).cast("int"))
    raw = F.concat(F.when(n % 4 == 0, F.concat((1 + n % 3).cast("string"), F.lit(" "))).otherwise(F.lit("")), book, F.lit(" "), _title())
    return t.documents.select("doc_id", R.translated_reference(raw).alias("reference"))


_TONIC = "regexp_extract(text, '^([A-Ga-g][#b]?)', 1)"
_MINOR = "regexp_matches(text, '^[A-Ga-g][#b]?\\s*([mM]([^A-Za-z]|$)|[mM][iI][nN])')"
_METER = "translate(substr(text, 3, 3), 'aehnt', '34/68')"


@query(f"""select doc_id, case when {_TONIC} = '' then 'C' when {_MINOR} then {_TONIC} || 'm' else {_TONIC} end as key, case when regexp_matches({_METER}, '^[0-9]+/[0-9]+$') then {_METER} end as meter,
    greatest(40, least(200, round(n_chars * 3 / 8.0 * 4)))::int as bpm, nullif(regexp_extract(text, '(?:^|[^0-9])((?:1[5-9]|20)[0-9]{{2}})(?:[^0-9]|$)', 1), '')::int as year from documents""")
def tune_fields(t: Tables) -> DataFrame:
    from lectern.functions import text as X

    signs = F.translate(F.substring("text", 3, 3), "aehnt", "34/68")
    return t.documents.select("doc_id", R.musical_key(F.col("text")).alias("key"), R.meter(signs).alias("meter"), X.clamped_tempo(F.col("n_chars"), F.lit(3), F.lit(8)).alias("bpm"), X.year_of(F.col("text")).alias("year"))


@query("""select c_custkey, case when n_nationkey is not null then n_name || case when c_custkey % 2 = 0 then ' translation · tr. ' else ' original · ' end || c_name || case when c_custkey % 3 = 0 then ', ' || (1800 + c_custkey % 100) else '' end end as label from customer left join nation on n_nationkey = c_nationkey and n_nationkey % 5 <> 0""")
def relation_labels(t: Tables) -> DataFrame:
    c = t.customer.join(t.nation.where("n_nationkey % 5 <> 0"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    year = F.when(F.col("c_custkey") % 3 == 0, 1800 + F.col("c_custkey") % 100)
    return c.select("c_custkey", R.relation_label(F.col("n_nationkey").isNotNull(), F.col("n_name"), F.col("c_custkey") % 2 == 0, F.col("c_name"), year).alias("label"))


@query("""with l as (select conv_id, turn, role, text, row_number() over (partition by conv_id, role order by turn) as n from conversations where role in ('user', 'assistant')),
    p as (select conv_id, case when role = 'user' then 'Verse ' || n || chr(10) || text else 'Chorus' || chr(10) || text end as part, case when role = 'user' then (case when n = 1 then 1 else n + 1 end) else 2 end as pos from l where role = 'user' or n = 1)
    select conv_id, string_agg(part, chr(10) || chr(10) order by pos) as body from p group by conv_id""")
def stanza_compose(t: Tables) -> DataFrame:
    return _composed(t)


@query("""with l as (select conv_id, role, replace(text, '. ', '.' || chr(10)) as text, row_number() over (partition by conv_id, role order by turn) as n from conversations where role in ('user', 'assistant')),
    p as (select conv_id, case when role = 'user' then 'Verse ' || n else 'Chorus' end as label, string_split(text, chr(10)) as a, case when role = 'user' then (case when n = 1 then 1 else n + 1 end) else 2 end as pos from l where role = 'user' or n = 1),
    q as (select conv_id, label, a, row_number() over (partition by conv_id order by pos) - 1 as stanza from p)
    select conv_id, stanza, label, u.i::int as line, u.s as line_text from q, lateral (select unnest(a) as s, generate_subscripts(a, 1) - 1 as i) u""")
def stanza_lines(t: Tables) -> DataFrame:
    """Every line of a composed body with its stanza's number and label: a sentence is a line."""
    body = F.replace("body", F.lit(". "), F.lit(".\n"))
    found = _composed(t).select("conv_id", F.posexplode(R.stanzas(body)).alias("stanza", "s"))
    return found.select("conv_id", "stanza", F.col("s.label").alias("label"), F.posexplode("s.lines").alias("line", "line_text"))


def _composed(t: Tables) -> DataFrame:
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    c = t.conversations.where("role in ('user', 'assistant')").groupBy("conv_id").agg(said.alias("said"))
    of = lambda role: F.transform(F.filter("said", lambda s: s["role"] == role), lambda s: s["text"])
    return c.select("conv_id", R.stanza_text(of("user"), F.try_element_at(of("assistant"), F.lit(1))).alias("body"))


_NAMES = "['" + "','".join(R.SHARPS) + "']", "['" + "','".join(R.FLATS) + "']"
_QUALITIES = ", ".join(f"({i}, {list(iv)}, '{s}')" for i, (iv, s) in enumerate(R.QUALITIES))


@query(f"""with s as (select l_orderkey, list_sort(list_distinct(list((l_partkey % 12)::int))) as pitches, arg_min((l_partkey % 12)::int, l_linenumber * 1000000000000 + l_partkey) as bass from lineitem group by 1),
    f as (select l_orderkey, bass, r.root, q.*, len(q.iv) as notes from s, lateral (select unnest(pitches) as root) r, (values {_QUALITIES}) q(ord, iv, suffix) where len(list_filter(list_transform(pitches, lambda p: (p - r.root + 12) % 12), lambda p: not list_contains(q.iv, p))) = 0),
    b as (select *, row_number() over (partition by l_orderkey order by root <> bass, notes, root, ord) as k from f)
    select s.l_orderkey, case when s.l_orderkey % 2 = 0 then {_NAMES[1]}[b.root + 1] else {_NAMES[0]}[b.root + 1] end || b.suffix as chord from s left join b on b.l_orderkey = s.l_orderkey and b.k = 1""")
def chord_names(t: Tables) -> DataFrame:
    pitch = (F.col("l_partkey") % 12).cast("int")
    slices = t.lineitem.groupBy("l_orderkey").agg(F.sort_array(F.collect_set(pitch)).alias("pitches"), F.min_by(pitch, F.struct("l_linenumber", "l_partkey")).alias("bass"))
    return slices.select("l_orderkey", R.chord_name(F.col("pitches"), F.col("bass"), F.col("l_orderkey") % 2 == 0).alias("chord"))


@query("""select l_orderkey, string_agg(case when l_linenumber % 2 = 1 then '[' || l_returnflag || ']' else '' end || l_partkey || '-' || l_linestatus, ' ' order by l_linenumber, l_partkey, l_linestatus, l_returnflag) as line from lineitem group by 1""")
def annotated_lines(t: Tables) -> DataFrame:
    chord = F.when(F.col("l_linenumber") % 2 == 1, F.col("l_returnflag"))
    parts = F.array(F.struct(chord.alias("chord"), F.concat(F.col("l_partkey").cast("string"), F.lit("-")).alias("syllable")), F.struct(F.lit(None).cast("string").alias("chord"), F.col("l_linestatus").alias("syllable")))
    ordered = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_linestatus", "l_returnflag", parts.alias("w"))))
    words = t.lineitem.groupBy("l_orderkey").agg(ordered.alias("ws")).select("l_orderkey", F.transform("ws", lambda w: w["w"]).alias("ws"))
    return words.select("l_orderkey", R.annotated_line(F.col("ws")).alias("line"))


@query("select page_id, starts_with(html, '<!DOCTYPE') as is_page from pages")
def magic_prefix(t: Tables) -> DataFrame:
    return t.pages.select("page_id", R.has_magic(F.col("html").cast("binary"), b"<!DOCTYPE").alias("is_page"))


_MAIN = r"(?is)<article>(.*?)</article>"
_BODY = r"(?is)<body>(.*)</body>"


@query(f"select page_id, coalesce(nullif(regexp_extract(html, '{_MAIN}', 1), ''), nullif(regexp_extract(html, '{_BODY}', 1), '')) as main from pages")
def main_blocks(t: Tables) -> DataFrame:
    return t.pages.select("page_id", R.main_block(F.col("html"), (_MAIN, _BODY)).alias("main"))


@query("""with l as (select page_id, regexp_extract(u.a, 'href="([^"]*)"', 1) as k, regexp_extract(u.a, '>([^<]*)</a>', 1) as v, u.i from (select page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') as l from pages), lateral (select unnest(l) as a, generate_subscripts(l, 1) as i) u),
    m as (select page_id, k, arg_min(v, i) as v from l group by 1, 2) select page_id, count(*)::int as n, max(case when k = '/the' then v end) as the from m group by 1""")
def label_maps(t: Tables) -> DataFrame:
    m = t.pages.select("page_id", R.label_map(F.col("html"), '<a href="([^"]*)">([^<]*)</a>').alias("m")).where(F.size("m") > 0)
    return m.select("page_id", F.size("m").alias("n"), F.try_element_at("m", F.lit("/the")).alias("the"))


_NOTICE = r"(?i)(©|&copy;)\s*((19|20)[0-9][0-9]|[a-z]+\.example)|copyright\s+(19|20)[0-9][0-9]"


@query(f"""select page_id, regexp_matches(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', '', 'g'), '<[^>]+>', ' ', 'g'), '{_NOTICE}') and not contains(html, 'class="ad"') as rejected, url from pages where regexp_matches(url, '^https?://[^/]+/[a-z]{{2}}/[0-9]+') and not regexp_matches(url, '/0?([?#]|$)')""")
def notice_reject(t: Tables) -> DataFrame:
    pages = t.pages.where(F.col("url").rlike("^https?://[^/]+/[a-z]{2}/[0-9]+") & ~F.col("url").rlike("/0?([?#]|$)"))
    shown = F.regexp_replace(F.regexp_replace("html", "(?is)<script.*?</script>", ""), "<[^>]+>", " ")
    return pages.select("page_id", (shown.rlike(_NOTICE) & ~F.contains("html", F.lit('class="ad"'))).alias("rejected"), "url")


@query("""select p_partkey from part where not (coalesce(case when p_size % 7 <> 0 then p_size + 1900 end, 0) > 1930 and p_type <> 'PROMO')""")
def year_cutoff(t: Tables) -> DataFrame:
    year = F.when(F.col("p_size") % 7 != 0, F.col("p_size") + 1900)
    return t.part.where(~((F.coalesce(year, F.lit(0)) > 1930) & (F.col("p_type") != "PROMO"))).select("p_partkey")


@query("select l_orderkey, l_returnflag, n, rank from (select *, row_number() over (partition by l_orderkey order by n desc, l_returnflag) as rank from (select l_orderkey, l_returnflag, count(*) as n from lineitem group by 1, 2))")
def frequency_rank(t: Tables) -> DataFrame:
    return rows.by_frequency(t.lineitem, ["l_orderkey"], "l_returnflag")


@query("""with recursive part_names as (select p_partkey, p_name || case when p_partkey % 9 = 0 then '-2' else '' end as name from part), taken as (select distinct name || '-' || (p_partkey % 4 + 2) as name from part_names where p_partkey % 5 = 0 union select distinct name from part_names where p_partkey % 31 = 0),
    used as (select name from taken union select name from part_names where regexp_matches(name, '-[1-9][0-9]*$')),
    free as (select n.name, k, row_number() over (partition by n.name order by k) as r from (select distinct name from part_names) n, range(1, (select count(*) + 20 from part)) g(k) where case when k = 1 then n.name not in (select name from taken) else n.name || '-' || k not in (select name from used) end),
    want as (select p_partkey, name, row_number() over (partition by name order by p_partkey) as r from part_names)
    select p_partkey, case when k = 1 then w.name else w.name || '-' || k end as unique_name from want w join free f on f.name = w.name and f.r = w.r""")
def free_names(t: Tables) -> DataFrame:
    named = t.part.select("p_partkey", F.concat("p_name", F.when(F.col("p_partkey") % 9 == 0, "-2").otherwise("")).alias("name"))
    taken = named.where("p_partkey % 5 = 0").select(F.concat_ws("-", "name", (F.col("p_partkey") % 4 + 2).cast("string")).alias("name")).union(named.where("p_partkey % 31 = 0").select("name"))
    return rows.free_names(named, "name", taken, F.col("p_partkey")).select("p_partkey", "unique_name")
