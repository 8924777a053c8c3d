"""Queries on documents, pages and dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import records as R
from lectern.functions import text as X
from lectern.operators import match, rows
from lectern.plans.registry import Tables, query

_FIRST = "split_part(text, chr(10), 1)"
_ID = "substr(translate(to_base64(unhex(sha1('song:' || {0}))), '+/', '-_'), 1, 11)"
_SLUG = r"regexp_replace(regexp_replace(regexp_replace(lower(nfc_normalize({0})), '[''’ʼ]', '', 'g'), '[^\p{{L}}\p{{M}}\p{{N}}]+', '-', 'g'), '^-+|-+$', '', 'g')"
_FAMILY = "(select source, min(quality) as quality, max(toxic) as toxic from documents join labels using (doc_id) group by source)"


def _title() -> Column:
    return F.split_part("text", F.lit("\n"), F.lit(1))


def _family(t: Tables) -> DataFrame:
    return t.documents.join(t.labels, "doc_id").groupBy("source").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))


@query(f"""select d.doc_id, {_ID.format(_FIRST)} as id, coalesce(nullif({_SLUG.format(_FIRST)}, ''), 'untitled') as slug, d.lang as language, 'approved' as status, true as certified,
    case when l.doc_id is not null then l.quality else f.quality end as quality, case when l.doc_id is not null then l.toxic else f.toxic end as toxic,
    case when l.doc_id is not null then 'own' when f.source is not null then 'family' end as side
    from documents d left join labels l using (doc_id) left join {_FAMILY} f on f.source = d.source""")
def catalog_build(t: Tables) -> DataFrame:
    # Id and slug come first, so that no text goes through the joins.
    named = t.documents.select("doc_id", "source", F.col("lang").alias("language"), X.stable_id(_title(), "song:").alias("id"), X.slug(_title()).alias("slug"))
    d = rows.inherit(named, t.labels, _family(t), "doc_id", "source", ["quality", "toxic"])
    return d.select("doc_id", "id", "slug", "language", F.lit("approved").alias("status"), F.lit(True).alias("certified"), "quality", "toxic", "side")


@query(f"select p_partkey, {_ID.format('p_name')} as id from part")
def stable_ids(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", X.stable_id(F.col("p_name"), "song:").alias("id"))


@query(f"""select doc_id, coalesce(nullif({_SLUG.format(_FIRST)}, ''), 'untitled') as slug,
    regexp_replace(regexp_replace(lower(strip_accents({_FIRST})), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as ascii_slug from documents""")
def slugs(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.slug(_title()).alias("slug"), X.ascii_slug(_title(), True).alias("ascii_slug"))


_KEY = "trim(regexp_replace(regexp_replace(lower({0}), '[''’,!().\"]', '', 'g'), '[^a-z0-9]+', ' ', 'g'))"


@query(f"""select doc_id, {_KEY.format(_FIRST)} as ascii, {_KEY.format(f"strip_accents({_FIRST})")} as folded,
    trim(regexp_replace(lower(strip_accents({_FIRST})), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', ' ', 'g')) as unicode,
    {_KEY.format(f"regexp_replace({_FIRST}, '&#?[0-9A-Za-z_]+;', ' ', 'g')")} as entity, regexp_replace(lower({_FIRST}), '[^a-z0-9]', '', 'g') as word from documents""")
def norm_keys(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.key_ascii(_title()).alias("ascii"), X.key_folded(_title()).alias("folded"), X.key_unicode(_title()).alias("unicode"), X.key_without_entities(_title()).alias("entity"), X.word_key(_title()).alias("word"))


@query("select doc_id, split_part(text, chr(10), 1) as header, case when strpos(text, chr(10)) > 0 then substr(text, strpos(text, chr(10)) + 1) else '' end as body from documents")
def header_split(t: Tables) -> DataFrame:
    at = F.instr("text", "\n")
    return t.documents.select("doc_id", _title().alias("header"), F.when(at > 0, F.col("text").substr(at + 1, F.char_length("text"))).otherwise("").alias("body"))


@query("""select doc_id, (u.i - 1)::int as line, u.s as line_text from (select doc_id, string_split(text, chr(10)) as a from documents), lateral (select unnest(a) as s, generate_subscripts(a, 1) as i) u where trim(u.s) <> ''""")
def stanza_explode(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "line_text")).where(F.trim("line_text") != "")


#: First lines in which some letters are marks, so that parsers meet them in every place.
_MARKED = "translate(split_part(text, chr(10), 1), '{0}', '{1}')"


def _marked(letters: str, marks: str) -> Column:
    return F.translate(_title(), letters, marks)


@query(f"""select doc_id, array_to_string(list_transform(list_filter(list_transform(string_split({_MARKED.format("ovgb", ";(),")}, ';'), lambda n: trim(regexp_replace(n, '\\s*\\([^)]*\\)', '', 'g'))),
    lambda n: lower(n) not in ('', 'none', 'unknown', 'anonymous', 'traditional')), lambda n: regexp_replace(n, '^([^,]+),\\s*(.+)$', '\\2 \\1')), ' & ') as names from documents""")
def name_parse(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.person_list(_marked("ovgb", ";(),")).alias("names"))


@query(f"""select doc_id, regexp_replace({_FIRST} || ', ' || regexp_extract({_FIRST}, '^(?:The|A|An|[^ ]*)', 0), '^(.+), (The|A|An)$', '\\2 \\1') as title from documents""")
def article_uninvert(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.uninverted(F.concat(_title(), F.lit(", "), F.regexp_extract(_title(), "^(?:The|A|An|[^ ]*)", 0))).alias("title"))


@query(f"""select doc_id, array_to_string(list_slice(list_filter(list_transform(regexp_extract_all({_MARKED.format("oavgbc", "{},()[")}, '\\{{([^}}]*)\\}}', 1), lambda x: trim(regexp_replace(x, '\\([^)]*\\)|\\[[^\\]]*\\]', '', 'g'))),
    lambda x: x <> '' and not contains(x, ',')), 1, 3), ',') as topics from documents""")
def topic_list(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.topics(_marked("oavgbc", "{},()[")).alias("topics"))


@query("""select s_suppkey, case when s_suppkey % 3 = 0 then 'Unknown' when s_suppkey % 3 = 1 then s_name else s_name || ' · tr. N' || s_nationkey end as label from supplier""")
def credit_label(t: Tables) -> DataFrame:
    third = F.col("s_suppkey") % 3
    return t.supplier.select("s_suppkey", X.credit(F.when(third > 0, F.col("s_name")), F.when(third == 2, F.concat(F.lit("N"), F.col("s_nationkey").cast("string")))).alias("label"))


_VISIBLE = "regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script>|<style\\b.*?</style>', ' ', 'g'), '<[^>]*>', ' ', 'g')"
_DECODED = _VISIBLE
for _entity, _plain in X._ENTITIES:
    _DECODED = f"replace({_DECODED}, '{_entity}', '{_plain.replace(chr(39), chr(39) * 2)}')"


@query(f"select page_id, trim(regexp_replace({_DECODED}, '[\\s\\x{{00A0}}]+', ' ', 'g')) as visible from pages")
def tag_strip(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.visible(F.col("html")).alias("visible"))


@query("select page_id, trim(regexp_extract(html, '(?is)<title>(.*?)</title>', 1)) as title from pages")
def page_titles(t: Tables) -> DataFrame:
    return t.pages.select("page_id", X.page_title(F.col("html")).alias("title"))


@query("""select page_id, u.i::int as position, regexp_extract(u.a, 'href="([^"]*)"', 1) as href, regexp_extract(u.a, '>([^<]*)</a>', 1) as label
    from (select page_id, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') as l from pages), lateral (select unnest(l) as a, generate_subscripts(l, 1) - 1 as i) u""")
def page_links(t: Tables) -> DataFrame:
    found = F.regexp_extract_all("html", F.lit('<a href="[^"]*">[^<]*</a>'), 0)
    links = t.pages.select("page_id", F.posexplode(found).alias("position", "a"))
    return links.select("page_id", "position", F.regexp_extract("a", 'href="([^"]*)"', 1).alias("href"), F.regexp_extract("a", ">([^<]*)</a>", 1).alias("label"))


@query("""select page_id, u.i::int as position, regexp_extract(u.a, '(?s)<p>(.*)</p>', 1) as paragraph from (select page_id, regexp_extract_all(html, '(?s)<p>[^<]*</p>') as l from pages), lateral (select unnest(l) as a, generate_subscripts(l, 1) - 1 as i) u""")
def page_paragraphs(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit("(?s)<p>([^<]*)</p>"), 1)).alias("position", "paragraph"))


# What a notice of rights looks like.
NOTICE = r"(?i)(©|&copy;)\s*((19|20)[0-9][0-9]|[a-z]+\.example)|copyright\s+(19|20)[0-9][0-9]"
_SHOWN = "regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', '', 'g'), '<[^>]+>', ' ', 'g')"
_YEAR = f"regexp_extract({_SHOWN}, '(?:^|[^0-9])((?:1[5-9]|20)[0-9]{{2}})(?:[^0-9]|$)', 1)"
_OUTCOME = f"""case when regexp_extract(html, '(?is)<article>(.*?)</article>', 1) = '' then 'no content' when regexp_matches({_SHOWN}, '{NOTICE}') then 'notice'
    when {_YEAR} <> '' and {_YEAR} > '1930' then 'year' when not regexp_matches(html, '(?is)<p>.*?<p>') then 'one paragraph' else 'accepted' end"""


def _outcome() -> Column:
    page = F.col("html")
    shown = F.regexp_replace(F.regexp_replace(page, "(?is)<script.*?</script>", ""), "<[^>]+>", " ")
    return R.first_failing(
        ("no content", R.main_block(page, (r"(?is)<article>(.*?)</article>",)).isNull()), ("notice", shown.rlike(NOTICE)),
        ("year", X.year_of(shown) > 1930), ("one paragraph", ~page.rlike("(?is)<p>.*?<p>")),
    )


@query(f"select page_id, {_OUTCOME} as outcome from pages")
def reject_outcome(t: Tables) -> DataFrame:
    return t.pages.select("page_id", _outcome().alias("outcome"))


@query(f"select coalesce(outcome, 'total') as outcome, count(*) as n from (select {_OUTCOME} as outcome from pages) group by rollup (outcome)")
def outcome_counts(t: Tables) -> DataFrame:
    counted = t.pages.select(_outcome().alias("outcome")).rollup("outcome").agg(F.count("*").alias("n"))
    return counted.select(F.coalesce("outcome", F.lit("total")).alias("outcome"), "n")


_LICENCE = "(?i)licen[sc]ed under (the )?(apache|mit|cc|gnu)"


@query(f"select doc_id, regexp_extract(text, '{_LICENCE}', 0) as notice from documents where regexp_matches(text, '{_LICENCE}')")
def licence_filter(t: Tables) -> DataFrame:
    return t.documents.where(F.col("text").rlike(_LICENCE)).select("doc_id", F.regexp_extract("text", _LICENCE, 0).alias("notice"))


_EVIDENCE = "[áéíóúñÁÉÍÓÚÑ]|(^|[^A-Za-z])([Ee]l|[Ll]os|[Ll]as|[Dd]el|[Qq]ue)($|[^A-Za-z])"


@query(f"select doc_id, regexp_matches(text, '{_EVIDENCE}') as evidence from documents")
def lang_evidence(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.col("text").rlike(_EVIDENCE).alias("evidence"))


@query(f"""select d.doc_id, case when l.doc_id is not null then l.quality else f.quality end as quality, case when l.doc_id is not null then l.toxic else f.toxic end as toxic,
    case when l.doc_id is not null then 'own' when f.source is not null then 'family' end as side from documents d left join labels l using (doc_id) left join {_FAMILY} f on f.source = d.source""")
def override_inherit(t: Tables) -> DataFrame:
    return rows.inherit(t.documents.select("doc_id", "source"), t.labels, _family(t), "doc_id", "source", ["quality", "toxic"]).select("doc_id", "quality", "toxic", "side")


@query("""with m as (select l_orderkey, l_returnflag as asset, min(l_suppkey) as source from lineitem group by 1, 2)
    select l_orderkey, string_agg(asset || ': ' || coalesce(s_name, '?' || source), '; ' order by list_position(['R', 'A', 'N'], asset)) as sources from m left join supplier on s_suppkey = source and s_suppkey % 9 <> 0 group by 1""")
def registry_map_join(t: Tables) -> DataFrame:
    """A map of assets to source keys, resolved in a registry that lacks some, put together again in fixed order."""
    of = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.min("l_suppkey").alias("source"))
    held = of.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "source"))).alias("sources"))
    known = t.supplier.where("s_suppkey % 9 <> 0")
    return match.registry_names(held, "l_orderkey", "sources", known, "s_suppkey", "s_name", ["R", "A", "N"])


@query("""select n_nationkey, 'Attribution' || chr(10) || coalesce(string_agg('- ' || s_name, chr(10) order by s_suppkey), '- none') as rendered from nation left join supplier on s_nationkey = n_nationkey group by n_nationkey""")
def attribution_render(t: Tables) -> DataFrame:
    lines = t.supplier.groupBy("s_nationkey").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("s_suppkey", "s_name"))), lambda s: F.concat(F.lit("- "), s["s_name"])), "\n").alias("lines"))
    out = t.nation.join(lines, F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return out.select("n_nationkey", F.concat(F.lit("Attribution\n"), F.coalesce("lines", F.lit("- none"))).alias("rendered"))


@query("""with keys as (select p_name as name, min(p_partkey) as key from part where p_partkey % 3 = 0 group by 1)
    select p.p_partkey, coalesce(a.key, b.key, c.key) as hit from part p left join keys a on a.name = p.p_name left join keys b on b.name = split_part(p.p_name, ' ', 2) || ' ' || split_part(p.p_name, ' ', 1) left join keys c on c.name = split_part(p.p_name, ' ', 1) || ' ' || split_part(p.p_name, ' ', 1)""")
def variant_key_match(t: Tables) -> DataFrame:
    keys = rows.first_per_key(t.part.where("p_partkey % 3 = 0").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("key")), ["name"], F.col("key"))
    one, two = F.split_part("p_name", F.lit(" "), F.lit(1)), F.split_part("p_name", F.lit(" "), F.lit(2))
    found = match.variant_join(t.part, [F.col("p_name"), F.concat_ws(" ", two, one), F.concat_ws(" ", one, one)], keys, "name")
    return found.select("p_partkey", F.col("hit_key").alias("hit"))


@query("""select segment, min(p_partkey) as p_partkey from (select p_partkey, unnest(string_split(p_name, ' ')) as segment from part) where segment <> '' group by segment""")
def segment_index(t: Tables) -> DataFrame:
    return match.segment_index(t.part, "p_partkey", "p_name", " ")


@query(f"""select l.doc_id as item_id, d.doc_id from (select doc_id, lower({_FIRST}) as w from documents join labels using (doc_id)) l join (select doc_id, lower({_FIRST}) as n from documents) d
    on (case when length(l.w) >= 8 then d.n <> '' and (starts_with(l.w, d.n) or starts_with(d.n, l.w)) else l.w <> '' and l.w = d.n end)""")
def prefix_match(t: Tables) -> DataFrame:
    # Titles come first, so that no text goes through the joins.
    titled = t.documents.select("doc_id", F.lower(_title()).alias("n"))
    wanted = titled.join(t.labels.select("doc_id"), "doc_id").select(F.col("doc_id").alias("item_id"), F.col("n").alias("w"))
    return match.prefix_join(wanted, "w", titled, "n").select("item_id", "doc_id")


@query(f"""with b as (select item_id, list_distinct(string_split({_KEY.format("split_part(text, '.', 1)")}, ' ')) as t from benchmark), d as (select doc_id, list_distinct(string_split({_KEY.format("split_part(text, '.', 1)")}, ' ')) as t from documents),
    s as (select item_id, doc_id, len(list_intersect(b.t, d.t))::double / greatest(len(b.t), len(d.t)) as score from b, d)
    select item_id, doc_id, round(score, 6) as score from (select *, row_number() over (partition by item_id order by score desc, doc_id) as r from s where score > 0) where r = 1 and score >= 0.5""")
def token_overlap(t: Tables) -> DataFrame:
    def first(df: DataFrame, key: str) -> DataFrame:
        return df.select(key, X.key_ascii(F.split_part("text", F.lit("."), F.lit(1))).alias("line"))

    found = match.token_overlap(first(t.benchmark, "item_id"), "item_id", "line", first(t.documents, "doc_id").withColumnRenamed("line", "doc_line"), "doc_id", "doc_line")
    return found.select("item_id", "doc_id", F.round("score", 6).alias("score"))


@query("""select n.n_nationkey, min(s.s_suppkey) as s_suppkey from nation n join supplier s on len(list_filter(string_split(lower(n.n_name), '_'), lambda w: contains(lower(s.s_name), w) or length(w) < 3)) >= ceil(0.5 * len(string_split(n.n_name, '_'))) group by 1""")
def containment_match(t: Tables) -> DataFrame:
    """Half of a nation's words, where those of under three letters count as found."""
    words = F.split(F.lower("n_name"), "_")
    long = F.filter(words, lambda w: F.length(w) >= 3)
    need = F.ceil(F.lit(0.5) * F.size(words)) - (F.size(words) - F.size("long"))
    wanted = t.nation.select("n_nationkey", "n_name", long.alias("long"))
    return match.contained_words(wanted, "n_nationkey", "long", t.supplier.select("s_suppkey", F.lower("s_name").alias("s")), "s_suppkey", "s", need=need)


# Words of titles that tell nothing.
_STOP = "a an the of in to and is o oh for my thy with".split()
_STOP_SQL = ", ".join(f"'{w}'" for w in ("", *_STOP))
_ENTITY_KEY = _KEY.format("regexp_replace({0}, '&#?[0-9A-Za-z_]+;', ' ', 'g')")


@query(f"""with b as (select item_id, list_filter(string_split({_ENTITY_KEY.format("split_part(text, '.', 1)")}, ' '), lambda w: w not in ({_STOP_SQL})) as w from benchmark), d as (select doc_id, {_ENTITY_KEY.format("text")} as t from documents)
    select item_id, min(doc_id) as doc_id from b join d on 100 * len(list_filter(b.w, lambda w: contains(d.t, w))) >= 80 * len(b.w) group by 1""")
def title_containment(t: Tables) -> DataFrame:
    """The first document that contains four fifths of the words of a benchmark item's first sentence, stop words aside."""
    words = F.split(X.key_without_entities(F.split_part("text", F.lit("."), F.lit(1))), " ")
    wanted = t.benchmark.select("item_id", F.filter(words, lambda w: ~w.isin("", *_STOP)).alias("words"))
    return match.contained_words(wanted, "item_id", "words", t.documents.select("doc_id", X.key_without_entities(F.col("text")).alias("t")), "doc_id", "t")


@query("""select f.p_name, f.file, w.wanted from (select p_name, min(p_partkey) as file from part where p_size > 25 group by 1) f join (select p_name, min(p_partkey) as wanted from part where p_size <= 25 group by 1) w using (p_name)""")
def consume_match(t: Tables) -> DataFrame:
    files = t.part.where("p_size > 25").select("p_name", F.col("p_partkey").alias("file"))
    wanted = t.part.where("p_size <= 25").select("p_name", F.col("p_partkey").alias("wanted"))
    return match.consuming_match(wanted, "wanted", files, "file", "p_name")


@query("select p_partkey, p_brand || ' ' || p_name as title from part where p_size > 25 and p_brand || ' ' || p_name not in (select p_brand || ' ' || p_name from part where p_size <= 25)")
def consume_leftovers(t: Tables) -> DataFrame:
    """Parts over 25 in size are files, the others are wanted; both go by brand and name."""
    titled = t.part.select("p_partkey", "p_size", F.concat_ws(" ", "p_brand", "p_name").alias("title"))
    return match.leftovers(titled.where("p_size <= 25"), titled.where("p_size > 25"), "title").select("p_partkey", "title")


# What the lines of an attribution text are called, in their order.
ASSETS = {"R": "Text", "A": "Tune", "N": "Engraving source"}
_LABELLED = "case asset when 'R' then 'Text' when 'A' then 'Tune' else 'Engraving source' end"


@query(f"""with m as (select l_orderkey, l_returnflag as asset, min(l_suppkey) as source from lineitem group by 1, 2), s as (select * from supplier where s_suppkey % 9 <> 0),
    x as (select *, list_position(['R', 'A', 'N'], asset) as pos, {_LABELLED} || ': ' || s_name || case when s_nationkey % 2 = 0 then ' — http://n' || s_nationkey else '' end || case when s_acctbal < 0 then ' (attribution required)' else '' end || chr(10) as line,
        case when s_suppkey is null then 'unknown source ' || source || ' for ' || asset end as missing from m left join s on s_suppkey = source),
    g as (select l_orderkey, string_agg(line, '' order by pos) as body, arg_min(missing, pos) filter (missing is not null) as error from x group by 1)
    select o_orderkey, error, case when error is null then 'Order ' || o_orderkey || ' — sources & attribution' || chr(10) || chr(10) || coalesce(body, '') || chr(10) || case when o_orderstatus = 'F' then 'License: Public domain.' else 'License: own terms.' end || chr(10) end as rendered
    from orders left join g on l_orderkey = o_orderkey""")
def attribution_text(t: Tables) -> DataFrame:
    """The text of each order's sources (its line items' suppliers by flag), or the first source that the registry lacks."""
    of = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.min("l_suppkey").alias("source"))
    held = of.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "source"))).alias("sources"))
    orders = t.orders.select("o_orderkey", F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"), (F.col("o_orderstatus") == "F").alias("public")).join(held, "o_orderkey", "left")
    url = F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("http://n"), F.col("s_nationkey").cast("string")))
    registry = t.supplier.where("s_suppkey % 9 <> 0").select("s_suppkey", "s_name", url.alias("url"), (F.col("s_acctbal") < 0).alias("required"))
    return match.attributions(orders, "o_orderkey", "title", "sources", "public", registry, "s_suppkey", "s_name", "url", "required", ASSETS)


@query("select min(doc_id) as first_id, count(*) as n, sha256(text) as digest from documents group by sha256(text) having count(*) > 1")
def content_duplicates(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.sha2("text", 256).alias("digest")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").select("first_id", "n", "digest")


@query("select p_name, p_partkey, p_size from (select *, row_number() over (partition by p_name order by p_partkey) r from part) where r = 1")
def first_wins(t: Tables) -> DataFrame:
    return rows.first_per_key(t.part, ["p_name"], F.col("p_partkey")).select("p_name", "p_partkey", "p_size")


@query("select p_name, p_partkey, p_size from (select *, row_number() over (partition by p_name order by p_partkey desc) r from part) where r = 1")
def last_wins(t: Tables) -> DataFrame:
    return rows.first_per_key(t.part, ["p_name"], F.col("p_partkey").desc()).select("p_name", "p_partkey", "p_size")


@query("select digest, doc_id, source from (select sha256(text) as digest, doc_id, source, row_number() over (partition by sha256(text) order by source desc, doc_id) r from documents) where r = 1")
def source_priority(t: Tables) -> DataFrame:
    d = t.documents.select(F.sha2("text", 256).alias("digest"), "doc_id", "source")
    return rows.first_per_key(d, ["digest"], F.col("source").desc(), F.col("doc_id"))


@query("select p_partkey, case when r = 1 then p_name else p_name || '-' || r end as unique_name from (select *, row_number() over (partition by p_name order by p_partkey) r from part)")
def slug_suffix(t: Tables) -> DataFrame:
    return rows.suffixed(t.part, "p_name", F.col("p_partkey")).select("p_partkey", "unique_name")


@query("select p_brand, p_partkey from (select *, row_number() over (partition by p_brand, lower(p_name) order by p_partkey) r from part) where r > 1")
def case_collision(t: Tables) -> DataFrame:
    return rows.case_collisions(t.part, ["p_brand"], "p_name", F.col("p_partkey")).select("p_brand", "p_partkey")


@query("select o_custkey, o_orderkey from (select *, row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) r from orders) where r <= 10")
def top_candidates(t: Tables) -> DataFrame:
    return rows.top_per_key(t.orders, ["o_custkey"], 10, F.col("o_totalprice").desc(), F.col("o_orderkey")).select("o_custkey", "o_orderkey")


@query("select o_orderkey from orders where o_orderstatus <> 'F' order by o_totalprice desc, o_orderkey limit 150")
def accept_n(t: Tables) -> DataFrame:
    return t.orders.where("o_orderstatus <> 'F'").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(150).select("o_orderkey")


@query("""select l_partkey, coalesce(nullif(max(case when l_returnflag = 'R' then l_quantity end), 0), max(case when l_linestatus = 'O' and l_returnflag <> 'R' then l_quantity end)) as best from lineitem group by 1""")
def conditional_best(t: Tables) -> DataFrame:
    return match.conditional_best(t.lineitem, "l_partkey", F.col("l_returnflag") == "R", F.col("l_linestatus") == "O", "l_quantity")


@query("select doc_id from (select doc_id, row_number() over (partition by lower(split_part(text, chr(10), 1)) order by doc_id) r from documents) where r = 1")
def dedupe_single_key(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", F.lower(_title()).alias("k"))
    return rows.first_per_key(d, ["k"], F.col("doc_id")).select("doc_id")


@query(f"""with taken as (select lower({_FIRST}) as k from documents join labels using (doc_id) union select lower(source) from documents where source is not null)
    select d.doc_id from documents d where d.doc_id not in (select doc_id from labels) and not exists (select 1 from taken where k = lower({_FIRST}))""")
def exclude_variants(t: Tables) -> DataFrame:
    """Documents without a label whose title, in any case, is neither a labelled document's nor a source's name."""
    own = t.documents.join(t.labels.select("doc_id").distinct(), "doc_id", "left_anti").withColumn("k", F.lower(_title()))
    labelled = t.documents.join(t.labels.select("doc_id").distinct(), "doc_id", "left_semi").select(F.lower(_title()).alias("k"))
    taken = labelled.union(t.documents.where("source is not null").select(F.lower("source"))).distinct()
    return own.join(taken, "k", "left_anti").select("doc_id")


@query("select doc_id from documents except select doc_id from labels")
def except_own(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").subtract(t.labels.select("doc_id"))


@query("""select coalesce(a.id, b.id) as id, case when b.id is null then 'left' else 'right' end as side from (select distinct doc_id as id from documents) a full join (select distinct l_orderkey * 3 as id from lineitem) b on a.id = b.id where a.id is null or b.id is null""")
def presence_audit(t: Tables) -> DataFrame:
    return rows.presence(t.documents.select(F.col("doc_id").alias("id")), t.lineitem.select((F.col("l_orderkey") * 3).alias("id")), "id")


_SNAP = "(select o_orderkey, o_totalprice as v from orders where o_orderkey % 10 <> 1) o full join (select o_orderkey, case when o_orderkey % 7 = 0 then o_totalprice + 1 else o_totalprice end as v from orders where o_orderkey % 10 <> 2) n on o.o_orderkey = n.o_orderkey"


def _snapshots(t: Tables) -> tuple[DataFrame, DataFrame]:
    old = t.orders.where("o_orderkey % 10 <> 1").select("o_orderkey", F.col("o_totalprice").alias("v"))
    new = t.orders.where("o_orderkey % 10 <> 2").select("o_orderkey", F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("v"))
    return old, new


@query(f"""select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey, case when o.o_orderkey is null then 'insert' when n.o_orderkey is null then 'delete' else 'update' end as action from {_SNAP} where o.o_orderkey is null or n.o_orderkey is null or o.v is distinct from n.v""")
def snapshot_diff(t: Tables) -> DataFrame:
    return rows.snapshot_changes(*_snapshots(t), "o_orderkey", "v")


@query(f"""select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey, case when o.o_orderkey is null then 'insert' else 'update' end as action from {_SNAP} where n.o_orderkey is not null and (o.o_orderkey is null or o.v is distinct from n.v)""")
def write_if_changed(t: Tables) -> DataFrame:
    return rows.snapshot_changes(*_snapshots(t), "o_orderkey", "v", deletes=False)


@query(f"select coalesce(o.o_orderkey, n.o_orderkey) as o_orderkey, coalesce(n.v, o.v) as v from {_SNAP}")
def carry_forward(t: Tables) -> DataFrame:
    return rows.carry_forward(*_snapshots(t), "o_orderkey", "v")


@query("select o_orderkey from orders left join (select l_orderkey, max(l_shipdate) as made from lineitem group by 1) on l_orderkey = o_orderkey where made is null or made < o_orderdate")
def stale_derivative(t: Tables) -> DataFrame:
    made = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("made"))
    return t.orders.join(made, "o_orderkey", "left").where("made is null or made < o_orderdate").select("o_orderkey")


_RULES = """select 'V4' as rule_id, 'E' as severity, p_name as key from part group by p_name having count(*) > 1
    union all select 'V24', 'E', o_orderkey::varchar from orders where o_custkey not in (select c_custkey from customer where c_custkey % 50 <> 0)
    union all select 'V15', 'E', doc_id::varchar from documents where trim(text) = ''
    union all select 'V35', 'W', n_nationkey::varchar from nation left join supplier on s_nationkey = n_nationkey group by n_nationkey having count(s_suppkey) < 2
    union all select 'V3', 'E', c_custkey::varchar from customer where not regexp_matches(c_name, '^Customer#[0-9]*[02468]$')"""


def _violations(t: Tables) -> DataFrame:
    def rule(df: DataFrame, rule_id: str, severity: str, key: str) -> DataFrame:
        return df.select(F.lit(rule_id).alias("rule_id"), F.lit(severity).alias("severity"), F.col(key).cast("string").alias("key"))

    found = rule(rows.duplicate_keys(t.part, "p_name"), "V4", "E", "p_name")
    found = found.unionByName(rule(rows.dangling(t.orders, "o_custkey", t.customer.where("c_custkey % 50 <> 0"), "c_custkey"), "V24", "E", "o_orderkey"))
    found = found.unionByName(rule(t.documents.where(F.trim("text") == ""), "V15", "E", "doc_id"))
    few = t.nation.join(t.supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_nationkey").agg(F.count("s_suppkey").alias("n")).where("n < 2")
    found = found.unionByName(rule(few, "V35", "W", "n_nationkey"))
    return found.unionByName(rule(t.customer.where(~F.col("c_name").rlike("^Customer#[0-9]*[02468]$")), "V3", "E", "c_custkey"))


@query(_RULES)
def rule_violations(t: Tables) -> DataFrame:
    return _violations(t)


@query(f"select severity, count(*) as n from ({_RULES}) group by severity")
def severity_totals(t: Tables) -> DataFrame:
    return _violations(t).groupBy("severity").agg(F.count("*").alias("n"))


@query(f"""select rule_id, key, greatest(n - 15, 0) as more from (select *, row_number() over (partition by rule_id order by key) as r, count(*) over (partition by rule_id) as n from ({_RULES})) where r <= 15""")
def first_failures(t: Tables) -> DataFrame:
    """The first 15 findings of each rule, and how many more there are."""
    return rows.first_and_rest(_violations(t), ["rule_id"], 15, F.col("key")).select("rule_id", "key", "more")


@query("select count(*) as n, count(distinct c_nationkey) as nations from customer")
def run_summary(t: Tables) -> DataFrame:
    return t.customer.agg(F.count("*").alias("n"), F.count_distinct("c_nationkey").alias("nations"))


@query("select count(*) as total, count(o.c) as found, round(count(o.c)::double / count(*), 6) as rate from customer left join (select distinct o_custkey as c from orders) o on o.c = c_custkey")
def match_rate(t: Tables) -> DataFrame:
    found = t.customer.join(t.orders.select(F.col("o_custkey").alias("c_custkey"), F.lit(1).alias("hit")).distinct(), "c_custkey", "left")
    return found.agg(F.count("*").alias("total"), F.count("hit").alias("found"), F.round(F.count("hit") / F.count("*"), 6).alias("rate"))


_FLAT = "trim(regexp_replace(text, '[\\s\\x{000B}\\x{00A0}]+', ' ', 'g'))"
#: Sentence ends of the first 320 characters that follow no initial, by looking at each; the last one wins.
_ENDS = """list_filter(generate_series(1, 320), lambda i: substr(c, i, 1) in ('.', '!', '?') and (i = 320 or substr(c, i + 1, 1) = ' ') and i > 1 and not (regexp_matches(substr(c, i - 1, 1), '[A-Z]') and (i > 2 and substr(c, i - 2, 1) in (' ', '.'))))"""


@query(f"""with d as (select doc_id, {_FLAT} as c from documents), e as (select *, list_last({_ENDS}) as pos from d)
    select doc_id, case when length(c) <= 320 then c when pos is not null then substr(c, 1, pos) else regexp_replace(substr(c, 1, 320), ' +[^ ]*$', '') || '…' end as excerpt from e""")
def excerpts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", X.excerpt(F.col("text")).alias("excerpt"))
