"""Queries on words, phrases, families and greedy choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as X
from lectern.operators import align, dedupe, family, match, sequence, similar
from lectern.plans.catalogue import _KEY
from lectern.plans.ordered import _ROOTS, _pointers
from lectern.plans.registry import Tables, query
from lectern.plans.timed import follow_sql, micros, phrase_sql


def _words(sentence: Column) -> Column:
    return F.filter(F.split(X.key_folded(sentence), " "), lambda w: w != "")


def _heard(n: Column, words: Column) -> Column:
    """The words of a document's n-th sentence as if heard, with changes: words lost, split and misspelt."""

    def heard(w, i):
        at = (i + n) % 11
        return F.when(at == 3, F.array(w, F.lit("and"))).when(at == 6, F.array(F.substring(w, 1, 2), w.substr(F.lit(3), F.char_length(w)))).when(at == 9, F.array(F.concat(w, F.lit("s")))).otherwise(F.array(w))

    return F.when(n % 3 == 0, words).otherwise(F.filter(F.flatten(F.transform(words, heard)), lambda w: w != ""))


def _sentences(t: Tables) -> DataFrame:
    """(doc_id, n, words, heard): the sentences of each document and what is heard of them."""
    d = t.documents.select("doc_id", F.posexplode(F.split("text", "[.\n]+")).alias("n", "sentence"))
    d = d.select("doc_id", "n", _words(F.col("sentence")).alias("words")).where(F.size("words") > 0)
    # Folding a sentence is dear and its words are used many times.
    d = family.cut(d)
    return d.withColumn("heard", _heard(F.col("n"), F.col("words")))


def _said(text: Column) -> Column:
    """The sentences of one text, as an array of (n, words, heard) in order."""
    said = F.transform(F.split(text, "[.\n]+"), lambda s, n: F.struct(n.alias("n"), _words(s).alias("words")))
    return F.transform(F.filter(said, lambda s: F.size(s["words"]) > 0), lambda s: F.struct(s["n"], s["words"], _heard(s["n"], s["words"]).alias("heard")))


def _said_of_documents(t: Tables) -> DataFrame:
    """(doc_id, s): the sentences of each document that has any; rows with equal ids are one document.

    A row's sentences never leave its task, so nothing is written: only ids are counted, and only rows with equal ids are brought together.
    """
    d = t.documents.select("doc_id", "text")
    several = family.cut(d.groupBy(F.col("doc_id").alias("_several")).count().where(F.col("count") > 1).select("_several"))
    # As one of one, so that the test for sentences can't be moved before them and work them out twice.
    said = lambda rows: rows.select("doc_id", F.explode(F.array(_said(F.col("text")))).alias("s")).where(F.size("s") > 0)
    if several.isEmpty():
        return said(d)
    same = F.col("doc_id").eqNullSafe(F.col("_several"))
    joined = said(d.join(several, same, "left_semi")).groupBy("doc_id").agg(F.sort_array(F.flatten(F.collect_list("s"))).alias("s"))
    return said(d.join(several, same, "left_anti")).unionByName(joined)


@query()
def line_alignment(t: Tables) -> DataFrame:
    return align.aligned_lines(_sentences(t), "words", "heard").select("doc_id", "n", "cost", "consumed", "edits", "fits")


@query()
def document_alignment(t: Tables) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("n", "words", "heard")))
    d = _sentences(t).groupBy("doc_id").agg(ordered.alias("s"))
    d = d.select("doc_id", F.transform("s", lambda s: s["words"]).alias("lines"), F.flatten(F.transform("s", lambda s: s["heard"])).alias("stream"))
    return align.aligned_documents(d, "lines", "stream").select("doc_id", "accepted", "failed_line", "cost", "consumed")


@query()
def stream_alignment(t: Tables) -> DataFrame:
    """Even and odd sentences of a document against a stream each, every fifth against both; the first sentence is heard last in odd documents."""
    return align.aligned_streams(_streams(t), "lines", "streams").select("doc_id", "accepted", "failed_line", "cost", F.to_json("placed").alias("placed"))


def _streams(t: Tables) -> DataFrame:
    d = _said_of_documents(t)
    late = (F.col("doc_id") % 2 == 1) & (F.size("s") > 1)
    heard = F.when(late, F.concat(F.slice("s", F.lit(2), F.size("s") - 1), F.slice("s", 1, 1))).otherwise(F.col("s"))
    own = lambda s: s["n"] % 2 + 1
    of = lambda k: F.flatten(F.transform(F.filter(heard, lambda s: own(s) == k), lambda s: s["heard"]))
    lines = F.transform("s", lambda s: F.struct(F.when(s["n"] % 5 != 4, own(s)).alias("stream"), s["words"].alias("words")))
    return d.select("doc_id", lines.alias("lines"), F.create_map(F.lit(1), of(1), F.lit(2), of(2)).alias("streams"))


_PAIRS = f"""s as (select doc_id, p, unnest(range(0, len(p))) as n from (select doc_id, string_split_regex(text, '[.\\n]+') as p from documents)),
    w as (select doc_id, n, list_filter(string_split({_KEY.format("strip_accents(p[n + 1])")}, ' '), lambda x: x <> '') as words from s),
    h as (select *, case when n % 3 = 0 then words else list_filter(flatten(list_transform(words, lambda x, i: case (i - 1 + n) % 11 when 3 then [x, 'and'] when 6 then [x[1:2], x[3:]] when 9 then [x || 's'] else [x] end)), lambda x: x <> '') end as heard from w where len(words) > 0),
    t as (select doc_id, n::int as n, array_to_string(words[1:10], '') as a, array_to_string(heard[1:14], '') as b from h)"""


@query(f"""with recursive {_PAIRS}, f as (select *, left(b, length(a) + 10) as front, contains(b, a) as inside from t),
    open as (select doc_id || ' ' || n as id, a, front from f where not inside and 2.0::double * least(length(a), length(front)) / (length(a) + length(front)) > 0.8),
    {similar.ratio_sql("open", "id", "a", "front")}
    select doc_id, n, inside or coalesce(ratio > 0.8, false) as agree from f left join likeness on id = doc_id || ' ' || n""")
def text_identity(t: Tables) -> DataFrame:
    s = _sentences(t).select("doc_id", "n", F.array_join(F.slice("words", 1, 10), "").alias("a"), F.array_join(F.slice("heard", 1, 14), "").alias("b"))
    return similar.texts_agree(s, "a", "b").select("doc_id", "n", "agree")


_ITEMS = "select user_id as unit, event_id as id, epoch_us(ts)::double / 3600000000 as tm, value / 100 as len from events"


@query(f"""with recursive {phrase_sql(_ITEMS, 6.0)}, x as (select unit, ids, ends, unnest(range(1, len(ids) + 1)) as j from cut)
    select unit as user_id, ids[j] as event_id, len(list_filter(ends, lambda e: e < j))::int as phrase from x""")
def phrase_segments(t: Tables) -> DataFrame:
    e = t.events.select("user_id", "event_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 3_600_000_000).alias("at"), (F.col("value") / 100).alias("length"))
    return align.phrases(e, "user_id", "event_id", "at", "length", gap=6.0)


@query(f"""with recursive e as (select user_id, ts::date as day, list_sort(list_distinct(list(epoch_us(ts)::double / 1000000))) as ticks from events group by 1, 2),
    wanted_passes as (select *, list_transform(list_filter(ticks, lambda x, i: i % 2 = 1), lambda x, i: x + ((i - 1) * 37) % 400) as wanted from e),
    {follow_sql("user_id, day", 900)}
    select user_id, day::varchar as day, len(wanted)::int as n, array_to_string(list_transform(got, lambda x: round(x * 1000000)::bigint), ',') as matched from wanted_passes join followed using (user_id, day)""")
def onset_match(t: Tables) -> DataFrame:
    # one pass a user and day: every other event, moved, against all of the day's events
    e = t.events.select("user_id", F.to_date("ts").alias("day"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000).cast("double").alias("at"), F.col("event_id").alias("id"))
    grouped = e.groupBy("user_id", "day").agg(F.array_sort(F.collect_set("at")).alias("ticks"))
    moved = grouped.withColumn("wanted", F.transform(F.filter("ticks", lambda x, i: i % 2 == 0), lambda x, i: x + (i * 37) % 400))
    return align.matched_onsets(moved, "wanted", "ticks", F.lit(900)).select("user_id", F.col("day").cast("string").alias("day"), F.size("wanted").alias("n"), F.array_join(F.transform("matched", micros), ",").alias("matched"))


@query("""with recursive o as (select doc_id, 's:' || source || ' ' || lower(split_part(text, ' ', 1)) as a, 'l:' || lower(split_part(text, chr(10), 1)) as b, row_number() over (order by doc_id) as i from documents),
    s as (select 0::bigint as i, []::varchar[] as seen, null::bigint as doc_id, null::boolean as accepted union all
        select o.i, case when coalesce(list_contains(s.seen, o.a), false) or coalesce(list_contains(s.seen, o.b), false) then s.seen else list_concat(s.seen, [o.a, o.b]) end, o.doc_id, not (coalesce(list_contains(s.seen, o.a), false) or coalesce(list_contains(s.seen, o.b), false)) from s join o on o.i = s.i + 1)
    select doc_id, accepted from s where i > 0""")
def dedupe_two_keys(t: Tables) -> DataFrame:
    """A document goes if its source has its first word, or any document its first line, in one that stayed before it."""
    a = F.concat(F.lit("s:"), "source", F.lit(" "), F.lower(F.split_part("text", F.lit(" "), F.lit(1))))
    b = F.concat(F.lit("l:"), F.lower(F.split_part("text", F.lit("\n"), F.lit(1))))
    return dedupe.greedy_two_keys(t.documents.select("doc_id", a.alias("a"), b.alias("b")), "doc_id", "a", "b").select("doc_id", "accepted")


@query("""select user_id, event_id, word from (select *, sum(starts) over (partition by user_id order by ts, event_id)::bigint as word from (select *, case when coalesce(lag(event_type in ('view', 'click')) over (partition by user_id order by ts, event_id), false) then 0 else 1 end as starts from events))""")
def open_words(t: Tables) -> DataFrame:
    return sequence.open_words(t.events, "user_id", ["ts", "event_id"], F.col("event_type").isin("view", "click")).select("user_id", "event_id", "word")


@query("""select conv_id, turn, greatest(n, 1)::bigint as "group" from (select conv_id, turn, count(v) over (partition by conv_id order by turn) as n, count(v) over (partition by conv_id) as alln from (select *, case when role = 'assistant' then text end as v from conversations)) where alln > 0""")
def merge_unvalued(t: Tables) -> DataFrame:
    c = t.conversations.select("conv_id", "turn", F.when(F.col("role") == "assistant", F.col("text")).alias("v"))
    return sequence.merge_unvalued(c, "conv_id", ["turn"], "v").select("conv_id", "turn", "group")


@query("""select event_id, sum(k) over (partition by user_id order by ts, event_id)::bigint as at, sum(k) over (partition by user_id)::bigint as span from (select *, json_extract(props, '$.k')::bigint as k from events)""")
def running_ticks(t: Tables) -> DataFrame:
    e = t.events.withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return sequence.running_time(e, "user_id", ["ts", "event_id"], "k").select("event_id", "at", "span")


@query("""with s as (select user_id, ts, max(value) as v from events where event_type = 'signup' group by 1, 2), b as (select user_id, ts, max(value) as v from events where event_type = 'purchase' group by 1, 2)
    select e.event_id, case when s.v < 50 then coalesce(b.v, s.v) else s.v end as held from events e asof left join s on e.user_id = s.user_id and e.ts >= s.ts asof left join b on e.user_id = b.user_id and e.ts >= b.ts where e.event_type = 'view'""")
def asof_fallback(t: Tables) -> DataFrame:
    e = t.events.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))

    def slices(kind: str) -> DataFrame:
        return e.where(F.col("event_type") == kind).groupBy("user_id", "at").agg(F.max("value").alias("v"))

    found = match.as_of(e.where("event_type = 'view'").select("event_id", "user_id", "at"), slices("signup"), ["user_id"], "at", "v", "first")
    found = match.as_of(found, slices("purchase"), ["user_id"], "at", "v", "second")
    return found.select("event_id", F.when(F.col("first") < 50, F.coalesce("second", "first")).otherwise(F.col("first")).alias("held"))


@query("""with r as (select conv_id, turn, case when role = 'system' then null else turn % 2 end as verse from conversations), p as (select conv_id, unnest([0, 1]) as pass from (select distinct conv_id from conversations))
    select p.conv_id, p.pass::bigint as pass, r.turn from p join r on p.conv_id = r.conv_id and (r.verse = p.pass or r.verse is null)""")
def wildcard_passes(t: Tables) -> DataFrame:
    r = t.conversations.select("conv_id", "turn", F.when(F.col("role") != "system", F.col("turn") % 2).alias("verse"))
    passes = t.conversations.select("conv_id").distinct().select("conv_id", F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))).alias("pass"))
    return match.wildcard_join(passes, r, ["conv_id"], "pass", "verse").select("conv_id", "pass", "turn")


@query("""select c.conv_id, string_agg(c.role || ':' || c.turn, ',' order by c.turn) as missing from conversations c where not exists (select 1 from conversations d where d.conv_id = c.conv_id + 1 and d.role = c.role and d.turn = c.turn) group by 1""")
def missing_labels(t: Tables) -> DataFrame:
    theirs = t.conversations.select((F.col("conv_id") - 1).alias("conv_id"), "role", "turn")
    left = t.conversations.join(theirs, ["conv_id", "role", "turn"], "left_anti")
    parts = F.sort_array(F.collect_list(F.struct("turn", F.concat_ws(":", "role", F.col("turn").cast("string")).alias("p"))))
    return left.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda x: x["p"]), ",").alias("missing"))


_LOOPS = """with recursive p as (select o_orderkey as k, case when o_custkey % 7 <> 0 then (o_orderkey * 7 + 3) % (select count(*) from orders) end as parent from orders), q as (select p.k, u.k as up from p left join p u on u.k = p.parent), r as (select k from q where up is null union all select q.k from q join r on q.up = r.k)"""


@query(f"{_LOOPS} select k as o_orderkey from p where k not in (select k from r)")
def family_cycles(t: Tables) -> DataFrame:
    n = t.orders.count()
    p = t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 7 != 0, (F.col("o_orderkey") * 7 + 3) % n).alias("parent"))
    found = family.cyclic(p, "o_orderkey", "parent")
    # In SQL no key is known to be outside a list that holds a null, and a row without a key is a root.
    return found if t.orders.where("o_orderkey is null").isEmpty() else found.limit(0)


_CANON = f"""{_ROOTS}, f as (select root, max(k) as top, count(*) as n from r group by root having count(*) > 1),
    c as (select root, case when root % 2 = 0 and root % 3 <> 0 then top else root end as canonical, not (root % 2 = 0 and root % 3 = 0) as valid from f)"""


def _canonical(t: Tables) -> tuple[DataFrame, DataFrame]:
    rooted = family.roots(_pointers(t), "o_orderkey", "parent")
    tops = rooted.groupBy("root").agg(F.max("o_orderkey").alias("top")).where("root % 2 = 0")
    chosen = tops.select("root", F.when(F.col("root") % 3 == 0, F.lit(-1)).otherwise(F.col("top")).alias("member"))
    return rooted, family.canonical_members(rooted, "o_orderkey", chosen, "member")


@query(f"{_CANON} select root, canonical, valid from c")
def canonical_override(t: Tables) -> DataFrame:
    return _canonical(t)[1]


@query(f"""{_CANON}, m as (select r.k, r.root, c.canonical, case when o.o_custkey % 11 = 0 then 'w' || r.k end as own from r join c using (root) join orders o on o.o_orderkey = r.k), a as (select root, arg_min(own, k) filter (own is not null) as known from m group by 1)
    select m.k as o_orderkey, coalesce(m.own, a.known, 'f' || m.canonical) as work, case when m.k = m.canonical then 'original' when m.k = m.root then 'former root' else 'member' end as label, m.own is null as changed from m join a using (root)""")
def family_rewrite(t: Tables) -> DataFrame:
    rooted, canonical = _canonical(t)
    d = t.orders.select("o_orderkey", F.when(F.col("o_custkey") % 11 == 0, F.concat(F.lit("w"), F.col("o_orderkey").cast("string"))).alias("work"))
    return family.rewrite(d, rooted, canonical, "o_orderkey", "work", F.concat(F.lit("f"), F.col("canonical").cast("string")))


@query(f"""{_CANON} select r.k as o_orderkey from r join c using (root) join orders a on a.o_orderkey = r.k join orders b on b.o_orderkey = c.canonical where r.k <> c.canonical and a.o_orderpriority = b.o_orderpriority""")
def family_assets(t: Tables) -> DataFrame:
    rooted, canonical = _canonical(t)
    return family.redundant_copies(t.orders, rooted, canonical, "o_orderkey", F.col("o_orderpriority"))


@query(f"""{_CANON} select c.root, count(*) as n from c join r using (root) join orders o on o.o_orderkey = r.k where c.canonical = c.root and r.k <> c.root and regexp_matches(o.o_orderpriority, '(?i)urgent') group by 1""")
def family_review(t: Tables) -> DataFrame:
    rooted, canonical = _canonical(t)
    children = rooted.join(canonical.where("canonical = root").select("root"), "root").where("o_orderkey <> root")
    return children.join(t.orders.where(F.col("o_orderpriority").rlike("(?i)urgent")).select("o_orderkey"), "o_orderkey").groupBy("root").agg(F.count("*").alias("n"))
