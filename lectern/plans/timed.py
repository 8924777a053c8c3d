"""Queries on stanzas from streams, the structure of passes, timed documents and attempts in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators import audit, timing
from lectern.plans.registry import Tables, query


def phrase_sql(items: str, gap: float, long: float = 1.9, most: int = 12) -> str:
    """CTEs for 'with recursive': cut(unit, ats, lens, ids, ends), ends being the last item of each phrase, from items (unit, id, tm, len)."""
    longest = "s + 1 + list_position(lens[s + 2 : {0}], list_max(lens[s + 2 : {0}]))"
    return f"""phrase_items as ({items}),
    phrase_lists as (select unit, list(tm order by tm, id) as ats, list(len order by tm, id) as lens, list(id order by tm, id) as ids, count(*) as n from phrase_items group by 1),
    steps as (select unit, 1::bigint as i, 1::bigint as s, []::bigint[] as ends from phrase_lists union all
        select unit, i + 1, case when closes then i + 1 else s1 end, case when closes then list_append(e1, i) else e1 end from (
            select *, lens[i] >= {long} and i - s1 + 1 >= 3 as closes from (
                select unit, i, lens, case when gaps then i when full_ then c + 1 else s end as s1, case when gaps then list_append(ends, i - 1) when full_ then list_append(ends, c) else ends end as e1 from (
                    select steps.*, lens, i - s >= 2 and ats[i] - (ats[i - 1] + lens[i - 1]) > {gap} as gaps, i - s >= {most} as full_, {longest.format("i - 2")} as c from steps join phrase_lists using (unit) where i <= n)))),
    cut as (select unit, ats, lens, ids, case when n - s + 1 >= {most} then list_append(ends, {longest.format("n - 1")}) else ends end as ends from steps join phrase_lists using (unit) where i = n + 1)"""


#: A verse of each event, one of three streams of its user.
_STREAM = "1 + json_extract(props, '$.k')::bigint % 3"


@query(f"""with recursive e as (select user_id, event_id, {_STREAM} as verse, epoch_us(ts)::double / 3600000000 as tm, value / 100 as len, event_type = 'signup' as shared from events),
    v as (select *, row_number() over (partition by user_id order by verse) as stanza from (select distinct user_id, verse from e)),
    sung as (select user_id, stanza, event_id, tm, len from e join v using (user_id, verse) union all select v.user_id, stanza, event_id, tm, len from v join e on e.user_id = v.user_id and e.verse = 1 and e.shared where v.verse <> 1),
    {phrase_sql("select {'u': user_id, 's': stanza} as unit, event_id as id, tm, len from sung", 6.0)},
    x as (select unit, ids, ends, unnest(range(1, len(ids) + 1)) as j from cut)
    select unit.u as user_id, unit.s::int as stanza, ids[j] as event_id, len(list_filter(ends, lambda e: e < j))::int as line from x""")
def stream_stanzas(t: Tables) -> DataFrame:
    """A user's events as the words of three streams, sign-ups of the first one being the refrain."""
    k = F.get_json_object("props", "$.k").cast("long")
    hours = F.unix_micros(F.col("ts").cast("timestamp")).cast("double") / 3_600_000_000
    e = t.events.select("user_id", "event_id", (1 + k % 3).alias("verse"), hours.alias("at"), (F.col("value") / 100).alias("length"), "event_type")
    return timing.stream_stanzas(e, "user_id", "verse", "event_id", "at", "length", F.col("event_type") == "signup", gap=6.0)


#: The tick for a wanted time: from an eighth of a unit before to three units behind it, the nearest, ties to the earlier.
_NEAREST = """list_sort(list_transform(list_filter(ticks, lambda t: t >= expected - {u}::double / 8 and t <= expected + 3 * {u}), lambda t: {{'d': abs(t - expected), 't': t}}))[1]"""


def follow_sql(keys: str, unit: int) -> str:
    """CTEs for 'with recursive': followed(keys, got), got being null where a pass can't be followed, from wanted_passes (keys, wanted, ticks)."""
    return f"""runs as (select {keys}, wanted, ticks, 0::bigint as i, 0::double as shift, []::double[] as got, true as ok from wanted_passes union all
        select {keys}, wanted, ticks, i + 1, best.t - w, list_append(got, best.t), coalesce(best.d <= {unit}, false) from (
            select *, {_NEAREST.format(u=unit)} as best from (select *, wanted[i + 1] as w, wanted[i + 1] + shift as expected from runs where ok and i < len(wanted)))),
    followed as (select {keys}, case when ok then got end as got from runs where not ok or i = len(wanted))"""


#: Half a day, in seconds: how far a tick may be from where it is looked for.
_HALF_DAY = 43_200


def micros(x: Column) -> Column:
    return F.round(x * 1_000_000).cast("long").cast("string")


@query(f"""with recursive e as (select user_id, event_type, (epoch_us(ts) - min(epoch_us(ts)) over (partition by user_id))::double / 1000000 as tm from events),
    u as (select user_id, list_sort(list_distinct(list(tm))) as ticks, list_sort(list_distinct(list_append(coalesce(list(tm) filter (event_type = 'signup'), []), 0::double))) as starts,
        list_filter(list_sort(list_distinct(list(tm) filter (event_type = 'click'))), lambda x: x <= max(tm) / 4) as clicks, max(tm) as span from e group by 1),
    o as (select *, list_transform(clicks, lambda x: x - clicks[1]) as onsets from u where len(clicks) > 0),
    d as (select user_id, starts[i + 1] - starts[i] as period, count(*) as often from (select user_id, starts, unnest(range(1, len(starts))) as i from o) group by 1, 2),
    s as (select user_id, ticks, onsets, span, unnest(starts) as start from o),
    c as (select * from s join d using (user_id) where period >= onsets[-1] and start + period + onsets[-1] <= span + 3 * {_HALF_DAY}),
    wanted_passes as (select user_id, start, period, often, p, ticks, list_transform(onsets, lambda x: start + p * period + x) as wanted from c, (select unnest([0, 1]) as p)),
    {follow_sql("user_id, start, period, often, p", _HALF_DAY)},
    whole as (select user_id, start, period, often, string_agg(array_to_string(list_transform(got, lambda x: round(x * 1000000)::bigint), ','), ';' order by p) as matched from followed group by 1, 2, 3, 4 having count(got) = 2),
    best as (select *, row_number() over (partition by user_id order by start, often desc, period) as r from whole)
    select u.user_id, start, period, matched from u left join (select * from best where r = 1) b using (user_id)""")
def pass_structure(t: Tables) -> DataFrame:
    """Where a user's clicks of the first quarter are repeated: two passes, begun at sign-ups, on the ticks of all events."""
    from pyspark.sql import Window

    at = F.unix_micros(F.col("ts").cast("timestamp"))
    e = t.events.select("user_id", "event_type", ((at - F.min(at).over(Window.partitionBy("user_id"))).cast("double") / 1_000_000).alias("at"))

    def times(kind: str) -> Column:
        return F.array_sort(F.collect_set(F.when(F.col("event_type") == kind, F.col("at"))))

    u = e.groupBy("user_id").agg(F.array_sort(F.collect_set("at")).alias("ticks"), times("signup").alias("starts"), times("click").alias("clicks"), F.max("at").alias("span"))
    u = u.withColumn("clicks", F.filter("clicks", lambda x: x <= F.col("span") / 4))
    u = u.withColumn("onsets", F.transform("clicks", lambda x: x - F.get("clicks", F.lit(0))))
    found = timing.pass_structure(u, "onsets", "ticks", "starts", F.lit(2), F.col("span"), F.lit(_HALF_DAY))
    return found.select("user_id", "start", "period", F.array_join(F.transform("matched", lambda run: F.array_join(F.transform(run, micros), ",")), ";").alias("matched"))


_TIMED = """with lines as (select conv_id, turn, role, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) as line from conversations),
    split as (select *, string_split(string_split(text, chr(10))[line], ' ') as ws from lines), placed as (select *, unnest(range(1, len(ws) + 1)) as pos from split),
    w as (select conv_id, turn as stanza, case role when 'user' then 1 when 'assistant' then 2 end as verse, line, pos, ws[pos] as word, (turn * 100000 + line * 2000 + pos * 20) as first, length(ws[pos]) * 5 as hold from placed where ws[pos] <> ''),
    n as (select conv_id, case when conv_id % 13 = 0 then 3 when bool_or(role = 'assistant') then 2 else 1 end as runs, case when conv_id % 5 = 0 then 1000 else 3000000 end as period, case when conv_id % 11 = 0 then 1 else 9000000 end as span from conversations group by conv_id),
    p as (select conv_id, pass, first, first + (pass - 1) * period as tick from (select distinct conv_id, first from w where not (conv_id % 7 = 0 and first % 100000 = 2020)) join n using (conv_id), (select unnest([1, 2, 3]) as pass) where pass <= runs),
    tempo as (select conv_id, turn * 100000 as tm, 400000 + length(text) as tempo from conversations where text is not null),
    g as (select *, tm - coalesce(lag(tm) over q, 0) as gone, coalesce(lag(tempo) over q, 500000) as before from tempo window q as (partition by conv_id order by tm)),
    c as (select *, sum(gone * before) over (partition by conv_id order by tm) as past from g),
    sung as (select w.*, x.pass, min(first) over (partition by w.conv_id, x.pass, w.stanza) as opens from w join (select distinct conv_id, pass from p) x on x.conv_id = w.conv_id and (w.verse = x.pass or w.verse is null)),
    m as (select sung.*, p.tick as a, p.tick + hold as b from sung left join p using (conv_id, pass, first)),
    s1 as (select m.*, round(coalesce(c.past + (a - c.tm) * c.tempo, a * 500000)::double / 480000000, 3) as t, coalesce(c.past + (a - c.tm) * c.tempo, a * 500000)::double / 480000000 as exact from m asof left join c on m.conv_id = c.conv_id and m.a > c.tm),
    s2 as (select s1.*, round(coalesce(c.past + (b - c.tm) * c.tempo, b * 500000)::double / 480000000 - exact, 3) as d from s1 asof left join c on s1.conv_id = c.conv_id and s1.b > c.tm),
    o as (select *, coalesce(lag(t) over (partition by conv_id order by pass, opens, stanza, line, pos) > t, false) as falls from s2),
    whole as (select conv_id, bool_or(falls) as falls, bool_or(t is null) as lost, count(distinct (pass, stanza)) as stanzas, count(*) as words, sum(round(t * 1000)::bigint) as t_ms, sum(round(d * 1000)::bigint) as d_ms, arg_max(t, (pass, opens, stanza, line, pos)) as final from o group by 1),
    e as (select n.conv_id, runs, round(coalesce(c.past + (span - c.tm) * c.tempo, span * 500000)::double / 480000000, 3) as duration from n asof left join c on n.conv_id = c.conv_id and n.span > c.tm),
    v as (select conv_id, list_sort(list_distinct(list(verse))) as verses from w group by 1)
    select conv_id, outcome, duration, case when outcome = 'timed' then stanzas end as stanzas, case when outcome = 'timed' then words end as words, case when outcome = 'timed' then t_ms end::bigint as t_ms, case when outcome = 'timed' then d_ms end::bigint as d_ms from (
        select *, case when len(verses) > 0 and verses <> range(1, greatest(1, runs) + 1)::int[] then 'verses' when whole.conv_id is null or lost then 'unmatched' when falls then 'falling' when final > duration + 1 then 'past end' else 'timed' end as outcome
        from e left join v using (conv_id) left join whole using (conv_id))"""


@query(_TIMED)
def timed_documents(t: Tables) -> DataFrame:
    """Conversations as documents: turns are stanzas, users sing the first pass and assistants the second; counts and sums of the times."""
    c = t.conversations.select("conv_id", F.col("turn").alias("stanza"), "role", F.posexplode(F.split("text", "\n")).alias("l", "rest"))
    c = c.select("conv_id", "stanza", "role", (F.col("l") + 1).alias("line"), F.posexplode(F.split("rest", " ")).alias("q", "text")).where("text <> ''").withColumn("pos", F.col("q") + 1)
    verse = F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 2)
    first = F.col("stanza") * 100_000 + F.col("line") * 2_000 + F.col("pos") * 20
    w = c.select("conv_id", "stanza", F.col("role").alias("label"), verse.alias("verse"), "line", "pos", "text", first.alias("first"), first.alias("last"), (F.char_length("text") * 5).alias("hold"))
    runs = F.when(F.col("conv_id") % 13 == 0, 3).when(F.bool_or(F.col("role") == "assistant"), 2).otherwise(1)
    n = t.conversations.groupBy("conv_id").agg(runs.alias("runs"))
    n = n.select("conv_id", "runs", F.when(F.col("conv_id") % 5 == 0, 1_000).otherwise(3_000_000).alias("period"), F.when(F.col("conv_id") % 11 == 0, 1).otherwise(9_000_000).alias("span"))
    onsets = w.select("conv_id", F.col("first").alias("onset")).distinct().where("not (conv_id % 7 = 0 and onset % 100000 = 2020)")
    passes = onsets.join(n, "conv_id").select("conv_id", F.explode(F.sequence(F.lit(1), "runs")).alias("pass"), "onset", "period")
    passes = passes.select("conv_id", "pass", "onset", (F.col("onset") + (F.col("pass") - 1) * F.col("period")).alias("tick"))
    tempos = t.conversations.where("text is not null").select("conv_id", (F.col("turn") * 100_000).alias("at"), (400_000 + F.char_length("text")).cast("decimal(18,0)").alias("tempo"))
    done = timing.timed_documents(w, passes, tempos, n.select("conv_id", "span"), "conv_id", 480)
    words = F.flatten(F.flatten(F.transform("stanzas", lambda s: s["lines"])))

    def total(field: str) -> Column:
        return F.aggregate("_w", F.lit(0).cast("long"), lambda a, x: a + F.round(x[field] * 1000).cast("long"))

    done = done.withColumn("_w", words)
    sized = [F.when(F.col("outcome") == "timed", F.size(x).cast("long")).alias(n) for x, n in (("stanzas", "stanzas"), ("_w", "words"))]
    return done.select("conv_id", "outcome", "duration", *sized, total("t").alias("t_ms"), total("d").alias("d_ms"))


@query("""select d.doc_id, case when l.doc_id is not null then 'label' when length(d.text) >= 400 then 'text' else 'skipped' end as outcome,
    case when l.doc_id is null and coalesce(length(d.text) < 400, true) then case when d.text is null then 'no text' else 'short text' end end as error,
    case when l.doc_id is not null then l.quality::bigint when length(d.text) >= 400 then length(d.text) end as value from documents d left join labels l using (doc_id)""")
def first_success(t: Tables) -> DataFrame:
    """A document's own label, else the length of its text if it is long enough, else the reason why neither will do."""
    d = t.documents.select("doc_id", "text").join(t.labels.select("doc_id", F.col("quality").cast("long"), F.lit(True).alias("there")), "doc_id", "left")
    n = F.char_length("text").cast("long")
    label = d.select("doc_id", F.lit(1).alias("priority"), F.lit("label").alias("mode"), F.when(F.col("there").isNull(), "no label").alias("error"), F.col("quality").alias("value"))
    text = d.select("doc_id", F.lit(2).alias("priority"), F.lit("text").alias("mode"), F.when(n.isNull(), "no text").when(n < 400, "short text").alias("error"), n.alias("value"))
    return timing.first_success(label.unionByName(text), "doc_id", "priority", "mode", "error", ["value"])


@query("""with m as (select l_orderkey, l_returnflag as asset, min(l_suppkey) as source from lineitem group by 1, 2)
    select l_orderkey, string_agg('provenance.' || asset || ' references unknown source "' || source || '"', '; ' order by list_position(['R', 'A', 'N'], asset)) as error from m left join supplier on s_suppkey = source and s_suppkey % 9 <> 0 where s_suppkey is null group by 1""")
def render_errors(t: Tables) -> DataFrame:
    """Orders whose sources can't be rendered, as their registry lacks some."""
    of = t.lineitem.groupBy("l_orderkey", "l_returnflag").agg(F.min("l_suppkey").alias("source"))
    held = of.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "source"))).alias("sources"))
    return audit.render_errors(held, "l_orderkey", "sources", t.supplier.where("s_suppkey % 9 <> 0"), "s_suppkey", ["R", "A", "N"])
