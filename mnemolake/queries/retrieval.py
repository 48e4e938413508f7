"""Search, fusion, and the tables that writes change."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.operators import reading, routing, search
from mnemolake.queries.common import BLANKS_SQL, CHUNKS, EMBEDDINGS, ENTRIES, ITEMS, SEARCH_TEXT, chunks, embeddings, entries, items, lex, registry
from mnemolake.runtime import table

QUERIES, SQL, query = registry()


# ---- requests out of the data ------------------------------------------------------------------
def _requests(spark, d, forms: bool = True):
    """Requests of every scope: the title of its first item as it is, its first word in capitals, and (``forms``) a longer question that nothing holds whole."""
    t = items(spark, d).where("title is not null and status = 'active'").groupBy("user_id", "workspace_id").agg(F.min_by("title", "id").alias("title"))
    word = F.upper(F.regexp_extract("title", r"([\p{L}\p{N}]{4,})", 1))
    ask = F.array(F.col("title"), word, *([F.concat(F.lit("what is the exact "), F.lower("title"), F.lit(" zzzq"))] if forms else []))
    rows = t.select("user_id", "workspace_id", F.posexplode(ask).alias("n", "query"))
    return rows.where("query <> ''").select(F.concat_ws("#", "workspace_id", F.col("n").cast("string")).alias("request"), "user_id", "workspace_id", "query")


_ASKED = rf"""asked0 as (select user_id, workspace_id, arg_min(title, id) as title from items where title is not null and status = 'active' group by 1, 2),
 asked as (select workspace_id || '#' || n as request, user_id, workspace_id, query, list_distinct({lex('query')}) as q from (select *, unnest([0, 1, 2]) as n, unnest([title, upper(regexp_extract(title, '([\p{{L}}\p{{N}}]{{4,}})', 1)), 'what is the exact ' || lower(title) || ' zzzq']) as query from asked0) where query <> '')"""


def _strict(name: str, rows: str, words: str, boost: str, weight: float = 0.1) -> str:
    """SQL of strict hits with cover density: minimal covers are found by joins over the places of the words."""
    return f"""{name}_doc as (select r.request, r.query, r.q, x.* from (select *, {words} as doc from {rows}) x join asked r on x.user_id = r.user_id and x.workspace_id = r.workspace_id where len(r.q) > 0 and list_has_all(x.doc, r.q)),
 {name}_tok as (select request, id, q, unnest(doc) as w, generate_subscripts(doc, 1) as p from {name}_doc), {name}_occ as (select request, id, w, p, len(q) as need from {name}_tok where list_contains(q, w)),
 {name}_last as (select e.request, e.id, e.p as e, e.need, o.w, max(o.p) as p from {name}_occ e join {name}_occ o on o.request = e.request and o.id = e.id and o.p <= e.p group by 1, 2, 3, 4, 5),
 {name}_cov as (select request, id, e, min(p) as b from {name}_last group by 1, 2, 3 having count(*) = max(need)), {name}_min as (select request, id, b, min(e) as e from {name}_cov group by 1, 2, 3),
 {name}_den as (select request, id, sum(worth) as density from (select m.request, m.id, m.b, {weight} / (1 + (max(m.e) - m.b) - (count(*) - 1)) as worth from {name}_min m join {name}_occ o on o.request = m.request and o.id = m.id and o.p between m.b and m.e group by 1, 2, 3) group by 1, 2),
 {name} as (select d.*, round(coalesce(n.density, 0) + {boost}, 6) as score from {name}_doc d left join {name}_den n using (request, id))"""


_ITEM_BOOST = "case when lower(coalesce(title, '')) = lower(query) then 3.0 when lower(content) = lower(query) then 2.5 when lower(coalesce(canonical_key, '')) = lower(query) then 2.25 else 0 end"
_DAILY_BOOST = "case when lower(content) = lower(query) then 2.5 else 0 end"
_STRICT = f"""live as (select * from items where status = 'active'), {_strict('si', 'live', lex(SEARCH_TEXT), _ITEM_BOOST)},
 ranked as (select *, row_number() over (partition by request order by score desc, importance desc nulls last, updated_at desc nulls last, id)::int as rank from si)"""
_DAILY = f"""open_entries as (select * from entries where source_kind <> 'session_memory'), {_strict('sd', 'open_entries', lex('content'), _DAILY_BOOST)},
 dranked as (select *, row_number() over (partition by request order by score desc, logical_date desc nulls last, updated_at desc nulls last, id)::int as rank from sd)"""


@query("ret01_srt01_strict_items", f"with {ITEMS}, {_ASKED}, {_STRICT} select request, id, score, rank from ranked where rank <= 10")
def ret01(spark, d):
    return search.strict_items(table(spark, d, "memory_items"), _requests(spark, d)).select("request", "id", "score", "rank")


@query("ret02_srt02_strict_daily", f"with {ITEMS}, {ENTRIES}, {_ASKED}, {_DAILY} select request, id, score, rank from dranked where rank <= 10")
def ret02(spark, d):
    return search.strict_daily(table(spark, d, "memory_daily_entries"), _requests(spark, d)).select("request", "id", "score", "rank")


_STOP = "['a', 'an', 'and', 'are', 'did', 'do', 'does', 'i', 'is', 'me', 'my', 'of', 'the', 'to', 'what', 'which', 'who', 'как', 'какая', 'какие', 'какой', 'какое', 'меня', 'мне', 'мой', 'мои', 'моя', 'мое', 'моё', 'у', 'что']"
_FORMS = rf"""f0 as (select k, orig, list_filter(list_distinct_in_order, lambda w: w <> '') as kept from (select k, orig, list_filter(ws, lambda w, i: list_position(ws, w) = i) as list_distinct_in_order from (select k, orig, list_filter(regexp_extract_all(lower(orig), '[\p{{L}}\p{{N}}_@.-]+'), lambda w: length(w) >= 2 and not list_contains({_STOP}, w)) as ws from source))),
 f1 as (select k, list_concat(list_transform(range(1, len(kept)), lambda i: kept[i::int] || ' ' || kept[i::int + 1]), kept) as cs, lower(trim(orig)) as o from f0 where len(kept) >= 2),
 forms as (select k, list_filter(list_filter(cs, lambda c, i: list_position(cs, c) = i), lambda c: c <> o)[1:12] as fs from f1)"""


@query("ret03_relaxed_queries", f"with {ITEMS}, source as (select id as k, title as orig from items where title is not null), {_FORMS} select s.k as id, coalesce(array_to_string(fs, '|'), '') as forms from source s left join forms using (k)")
def ret03(spark, d):
    return items(spark, d).where("title is not null").select("id", F.array_join(T.relaxed_queries(F.col("title")), "|").alias("forms"))


@query("ret04_prj05_fuzzy_items")
def ret04(spark, d):
    asked = _requests(spark, d, forms=False).withColumn("query", F.regexp_replace(F.lower("query"), r"(\p{L}{3})\p{L}(\p{L}{2})", "$1$2"))
    return search.fuzzy_items(table(spark, d, "memory_items"), asked).select("request", "id", "score", "rank")


# the cascade without its last tier, which SQL would need best extents of trigrams for
_BASE_ASKED = "base_asked as (select * from asked)"
_HITS = "select request, 'memory' as corpus, id, 'db-memory/items/' || id || '.md' as path, score, importance, updated_at from ranked where rank <= 10 union all select request, 'daily', id, path, score, null, updated_at from dranked where rank <= 10"
_HIT_ORDER = "score desc, (corpus = 'memory')::int desc, case when corpus = 'memory' then coalesce(importance, 0) end desc nulls last, case when corpus = 'memory' then updated_at end desc nulls last, path"


def _tiers(parts: str, hits: str) -> str:
    """Two tiers as one statement: all hits of strict and relaxed forms, then of each request the lowest tier that has any."""
    relaxed = parts.replace("asked r on", "all_asked r on")
    forms = _FORMS.replace("from source", "from (select request as k, query as orig from asked)")
    return f"""{forms}, all_asked as (select request || '|0' as request, user_id, workspace_id, query, q, request as base, 0 as form from asked union all
  select request || '|' || (form + 1), user_id, workspace_id, query, list_distinct({lex('query')}), request, form + 1 from (select a.request, a.user_id, a.workspace_id, unnest(f.fs) as query, unnest(range(0, len(f.fs))) as form from asked a join forms f on f.k = a.request)),
 {relaxed}, hits as ({hits}), tiered as (select a.base as request, h.* exclude (request), a.form, least(a.form, 1) + 1 as tier from hits h join all_asked a using (request)),
 best as (select * from tiered qualify tier = min(tier) over (partition by request) and row_number() over (partition by request, corpus, id, tier order by score desc, form) = 1),
 final as (select *, row_number() over (partition by request order by {_HIT_ORDER})::int as rank from best)"""


@query("ret05_srt05_set01_cascade", f"with {ITEMS}, {ENTRIES}, {_ASKED}, {_tiers(_STRICT + ', ' + _DAILY, _HITS)} select request, tier, corpus, id, score, rank from final where rank <= 10")
def ret05(spark, d):
    hits = search.cascade(table(spark, d, "memory_items"), table(spark, d, "memory_daily_entries"), _requests(spark, d))
    return hits.where("tier < 3").select("request", "tier", "corpus", "id", "score", "rank")


@query("ret05_cascade")
def ret05_all(spark, d):
    """All three tiers."""
    return search.cascade(table(spark, d, "memory_items"), table(spark, d, "memory_daily_entries"), _requests(spark, d)).select("request", "tier", "corpus", "id", "score", "rank")


@query("ret06_agg04_set03_daily_cascade", f"with {ITEMS}, {ENTRIES}, {_ASKED}, {_tiers(_DAILY, _HITS.split('union all ')[1].replace('null, updated_at', 'null as importance, updated_at').replace(chr(39) + 'daily' + chr(39) + ',', chr(39) + 'daily' + chr(39) + ' as corpus,'))} select request, tier, corpus, id, score, rank from final where rank <= 10")
def ret06(spark, d):
    return search.daily_cascade(table(spark, d, "memory_daily_entries"), _requests(spark, d)).select("request", "tier", "corpus", "id", "score", "rank")


def _vector_requests(spark, d):
    """Per scope and profile, the vector of its smallest item."""
    live = items(spark, d).select("user_id", "workspace_id", "id")
    emb = embeddings(spark, d).where(search.is_usable(F.col("embedding"), F.col("dimensions")))
    mine = live.join(emb.select(F.col("memory_item_id").alias("id"), "profile_key", "embedding").hint("merge"), "id")
    return mine.groupBy("user_id", "workspace_id", "profile_key").agg(F.min_by("embedding", "id").alias("vector")).withColumn("request", F.concat_ws("#", "workspace_id", "profile_key"))


_SEMANTIC = """u as (select i.user_id, i.workspace_id, i.id, i.version, i.importance, i.updated_at, i.status, e.profile_key, e.embedding, e.memory_item_version as v, e.dimensions from items i join emb e on e.memory_item_id = i.id
  where len(e.embedding) = e.dimensions and len(e.embedding) > 0 and len(list_filter(e.embedding, lambda x: x is null or not isfinite(x))) = 0),
 vq as (select user_id, workspace_id, profile_key, min_by(embedding, id) as vector from u group by 1, 2, 3),
 sem as (select q.workspace_id || '#' || q.profile_key as request, u.id, round(list_cosine_similarity(u.embedding::double[], q.vector::double[]), 6) as score, importance, updated_at from u join vq q using (user_id, workspace_id, profile_key) where status = 'active' and version is not distinct from v
  and len(list_filter(u.embedding, lambda x: x <> 0)) > 0 and len(list_filter(q.vector, lambda x: x <> 0)) > 0 and len(q.vector) = u.dimensions),
 semantic as (select *, row_number() over (partition by request order by score desc, importance desc nulls last, updated_at desc nulls last, id)::int as rank from sem)"""


@query("ret07_srt04_semantic", f"with {ITEMS}, {EMBEDDINGS}, {_SEMANTIC} select request, id, score, rank from semantic where rank <= 10")
def ret07(spark, d):
    return search.semantic(table(spark, d, "memory_items"), table(spark, d, "memory_item_embeddings"), _vector_requests(spark, d)).select("request", "id", "score", "rank")


def _text_vectors(spark, d):
    """Vector requests under the names of the text requests: those with the title as query."""
    v = _vector_requests(spark, d).where("profile_key = 'local:mini-64'")
    return v.withColumn("request", F.concat(F.col("workspace_id"), F.lit("#0")))


_LISTS = f"""{_STRICT}, {_DAILY}, merged0 as ({_HITS}), lexical as (select *, row_number() over (partition by request order by {_HIT_ORDER})::int as rank from merged0),
 near as (select replace(request, '#local:mini-64', '#0') as request, id, score, importance, updated_at, rank from semantic where rank <= 10 and ends_with(request, '#local:mini-64'))"""


@query("ret08_agg05_win02_fusion", f"""with {ITEMS}, {ENTRIES}, {EMBEDDINGS}, {_ASKED}, {_SEMANTIC}, {_LISTS},
 parts as (select request, corpus, id, path, score as own, 1 as lexical_first, importance, updated_at, 1.0::double / (60 + rank) as r, rank as lex from lexical where rank <= 10 union all select request, 'memory', id, 'db-memory/items/' || id || '.md', score, 0, importance, updated_at, 1.0::double / (60 + rank), null from near),
 sums as (select request, id, sum(r) as rrf, min(lex) as lex from parts group by 1, 2), rep as (select * from parts qualify row_number() over (partition by request, id order by own desc, lexical_first desc) = 1),
 merged as (select s.request, s.id, rep.corpus, rep.path, rep.importance, rep.updated_at, rep.own, s.lex, h.request is not null as hybrid, round(case when h.request is not null then s.rrf else rep.own end, 9) as score from sums s join rep using (request, id) left join (select distinct request from near) h on h.request = s.request),
 fused as (select *, row_number() over (partition by request order by case when not hybrid then lex end nulls first, {_HIT_ORDER})::int as rank from merged)
 select request, corpus, id, score, own as shown_score, rank from fused where rank <= 10""")
def ret08(spark, d):
    asked = _requests(spark, d)
    i, e = table(spark, d, "memory_items"), table(spark, d, "memory_daily_entries")
    a = search._items_as_hits(search.strict_items(i, asked)).unionByName(search._daily_as_hits(search.strict_daily(e, asked)))
    lexical = search._ranked(a, search.hit_order(), 10)
    vector = search.semantic(i, table(spark, d, "memory_item_embeddings"), _text_vectors(spark, d)).withColumn("corpus", F.lit("memory"))
    return search.fuse(lexical, vector).select("request", "corpus", "id", "score", "shown_score", "rank")


_SESSION = f"""sc as (select c.*, max(created_at) over (partition by user_id, workspace_id, path) as file_updated_at from chunks c),
 {_strict('st', 'sc', lex('text'), '0', 0.4)}, {_strict('sp', 'sc', lex('path'), '0', 1.0)},
 smet as (select x.*, r.request from (select *, {lex('text')} || {lex('path')} as doc from sc) x join asked r on x.user_id = r.user_id and x.workspace_id = r.workspace_id where len(r.q) > 0 and list_has_all(x.doc, r.q)),
 sall as (select m.request, m.id, m.path, m.chunk_index, m.start_line, m.end_line, m.text, m.file_updated_at, round(coalesce(a.score, 0) + coalesce(b.score, 0), 6) as score from smet m left join st a using (request, id) left join sp b using (request, id)),
 sranked as (select *, row_number() over (partition by request order by score desc, file_updated_at desc nulls last, path, chunk_index, id)::int as rank from sall)"""


def _session_requests(spark, d):
    """Requests that transcripts can answer: the longest word of the first chunk of every scope, and two common words."""
    c = chunks(spark, d).where("text is not null").groupBy("user_id", "workspace_id").agg(F.min_by("text", "id").alias("text"))
    longest = F.array_max(F.transform(T.lexemes(F.col("text")), lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"]
    rows = c.select("user_id", "workspace_id", F.posexplode(F.array(longest, F.lit("Look first"))).alias("n", "query")).where("query is not null")
    return rows.select(F.concat_ws("#", "workspace_id", F.col("n").cast("string")).alias("request"), "user_id", "workspace_id", "query")


_SESSION_ASKED = rf"""sasked as (select user_id, workspace_id, arg_min(text, id) as text from chunks where text is not null group by 1, 2),
 asked as (select workspace_id || '#' || n as request, user_id, workspace_id, query, list_distinct({lex('query')}) as q from (select *, unnest([0, 1]) as n, unnest([list_reverse_sort(list_transform({lex('text')}, lambda w: {{'n': length(w), 'w': w}}))[1].w, 'Look first']) as query from sasked) where query is not null)"""


@query("ret10_srt03_jon04_session_index", f"with {CHUNKS}, {_SESSION_ASKED}, {_SESSION} select request, id, score, rank from sranked where rank <= 10")
def ret10(spark, d):
    return search.session_hits(table(spark, d, "session_index_chunks"), _session_requests(spark, d)).select("request", "id", "score", "rank")


def _lines(spark, d):
    """Lines of transcript files: numbered message rows, the session key as the name that may be shown."""
    m = table(spark, d, "session_messages").where("line_no is not null and session_id is not null and content is not null")
    one = m.groupBy("user_id", "workspace_id", "agent_id", "session_id", "line_no").agg(F.min_by(F.struct(F.col("content").alias("text"), "session_key"), "row_id").alias("l"), F.max("ingested_at").alias("at"))
    rows = one.select("user_id", "workspace_id", F.concat_ws("/", F.lit("sessions"), "agent_id", F.concat("session_id", F.lit(".jsonl"))).alias("path"), "line_no", "l.text", "l.session_key", "at")
    return rows.withColumn("mtime", F.max("at").over(Window.partitionBy("user_id", "workspace_id", "path"))).drop("at")


_LINES = """ln0 as (select user_id, workspace_id, concat_ws('/', 'sessions', agent_id, session_id || '.jsonl') as path, line_no, arg_min(content, row_id) as text, arg_min(coalesce(session_key, ''), row_id) as session_key, max(ingested_at) as seen_at from session_messages where line_no is not null and session_id is not null and content is not null group by user_id, workspace_id, agent_id, session_id, line_no),
 lines as (select *, max(seen_at) over (partition by user_id, workspace_id, path) as mtime from ln0)"""
_SCAN = """hit_lines as (select r.request, l.path, min(l.line_no) as line_no, max(l.mtime) as mtime from lines l join asked r on l.user_id = r.user_id and l.workspace_id = r.workspace_id where trim(r.query) <> '' and contains(lower(l.text), lower(trim(r.query))) group by 1, 2),
 scanned as (select *, row_number() over (partition by request order by mtime desc, path)::int as rank from hit_lines)"""


@query("ret11_first_line_scan", f"with {CHUNKS}, {_SESSION_ASKED}, {_LINES}, {_SCAN} select request, path, line_no as start_line, rank from scanned where rank <= 10")
def ret11(spark, d):
    return routing.first_lines(_lines(spark, d), _session_requests(spark, d)).select("request", "path", "start_line", "rank")


def _half(spark, d):
    """Only scopes whose id is in the first half have an index."""
    return table(spark, d, "session_index_chunks").where("workspace_id < '8'")


@query("ret12_fallback_gate", f"with {CHUNKS}, {_SESSION_ASKED} select request from asked a where not exists (select 1 from chunks c where c.workspace_id < '8' and c.user_id = a.user_id and c.workspace_id = a.workspace_id)")
def ret12(spark, d):
    return routing.without_index(_session_requests(spark, d), _half(spark, d)).select("request")


_HALF = "chunks as (select * from session_index_chunks where workspace_id < '8' qualify row_number() over (partition by id order by created_at desc nulls last) = 1)"
_ALL_CHUNKS = CHUNKS.replace("chunks as", "every_chunk as")
_FALLBACK = f"{_ALL_CHUNKS}, {_HALF}, {_SESSION_ASKED.replace('from chunks', 'from every_chunk')}, {_SESSION}, {_LINES}, {_SCAN}"


@query("ret13_sessions_corpus", f"""with {_FALLBACK} select request, path, 'sessions_index' as mode, rank from sranked where rank <= 10 union all select request, path, 'sessions_fallback', rank from scanned s where rank <= 10 and not exists (select 1 from asked a join chunks c on c.user_id = a.user_id and c.workspace_id = a.workspace_id where a.request = s.request)""")
def ret13_sessions(spark, d):
    corpus = routing.Corpus(items=table(spark, d, "memory_items"), chunks=_half(spark, d), lines=_lines(spark, d))
    return routing.routed("sessions", corpus, _session_requests(spark, d)).select("request", "path", "mode", "rank")


def _corpus(spark, d):
    return routing.Corpus(*[table(spark, d, n) for n in ("memory_items", "memory_daily_entries", "memory_item_embeddings", "session_index_chunks")])


_ALL = f"""{ITEMS}, {ENTRIES}, {CHUNKS}, {_ASKED.replace('[0, 1, 2]', '[0, 1]').replace(", 'what is the exact ' || lower(title) || ' zzzq'", '')}, {_STRICT}, {_DAILY}, merged0 as ({_HITS}), lexical as (select *, row_number() over (partition by request order by {_HIT_ORDER})::int as rank from merged0), {_SESSION},
 allhits as (select request, corpus, id, path, score from lexical where rank <= 10 union all select request, 'sessions', id, path, score from sranked where rank <= 10)"""


def _answered(spark, d):
    """Requests that strict search answers, so that SQL can say the same as the cascade."""
    asked = _requests(spark, d, forms=False)
    i, e = search.strict_items(table(spark, d, "memory_items"), asked).select("request"), search.strict_daily(table(spark, d, "memory_daily_entries"), asked).select("request")
    return asked.join(i.union(e).distinct(), "request", "left_semi")


_ANSWERED = "answered as (select distinct request from merged0)"


@query("ret13_flt12_srt07_all_corpus", f"with {_ALL}, {_ANSWERED}, r as (select b.*, row_number() over (partition by request order by score desc, (corpus = 'sessions')::int, path, id)::int as rank from allhits b join answered using (request)) select request, corpus, path, score, 'all_merge_lexical' as mode from r where rank <= 10 and score >= 0.05")
def ret13_all(spark, d):
    return routing.routed("all", _corpus(spark, d), _answered(spark, d), min_score=0.05).select("request", "corpus", "path", "score", "mode")


@query("ret14_srt06_prj03_manager", f"""with {_ALL}, {_ANSWERED}, m as (select b.request, b.id, b.path, b.score, case when corpus = 'sessions' then 'sessions' else 'memory' end as source, case when s.start_line > 0 then s.start_line else 1 end as start_line from allhits b join answered using (request) left join chunks s on b.corpus = 'sessions' and s.id = b.id)
 select request, id, path, source, start_line, rank from (select *, row_number() over (partition by request order by score desc, source, path, id)::int as rank from m where score >= 0.02) where rank <= 10""")
def ret14(spark, d):
    return routing.manager(_corpus(spark, d), _answered(spark, d), ("memory", "sessions"), min_score=0.02).select("request", "id", "path", "source", "start_line", "rank")


@query("prj07_advice", f"""with {ITEMS}, {ENTRIES}, {_ASKED}, {_STRICT}, {_DAILY}, merged0 as ({_HITS}), lexical as (select *, row_number() over (partition by request order by {_HIT_ORDER})::int as rank from merged0), answered as (select distinct request from merged0),
 top as (select l.request, case when l.corpus = 'memory' then i.title else e.path end as title, case when l.corpus = 'memory' then case when length(i.content) > 240 then substr(i.content, 1, 240) || '…' else i.content end else case when length(e.content) > 240 then substr(e.content, 1, 240) || '…' else e.content end end as snippet from lexical l left join items i on l.corpus = 'memory' and i.id = l.id left join entries e on l.corpus = 'daily' and e.id = l.id where l.rank = 1)
 select request, exact as exact_top1, case when exact then trim(title) end as exact_value, case when exact then 'return_exact' else 'inspect_top' end as action from (select a.request, coalesce(lower(trim(t.title)) = lower(trim(a.query)) or lower(trim(t.snippet)) = lower(trim(a.query)), false) as exact, t.title from asked a join answered using (request) join top t using (request))""")
def prj07(spark, d):
    asked = _requests(spark, d)
    hits = routing.routed("memory", routing.Corpus(table(spark, d, "memory_items"), table(spark, d, "memory_daily_entries")), asked)
    strict = search.strict_items(table(spark, d, "memory_items"), asked).select("request").union(search.strict_daily(table(spark, d, "memory_daily_entries"), asked).select("request")).distinct()
    return routing.advice(hits, asked.join(strict, "request", "left_semi"))


_MARKED = r"(regexp_matches(trim({0}), '^[A-Z0-9]+(_[A-Z0-9]+){{2,}}$') or regexp_matches(trim({0}), '^@\w{{3,}}$') or regexp_matches(trim({0}), '^[0-9]{{6,}}$'))"


@query("srt08_exact_order", f"""with {ITEMS}, h as (select id, user_id, workspace_id, 'db-memory/items/' || id || '.md' as path, case when ord(id) % 3 = 0 then upper(replace(id, '-', '_')) else title end as title, content as snippet, (importance % 5)::double as score, importance, updated_at from items)
 select id, row_number() over (partition by user_id, workspace_id order by score + case when coalesce({_MARKED.format('title')}, false) or coalesce({_MARKED.format('snippet')}, false) then 2 else 0 end desc, coalesce(importance, 0) desc, updated_at desc nulls last, path)::int as place from h where score is not null""")
def srt08(spark, d):
    title = F.when(F.ascii("id") % 3 == 0, F.upper(F.translate("id", "-", "_"))).otherwise(F.col("title"))
    h = items(spark, d).select("id", "user_id", "workspace_id", F.lit("memory").alias("corpus"), F.concat(F.lit("db-memory/items/"), "id", F.lit(".md")).alias("path"), title.alias("title"), F.col("content").alias("snippet"), (F.col("importance") % 5).cast("double").alias("score"), "importance", "updated_at")
    return h.where("score is not null").withColumn("place", F.row_number().over(Window.partitionBy("user_id", "workspace_id").orderBy(*routing.exact_order()))).select("id", "place")


@query("prj06_visible_output", f"""with {CHUNKS}, {ENTRIES}, h as (select id, 'sessions' as corpus, path, substr(text, 1, 60) as snippet, start_line, end_line, null as source_kind, 'k' as canonical_key, chunk_index / 7.0 as score, chunk_index + 1 as rank from chunks union all select id, 'daily', path, substr(content, 1, 60), null, null, source_kind, null, 0.5, 1 from entries),
 c as (select *, case when coalesce(path, '') = '' then '' else path || '#L' || coalesce(start_line, 1) || case when end_line > coalesce(start_line, 1) then '-L' || end_line else '' end end as cite from h)
 select id, cite as citation, case when coalesce(snippet, '') <> '' then snippet || chr(10) || chr(10) || case when corpus = 'daily' then 'Scope: date-specific daily memory.' || case when source_kind = 'session_memory' then chr(10) || 'Entry type: session capture from /new or /reset.' else '' end else 'Canonical key: k' end
  || case when cite <> '' then chr(10) || chr(10) || 'Source: ' || case when corpus = 'daily' then 'DB daily entry ' else '' end || cite else '' end else '' end as shown, rank || '. [' || case when corpus = 'daily' then 'daily DB entry' else corpus end || '] ' || cite || ' (score ' || printf('%.3f', score::double) || ')' as line from c""")
def prj06(spark, d):
    none = F.lit(None)
    a = chunks(spark, d).select("id", F.lit("sessions").alias("corpus"), "path", F.substring("text", 1, 60).alias("snippet"), "start_line", "end_line", none.cast("string").alias("source_kind"), F.lit("k").alias("canonical_key"), (F.col("chunk_index") / 7.0).alias("score"), (F.col("chunk_index") + 1).alias("rank"))
    b = entries(spark, d).select("id", F.lit("daily").alias("corpus"), "path", F.substring("content", 1, 60).alias("snippet"), none.cast("int").alias("start_line"), none.cast("int").alias("end_line"), "source_kind", none.cast("string").alias("canonical_key"), F.lit(0.5).alias("score"), F.lit(1).alias("rank"))
    return routing.visible_output(a.unionByName(b)).select("id", "citation", "shown", "line")


@query("ret09_backlog_search")
def ret09(spark, d):
    """Missing vectors of the newest items are made before the search, here by a hash of the words; the rest is queued."""

    def embed(rows):
        dims = F.array(*[(F.pmod(F.xxhash64("content", F.lit(i)), F.lit(1000)) / 500.0 - 1).cast("float") for i in range(64)])
        return rows.select(F.col("id").alias("memory_item_id"), F.lit("local:mini-64").alias("profile_key"), dims.alias("embedding"), F.col("version").alias("memory_item_version"), F.lit(64).alias("dimensions"), F.current_timestamp().alias("updated_at"))

    hits, _, queue = routing.with_backlog(_corpus(spark, d), _text_vectors(spark, d), embed, "local:mini-64")
    return hits.select("request", "id", "rank").unionByName(queue.select(F.col("workspace_id").alias("request"), F.col("reason").alias("id"), F.col("missing").cast("int").alias("rank")))


@query("ret15_jon11_known_candidates", rf"""with {ITEMS}, {BLANKS_SQL}, act as (select *, lower(trim(regexp_replace(content, '[\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{0085}}\x{{000b}}]+', ' ', 'g'))) as same, {lex(SEARCH_TEXT)} as doc from items where status = 'active'),
 cand as (select id as cid, user_id, workspace_id, 'note' as type, case when ord(id) % 4 = 0 then canonical_key end as canonical_key, case ord(id) % 3 when 0 then replace(content, ' ', '  ') when 1 then split_part(content, '.', 1) else content || ' zzzq' end as content from items where content is not null),
 c as (select *, lower(trim(regexp_replace(content, '[\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{0085}}\x{{000b}}]+', ' ', 'g'))) as same, list_distinct({lex('content')}) as q from cand),
 top as (select c.cid, c.same as mine, a.same, row_number() over (partition by c.cid order by len(list_filter(a.doc, lambda w: list_contains(c.q, w)))::double / len(a.doc) desc, a.id) as n from c join act a on a.user_id = c.user_id and a.workspace_id = c.workspace_id where len(c.q) > 0 and list_has_all(a.doc, c.q))
 select distinct cid from (select cid from c join act a using (user_id, workspace_id, type, canonical_key) union all select cid from c join act a using (user_id, workspace_id, same) union all select cid from c where coalesce(same, '') = '' union all select cid from top where n <= 3 and same <> '' and (contains(same, mine) or contains(mine, same)))""")
def ret15(spark, d):
    said = F.when(F.ascii("id") % 3 == 0, F.replace("content", F.lit(" "), F.lit("  "))).when(F.ascii("id") % 3 == 1, F.substring_index("content", ".", 1)).otherwise(F.concat("content", F.lit(" zzzq")))
    cand = items(spark, d).where("content is not null").select(F.col("id").alias("cid"), "user_id", "workspace_id", F.lit("note").alias("type"), F.when(F.ascii("id") % 4 == 0, F.col("canonical_key")).alias("canonical_key"), said.alias("content"))
    return routing.known_candidates(cand, table(spark, d, "memory_items"))


# ---- imports -----------------------------------------------------------------------------------
@query("imp01_imp03_markdown_items")
def imp01(spark, d):
    docs = table(spark, d, "documents").where("source in ('memory_export', 'legacy_import', 'durable_item', 'daily_note')")
    blocks = reading.markdown_items(docs, "doc_id", "text")
    return blocks.select("doc_id", "block", "title", "type", "canonical_key", reading.import_key(F.col("canonical_key"), F.col("content")).alias("import_key"))


@query("imp02_stubs", f"with {BLANKS_SQL} select doc_id, trim(regexp_replace(text, '<!--.*?-->', '', 'gs'), blanks) = '' as stub, trim(regexp_replace(text, '[^<>!-]', '', 'g') || '<!-- x -->', blanks) <> '' as marked from documents, blanks where text is not null")
def imp02(spark, d):
    marks = F.concat(F.regexp_replace("text", "[^<>!-]", ""), F.lit("<!-- x -->"))
    return table(spark, d, "documents").where("text is not null").select("doc_id", (T.without_comments(F.col("text")) == "").alias("stub"), (T.whole_trim(marks) != "").alias("marked"))
