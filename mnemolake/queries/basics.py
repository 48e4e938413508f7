"""Scans, predicates, projections, joins, aggregations, sets and scalars over the memory tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mnemolake.functions import scalars as S
from mnemolake.functions import text as T
from mnemolake.operators import daily, reading, records, search
from mnemolake.queries.common import CHUNKS, EMBEDDINGS, ENTRIES, ITEMS, SEARCH_TEXT, chunks, embeddings, entries, items, lex
from mnemolake.runtime import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return keep


# ---- scans -------------------------------------------------------------------------------------
@query("src01_scoped_scan", f"with {ITEMS} select i.user_id, i.workspace_id, i.id, i.type from items i join workspaces w on i.user_id = w.user_id and i.workspace_id = w.id where w.is_default")
def src01(spark, d):
    scopes = table(spark, d, "workspaces").where("is_default").select("user_id", F.col("id").alias("workspace_id"))
    return items(spark, d).join(scopes, ["user_id", "workspace_id"]).select("user_id", "workspace_id", "id", "type")


@query("src10_ordinality", f"with {ITEMS} select id, generate_subscripts(tags, 1) as place, unnest(tags) as tag from items")
def src10(spark, d):
    return items(spark, d).select("id", F.posexplode("tags").alias("p", "tag")).select("id", (F.col("p") + 1).cast("bigint").alias("place"), "tag")


_TRIMMED = r"regexp_replace(regexp_replace(replace(content, chr(13) || chr(10), chr(10)), '^\s+', ''), '\s+$', '')"
_WINDOWS = rf"""wins as (select id, (s // 640)::int as window_index, s::int as char_start, least(s + 768, length(t))::int as char_end, sha256(substr(t, s::int + 1, 768)) as window_sha256
 from (select id, t, unnest(range(0, length(t), 640)) as s from (select id, {_TRIMMED} as t from entries where content is not null) where length(t) > 0))"""


@query("src11_wnd01_windows", f"with {ENTRIES}, {_WINDOWS} select * from wins")
def wnd01(spark, d):
    return daily.windows(entries(spark, d), "id", "content")


# ---- predicates --------------------------------------------------------------------------------
@query("flt01_live", f"with {ITEMS} select status, count(*) as n from items where status = 'active' group by 1")
def flt01(spark, d):
    return items(spark, d).where("status = 'active'").groupBy("status").agg(F.count("*").alias("n"))


@query("flt02_null_safe", f"with {ITEMS} select a.id from items a where a.session_id is not distinct from null or a.title is distinct from a.canonical_key")
def flt02(spark, d):
    return items(spark, d).where(F.col("session_id").eqNullSafe(F.lit(None)) | ~F.col("title").eqNullSafe(F.col("canonical_key"))).select("id")


@query("flt03_membership", f"with {ITEMS} select id, type from items where type in ('fact', 'preference') and source not in ('system', 'integration')")
def flt03(spark, d):
    return items(spark, d).where(F.col("type").isin("fact", "preference") & ~F.col("source").isin("system", "integration")).select("id", "type")


@query("flt05_all_lexemes", f"with {ITEMS} select id from items where list_has_all({lex(SEARCH_TEXT)}, ['the', 'look'])")
def flt05(spark, d):
    doc = T.lexemes(T.search_text(F.col("title"), F.col("content"), F.col("canonical_key")))
    return items(spark, d).where(T.matches_all(doc, F.array(F.lit("the"), F.lit("look")))).select("id")


@query("flt07_like", f"with {ITEMS} select id from items where lower({SEARCH_TEXT}) like '%re_order%' or lower({SEARCH_TEXT}) like '%look at%'")
def flt07(spark, d):
    st = F.lower(T.search_text(F.col("title"), F.col("content"), F.col("canonical_key")))
    return items(spark, d).where(st.like("%re_order%") | st.like("%look at%")).select("id")


@query("flt08_path_prefix", f"with {CHUNKS} select id from chunks where starts_with(path, 'sessions/main/')")
def flt08(spark, d):
    return chunks(spark, d).where(F.col("path").startswith("sessions/main/")).select("id")


@query("flt09_hidden_kinds", f"with {ENTRIES} select source_kind, count(*) as n from entries where source_kind not in ('session_memory') group by 1")
def flt09(spark, d):
    return entries(spark, d).where(~F.col("source_kind").isin("session_memory")).groupBy("source_kind").agg(F.count("*").alias("n"))


@query("flt10_regex_and_key", rf"with {ENTRIES} select id, regexp_matches(path, '^memory/\d{{4}}-\d\d-\d\d\.md$') as is_page, coalesce(list_contains(json_keys(metadata), 'lines'), false) as has_lines from entries where json_valid(metadata)")
def flt10(spark, d):
    has = F.coalesce(F.array_contains(F.json_object_keys("metadata"), "lines"), F.lit(False))
    return entries(spark, d).select("id", F.col("path").rlike(r"^memory/\d{4}-\d\d-\d\d\.md$").alias("is_page"), has.alias("has_lines"))


@query("flt14_durable", f"with {ITEMS} select id from items where length(trim(content)) >= 48 and regexp_matches(lower(trim(content)), '{'|'.join(T.SIGNALS)}')")
def flt14(spark, d):
    return items(spark, d).where(T.is_durable(F.col("content"))).select("id")


@query("prj01_hits", f"""with {ITEMS} select 'memory' as corpus, 'db-memory/items/' || id || '.md' as path, id, title, type as kind, case when length(content) > 240 then substr(content, 1, 240) || '…' else content end as snippet from items""")
def prj01(spark, d):
    return items(spark, d).select(F.lit("memory").alias("corpus"), F.concat(F.lit("db-memory/items/"), "id", F.lit(".md")).alias("path"), "id", "title", F.col("type").alias("kind"), T.snippet(F.col("content")).alias("snippet"))


@query("prj02_session_snippets", f"""with {CHUNKS} select id, case when length(substr(text, 1, 240)) = 240 then substr(text, 1, 240) || '…' else substr(text, 1, 240) end as snippet from chunks""")
def prj02(spark, d):
    cut = F.substring("text", 1, 240)
    return chunks(spark, d).select("id", F.when(F.length(cut) == 240, F.concat(cut, F.lit("…"))).otherwise(cut).alias("snippet"))


# ---- joins -------------------------------------------------------------------------------------
@query("jon01_current_vectors", f"with {ITEMS}, {EMBEDDINGS} select i.id, e.profile_key from items i join emb e on i.id = e.memory_item_id where i.version is not distinct from e.memory_item_version and i.status = 'active'")
def jon01(spark, d):
    i, e = items(spark, d).where("status = 'active'"), embeddings(spark, d)
    return i.join(e, i["id"] == e["memory_item_id"]).where(F.col("version").eqNullSafe(F.col("memory_item_version"))).select(i["id"], "profile_key")


@query("jon02_agg01_backlog", f"""with {ITEMS}, {EMBEDDINGS} select state, count(*) as n from (select case when e.memory_item_id is null then 'missing' else 'stale' end as state from items i left join (select * from emb where profile_key = 'local:mini-64') e on i.id = e.memory_item_id
 where i.status = 'active' and (e.memory_item_id is null or e.memory_item_version is distinct from i.version or e.dimensions is distinct from coalesce(len(e.embedding), -1))) group by 1""")
def jon02(spark, d):
    return records.embedding_backlog(items(spark, d), embeddings(spark, d), "local:mini-64").groupBy("state").agg(F.count("*").alias("n"))


@query("jon12_shared_workspaces", f"with {CHUNKS}, g as (select distinct workspace_id, agent_id from chunks) select a.agent_id, b.agent_id as peer, count(*) as workspaces from g a join g b on a.workspace_id = b.workspace_id and a.agent_id < b.agent_id group by all")
def jon12(spark, d):
    g = chunks(spark, d).select("workspace_id", "agent_id").distinct()  # a handful of agents a workspace
    peers = g.withColumnRenamed("agent_id", "peer")
    return g.join(peers, "workspace_id").where("agent_id < peer").groupBy("agent_id", "peer").agg(F.count("*").alias("workspaces"))


# ---- aggregations ------------------------------------------------------------------------------


@query("agg03_by_type", f"with {ITEMS} select type, count(*) as n from items group by 1")
def agg03(spark, d):
    return items(spark, d).groupBy("type").agg(F.count("*").alias("n"))


@query("agg06_newest_per_day", f"with {ENTRIES} select user_id, workspace_id, logical_date, id from entries qualify row_number() over (partition by user_id, workspace_id, logical_date order by updated_at desc, id) = 1")
def agg06(spark, d):
    return records.first_by_key(entries(spark, d), ["user_id", "workspace_id", "logical_date"], [F.col("updated_at").desc(), F.col("id")]).select("user_id", "workspace_id", "logical_date", "id")


@query("agg07_distinct_in_order", f"with {ITEMS} select id, array_to_string(list_filter(tags, lambda t, i: list_position(tags, t) = i), ',') as tags from items where tags is not null")
def agg07(spark, d):
    return items(spark, d).where("tags is not null").select("id", F.array_join(F.array_distinct("tags"), ",").alias("tags"))


@query("win01_sel02_startup", f"""with {ENTRIES}, hits as (select e.*, e.path = 'memory/' || e.logical_date || '.md' as is_exact from entries e where regexp_matches(e.logical_date, '^\\d{{4}}-\\d\\d-\\d\\d$') and (e.path = 'memory/' || e.logical_date || '.md' or (starts_with(e.path, 'memory/' || e.logical_date || '-') and e.path like '%.md')))
 select id, is_exact, place from (select *, row_number() over (partition by user_id, workspace_id, logical_date, is_exact order by updated_at desc, path desc, id desc)::int as place from hits) where is_exact or place <= 4""".replace("\\\\", "\\"))
def win01(spark, d):
    e = entries(spark, d)
    days = e.where(F.col("logical_date").rlike(r"^\d{4}-\d\d-\d\d$")).select("user_id", "workspace_id", F.col("logical_date").alias("day")).distinct()
    return daily.startup_entries(e, days).select("id", "is_exact", "place")


# ---- orders ------------------------------------------------------------------------------------


@query("srt16_last_messages", "select session_id, row_id from session_messages where session_id is not null qualify row_number() over (partition by session_id order by ingested_at desc, row_id desc) <= 15")
def srt16(spark, d):
    w = Window.partitionBy("session_id").orderBy(F.col("ingested_at").desc(), F.col("row_id").desc())
    return table(spark, d, "session_messages").where("session_id is not null").withColumn("n", F.row_number().over(w)).where("n <= 15").select("session_id", "row_id")


# ---- sets --------------------------------------------------------------------------------------
@query("set01_union", f"with {ITEMS}, {ENTRIES} select 'memory' as corpus, id from items union all select 'daily', id from entries")
def set01(spark, d):
    return items(spark, d).select(F.lit("memory").alias("corpus"), "id").unionByName(entries(spark, d).select(F.lit("daily").alias("corpus"), "id"))


@query("set04_difference", f"with {CHUNKS} select distinct user_id, workspace_id from workspaces_chunks except select user_id, workspace_id from memory_items".replace("workspaces_chunks", "chunks"))
def set04(spark, d):
    return chunks(spark, d).select("user_id", "workspace_id").distinct().join(table(spark, d, "memory_items").select("user_id", "workspace_id").distinct(), ["user_id", "workspace_id"], "left_anti")


@query("set05_trigram_similarity", f"""with {ITEMS}, g as (select id, title, list_distinct(flatten(list_transform({lex('title')}, lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i::int, 3))))) as a, ['  b', ' bu', 'bud', 'udg', 'dge', 'get', 'et '] as b from items where title is not null)
 select id, round(len(list_intersect(a, b)) / greatest(1, len(list_distinct(list_concat(a, b)))), 6) as similarity from g""")
def set05(spark, d):
    sim = T.trigram_similarity(T.trigrams(F.col("title")), T.trigrams(F.lit("budget")))
    return items(spark, d).where("title is not null").select("id", F.round(sim, 6).alias("similarity"))


# ---- scalars -----------------------------------------------------------------------------------
@query("scl01_scl07_hashes", f"with {ENTRIES} select id, sha256(content) as content_hash, 'dir:' || sha256(path) as workspace_name, content_sha256 = sha256(content) as is_sound from entries")
def scl01(spark, d):
    return entries(spark, d).select("id", S.sha256(F.col("content")).alias("content_hash"), S.workspace_name(F.col("path")).alias("workspace_name"), (F.col("content_sha256") == S.sha256(F.col("content"))).alias("is_sound"))


@query("scl05_scl06_identity", r"select id, regexp_matches(id, '(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$') as is_uuid, sha256(lower(trim(display_name))) as identity from users")
def scl05(spark, d):
    return table(spark, d, "users").select("id", S.is_uuid(F.col("id")).alias("is_uuid"), S.identity(F.lit(None).cast("string"), F.col("display_name")).alias("identity"))


@query("scl08_scl09_scl13_local_days", """select i.id, strftime(timezone(z.tz, i.created_at), '%Y-%m-%d') as day, strftime(timezone(z.tz, i.created_at), '%H%M') as slug, strftime(timezone(z.tz, i.created_at)::date - 2, '%Y-%m-%d') as earlier
 from (select distinct id, workspace_id, created_at from memory_items) i join (select id, min(json_extract_string(metadata, '$.timezone')) as tz from workspaces group by 1) z on i.workspace_id = z.id""")
def scl08(spark, d):
    z = table(spark, d, "workspaces").groupBy(F.col("id").alias("workspace_id")).agg(F.min(F.get_json_object("metadata", "$.timezone")).alias("tz"))
    i = table(spark, d, "memory_items").select("id", "workspace_id", "created_at").distinct().join(z, "workspace_id")
    local = F.from_utc_timestamp("created_at", F.col("tz"))
    return i.select("id", F.date_format(local, "yyyy-MM-dd").alias("day"), F.date_format(local, "HHmm").alias("slug"), F.date_format(F.date_sub(local.cast("date"), 2), "yyyy-MM-dd").alias("earlier"))


@query("scl10_scl11_dates", rf"with {ENTRIES} select id, case when regexp_matches(logical_date, '^\d{{4}}-\d{{2}}-\d{{2}}$') then strftime(try_cast(logical_date as date), '%Y-%m-%d') end as explicit, nullif(regexp_extract(path, '^memory/(\d{{4}}-\d{{2}}-\d{{2}})\.md$', 1), '') as of_path from entries")
def scl10(spark, d):
    return entries(spark, d).select("id", S.explicit_date(F.col("logical_date")).alias("explicit"), S.path_date(F.col("path")).alias("of_path"))


@query("scl15_clamp", f"with {ITEMS} select id, greatest(10, least(90, coalesce(importance, 10)))::int as importance from items")
def scl15(spark, d):
    return items(spark, d).select("id", S.clamp(F.col("importance"), 10, 90).alias("importance"))


@query("scl16_cosine", f"""with {EMBEDDINGS}, u as (select memory_item_id as id, profile_key, embedding from emb where len(embedding) = dimensions and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
 q as (select profile_key, min(id) as id from u group by 1) select u.profile_key, u.id, round(list_cosine_similarity(u.embedding::double[], v.embedding::double[]), 5) as similarity from u join q using (profile_key) join u v on v.profile_key = q.profile_key and v.id = q.id""")
def scl16(spark, d):
    e = embeddings(spark, d).where(search.is_usable(F.col("embedding"), F.col("dimensions")) & F.exists("embedding", lambda x: x != 0)).select(F.col("memory_item_id").alias("id"), "profile_key", "embedding")
    first = e.groupBy("profile_key").agg(F.min_by("embedding", "id").alias("other"))  # three profiles
    return e.join(F.broadcast(first), "profile_key").select("profile_key", "id", F.round(search.cosine(F.col("embedding"), F.col("other")), 5).alias("similarity"))


@query("scl17_usable_vectors", f"with {EMBEDDINGS} select memory_item_id, profile_key, coalesce(len(embedding) = dimensions and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0, false) as usable from emb")
def scl17(spark, d):
    return embeddings(spark, d).select("memory_item_id", "profile_key", search.is_usable(F.col("embedding"), F.col("dimensions")).alias("usable"))


@query("scl18_backoff", f"with {ITEMS} select id, least(2000 * pow(2, version - 1), 30000)::bigint as delay from items")
def scl18(spark, d):
    return items(spark, d).select("id", S.backoff_ms(F.col("version")).alias("delay"))


@query("scl21_json_fields", f"with {ITEMS} select id, json_extract_string(metadata, '$.agent') as agent, coalesce(list_contains(json_keys(metadata), 'channel'), false) as has_channel from items where json_valid(metadata)")
def scl21(spark, d):
    has = F.coalesce(F.array_contains(F.json_object_keys("metadata"), "channel"), F.lit(False))
    return items(spark, d).where("metadata is not null").select("id", F.get_json_object("metadata", "$.agent").alias("agent"), has.alias("has_channel"))


@query("scl23_utf16_length", f"with {ITEMS} select id, (length(content) + length(regexp_replace(content, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))::int as units from items where content is not null".replace("\\\\", "\\"))
def scl23(spark, d):
    return items(spark, d).where("content is not null").select("id", T.utf16_length(F.col("content")).alias("units"))


@query("txt01_txt02_one_line", rf"with {ENTRIES} select id, trim(regexp_replace(content, '[\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{0085}}\x{{000b}}]+', ' ', 'g')) as line, lower(trim(regexp_replace(content, '[\s\x{{00a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}\x{{0085}}\x{{000b}}]+', ' ', 'g'))) as same from entries")
def txt01(spark, d):
    return entries(spark, d).select("id", T.one_line(F.col("content")).alias("line"), T.comparable(F.col("content")).alias("same"))


@query("txt16_slug", f"with {ITEMS} select id, regexp_replace(regexp_replace(lower(trim(title)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from items")
def txt16(spark, d):
    return items(spark, d).select("id", T.slugify(F.col("title")).alias("slug"))


@query("rd05_references", f"with {CHUNKS} select id, path, start_line as from_line, end_line as to_line from chunks")
def rd05(spark, d):
    ref = chunks(spark, d).select("id", F.concat("path", F.lit("#L"), F.col("start_line").cast("string"), F.lit("-L"), F.col("end_line").cast("string")).alias("ref"))
    return ref.select("id", *[c.alias(n) for n, c in reading.line_reference(F.col("ref")).items()])


@query("rd06_rd07_path_kinds", rf"with {ENTRIES}, {CHUNKS}, p as (select path from entries union all select path from chunks union all select 'db-memory/items/' || id || '.md' from memory_items) select case when regexp_matches(path, '(?i)^db-memory/items/[0-9a-f-]{{36}}\.md$') then 'item' when regexp_matches(path, '^sessions/[^/]+/[^/]+\.jsonl') then 'session' when starts_with(path, 'memory/') then 'daily' else 'other' end as kind, count(*) as n from p group by 1")
def rd06(spark, d):
    item_paths = table(spark, d, "memory_items").select(F.concat(F.lit("db-memory/items/"), "id", F.lit(".md")).alias("path"))
    paths = entries(spark, d).select("path").unionByName(chunks(spark, d).select("path")).unionByName(item_paths)
    return paths.groupBy(reading.path_kind(F.col("path")).alias("kind")).agg(F.count("*").alias("n"))
