"""Transcripts: files, text, captures, the session index, and updates as a stream."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mnemolake.functions import scalars as S
from mnemolake.functions import text as T
from mnemolake.functions import transcript_text as X
from mnemolake.operators import reading, selection
from mnemolake.operators.normal_times import with_instant
from mnemolake.queries.common import CHUNKS, chunks, registry
from mnemolake.runtime import shared_path, table
from mnemolake.sources import transcripts
from mnemolake.streaming import growth, schedules

QUERIES, SQL, query = registry()


def _messages(spark, d):
    return table(spark, d, "session_messages").where("record_type = 'message'")


def _files(spark, d):
    """Session messages written as the JSON lines of one file per session.

    Numbered lines come first, by number; the others follow by instant and ``row_id``, as in p1. Of
    repeated lines (same number, or without number same instant, role and content) the smallest ``row_id`` stands.
    """
    m = with_instant(_messages(spark, d).where("session_id is not null"), table(spark, d, "workspaces"))
    role = F.lower(F.trim("role"))
    lost = F.col("line_no").isNull()
    same = Window.partitionBy("session_id", "line_no", *[F.when(lost, c) for c in (F.col("instant"), role, F.col("content"))]).orderBy("row_id")
    m = m.withColumn("copy", F.row_number().over(same)).where("copy = 1")
    line = F.to_json(F.struct(F.lit("message").alias("type"), "timestamp", F.struct(role.alias("role"), "content", F.from_json("provenance", "kind string").alias("provenance")).alias("message")))
    ordered = F.array_sort(F.collect_list(F.struct(lost.alias("lost"), "line_no", F.col("instant").isNull().alias("unread"), F.when(lost, F.col("instant")).alias("at"), "row_id", line.alias("line"))))
    return m.groupBy(F.concat(F.lit("sessions/"), "agent_id", F.lit("/"), "session_id", F.lit(".jsonl")).alias("path")).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("value"))


_NAMES = """names as (select distinct n || s as name from (select split_part(path, '/', -1) as n, unnest(['', '.reset.2026-01-02T03-04-05.678Z', '.deleted.2026-01-02T03-04-05Z', '.reset.1', '.bak.2026-01-02T03-04-05Z', '.reset.x.jsonl']) as s from chunks where path is not null)
 union select unnest(['sessions.json', 'a.trajectory.jsonl', 'b.checkpoint.01234567-89ab-4cde-8f01-23456789abcd.jsonl', 'b.checkpoint.x.jsonl', 'notes.md']))"""


@query("src02_transcript_files", rf"""with {CHUNKS}, {_NAMES} select name, case when regexp_matches(name, '\.reset\.\d{{4}}-\d\d-\d\dT\d\d-\d\d-\d\d(\.\d{{3}})?Z$') then 'reset' when regexp_matches(name, '\.deleted\.\d{{4}}-\d\d-\d\dT\d\d-\d\d-\d\d(\.\d{{3}})?Z$') then 'deleted' else 'primary' end as kind from names
 where regexp_matches(name, '\.(reset|deleted)\.\d{{4}}-\d\d-\d\dT\d\d-\d\d-\d\d(\.\d{{3}})?Z$') or (ends_with(name, '.jsonl') and name <> 'sessions.json' and not ends_with(name, '.trajectory.jsonl') and not regexp_matches(name, '(?i)^.+\.checkpoint\.[0-9a-f]{{8}}-[0-9a-f]{{4}}-[1-5][0-9a-f]{{3}}-[89ab][0-9a-f]{{3}}-[0-9a-f]{{12}}\.jsonl$'))""")
def src02(spark, d):
    name = F.element_at(F.split("path", "/"), -1)
    forms = F.array(*[F.lit(x) for x in ("", ".reset.2026-01-02T03-04-05.678Z", ".deleted.2026-01-02T03-04-05Z", ".reset.1", ".bak.2026-01-02T03-04-05Z", ".reset.x.jsonl")])
    names = chunks(spark, d).where("path is not null").select(F.explode(F.transform(forms, lambda f: F.concat(name, f))).alias("name"))
    more = spark.createDataFrame([(n,) for n in ("sessions.json", "a.trajectory.jsonl", "b.checkpoint.01234567-89ab-4cde-8f01-23456789abcd.jsonl", "b.checkpoint.x.jsonl", "notes.md")], "name string")
    return names.union(more).distinct().withColumn("kind", reading.transcript_kind(F.col("name"))).where("kind is not null")


_KEYS = "keys as (select distinct agent_id, session_id, session_key || x as key from (select *, unnest(['', ':run:7', ':cron:n:run:7:x']) as x from session_messages where session_id is not null and session_key is not null and agent_id is not null) union select agent_id, session_id, 'agent:' || agent_id || ':dreaming-narrative-' || session_id from session_messages where session_id < '2' and agent_id is not null)"


@query("src07_txt18_jon13_generated_sessions", rf"with {_KEYS} select agent_id, session_id as stem, bool_or(starts_with(regexp_replace(trim(key), '^[^:]*:[^:]*:', ''), 'dreaming-narrative-')) as dream, bool_or(regexp_matches(key, '^agent:[^:]+:cron:[^:]+:run:[^:]+(:|$)')) as cron from keys group by 1, 2")
def src07(spark, d):
    m = table(spark, d, "session_messages").where("session_id is not null and session_key is not null and agent_id is not null").select("agent_id", "session_id", "session_key").distinct()
    forms = F.array(F.lit(""), F.lit(":run:7"), F.lit(":cron:n:run:7:x"))
    keys = m.select("agent_id", "session_id", F.explode(F.transform(forms, lambda f: F.concat("session_key", f))).alias("key"))
    dreams = table(spark, d, "session_messages").where("session_id < '2' and agent_id is not null").select("agent_id", "session_id", F.concat(F.lit("agent:"), "agent_id", F.lit(":dreaming-narrative-"), "session_id").alias("key"))
    # one JSON object per entry of a store; half of the entries name the file instead of the id
    entry = F.when(F.ascii("session_id") % 2 == 0, F.struct(F.col("session_id").alias("sessionId"), F.lit(None).cast("string").alias("sessionFile"))).otherwise(F.struct(F.lit(None).cast("string").alias("sessionId"), F.concat(F.lit("/x/"), "session_id", F.lit(".jsonl")).alias("sessionFile")))
    stores = keys.union(dreams).select("agent_id", F.to_json(F.create_map("key", entry)).alias("json"))
    return transcripts.generated_stems(stores)


@query("src03_json_lines", """select row_id, json_extract_string(provenance, '$.kind') as kind from session_messages where provenance is not null and json_valid(provenance) and regexp_matches(provenance, '^\\s*\\{')""".replace("\\\\", "\\"))
def src03(spark, d):
    """Each row as a file of three lines: broken, blank and the row's own."""
    m = table(spark, d, "session_messages").where("provenance is not null")
    own = F.concat(F.lit('{"message": {"role": "user", "provenance": '), "provenance", F.lit("}}"))
    lines = transcripts.parsed_lines(m.select(F.col("row_id").cast("string").alias("path"), F.concat(F.lit("{broken\r\n\n"), own).alias("value")))
    return lines.where("line_no = 3").select(F.col("path").cast("bigint").alias("row_id"), F.col("record.message.provenance.kind").alias("kind"))


@query("txt03_message_text", r"""select row_id, case when regexp_matches(content, '^\s*\[\s*\{') then case when json_valid(content) then case when len(p) > 0 then array_to_string(p, chr(10)) end end else content end as text
 from (select row_id, content, case when regexp_matches(content, '^\s*\[\s*\{') and json_valid(content) then list_transform(list_filter(from_json(content, '["json"]'), lambda x: json_extract_string(x, '$.type') = 'text' and json_extract_string(x, '$.text') is not null), lambda x: json_extract_string(x, '$.text')) end as p from session_messages where record_type = 'message')""")
def txt03(spark, d):
    return _messages(spark, d).select("row_id", X.message_parts(F.col("content")).alias("text"))


@query("txt04_txt05_txt06_txt07_txt09_txt11_visible_text")
def txt11(spark, d):
    """Every message of the two speakers; machines' blocks, silent replies and secrets are gone."""
    role = F.lower(F.trim("role"))
    return _messages(spark, d).where(role.isin("user", "assistant")).select("row_id", X.visible_text(X.message_parts(F.col("content")), role).alias("text"))


@query("txt08_txt10_system_texts", r"""select row_id, regexp_matches(c, '^System(?: \(untrusted\))?: \[[^\]]+\]\s*') as system, regexp_matches(c, '^\[cron:[^\]]+\]\s*') as cron, regexp_matches(regexp_replace(c, '^\s+', ''), '(?i)^exec finished(?::|\s*\()') or regexp_matches(regexp_replace(c, '^\s+', ''), '(?is)^exec (completed|failed) \([a-z0-9_-]{1,64}, (code -?\d+|signal [^)]+)\)( :: .*)?$') as exec_event
 from (select row_id, (['', 'System: [x] ', '[cron:7] ', 'Exec finished: ', ' exec completed (a-1, code 0) :: ', 'exec failed (b, signal 9)'])[1 + row_id % 6] || content as c from session_messages where content is not null)""")
def txt08(spark, d):
    heads = F.array(*[F.lit(x) for x in ("", "System: [x] ", "[cron:7] ", "Exec finished: ", " exec completed (a-1, code 0) :: ", "exec failed (b, signal 9)")])
    m = table(spark, d, "session_messages").where("content is not null").withColumn("c", F.concat(F.get(heads, (F.col("row_id") % 6).cast("int")), "content"))
    return m.select("row_id", X.is_system_message(F.col("c")).alias("system"), X.is_cron_prompt(F.col("c")).alias("cron"), X.is_exec_event(F.col("c")).alias("exec_event"))


def _capture_sql(c: str, all_markers: bool) -> str:
    """The capture rules in SQL; roles one by one, since its patterns have no references."""
    tool = r"(?:(?:\|DSML\|)|(?:｜DSML｜))?(?:tool_calls?|function_calls?|tool_use_error)"
    steps = [(r"<[|｜][^|｜]*[|｜]>", ""), (rf"(?is)<{tool}\b[^>]*>.*?(?:</{tool}>|\z)", "")]
    steps += [(rf"(?is)<{r}\b[^>]*>.*?</{r}>", "") for r in ("system", "assistant", "user")]
    steps += [(r"(?i)</?(?:system|assistant|user)\b[^>]*>", ""), (r"(?i)(^|\n)\s*<media:[^>]+>(?:\s*\([^)]*\))?\s*", r"\1"), (r"(?i)(?:^|\n)\s*NO_REPLY\s*\z", "")]
    steps += [(r"(?i)\bNO_REPLY\b", "")] if all_markers else []
    out = c
    for pattern, by in [*steps, (r"[ \t]+\n", "\n"), (r"\n{3,}", "\n\n"), (r"^[\s\x{00a0}\x{feff}]+|[\s\x{00a0}\x{feff}]+\z", "")]:
        out = f"regexp_replace({out}, '{pattern}', '{by}', 'g')"
    silent = rf"regexp_matches({c}, '(?i)^\s*NO_REPLY\s*\z') or regexp_matches({c}, '(?i)^\s*\{{\s*\"action\"\s*:\s*\"\s*NO_REPLY\s*\"\s*\}}\s*\z')"
    return f"case when not coalesce({silent}, false) then nullif({out}, '') end"


@query("txt13_capture_text", f"select row_id, {_capture_sql('content', False)} as text, {_capture_sql('content', True)} as bare from session_messages where record_type = 'message'")
def txt13(spark, d):
    return _messages(spark, d).select("row_id", X.capture_text(F.col("content")).alias("text"), X.capture_text(F.col("content"), True).alias("bare"))


@query("txt14_captured_messages")
def txt14(spark, d):
    m = _messages(spark, d).where("session_id is not null").withColumn("role", F.lower(F.trim("role")))
    return transcripts.captured_messages(m, ["session_id"], [F.col("ingested_at"), F.col("row_id")], (F.col("provider") == "host") & (F.col("model") == "delivery-mirror"))


_TURNS = rf"""docs as (select doc_id, string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)) as ls from documents where source = 'session_capture' and text is not null), ln as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as n from docs),
 fr as (select *, min(case when trim(line) = '### Conversation Summary' then n end) over (partition by doc_id) as f from ln), tn as (select *, sum(regexp_matches(line, '^(user|assistant):(\s|$)')::int) over (partition by doc_id order by n) as t from fr where f is null or n > f),
 tx as (select doc_id, t, string_agg(line, chr(10) order by n) as x from tn where t > 0 group by 1, 2), sa as (select doc_id, t, regexp_extract(x, '^(user|assistant):', 1) as role, {_capture_sql("regexp_replace(x, '^(user|assistant):" + chr(92) + "s?', '')", True)} as text from tx),
 kept as (select * from (select *, lag(role) over w as r0, lag(text) over w as x0 from sa where text is not null window w as (partition by doc_id order by t)) where not coalesce(role = 'assistant' and r0 = 'assistant' and x0 = text, false)), turns as (select doc_id, row_number() over (partition by doc_id order by t)::int as turn, role, text from kept)"""


@query("txt15_capture_turns", f"with {_TURNS} select * from turns")
def txt15(spark, d):
    return selection.capture_turns(table(spark, d, "documents").where("source = 'session_capture'"), "doc_id", "text")


@query("bud05_recent_tail", f"""with {_TURNS}, r as (select *, role || ': ' || text as l, sum(length(role || ': ' || text) + 1) over (partition by doc_id order by turn desc) - 1 as used, count(*) over (partition by doc_id) as n from turns),
 k as (select doc_id, string_agg(l, chr(10) order by turn) as body, count(*) as shown, max(used) as used, max(n) as n from r where used <= 400 group by 1) select doc_id, case when shown < n and used + 1 + 40 <= 400 then '...[earlier session messages omitted]...' || chr(10) || body else body end as text, shown::int as shown from k""")
def bud05(spark, d):
    return selection.recent_tail(txt15(spark, d), "doc_id", 400)


@query("snk22_str09_session_captures", """with m as (select distinct session_id, agent_id, min(ingested_at) over (partition by session_id, agent_id) as seen from session_messages where record_type = 'message' and session_id is not null and agent_id is not null),
 s as (select *, substr(sha256('{"agentId":"' || agent_id || '","sessionKey":null,"sessionId":"' || session_id || '","sessionFile":null,"fallbackContentSha256":null}'), 1, 32) as source_id from m)
 select session_id, agent_id, source_id, 'memory/' || strftime(seen, '%Y-%m-%d') || '-' || strftime(seen, '%H%M') || '-' || substr(source_id, 1, 8) || '-session-capture.md' as path from s""")
def snk22(spark, d):
    m = _messages(spark, d).where("session_id is not null and agent_id is not null").groupBy("session_id", "agent_id").agg(F.min("ingested_at").alias("at"))
    none = F.lit(None).cast("string")
    s = m.withColumn("source_id", S.capture_source_id(F.col("agent_id"), none, F.col("session_id"), none, none))
    path = F.concat(F.lit("memory/"), F.date_format("at", "yyyy-MM-dd-HHmm"), F.lit("-"), F.substring("source_id", 1, 8), F.lit("-session-capture.md"))
    return s.select("session_id", "agent_id", "source_id", path.alias("path"))


@query("src03_txt12_txt17_index_chunks")
def txt17(spark, d):
    return transcripts.chunks(transcripts.visible_lines(transcripts.parsed_lines(_files(spark, d))))


@query("txt17_index_entries")
def txt17_entries(spark, d):
    files = _files(spark, d)
    return transcripts.entries(transcripts.chunks(transcripts.visible_lines(transcripts.parsed_lines(files))), files)


_SYNC = f"""{CHUNKS}, f as (select path, sha256(string_agg(text, chr(10) order by chunk_index, id)) as hash from chunks where path is not null group by 1), old as (select path, case when hash < '8' then hash else 'x' end as hash from f where hash < 'c'), new as (select * from f where hash > '2'),
 acts as (select coalesce(n.path, o.path) as path, case when n.path is null then case when starts_with(o.path, 'sessions/main/') then 'removed' else 'kept' end when o.path is null then 'indexed' when o.hash = n.hash then 'skipped' else 'updated' end as action from new n full join old o on n.path = o.path)"""


def _sync(spark, d):
    c = chunks(spark, d).where("path is not null")
    ordered = F.array_sort(F.collect_list(F.struct("chunk_index", "id", "text")))
    f = c.groupBy("path").agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["text"]), "\n"), 256).alias("hash"))
    old = f.where("hash < 'c'").select("path", F.when(F.col("hash") < "8", F.col("hash")).otherwise("x").alias("hash"))
    return c, old, f.where("hash > '2'"), transcripts.synced(old, f.where("hash > '2'"), "main")


@query("snk10_snk11_jon10_sync_actions", f"with {_SYNC} select * from acts")
def snk10(spark, d):
    return _sync(spark, d)[3].select("path", "action")


@query("snk09_snk10_snk11_agg10_sync", f"with {_SYNC} select split_part(path, '/', 2) as agent, count_if(action in ('indexed', 'updated')) as indexed, count_if(action = 'updated') as updated, count_if(action = 'skipped') as skipped, count_if(action = 'removed') as removed from acts group by 1")
def agg10(spark, d):
    actions = _sync(spark, d)[3]
    return transcripts.sync_counts(actions.withColumn("agent", F.get(F.split("path", "/"), F.lit(1))), ["agent"])


@query("snk09_replaced_chunks", f"""with {_SYNC}, oldc as (select 'old-' || id as id, c.path from chunks c join old using (path)), newc as (select id, c.path from chunks c join new using (path))
 select id, path from newc join acts using (path) where action in ('indexed', 'updated') union all select id, path from oldc join acts using (path) where action in ('skipped', 'kept')""")
def snk09(spark, d):
    c, old, new, actions = _sync(spark, d)
    old_chunks = c.join(old.select("path"), "path", "left_semi").select(F.concat(F.lit("old-"), "id").alias("id"), "path")
    return transcripts.synced_tables(actions, old_chunks, c.join(new.select("path"), "path", "left_semi").select("id", "path"))[1]


@query("rd02_agg12_session_pages", f"""with {CHUNKS}, c as (select path, start_line, chunk_index, id, coalesce(text, '') as text, row_number() over (partition by path, start_line, chunk_index order by id) as dup from chunks where path is not null), u as (select * from c where dup = 1),
 h as (select *, row_number() over w as i, sum(length(text) + 1) over w - 1 as e from u where start_line >= 2 and start_line < 42 window w as (partition by path order by start_line, chunk_index)), k as (select *, e <= 300 or i = 1 as keep from h),
 l as (select path, start_line, bool_and(keep) as whole from k group by 1, 2), g as (select path, string_agg(text, chr(10) order by i) filter (keep) as t, max(e) filter (i = 1) as e1, bool_and(keep) as everything from k group by 1),
 b as (select path, min(start_line) as beyond from u where start_line >= 42 group by 1), s as (select path, min(start_line) as from_line, count_if(whole) as n, min(start_line) filter (not whole) as inside from l group by 1),
 o as (select p.path, coalesce(s.from_line, 2) as from_line, case when e1 > 300 then case when s.inside is null or s.inside > s.from_line then 1 else 0 end else coalesce(s.n, 0) end as page_lines, coalesce((e1 > 300 or not everything or beyond is not null) and t is not null, false) as truncated, t, e1, coalesce(inside, beyond) as nx from (select distinct path from chunks where path is not null) p left join g using (path) left join s using (path) left join b using (path)),
 q as (select *, case when t is not null and not coalesce(e1 > 300, false) and page_lines > 0 then nx end as next_from, coalesce(substr(t, 1, 300), '') as body from o)
 select path, from_line, page_lines, truncated, next_from, case when truncated and body <> '' then body || chr(10) || chr(10) || coalesce('[More content available. Use from=' || next_from || ' to continue.]', '[More content available. Requested excerpt exceeded the default maxChars budget.]') else body end as page from q""")
def rd02(spark, d):
    c = chunks(spark, d).where("path is not null").groupBy("path", "start_line", "chunk_index").agg(F.min_by("text", "id").alias("text"))
    return reading.session_page(c, ["path"], 2, 40, 300)


# ---- updates -----------------------------------------------------------------------------------
def _updates(spark, d):
    m = _messages(spark, d).where("session_id is not null")
    total = F.sum(F.length(F.coalesce("content", F.lit("")))).over(Window.partitionBy("session_id").orderBy("row_id"))
    return m.select(F.col("row_id").alias("seq"), F.concat(F.lit("sessions/"), "agent_id", F.lit("/"), "session_id", F.lit(".jsonl")).alias("path"), total.cast("bigint").alias("size"), F.lit(1).cast("bigint").alias("messages"), "agent_id", F.col("ingested_at").alias("at"))


_UPDATES = "u as (select row_id as seq, 'sessions/' || agent_id || '/' || session_id || '.jsonl' as path, sum(length(coalesce(content, ''))) over (partition by session_id order by row_id)::bigint as size, agent_id, ingested_at as at from session_messages where record_type = 'message' and session_id is not null)"


@query("str04_str05_win05_dirty_files", f"""with recursive {_UPDATES}, s as (select path, seq, size, row_number() over (partition by path order by seq) as k from u where path is not null),
 st as (select path, 0::bigint as k, 0::bigint as last, 0::bigint as b, 0::bigint as m, 0::bigint as seq, false as dirty from (select distinct path from s) union all
  select n.path, n.k, n.size, case when x.dirty then greatest(0, x.nb - 500) else x.nb end, case when x.dirty then greatest(0, x.nm - 6) else x.nm end, n.seq, x.dirty from st p join s n on n.path = p.path and n.k = p.k + 1,
   lateral (select nb, nm, nb >= 500 or nm >= 6 as dirty from (select nb, p.m + case when nb < 500 then 1 else 0 end as nm from (select p.b + case when n.size >= p.last then n.size - p.last else n.size end as nb))) x)
 select path, seq, b as pending_bytes, m as pending_messages from st where dirty""")
def str04(spark, d):
    base = shared_path(spark, "growth")
    updates = _updates(spark, d).drop("at")
    updates.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(updates.schema).parquet(f"{base}/in")
    return growth.drain(growth.dirty_files(stream, max_bytes=500, max_messages=6), base)


@query("str03_latest_updates", f"with {_UPDATES} select path, seq, size from u qualify row_number() over (partition by path order by seq desc) = 1")
def str03(spark, d):
    return growth.latest_updates(_updates(spark, d)).select("path", "seq", "size")


@query("str02_routed_updates", f"""with {_UPDATES}, r as (select seq, path, case when seq % 7 = 0 then 'path' when seq % 11 = 0 then 'agent' when agent_id not in ('main', 'ops', 'writer') then 'workspace' else 'kept' end as outcome from u where agent_id is not null),
 n as (select *, row_number() over (partition by case when outcome = 'path' then 'x' else path end, outcome order by seq) as k from r) select outcome, count(*) as n, count_if(outcome <> 'kept' and (k in (1, 5) or k % 20 = 0)) as warnings from n group by 1""")
def str02(spark, d):
    targets = spark.createDataFrame([(a, "w") for a in ("main", "ops", "writer")], "agent_id string, workspace string")
    u = _updates(spark, d).where("agent_id is not null")
    u = u.withColumns({"path": F.when(F.col("seq") % 7 == 0, "x").otherwise(F.col("path")), "agent_id": F.when((F.col("seq") % 11 == 0) & (F.col("seq") % 7 != 0), "nobody").otherwise(F.col("agent_id"))})
    kept, rejected = growth.routed(u, targets)
    counts = kept.select(F.lit("kept").alias("outcome")).unionByName(rejected.select(F.col("reason").alias("outcome"))).groupBy("outcome").agg(F.count("*").alias("n"))
    warned = growth.throttled(rejected).groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("warnings"))
    return counts.join(warned, "outcome", "left").select("outcome", "n", F.coalesce("warnings", F.lit(0)).alias("warnings"))


@query("agg11_update_targets", f"with {_UPDATES}, l as (select 'w-' || substr(path, 10, 1) as workspace, agent_id, path, max(seq) as seq from u where agent_id is not null group by 1, 2, 3) select workspace, agent_id, string_agg(path, ',' order by seq) as paths from l group by 1, 2")
def agg11(spark, d):
    u = _updates(spark, d).where("agent_id is not null").withColumn("workspace", F.concat(F.lit("w-"), F.substring("path", 10, 1)))
    return growth.by_target(u).select("workspace", "agent_id", F.array_join("paths", ",").alias("paths"))


@query("agg08_pending_totals", f"with {_UPDATES}, l as (select agent_id, path, max(size) as b, count(*) as m from u group by 1, 2) select agent_id, sum(b)::bigint as pending_bytes, sum(m)::bigint as pending_messages, count(*) as files from l group by 1")
def agg08(spark, d):
    states = _updates(spark, d).groupBy("agent_id", "path").agg(F.max("size").alias("pending_bytes"), F.sum("messages").alias("pending_messages"))
    return growth.pending_totals(states, ["agent_id"])


_CONSUMERS = [("a", "2025-10-01 00:00:00", None), ("b", "2026-01-15 00:00:00", "2026-04-01 00:00:00"), ("c", "2026-02-20 00:00:00", "2026-03-01 00:00:00"), ("d", "2026-06-01 00:00:00", None)]


@query("str01_newest_consumer", f"""with {_UPDATES}, c as (select * from (values ('a', timestamptz '2025-10-01 00:00:00+00', null::timestamptz), ('b', timestamptz '2026-01-15 00:00:00+00', timestamptz '2026-04-01 00:00:00+00'), ('c', timestamptz '2026-02-20 00:00:00+00', timestamptz '2026-03-01 00:00:00+00'), ('d', timestamptz '2026-06-01 00:00:00+00', null)) v(consumer, o, x))
 select seq, (select arg_max(consumer, o) from c where o <= u.at and (x is null or x > u.at)) as consumer from u""")
def str01(spark, d):
    c = spark.createDataFrame(_CONSUMERS, "consumer string, opened_at string, closed_at string")
    c = c.withColumns({n: F.col(n).cast("timestamp") for n in ("opened_at", "closed_at")})
    return schedules.newest_consumer(_updates(spark, d).select("seq", "at"), c).select("seq", "consumer")


@query("str06_retries", f"""with {_UPDATES}, o as (select path as target, seq, seq % 4 = 0 as ok from u where path is not null), r as (select *, coalesce(sum(ok::int) over (partition by target order by seq rows between unbounded preceding and 1 preceding), 0) as run from o),
 a as (select target, seq, case when not ok then row_number() over (partition by target, run order by seq) end as attempt from r) select target, seq, attempt::int as attempt, case when attempt is not null then least(2000 * pow(2, attempt - 1), 30000) end::bigint as retry_ms from a""")
def str06(spark, d):
    o = _updates(spark, d).where("path is not null").select(F.col("path").alias("target"), "seq", (F.col("seq") % 4 == 0).alias("ok"))
    return schedules.retries(o).select("target", "seq", "attempt", "retry_ms")


@query("str07_bootstraps", f"""with {_UPDATES}, r as (select distinct case when seq % 2 = 0 then 'current' else 'visible' end as visibility, 'w-' || substr(path, 10, 1) as workspace, agent_id from u where agent_id is not null)
 select visibility, workspace, case when visibility = 'visible' then agent_id || ',zz' else agent_id end as agents from r where not (visibility = 'current' and agent_id = 'main')""")
def str07(spark, d):
    u = _updates(spark, d).where("agent_id is not null")
    who = F.when(F.col("seq") % 2 == 0, F.array("agent_id")).otherwise(F.array(F.lit("zz"), "agent_id"))
    asked = u.select(F.when(F.col("seq") % 2 == 0, "current").otherwise("visible").alias("visibility"), F.concat(F.lit("w-"), F.substring("path", 10, 1)).alias("workspace"), who.alias("agents"))
    none = spark.createDataFrame([], "key string")
    done = schedules.to_bootstrap(asked, none).where("visibility = 'current' and agents[0] = 'main'").select("key")
    return schedules.to_bootstrap(asked, done).select("visibility", "workspace", F.array_join("agents", ",").alias("agents"))


def _triggers(spark, d):
    return _updates(spark, d).where("agent_id is not null").select("agent_id", F.unix_millis("at").alias("at_ms"), "seq")


_EVENTS = f"with recursive {_UPDATES}, e as (select agent_id, epoch_us(u.at) // 1000 as ms, case when seq % 5 = 0 then 'drop' else 'read' end as kind, seq from u where agent_id is not null)"


@query("str10_maintenance_runs", f"""{_EVENTS}, o as (select agent_id, ms, row_number() over (partition by agent_id order by ms) as k from e),
 st as (select distinct agent_id, 0::bigint as k, -1::bigint as free, -1::bigint as last, null::bigint as run from o union all
  select n.agent_id, n.k, case when n.ms >= p.free then n.ms + 3600000 when n.ms > p.last then p.free + 3600000 else p.free end, case when n.ms >= p.free then n.ms when n.ms > p.last then p.free else p.last end, case when n.ms >= p.free then n.ms when n.ms > p.last then p.free end from st p join o n on n.agent_id = p.agent_id and n.k = p.k + 1)
 select agent_id, run as start_ms from st where run is not null""")
def str10(spark, d):
    return schedules.maintenance_runs(_triggers(spark, d), "agent_id", 3_600_000)


@query("str12_cache_outcomes", f"""{_EVENTS}, o as (select *, row_number() over (partition by agent_id order by ms, kind, seq) as k from e),
 st as (select distinct agent_id, 0::bigint as k, null::bigint as loaded, null::varchar as outcome from o union all
  select n.agent_id, n.k, case when n.kind = 'drop' then null when n.ms < p.loaded + 60000 then p.loaded else n.ms end, case when n.kind = 'drop' then null when n.ms < p.loaded + 60000 then 'hit' else 'load' end from st p join o n on n.agent_id = p.agent_id and n.k = p.k + 1)
 select agent_id, outcome, count(*) as n from st where outcome is not null group by 1, 2""")
def str12(spark, d):
    events = _triggers(spark, d).select("agent_id", "at_ms", F.when(F.col("seq") % 5 == 0, "drop").otherwise("read").alias("kind"))
    return schedules.cache_outcomes(events, "agent_id").groupBy("agent_id", "outcome").agg(F.count("*").alias("n"))
