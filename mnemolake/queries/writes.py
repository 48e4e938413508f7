"""Writes: items, audit, daily documents, imports, embeddings, queues, runs. SQL follows the rules, not the operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from mnemolake.functions import scalars as S
from mnemolake.functions import text as T
from mnemolake.operators import daily, records, selection
from mnemolake.queries.common import BLANKS_SQL, EMBEDDINGS, ENTRIES, ITEMS, embeddings, entries, items, registry
from mnemolake.runtime import shared_path, table

QUERIES, SQL, query = registry()

NOW, NOW_SQL = "2026-03-01 00:00:00", "timestamptz '2026-03-01 00:00:00+00'"


# ---- items -------------------------------------------------------------------------------------
def _writes(spark, d):
    """Every item as one write; keys are cut to two letters, so that several writes meet."""
    short = F.concat_ws("-", F.lit("k"), F.substring(F.regexp_replace("canonical_key", "[^a-z]", ""), 1, 2))
    return items(spark, d).withColumn("canonical_key", F.when(F.col("canonical_key").isNotNull(), short))


_KEYED = "w as (select * replace (case when canonical_key is not null then concat_ws('-', 'k', substr(regexp_replace(canonical_key, '[^a-z]', '', 'g'), 1, 2)) end as canonical_key) from items)"
_PART = "partition by user_id, workspace_id, namespace, type, canonical_key"


@query("snk01_upsert", f"""with {ITEMS}, {_KEYED}, g as (select *, coalesce(status = 'deleted', false) as gone from w), l as (select *, coalesce(sum(gone::int) over ({_PART} order by created_at, id rows between unbounded preceding and 1 preceding), 0) as life from g where canonical_key is not null)
 select arg_min(id, (created_at, id)) as id, arg_max(content, (created_at, id)) as content, count(*)::int as version from l group by user_id, workspace_id, namespace, type, canonical_key, life having not bool_or(gone)
 union all select id, content, 1 from g where canonical_key is null and not gone""")
def snk01(spark, d):
    return records.upserted(_writes(spark, d), [F.col("created_at"), F.col("id")]).select("id", "content", F.col("new_version").alias("version"))


@query("snk02_normalised_input", f"""with {ITEMS}, {BLANKS_SQL} select id, case when trim(coalesce(title, ''), blanks) <> '' then title else case when length(l) > 120 then substr(l, 1, 120) || '…' else l end end as title,
 case when type in ('fact', 'note') then type else 'note' end as type, case when trim(coalesce(namespace, ''), blanks) = '' then 'default' else trim(namespace, blanks) end as namespace, case when source in ('user', 'agent', 'migration', 'system', 'integration') then source else 'agent' end as source,
 case when tags is not null and len(list_filter(tags, lambda t: t is null)) = 0 then array_to_string(tags, ',') else '' end as tags, greatest(0, least(100, coalesce(importance, 50)))::int as importance, greatest(0, least(100, coalesce(confidence, 80)))::int as confidence
 from (select *, list_filter(list_transform(string_split(content, chr(10)), lambda x: trim(x, blanks)), lambda x: x <> '')[1] as l from items, blanks where trim(coalesce(content, ''), blanks) <> '')""")
def snk02(spark, d):
    return records.normalised_input(items(spark, d)).select("id", "title", "type", "namespace", "source", F.array_join("tags", ",").alias("tags"), "importance", "confidence")


@query("snk03_forget", f"with {ITEMS} select id, case when type = 'note' and status <> 'deleted' then 'deleted' else status end as status, type = 'note' and status <> 'deleted' as changed, version from items")
def snk03(spark, d):
    i = items(spark, d)
    return records.forgotten(i, i.where("type = 'note'").select("id")).select("id", "status", F.col("changed"), "version")


@query("snk04_audit", f"""with {ITEMS}, {_KEYED}, r as (select *, row_number() over ({_PART} order by created_at, id)::int as n, first(id) over ({_PART} order by created_at, id) as first_id, lag(content) over ({_PART} order by created_at, id) as old, lag(title) over ({_PART} order by created_at, id) as old_title from w where canonical_key is not null)
 select first_id as id, n as version, case when n = 1 then 'insert' else 'update' end as operation, sha256(old) as before_hash, old_title as before_title, sha256(content) as after_hash, importance as after_importance from r""")
def snk04(spark, d):
    trail = records.audit_trail(_writes(spark, d), [F.col("created_at"), F.col("id")])
    of = lambda c, p: F.get_json_object(c, p)
    return trail.select(
        "id", "version", "operation", F.sha2(of("before", "$.content"), 256).alias("before_hash"), of("before", "$.title").alias("before_title"),
        F.sha2(of("after", "$.content"), 256).alias("after_hash"), of("after", "$.importance").cast("smallint").alias("after_importance"),
    )


# ---- daily documents ---------------------------------------------------------------------------
def _notes(spark, d):
    """Entries as notes of the month they were written in, so that documents have many blocks of several kinds."""
    month = F.date_format("created_at", "yyyy-MM")
    return entries(spark, d).select("id", "user_id", "workspace_id", month.alias("logical_date"), "content", F.when(F.col("source_kind") != "memory_log", F.col("source_kind")).alias("source_kind"), "source_path", "created_at")


_NOTES = f"""{BLANKS_SQL}, notes as (select id, user_id, workspace_id, 'memory/' || strftime(created_at, '%Y-%m') || '.md' as path, strftime(created_at, '%Y-%m') as logical_date, trim(content, blanks) as content, source_kind, source_path,
 row_number() over (partition by user_id, workspace_id, strftime(created_at, '%Y-%m') order by created_at, id) - 1 as block_index, count(*) over (partition by user_id, workspace_id, strftime(created_at, '%Y-%m')) as n from entries, blanks where trim(content, blanks) <> '')"""
_ORDER = ["created_at", "id"]


def _blocks(spark, d):
    return daily.numbered(daily.logged(_notes(spark, d)), [F.col(c) for c in _ORDER])


@query("snk07_logged_notes", f"with {ENTRIES}, {_NOTES} select id, path, block_index, sha256(content) as content_sha256, source_kind from notes")
def snk07(spark, d):
    return _blocks(spark, d).select("id", "path", "block_index", F.sha2("content", 256).alias("content_sha256"), "source_kind")


@query("snk05_agg13_documents", rf"""with {ENTRIES}, {_NOTES} select user_id, workspace_id, path, sha256(string_agg(case when block_index = n - 1 then content else regexp_replace(content, '\s+$', '') end, chr(10) || chr(10) order by block_index)) as content_sha256, max(n) as blocks,
 case when count(distinct source_kind) > 1 then 'mixed' else max(source_kind) end as source_kind, case when count(distinct source_kind) = 1 then max_by(struct_pack(p := source_path), block_index).p end as source_path, max_by(id, block_index) as last_block_id from notes group by 1, 2, 3""")
def snk05(spark, d):
    return daily.documents(_blocks(spark, d)).select("user_id", "workspace_id", "path", "content_sha256", "blocks", "source_kind", "source_path", F.get_json_object("metadata", "$.lastBlockId").alias("last_block_id"))


@query("agg02_next_blocks", f"with {ENTRIES}, {_NOTES} select id, block_index + case when source_kind = 'memory_log' then coalesce(h, 0) else 0 end as block_index from (select a.id, a.source_kind, row_number() over (partition by a.user_id, a.workspace_id, a.path, a.source_kind = 'memory_log' order by a.block_index) - 1 as block_index, (select max(q) + 1 from (select row_number() over (order by b.block_index) - 1 as q from notes b where b.user_id = a.user_id and b.workspace_id = a.workspace_id and b.path = a.path and b.source_kind <> 'memory_log')) as h from notes a)")
def agg02(spark, d):
    notes = daily.logged(_notes(spark, d))
    order = [F.col(c) for c in _ORDER]
    held = daily.numbered(notes.where("source_kind <> 'memory_log'"), order)
    return held.unionByName(daily.numbered(notes.where("source_kind = 'memory_log'"), order, held)).select("id", "block_index")


@query("snk06_reject_policy", f"with {ENTRIES}, {_NOTES} select a.id from notes a where a.source_kind = 'legacy_import' and exists (select 1 from notes b where b.source_kind = 'memory_log' and b.user_id = a.user_id and b.workspace_id = a.workspace_id and b.path = a.path)")
def snk06(spark, d):
    b = _blocks(spark, d)
    return daily.rejected(b.where("source_kind = 'legacy_import'"), b.where("source_kind = 'memory_log'")).select("id")


@query("snk08_write_once", f"with {ENTRIES} select source_kind, count(*) as n from entries group by 1")
def snk08(spark, d):
    """A batch becomes visible whole or not at all: it is staged under its own number, and one that was committed before is not written again."""
    from mnemolake.operators.batches import BatchTable

    log = BatchTable(spark, shared_path(spark, "write-once"))
    rows = entries(spark, d).select("id", "source_kind")
    assert log.append(0, rows) and log.append(1, rows.limit(0)) and not log.append(0, rows)  # the second try of batch 0 changes nothing
    return log.read(rows.schema).groupBy("source_kind").agg(F.count("*").alias("n"))


@query("snk21_str08_flush_inbox", f"""with {ENTRIES}, {BLANKS_SQL}, files as (select user_id, workspace_id, coalesce(path, 'x') || '.flush.md' as rel_path, strftime(created_at, '%Y-%m-%d') as logical_date, content, sha256(content) as digest from entries, blanks where trim(coalesce(content, ''), blanks) <> ''),
 known as (select distinct user_id, workspace_id, rel_path, digest from files where digest < '4') select f.user_id, f.workspace_id, 'memory/' || logical_date || '.md' as path, f.rel_path, sha256('## Compaction Flush - 2026-03-01T00:00:00.000Z' || chr(10) || '- Source: ' || f.rel_path || chr(10) || chr(10) || trim(content, blanks)) as block_sha256
 from (select distinct user_id, workspace_id, rel_path, digest, min(logical_date) over (partition by user_id, workspace_id, rel_path, digest) as logical_date, content from files) f, blanks where not exists (select 1 from known k where k.user_id = f.user_id and k.workspace_id = f.workspace_id and k.rel_path = f.rel_path and k.digest = f.digest)""")
def snk21(spark, d):
    from mnemolake.streaming import drains

    files = entries(spark, d).select("user_id", "workspace_id", F.concat(F.coalesce("path", F.lit("x")), F.lit(".flush.md")).alias("rel_path"), F.date_format("created_at", "yyyy-MM-dd").alias("logical_date"), "content")
    ledger = files.where(F.sha2("content", 256) < "4").select("user_id", "workspace_id", "rel_path", F.sha2("content", 256).alias("sha256"))
    blocks, _ = drains.flushed(files, ledger, F.lit("2026-03-01T00:00:00.000Z"))
    return blocks.select("user_id", "workspace_id", "path", F.col("source_path").alias("rel_path"), F.sha2("content", 256).alias("block_sha256"))


@query("snk23_block_zero", f"with {ENTRIES}, {BLANKS_SQL} select id as entry_id, 0::bigint as block_index, content_sha256, coalesce(json_extract_string(metadata, '$.lines'), '') as kept, source_kind from entries, blanks where trim(coalesce(content, ''), blanks) <> ''")
def snk23(spark, d):
    e = entries(spark, d).where(T.whole_trim(F.coalesce("content", F.lit(""))) != "")
    return e.select(F.col("id").alias("entry_id"), F.lit(0).cast("bigint").alias("block_index"), "content_sha256", F.coalesce(F.get_json_object("metadata", "$.lines"), F.lit("")).alias("kept"), "source_kind")


def _receipts(spark, d):
    """Receipts of the old kind: the first 100 units of an entry, every third with a wrong hash."""
    e = entries(spark, d).where("content is not null").withColumn("_t", T.plain_daily(F.col("content")))
    good = F.sha2(T.utf16_slice(F.col("_t"), F.lit(0), F.lit(100)), 256)
    return e.select(F.col("id").alias("entry_id"), F.sha2("content", 256).alias("content_sha256"), F.lit(0).alias("char_start"), F.lit(100).alias("char_end"), F.when(F.ascii("id") % 3 == 0, "wrong").otherwise(good).alias("window_sha256"), "created_at")


@query("jon07_verified_receipts", f"""with {ENTRIES}, {BLANKS_SQL}, t as (select id, content, trim(replace(content, chr(13) || chr(10), chr(10)), blanks) as t from entries, blanks where content is not null)
 select id as entry_id, sha256(content) as content_sha256 from t where ord(id) % 3 <> 0 and length(t) + length(regexp_replace(t, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) >= 100 and not regexp_matches(substr(t, 1, 100), '[\\x{{10000}}-\\x{{10FFFF}}]')
 union all select id, sha256(content) from t where false""".replace("\\\\", "\\"))
def jon07(spark, d):
    blocks = entries(spark, d).where("content is not null").select(F.col("id").alias("entry_id"), "content")
    return daily.verified_receipts(_receipts(spark, d), blocks).select("entry_id", "content_sha256")


@query("jon08_covered_windows", f"""with {ENTRIES}, {BLANKS_SQL}, t as (select id, trim(replace(content, chr(13) || chr(10), chr(10)), blanks) as t from entries, blanks where content is not null),
 w as (select id, (s // 640)::int as window_index, s as a, least(s + 768, length(t)) as b from (select id, t, unnest(range(0, length(t), 640)) as s from t where length(t) > 0)) select id, window_index from w where a >= 0 and b <= 1400 and (a > 0 or b < 1400)""")
def jon08(spark, d):
    w = daily.windows(entries(spark, d), "id", "content")
    ranges = entries(spark, d).select("id", F.lit(0).alias("char_start"), F.lit(1400).alias("char_end"))
    return daily.contained_windows(w, ranges, "id").where("char_start > 0 or char_end < 1400").select("id", "window_index")


@query("snk18_receipts", f"with {ENTRIES}, k as (select distinct content_sha256 as k from entries where source_kind = 'memory_log') select content_sha256 as k, min(id) as id from entries where source_kind <> 'memory_log' and content_sha256 not in (select k from k where k is not null) group by 1")
def snk18(spark, d):
    e = entries(spark, d).select(F.col("content_sha256").alias("k"), "id", "source_kind")
    return records.inserted_if_absent(e.where("source_kind = 'memory_log'"), e.where("source_kind <> 'memory_log'"), ["k"], [F.col("id")]).select("k", "id")


# ---- imports -----------------------------------------------------------------------------------
@query("snk12_snk13_insert_if_absent", f"with {ENTRIES}, a as (select content_sha256 from entries where source_kind <> 'legacy_import') select min(id) as id, content_sha256 from entries e where source_kind = 'legacy_import' and not exists (select 1 from a where a.content_sha256 = e.content_sha256) group by content_sha256")
def snk12(spark, d):
    e = entries(spark, d)
    return records.inserted_if_absent(e.where("source_kind <> 'legacy_import'"), e.where("source_kind = 'legacy_import'"), ["content_sha256"], [F.col("id")]).select("id", "content_sha256")


def _runs(spark, d):
    """Entries as import runs: by number of the run completed, failed or still open."""
    status = F.get(F.array(*[F.lit(x) for x in ("completed", "failed_retryable", "failed_permanent", "running")]), F.ascii("id") % 4)
    return entries(spark, d).select("user_id", "workspace_id", "source_kind", F.lit("MEMORY.md").alias("source_path"), F.substring("content_sha256", 1, 1).alias("source_sha256"), status.alias("status"), F.lit(3).alias("attempt_count"), F.struct("created_at", "id").alias("started_at"))


@query("snk14_srt14_next_runs", f"""with {ENTRIES}, r as (select user_id, workspace_id, source_kind, substr(content_sha256, 1, 1) as s, (['completed', 'failed_retryable', 'failed_permanent', 'running'])[1 + ord(id) % 4] as status, created_at, id from entries),
 l as (select *, row_number() over (partition by user_id, workspace_id, source_kind, s order by created_at desc, id desc) as n from r), wanted as (select user_id, workspace_id, source_kind, s from r union select user_id, workspace_id, source_kind, 'x' from r)
 select w.user_id, w.workspace_id, w.source_kind, w.s as source_sha256, 'running' as status, coalesce(case when l.id is not null then 3 end, 0) + 1 as attempt_count from wanted w left join l on l.n = 1 and w.user_id = l.user_id and w.workspace_id = l.workspace_id and w.source_kind is not distinct from l.source_kind and w.s is not distinct from l.s where l.status is distinct from 'completed'""")
def snk14(spark, d):
    r = _runs(spark, d)
    wanted = r.select(*selection.RUN).unionByName(r.select(*selection.RUN).withColumn("source_sha256", F.lit("x")))
    return selection.next_runs(wanted, r).select("user_id", "workspace_id", "source_kind", "source_sha256", "status", "attempt_count")


@query("imp04_ended_runs", f"""with {ENTRIES}, e as (select id, case ord(id) % 3 when 0 then null when 1 then 'lock timeout' else 'syntax error' end as error from entries)
 select id, case when error is null then 'completed' when error = 'lock timeout' then 'failed_retryable' else 'failed_permanent' end as status, case when error is null then null when error = 'lock timeout' then 'transient_db_error' else 'import_failed' end as last_error_code,
  case when error is null then case when ord(id) % 2 = 0 then 'completed' else 'failed' end else 'not_needed' end as cleanup_status from e""")
def imp04(spark, d):
    error = F.when(F.ascii("id") % 3 == 1, "lock timeout").when(F.ascii("id") % 3 == 2, "syntax error")
    runs = entries(spark, d).select("id", "user_id", "workspace_id", "source_kind", F.col("id").alias("source_path"), F.lit("h").alias("source_sha256"), error.alias("error"))
    cleaned = runs.where("error is null").select(*selection.RUN, (F.ascii("id") % 2 == 0).alias("cleaned"))
    return selection.cleaned_runs(selection.ended_runs(runs, cleanup=True), cleaned).select("id", "status", "last_error_code", "cleanup_status")


_STATES = f"""{ENTRIES}, led as (select distinct user_id, workspace_id, path, sha256(content) as h from entries where source_kind = 'legacy_import'),
 s as (select e.id, source_kind, case when content is null then 'unreadable' when regexp_extract(path, '^memory/(\\d{{4}}-\\d{{2}}-\\d{{2}})\\.md$', 1) = '' or path is null then 'unsupported' when exists (select 1 from led where led.user_id = e.user_id and led.workspace_id = e.workspace_id and led.path = e.path and led.h = sha256(e.content)) then 'already_imported_active' else 'pending' end as state from entries e
 union all select w.id, 'page', case when ord(w.id) % 3 = 0 then 'absent' when ord(w.id) % 3 = 1 then 'stub' else 'pending' end from (select distinct id from workspaces) w)""".replace("\\\\", "\\")


def _states(spark, d):
    e = entries(spark, d).select("id", "user_id", "workspace_id", "path", "content", "source_kind", F.sha2("content", 256).alias("sha256"))
    ledger = e.where("source_kind = 'legacy_import'").select("user_id", "workspace_id", "path", "sha256").distinct().withColumn("imported", F.lit(True))
    seen = e.join(ledger, ["user_id", "workspace_id", "path", "sha256"], "left").withColumn("is_page", F.lit(False))
    page = F.when(F.ascii("id") % 3 == 1, "<!-- empty -->\n").when(F.ascii("id") % 3 == 2, "# Memory\ntea")
    pages = table(spark, d, "workspaces").select("id", F.lit("page").alias("source_kind"), F.lit("MEMORY.md").alias("path"), page.alias("content"), F.lit(None).cast("boolean").alias("imported"), F.lit(True).alias("is_page")).distinct()
    files = seen.select(*pages.columns).unionByName(pages)
    return files.withColumn("state", selection.import_state(F.col("content"), F.lit(True), S.path_date(F.col("path")), F.coalesce("imported", F.lit(False)), F.col("is_page")))


@query("src06_import_states", f"with {_STATES} select id, state from s")
def src06(spark, d):
    return _states(spark, d).select("id", "state")


@query("agg09_imp05_import_counts", f"with {_STATES} select source_kind, count_if(state = 'pending') as imported, count_if(state = 'already_imported_active') as skipped, count_if(state = 'unsupported') as unsupported, count_if(state = 'unreadable') as unreadable, count_if(state in ('pending', 'already_imported_active')) > 0 as has_active from s group by 1")
def imp05(spark, d):
    of = lambda *names: F.count_if(F.col("state").isin(*names))
    return _states(spark, d).groupBy("source_kind").agg(of("pending").alias("imported"), of("already_imported_active").alias("skipped"), of("unsupported").alias("unsupported"), of("unreadable").alias("unreadable"), (of("pending", "already_imported_active") > 0).alias("has_active"))


# ---- embeddings and queues ---------------------------------------------------------------------
@query("snk15_newest_embedding", f"with {EMBEDDINGS} select memory_item_id, profile_key, memory_item_version from emb")
def snk15(spark, d):
    return embeddings(spark, d).select("memory_item_id", "profile_key", "memory_item_version")


def _queue(spark, d):
    e = embeddings(spark, d).join(items(spark, d).select(F.col("id").alias("memory_item_id"), "user_id", "workspace_id"), "memory_item_id")
    return e.select(
        "user_id", "workspace_id", F.concat_ws(":", "profile_key", "memory_item_id").alias("profile_key"), F.substring("memory_item_id", 1, 1).alias("agent_id"), F.lit("old").alias("reason"), F.when(F.col("memory_item_version") % 3 == 0, "failed").otherwise("pending").alias("status"),
        F.col("memory_item_version").alias("attempts"), F.col("created_at").alias("requested_at"), F.col("updated_at").alias("next_attempt_at"), F.lit("timeout").alias("last_error"),
    )


_QUEUE = f"""{ITEMS}, {EMBEDDINGS}, queue as (select user_id, workspace_id, concat_ws(':', profile_key, memory_item_id) as profile_key, substr(memory_item_id, 1, 1) as agent_id, case when memory_item_version % 3 = 0 then 'failed' else 'pending' end as status, memory_item_version as attempts, e.created_at as requested_at, e.updated_at as next_attempt_at from emb e join items i on i.id = e.memory_item_id),
 due as (select * from (select *, row_number() over (partition by user_id, workspace_id order by requested_at, profile_key)::int as place from queue where status = 'pending' and next_attempt_at <= {NOW_SQL}) where place <= 5)"""


def _now():
    return F.lit(NOW).cast("timestamp")


@query("srt13_due_requests", f"with {_QUEUE} select profile_key, place from due")
def srt13(spark, d):
    return records.due_requests(_queue(spark, d), _now()).select("profile_key", "place")


@query("snk16_enqueued", f"""with {_QUEUE}, asked as (select user_id, workspace_id, profile_key, 'again' as reason from queue where agent_id < '4' union all select distinct user_id, workspace_id, 'new', 'first' from queue)
 select coalesce(q.profile_key, a.profile_key) as profile_key, coalesce(q.workspace_id, a.workspace_id) as workspace_id, case when a.profile_key is not null then a.reason else 'old' end as reason, case when a.profile_key is not null then 'pending' else q.status end as status, coalesce(q.attempts, 0) as attempts,
  strftime(case when a.profile_key is not null then {NOW_SQL} else q.next_attempt_at end, '%Y-%m-%d %H:%M:%S') as next_at, case when a.profile_key is null then 'timeout' end as last_error from queue q full join asked a on q.user_id = a.user_id and q.workspace_id = a.workspace_id and q.profile_key = a.profile_key""")
def snk16(spark, d):
    q = _queue(spark, d)
    again = q.where("agent_id < '4'").select(*records.QUEUE, "agent_id", F.lit("again").alias("reason"), F.lit(2).alias("seq"))
    first = q.select("user_id", "workspace_id").distinct().select("user_id", "workspace_id", F.lit("new").alias("profile_key"), F.lit("a").alias("agent_id"), F.lit("first").alias("reason"), F.lit(1).alias("seq"))
    out = records.enqueued(q, again.unionByName(again.withColumns({"seq": F.lit(1), "reason": F.lit("earlier")})).unionByName(first), _now())
    return out.select("profile_key", "workspace_id", "reason", "status", "attempts", F.date_format("next_attempt_at", "yyyy-MM-dd HH:mm:ss").alias("next_at"), "last_error")


@query("snk17_retries", f"with {_QUEUE} select profile_key, case when status = 'failed' then attempts + 1 else attempts end as attempts, 'pending' as status, strftime(case when status = 'failed' then next_attempt_at + interval 15 minute else next_attempt_at end, '%Y-%m-%d %H:%M:%S') as next_at from queue")
def snk17(spark, d):
    out = records.retried(_queue(spark, d), F.col("status") == "failed")
    return out.select("profile_key", "attempts", "status", F.date_format("next_attempt_at", "yyyy-MM-dd HH:mm:ss").alias("next_at"))


@query("str11_ret09_indexing_pass", f"""with {_QUEUE}, b as (select user_id, workspace_id, count(*) as missing from queue group by 1, 2)
 select profile_key, case when agent_id < '2' then 'failed' when agent_id < '5' then 'superseded' when missing > 25 then 'requeued' else 'done' end as outcome, case when agent_id < '5' then 0 else least(missing, 25) end as indexed,
  case when agent_id < '2' or (agent_id >= '5' and missing > 25) then attempts + 1 end as attempts, case when agent_id < '2' then '2026-03-01 00:15:00' when agent_id >= '5' and missing > 25 then '2026-03-01 00:00:00' end as next_at from due join b using (user_id, workspace_id)""")
def str11(spark, d):
    q = _queue(spark, d)
    keys = q.select("agent_id", "profile_key").distinct()
    # an agent has one profile; here its requests agree with it unless it was changed
    due = q.join(keys.where("agent_id >= '2'").groupBy("agent_id").agg(F.max("profile_key").alias("newest")), "agent_id", "left")
    asked = due.withColumn("agent_id", F.concat_ws("/", "agent_id", "profile_key"))
    profiles = asked.where("newest is not null").select("agent_id", F.when(F.col("agent_id") < "5", "other").otherwise(F.col("profile_key")).alias("current_key")).distinct()
    backlog = q.groupBy("user_id", "workspace_id").agg(F.count("*").alias("missing")).join(q.select(*records.QUEUE).distinct(), ["user_id", "workspace_id"])
    out = records.indexing_pass(asked, profiles, backlog, _now())
    return out.select("profile_key", "outcome", "indexed", "attempts", F.date_format("next_attempt_at", "yyyy-MM-dd HH:mm:ss").alias("next_at"))


@query("srt12_embedding_candidates", f"""with {ITEMS}, {EMBEDDINGS}, b as (select i.* from items i left join (select * from emb where profile_key = 'local:mini-64') e on i.id = e.memory_item_id where i.status = 'active' and (e.memory_item_id is null or e.memory_item_version is distinct from i.version or e.dimensions is distinct from coalesce(len(e.embedding), -1)))
 select id, place from (select id, row_number() over (partition by user_id, workspace_id order by updated_at desc, id)::int as place from b) where place <= 5""")
def srt12(spark, d):
    return records.candidates_for_embedding(items(spark, d), embeddings(spark, d), "local:mini-64", 5).select("id", "place")


@query("snk20_scl22_resolved", """with w as (select distinct user_id, name, id, metadata from workspaces), known as (select user_id, name, min(id) as id, arg_min(metadata, id) as metadata from w where ord(id) % 2 = 0 group by 1, 2), wanted as (select distinct user_id, name from w)
 select a.user_id, a.name, coalesce(k.id, 'new') as id, k.id is null as created, coalesce(json_extract_string(k.metadata, '$.timezone'), '-') as zone, 'yes' as seen from wanted a left join known k on a.user_id = k.user_id and a.name = k.name where a.user_id is not null and a.name is not null""")
def snk20(spark, d):
    w = table(spark, d, "workspaces").where("user_id is not null and name is not null").select("user_id", "name", "id", "metadata").distinct()
    wanted = w.select("user_id", "name", F.lit('{"seen": "yes"}').alias("metadata"))
    out = records.resolved(w.where(F.ascii("id") % 2 == 0), wanted, ["user_id", "name"], F.lit("new"))
    return out.select("user_id", "name", "id", "created", F.coalesce(F.col("metadata")["timezone"], F.lit("-")).alias("zone"), F.col("metadata")["seen"].alias("seen"))
