"""Scalar functions and small predicates with SQL written from their definitions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mnemolake.functions import scalars as S
from mnemolake.functions import text as T
from mnemolake.queries.common import ENTRIES, ITEMS, entries, items, registry
from mnemolake.runtime import table

QUERIES, SQL, query = registry()

_MARKED = r"regexp_matches({0}, '^[A-Z0-9]+(_[A-Z0-9]+){{{{2,}}}}$') or regexp_matches({0}, '(?i)^[0-9a-f]{{{{8}}}}-[0-9a-f]{{{{4}}}}-[1-5][0-9a-f]{{{{3}}}}-[89ab][0-9a-f]{{{{3}}}}-[0-9a-f]{{{{12}}}}$') or regexp_matches({0}, '^@\w{{{{3,}}}}$') or regexp_matches({0}, '^[0-9]{{{{6,}}}}$')".replace("{{{{", "{{").replace("}}}}", "}}")


@query("flt15_markers", rf"""with {ITEMS}, w as (select id, unnest(list_distinct(string_split_regex(content, '\s+'))) as word from items)
 select id, word, {_MARKED.format('trim(word)')} as marker from w where word <> '' and regexp_matches(word, '[@_]|^[0-9a-f-]+$|^[0-9]+$')""")
def flt15(spark, d):
    w = items(spark, d).select("id", F.explode(F.array_distinct(F.split("content", r"\s+"))).alias("word"))
    return w.where((F.col("word") != "") & F.col("word").rlike("[@_]|^[0-9a-f-]+$|^[0-9]+$")).withColumn("marker", T.is_marker(F.col("word")))


@query("flt16_query_modes", f"""with {ITEMS}, q as (select distinct lower(trim(title)) as t from items where title is not null union select unnest(['exact value of the key', 'Summary around the only token', '', 'ТОЧНОЕ значение', 'обзор id']))
 select t, case when not (contains(lower(t), 'summarize') or contains(lower(t), 'summary') or contains(lower(t), 'overview') or contains(lower(t), 'around') or contains(lower(t), 'what values') or contains(lower(t), 'какие') or contains(lower(t), 'кратко') or contains(lower(t), 'обзор') or contains(lower(t), 'сгруппируй') or contains(lower(t), 'вокруг'))
  and (contains(lower(t), 'exact') or contains(lower(t), 'top-1') or contains(lower(t), 'only') or contains(lower(t), 'id') or contains(lower(t), 'key') or contains(lower(t), 'marker') or contains(lower(t), 'token') or contains(lower(t), 'uuid') or contains(lower(t), 'login') or contains(lower(t), 'точн') or contains(lower(t), 'только') or contains(lower(t), 'значени')) then 'exact_value' else 'contextual' end as mode from q""")
def flt16(spark, d):
    asked = spark.createDataFrame([(q,) for q in ("exact value of the key", "Summary around the only token", "", "ТОЧНОЕ значение", "обзор id")], "t string")
    q = items(spark, d).where("title is not null").select(F.lower(F.trim("title")).alias("t")).union(asked).distinct()
    return q.withColumn("mode", T.query_mode(F.col("t")))


@query("scl03_profile_keys", """select distinct profile_key, sha256('{"provider":"' || split_part(profile_key, ':', 1) || '","model":"' || split_part(profile_key, ':', 2) || '","outputDimensionality":"auto","inputType":null,"queryInputType":null,"documentInputType":null,"remoteBaseUrl":"http://e","localModelPath":null,"localModelCacheDir":null}') as hash
 from memory_item_embeddings where profile_key is not null""")
def scl03(spark, d):
    p = table(spark, d, "memory_item_embeddings").where("profile_key is not null").select("profile_key").distinct()
    part = lambda i: F.get(F.split("profile_key", ":"), F.lit(i))
    return p.withColumn("hash", S.profile_key(part(0), part(1), remoteBaseUrl=F.lit("http://e")))


@query("scl04_capture_source_ids", """with m as (select distinct agent_id, session_key, session_id from session_messages)
 select agent_id, session_key, session_id, substr(sha256('{"agentId":' || coalesce('"' || agent_id || '"', 'null') || ',"sessionKey":' || coalesce('"' || session_key || '"', 'null') || ',"sessionId":' || coalesce('"' || session_id || '"', 'null') || ',"sessionFile":null,"fallbackContentSha256":'
  || case when session_key is null and session_id is null then '"h"' else 'null' end || '}'), 1, 32) as source_id from m""")
def scl04(spark, d):
    m = table(spark, d, "session_messages").select("agent_id", "session_key", "session_id").distinct()
    return m.withColumn("source_id", S.capture_source_id(F.col("agent_id"), F.col("session_key"), F.col("session_id"), F.lit(None).cast("string"), F.lit("h")))


_MS = r"case when try_cast({0} as double) > 0 and try_cast({0} as double) < 1e18 then floor(case when try_cast({0} as double) < 1e11 then try_cast({0} as double) * 1000 else try_cast({0} as double) end)::bigint when regexp_matches({0}, '^\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{2}}:\d{{2}}(:\d{{2}}(\.\d+)?)?(Z|[+-]\d{{2}}:\d{{2}})?)?$') and epoch_us(try_cast({0} as timestamptz)) >= 1000 then epoch_us(try_cast({0} as timestamptz)) // 1000 end"


@query("scl14_coerced_times", f"select row_id, coalesce({_MS.format('timestamp')}, {_MS.format('record_time')}, 0) as ms from (select row_id, timestamp, strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%gZ') as record_time from session_messages)")
def scl14(spark, d):
    record = F.date_format("ingested_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return table(spark, d, "session_messages").select("row_id", S.coerced_millis(F.col("timestamp"), record).alias("ms"))


@query("scl20_distinct_names", f"with {ITEMS} select id, list_filter(list_transform(tags || [' ', 'x '] || tags, lambda t: trim(t)), lambda t: t <> '') as raw, array_to_string(list_filter(raw, lambda t, i: list_position(raw, t) = i), ',') as names from items where tags is not null".replace("select id, list_filter", "select id, names from (select id, list_filter", 1) + ")")
def scl20(spark, d):
    doubled = F.concat("tags", F.array(F.lit(" "), F.lit("x ")), "tags")
    return items(spark, d).where("tags is not null").select("id", F.array_join(S.distinct_names(doubled), ",").alias("names"))


@query("scl24_utf16_slices", f"""with {ITEMS}, c as (select id, content, generate_subscripts(string_split(content, ''), 1) as p, unnest(string_split(content, '')) as ch from items where content is not null and content <> ''),
 w as (select id, ch, p, sum(case when ord(ch) > 65535 then 2 else 1 end) over (partition by id order by p) as hi, case when ord(ch) > 65535 then 2 else 1 end as n from c),
 s as (select id, case when max(hi) < 40 or bool_or((3 > hi - n and 3 < hi) or (40 > hi - n and 40 < hi)) then null else coalesce(string_agg(ch, '' order by p) filter (hi - n >= 3 and hi <= 40), '') end as slice from w group by 1) select * from s""")
def scl24(spark, d):
    i = items(spark, d).where("content is not null and content <> ''")
    return i.select("id", T.utf16_slice(F.col("content"), F.lit(3), F.lit(40)).alias("slice"))


@query("scl25_trimmed", f"""with {ENTRIES}, b as (select list_reduce(list_transform([9, 10, 12, 13, 32, 11, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288, 65279], lambda x: chr(x::int)), lambda a, x: a || x) as blanks)
 select id, sha256(trim(replace(chr(8203) || content || chr(8287) || chr(5760), chr(13) || chr(10), chr(10)), blanks)) as hash from entries, b where content is not null""")
def scl25(spark, d):
    padded = F.concat(F.lit("​"), "content", F.lit("  "))
    return entries(spark, d).where("content is not null").select("id", F.sha2(T.plain_daily(padded), 256).alias("hash"))


_PRE = "regexp_extract(v, '^v?[0-9.]+-([^+]+)', 1)"


@query("scl26_versions", rf"""with base as (select distinct regexp_extract(content, '\b(\d+\.\d+\.\d+)\b', 1) as v from memory_items), v as (select unnest([v, 'v' || v || '-rc.2', v || '-rc.10', v || '-rc', v || '+build.5', v || '-alpha.1+b', v || '-1', '0' || v, v || '-', v || '-01', v || '-x_y']) as v from base where v <> ''),
 k as (select v, string_split(regexp_extract(v, '^v?([0-9.]+)', 1), '.') as c, {_PRE} as pre, regexp_matches(v, '^v?(0|[1-9]\d*)\.(0|[1-9]\d*)\.(0|[1-9]\d*)(-(0|[1-9]\d*|\d*[A-Za-z-][0-9A-Za-z-]*)(\.(0|[1-9]\d*|\d*[A-Za-z-][0-9A-Za-z-]*))*)?(\+.*)?$') as sound from v)
 select v, case when sound then dense_rank() over (partition by sound order by c[1]::hugeint, c[2]::hugeint, c[3]::hugeint, (pre = '')::int, case when pre = '' then [] else list_transform(string_split(pre, '.'), lambda x: {{'a': not regexp_matches(x, '^\d+$'), 'b': coalesce(try_cast(x as bigint), 0), 'c': case when regexp_matches(x, '^\d+$') then '' else x end}}) end) end as place from k""")
def scl26(spark, d):
    base = table(spark, d, "memory_items").select(F.regexp_extract("content", r"\b(\d+\.\d+\.\d+)\b", 1).alias("v")).where("v <> ''").distinct()
    forms = [("", ""), ("v", "-rc.2"), ("", "-rc.10"), ("", "-rc"), ("", "+build.5"), ("", "-alpha.1+b"), ("", "-1"), ("0", ""), ("", "-"), ("", "-01"), ("", "-x_y")]
    v = base.select(F.explode(F.array(*[F.concat(F.lit(a), "v", F.lit(b)) for a, b in forms])).alias("v")).withColumn("key", S.version_key(F.col("v")))
    place = F.dense_rank().over(Window.partitionBy(F.col("key").isNull()).orderBy("key"))
    return v.select("v", F.when(F.col("key").isNotNull(), place).cast("bigint").alias("place"))


@query("scl27_transient_errors", """select id, reason, contains(lower(reason), 'connection terminated due to connection timeout') or contains(lower(reason), 'timeout') or contains(lower(reason), 'lock timeout') or contains(lower(reason), 'deadlock detected') or contains(lower(reason), 'econnreset') or contains(lower(reason), 'econnrefused') or contains(lower(reason), 'could not connect') or contains(lower(reason), 'server closed the connection unexpectedly') as transient
 from (select distinct id, content || ' ' || (['Lock TIMEOUT', 'deadlock detected', 'connection refused', 'too many clients', 'ECONNRESET', 'could not connect'])[1 + ord(id) % 6] as reason from memory_items where content is not null and id is not null)""")
def scl27(spark, d):
    errors = F.array(*[F.lit(x) for x in ("Lock TIMEOUT", "deadlock detected", "connection refused", "too many clients", "ECONNRESET", "could not connect")])
    said = F.concat("content", F.lit(" "), F.get(errors, F.ascii("id") % 6))
    rows = table(spark, d, "memory_items").where("content is not null and id is not null").select("id", said.alias("reason")).distinct()
    return rows.withColumn("transient", S.is_transient(F.col("reason")))


@query("srt15_limits", f"with {ITEMS} select id, case when a is null or not isfinite(a) then 1 else greatest(1, least(10, floor(a)))::int end as n from (select id, case version % 4 when 0 then null when 1 then 'nan'::double else importance / 7.0 end as a from items)")
def srt15(spark, d):
    asked = F.when(F.col("version") % 4 == 0, None).when(F.col("version") % 4 == 1, float("nan")).otherwise(F.col("importance") / 7.0)
    return items(spark, d).select("id", S.result_limit(asked, 10).alias("n"))


@query("bud03_cuts", rf"""with {ITEMS}, t as (select id, content as c, trim(content, ' ' || chr(9) || chr(10) || chr(13)) as s from items where content is not null)
 select id, case when length(s) <= 120 then s else substr(s, 1, 120 - 18) || chr(10) || '...[truncated]...' end as head, case when length(c) > 90 then substr(c, 1, 90) || '…' else c end as short,
  case when length(c) > 100 then regexp_replace(substr(c, 1, 80), '\s+$', '') || chr(10) || '[truncated]' else c end as message, case when length(s) <= 5 then s else substr(chr(10) || '...[truncated]...', 1, 5) end as tiny from t""")
def bud03(spark, d):
    c = F.col("content")
    return items(spark, d).where("content is not null").select("id", T.head_cut(c, 120).alias("head"), T.cut_short(c, 90).alias("short"), T.message_cut(c, 100).alias("message"), T.head_cut(c, 5).alias("tiny"))


@query("bud04_labels", rf"with {ITEMS} select id, trim(regexp_replace(regexp_replace(regexp_replace(title, '[\r\n\t]+', ' ', 'g'), '[\[\]]', '_', 'g'), '[^A-Za-z0-9._/\- ]+', '_', 'g'), ' ') as label from items")
def bud04(spark, d):
    return items(spark, d).select("id", T.label(F.col("title")).alias("label"))
