"""Smaller selections, orders and conversions with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.operators import records, reading, selection
from mnemolake.queries.common import CHUNKS, ENTRIES, ITEMS, SEARCH_TEXT, chunks, entries, items, lex
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


@query("src08_catalog", "select 'memory_items' as name, true as present union all select 'missing', false")
def src08(spark, d):
    hadoop = spark._jvm.org.apache.hadoop.fs
    here = lambda n: hadoop.Path(f"{d}/{n}.parquet").getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop.Path(f"{d}/{n}.parquet"))
    return spark.createDataFrame([(n, bool(here(n))) for n in ("memory_items", "missing")], "name string, present boolean")


@query("flt06_websearch", f"with {ITEMS}, w as (select id, ' ' || array_to_string({lex(SEARCH_TEXT)}, ' ') || ' ' as s from items) select id from w where (contains(s, ' look at ') and not contains(s, ' court ')) or contains(s, ' choir ')")
def flt06(spark, d):
    st = T.search_text(F.col("title"), F.col("content"), F.col("canonical_key"))
    return items(spark, d).where(selection.websearch(T.lexemes(st), st, '"look at" -court or choir')).select("id")


@query("flt13_visibility", f"""with {ITEMS}, m as (select distinct session_id, session_key from session_messages where session_id is not null and session_key is not null), allowed as (select distinct session_key from m where ends_with(session_key, ':main'))
 select 'memory' as corpus, id as hit from items union all select 'sessions', session_id from m where session_key in (select session_key from allowed)""")
def flt13(spark, d):
    m = table(spark, d, "session_messages").where("session_id is not null and session_key is not null").select("session_id", "session_key").distinct()
    hits = items(spark, d).select(F.lit("memory").alias("corpus"), F.col("id").alias("hit"), F.lit(None).cast("string").alias("session_key")).unionByName(m.select(F.lit("sessions").alias("corpus"), F.col("session_id").alias("hit"), "session_key"))
    return selection.visible_hits(hits, m.where(F.col("session_key").endswith(":main"))).select("corpus", "hit")


@query("prj04_boosts", f"with {ITEMS} select id, case when lower(coalesce(title, '')) = 'court plan' then 3.0 when lower(content) = 'court plan' then 2.5 when lower(coalesce(canonical_key, '')) = 'court plan' then 2.25 else 0.0 end::double as boost from items")
def prj04(spark, d):
    q = F.lit("court plan")
    boost = F.when(F.lower(F.coalesce("title", F.lit(""))) == q, 3.0).when(F.lower("content") == q, 2.5).when(F.lower(F.coalesce("canonical_key", F.lit(""))) == q, 2.25).otherwise(0.0)
    return items(spark, d).select("id", boost.alias("boost"))


@query("agg09_state_counters", f"with {ENTRIES} select count_if(content is null) as unreadable, count_if(source_kind = 'legacy_import') as imported, count_if(content_sha256 <> sha256(content)) as changed, count(*) as files from entries")
def agg09(spark, d):
    return entries(spark, d).agg(F.count_if(F.col("content").isNull()).alias("unreadable"), F.count_if(F.col("source_kind") == "legacy_import").alias("imported"), F.count_if(F.col("content_sha256") != F.sha2("content", 256)).alias("changed"), F.count("*").alias("files"))


@query("set02_srt05_merged_order", f"""with {ITEMS}, {CHUNKS}, h as (select user_id, workspace_id, 'memory' as corpus, 'db-memory/items/' || id || '.md' as path, length(content) % 7 as score, importance, updated_at from items union all select user_id, workspace_id, 'sessions', path || '#' || id, length(text) % 7, null, null from chunks)
 select path, row_number() over (partition by user_id, workspace_id order by score desc nulls last, (corpus = 'memory')::int desc, case when corpus = 'memory' then coalesce(importance, 0) end desc nulls last, case when corpus = 'memory' then updated_at end desc nulls last, path)::int as place from h""")
def set02(spark, d):
    a = items(spark, d).select("user_id", "workspace_id", F.lit("memory").alias("corpus"), F.concat(F.lit("db-memory/items/"), "id", F.lit(".md")).alias("path"), (F.length("content") % 7).alias("score"), F.col("importance").cast("int").alias("importance"), "updated_at")
    b = chunks(spark, d).select("user_id", "workspace_id", F.lit("sessions").alias("corpus"), F.concat_ws("#", "path", "id").alias("path"), (F.length("text") % 7).alias("score"), F.lit(None).cast("int").alias("importance"), F.lit(None).cast("timestamp").alias("updated_at"))
    from mnemolake.operators.search import hit_order

    order = [F.col("score").desc_nulls_last(), *hit_order()[1:]]
    return a.unionByName(b).withColumn("place", F.row_number().over(Window.partitionBy("user_id", "workspace_id").orderBy(*order))).select("path", "place")


@query("sel01_startup_days", """select id, array_to_string(case when date '2026-03-01' > t then ['2026-03-01', strftime(t, '%Y-%m-%d'), strftime(t - 1, '%Y-%m-%d')] when date '2026-03-01' < t and strftime(t - 1, '%Y-%m-%d') <> '2026-03-01' then [strftime(t, '%Y-%m-%d'), strftime(t - 1, '%Y-%m-%d'), '2026-03-01'] else [strftime(t, '%Y-%m-%d'), strftime(t - 1, '%Y-%m-%d')] end, ',') as days
 from (select distinct id, timezone(json_extract_string(metadata, '$.timezone'), timestamptz '2026-03-01 03:00:00+00')::date as t from workspaces)""")
def sel01(spark, d):
    w = table(spark, d, "workspaces").select("id", F.get_json_object("metadata", "$.timezone").alias("zone")).distinct()
    now = F.lit("2026-03-01 03:00:00").cast("timestamp")
    return w.select("id", F.array_join(selection.startup_days(F.col("zone"), now), ",").alias("days"))


_ORDER = "importance desc nulls last, updated_at desc, id"


@query("scl12_dates_of_paths", rf"with {ENTRIES} select id, strftime(try_strptime(regexp_extract(path, '(\d{{4}}-\d{{2}}-\d{{2}})', 1), '%Y-%m-%d'), '%Y-%m-%d') as day from entries")
def scl12(spark, d):
    day = F.nullif(F.regexp_extract("path", r"(\d{4}-\d{2}-\d{2})", 1), F.lit("")).try_cast("date")
    return entries(spark, d).select("id", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query("scl19_chunked_lists", f"with {ITEMS} select id, ceil(len(tags) / 2.0)::int as parts from items where tags is not null")
def scl19(spark, d):
    from mnemolake.functions.scalars import chunked

    return items(spark, d).where("tags is not null").select("id", F.size(chunked(F.col("tags"), 2)).alias("parts"))
