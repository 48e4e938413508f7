"""Queries of the general training-data operators: p5 and p6."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mnemolake.operators import changefeed, normal_times
from mnemolake.runtime import table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normal_times.normalised_times(
        table(spark, sf_dir, "session_messages"), table(spark, sf_dir, "memory_daily_entries"), table(spark, sf_dir, "workspaces")
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changefeed.current_state(table(spark, sf_dir, "memory_audit_log"))


QUERIES = {"p5_found": p5_found, "p6_found": p6_found}
SQL: dict[str, str] = {
    "p6_found": """with recursive rows_ as (select item_id, id, created_at, lower(trim(operation)) as kind, try_cast(json_extract_string(before, '$.version') as bigint) as bv, try_cast(json_extract_string(after, '$.version') as bigint) as av, sha256(json_extract_string(after, '$.content')) as h from memory_audit_log where item_id is not null and id is not null),
 one as (select * from rows_ where kind in ('insert', 'update', 'delete', 'soft_delete') qualify row_number() over (partition by item_id, id order by created_at, bv nulls first, kind) = 1), c as (select *, row_number() over (partition by item_id order by created_at, bv nulls first, id) as k from one),
 st as (select distinct item_id, 0::bigint as k, false as alive, null::bigint as v, null::varchar as h from c union all
  select c.item_id, c.k, case when x.takes then c.kind in ('insert', 'update') else p.alive end, case when x.takes then case when c.kind in ('insert', 'update') then c.av end else p.v end, case when x.takes then case when c.kind in ('insert', 'update') then c.h end else p.h end
   from st p join c on c.item_id = p.item_id and c.k = p.k + 1, lateral (select case when c.kind = 'insert' then not p.alive else p.alive and coalesce(c.bv = p.v, false) end as takes) x)
 select item_id, v as version, h as content_sha256 from (select *, row_number() over (partition by item_id order by k desc) as n from st) where n = 1 and alive""",
}
