"""Shared pieces of the registered queries and of their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mnemolake.operators import search
from mnemolake.runtime import table



def registry() -> tuple[dict, dict[str, str], Callable]:
    """Tables of the queries and SQL of one module, and the decorator that fills them."""
    queries: dict = {}
    texts: dict[str, str] = {}

    def query(name: str, sql: str | None = None):
        def keep(f):
            queries[name] = f
            if sql:
                texts[name] = sql
            return f

        return keep

    return queries, texts, query


# current rows, as common table expressions
ITEMS = """items as (select * from memory_items qualify row_number() over (partition by id order by version desc nulls last, updated_at desc nulls last) = 1)"""
ENTRIES = """entries as (select * from memory_daily_entries qualify row_number() over (partition by id order by updated_at desc nulls last) = 1)"""
CHUNKS = """chunks as (select * from session_index_chunks qualify row_number() over (partition by id order by created_at desc nulls last) = 1)"""
EMBEDDINGS = """emb as (select * from memory_item_embeddings qualify row_number() over (partition by memory_item_id, profile_key order by memory_item_version desc nulls last, updated_at desc nulls last) = 1)"""
BLANKS_SQL = "blanks as (select list_reduce(list_transform([9, 10, 11, 12, 13, 32, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288, 65279], lambda x: chr(x::int)), lambda a, x: a || x) as blanks)"
LEX = r"list_filter(regexp_extract_all(lower(coalesce({0}, '')), '[\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def lex(column: str) -> str:
    return LEX.format(column)


SEARCH_TEXT = "trim(coalesce(title, '') || ' ' || coalesce(content, '') || ' ' || coalesce(canonical_key, ''))"


def items(spark: SparkSession, d: str) -> DataFrame:
    return search.live_items(table(spark, d, "memory_items"))


def entries(spark: SparkSession, d: str) -> DataFrame:
    return search.live_entries(table(spark, d, "memory_daily_entries"))


def chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "session_index_chunks").dropDuplicates(["id"])


def embeddings(spark: SparkSession, d: str) -> DataFrame:
    return search.current_embeddings(table(spark, d, "memory_item_embeddings"))


def scope_requests(spark: SparkSession, d: str, query: str) -> DataFrame:
    """One request per workspace with the same query."""
    w = table(spark, d, "workspaces").select("user_id", F.col("id").alias("workspace_id")).distinct()
    return w.select(F.col("workspace_id").alias("request"), "user_id", "workspace_id", F.lit(query).alias("query"))


REQUESTS = "requests as (select distinct id as request, user_id, id as workspace_id from workspaces)"
