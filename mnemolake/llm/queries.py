"""Registered queries of the text operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mnemolake.llm import contamination, conversations, duplicates, neighbours, packing, personal_data, residue, subjects
from mnemolake.runtime import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = table(spark, sf_dir, "session_messages")
    # as a pattern, so that one file and a folder of files both make a stream
    stream = spark.readStream.schema(messages.schema).parquet(f"{sf_dir}/{{session_messages}}.parquet")
    return conversations.conversation_turns(messages, stream, table(spark, sf_dir, "workspaces"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.build_ledger(table(spark, sf_dir, "memory_items")).copies()


def p2_collapsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicates.build_ledger(table(spark, sf_dir, "memory_items")).collapsed()


def _personal_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in ("memory_items", "memory_daily_entries", "session_index_chunks")]


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(*_personal_tables(spark, sf_dir), table(spark, sf_dir, "users"))


def p3_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.redacted(personal_data.texts_of(*_personal_tables(spark, sf_dir)), table(spark, sf_dir, "users"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.neighbour_pairs(table(spark, sf_dir, "memory_item_embeddings"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("memory_items", "memory_daily_entries", "session_index_chunks", "session_messages")
    return residue.residue_records(*[table(spark, sf_dir, n) for n in names])


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), table(spark, sf_dir, "pack_budgets"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.fill_report(p8_containers(spark, sf_dir), table(spark, sf_dir, "pack_budgets"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.verbatim_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def p9_reparameterised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.reparameterised_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"))


def _subject_tables(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [table(spark, sf_dir, n) for n in ("documents", "topic_labels", "subject_areas")]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.document_subjects(*_subject_tables(spark, sf_dir))


def p10_composition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subjects.composition(*_subject_tables(spark, sf_dir))


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_collapsed": p2_collapsed,
    "p3_found": p3_found,
    "p3_redacted": p3_redacted,
    "p4_found": p4_found,
    "p7_found": p7_found,
    "p8_containers": p8_containers,
    "p8_fill": p8_fill,
    "p9_found": p9_found,
    "p9_reparameterised": p9_reparameterised,
    "p10_found": p10_found,
    "p10_composition": p10_composition,
}
_GRAMS = "unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i::int:i::int + 12], ' ')))"
_WORDS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"
SQL: dict[str, str] = {
    "p9_found": f"""with it as (select distinct item_id, unnest([passage, question]) as t from eval_items where item_id is not null), iw as (select item_id, {_WORDS.format('t')} as w from it where t is not null), dw as (select doc_id, {_WORDS.format('text')} as w from documents where doc_id is not null and text is not null),
 ig as (select distinct item_id, {_GRAMS} as g from iw where len(w) >= 13), dg as (select doc_id, {_GRAMS} as g from dw where len(w) >= 13) select distinct doc_id, item_id from dg join ig using (g)""",
}


def all_queries() -> dict:
    return dict(QUERIES)


def all_sql() -> dict:
    return dict(SQL)
