"""Drains of inboxes into daily documents, as batch plans and as streams of batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.operators import daily
from mnemolake.operators.batches import BatchTable
from mnemolake.operators.records import first_by_key

LEDGER = ["user_id", "workspace_id", "rel_path", "sha256"]


def flushed(files: DataFrame, ledger: DataFrame, imported_at: Column) -> tuple[DataFrame, DataFrame]:
    """(blocks to append, ledger rows to add) of inbox files (scope, ``rel_path``, ``logical_date``, ``content``).

    Blank files and those whose (path, hash) the ledger has are left; of equal files one counts.
    """
    rows = files.where(T.whole_trim(F.coalesce("content", F.lit(""))) != "").withColumn("sha256", F.sha2("content", 256))
    fresh = first_by_key(rows, LEDGER, [F.col("logical_date")]).join(ledger.select(*LEDGER).distinct(), LEDGER, "left_anti")
    blocks = fresh.select(
        "user_id", "workspace_id", "logical_date", F.concat(F.lit("memory/"), "logical_date", F.lit(".md")).alias("path"), F.sha2(F.concat_ws("|", *LEDGER), 256).alias("id"),
        daily.flush_block(F.col("content"), F.col("rel_path"), imported_at).alias("content"), F.lit("compaction_flush").alias("source_kind"), F.col("rel_path").alias("source_path"),
    )
    return blocks, fresh.select(*LEDGER)


def drain_batches(stream: DataFrame, blocks: BatchTable, ledger: BatchTable, checkpoint: str, take: Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]) -> None:
    """Run a stream of inbox files to its end; every micro-batch is taken against the ledger so far.

    Both tables commit by batch number, blocks first: a batch repeated after a loss writes what is missing.
    """
    ledger_schema = stream.select("user_id", "workspace_id", "rel_path", F.lit("").alias("sha256")).schema

    def each(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            known = batch.sparkSession.createDataFrame([], ledger_schema) if number == 0 else ledger.read(ledger_schema)
            fresh, rows = take(batch, known)
            blocks.append(number, fresh)
            ledger.append(number, rows)
        finally:
            batch.unpersist()

    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
