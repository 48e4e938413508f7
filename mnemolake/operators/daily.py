"""Daily documents: ordered fold of blocks, startup selection, windows, receipts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T

WINDOW, STRIDE = 768, 640


def folded(blocks: DataFrame, keys: list[str], order: Column, content: str) -> DataFrame:
    """Document per key: blocks in order, each without white space at its end, joined by an empty line.

    The last block stays as it is, blank blocks before it leave nothing; a document is one row, as large as its blocks.
    """
    parts = F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(content).alias("c")))), lambda x: x["c"])
    rows = blocks.where(F.col(content).isNotNull()).groupBy(*keys).agg(parts.alias("_p"), F.count("*").alias("blocks"))
    ended = F.filter(F.transform(F.slice("_p", F.lit(1), F.size("_p") - 1), lambda c: F.regexp_replace(c, r"\s+\z", "")), lambda c: c != "")
    lead = F.when((F.size("_p") > 1) & F.get("_p", F.lit(0)).rlike(r"^\s*\z"), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    text = F.array_join(F.concat(lead, ended, F.slice("_p", F.size("_p"), F.lit(1))), "\n\n")
    return rows.withColumn("content", text).drop("_p")


DOCUMENT = ["user_id", "workspace_id", "path"]


def logged(notes: DataFrame) -> DataFrame:
    """Notes for a day as blocks to append: content trimmed, blank ones refused, path from the day, kind of a log unless given."""
    rows = notes.withColumn("content", T.whole_trim(F.col("content"))).where("content <> ''")
    return rows.withColumns({"path": F.concat(F.lit("memory/"), "logical_date", F.lit(".md")), "source_kind": F.coalesce("source_kind", F.lit("memory_log"))})


def flush_block(content: Column, source: Column, imported_at: Column) -> Column:
    """The block that a compaction flush file becomes."""
    return F.concat(F.lit("## Compaction Flush - "), imported_at, F.lit("\n- Source: "), source, F.lit("\n\n"), T.whole_trim(content))


def numbered(blocks: DataFrame, order: list[Column], existing: DataFrame | None = None) -> DataFrame:
    """``blocks`` plus ``block_index``: their place in their document, after the blocks that it has."""
    at = F.row_number().over(Window.partitionBy(*DOCUMENT).orderBy(*order)) - 1
    rows = blocks.withColumn("block_index", at.cast("bigint"))
    if existing is None:
        return rows
    held = existing.groupBy(*DOCUMENT).agg((F.max("block_index") + 1).alias("_next"))
    return rows.join(held, DOCUMENT, "left").withColumn("block_index", F.col("block_index") + F.coalesce("_next", F.lit(0))).drop("_next")


def documents(blocks: DataFrame) -> DataFrame:
    """Current documents of numbered blocks (``id``, ``logical_date``, ``content``, ``source_kind``, ``source_path``): content and
    its hash, the newest day, the kind or ``mixed``, the newest source (none if mixed), and what the last block was."""
    text = folded(blocks, DOCUMENT, F.col("block_index"), "content")
    last = blocks.groupBy(*DOCUMENT).agg(
        F.max_by(F.struct("id", "block_index", "logical_date", "source_kind", "source_path"), "block_index").alias("l"), F.count_distinct("source_kind").alias("_kinds"),
    )
    mixed = F.col("_kinds") > 1
    note = F.struct(F.lit(True).alias("projection"), F.col("l.id").alias("lastBlockId"), F.col("l.block_index").alias("lastBlockIndex"), F.col("l.source_kind").alias("lastSourceKind"), F.col("l.source_path").alias("lastSourcePath"))
    return text.join(last, DOCUMENT).select(
        *DOCUMENT, "content", F.sha2("content", 256).alias("content_sha256"), "blocks", F.col("l.logical_date").alias("logical_date"), F.when(mixed, "mixed").otherwise(F.col("l.source_kind")).alias("source_kind"),
        F.when(~mixed, F.col("l.source_path")).alias("source_path"), F.to_json(note, {"ignoreNullFields": "false"}).alias("metadata"),
    )


def rejected(blocks: DataFrame, existing: DataFrame) -> DataFrame:
    """Blocks that a reject policy refuses: their document is there already."""
    return blocks.join(existing.select(*DOCUMENT).distinct(), DOCUMENT, "left_semi")


def verified_receipts(receipts: DataFrame, blocks: DataFrame) -> DataFrame:
    """Receipts whose block has the same content and whose range, in UTF-16 units, still has the hash that they hold.

    ``receipts``: (``entry_id``, ``content_sha256``, ``char_start``, ``char_end``, ``window_sha256``); ``blocks``: (``entry_id``, ``content``).
    """
    held = blocks.select("entry_id", F.sha2("content", 256).alias("content_sha256"), T.plain_daily(F.col("content")).alias("_t"))
    joined = receipts.join(held, ["entry_id", "content_sha256"]).where("char_start >= 0 and char_end > char_start")
    part = T.utf16_slice(F.col("_t"), F.col("char_start"), F.col("char_end"))
    return joined.where(F.sha2(part, 256) == F.col("window_sha256")).drop("_t")


def windows(blocks: DataFrame, key: str, content: str) -> DataFrame:
    """Overlapping character windows of each block, with place and hash; blank blocks have none."""
    rows = blocks.withColumn("_t", T.plain_daily(F.col(content))).where(F.length("_t") > 0)
    starts = F.sequence(F.lit(0), F.length("_t") - 1, F.lit(STRIDE))
    rows = rows.select(key, "_t", F.posexplode(starts).alias("window_index", "char_start"))
    part = F.substring(F.col("_t"), F.col("char_start") + 1, F.lit(WINDOW))
    return rows.select(key, "window_index", "char_start", (F.col("char_start") + F.length(part)).alias("char_end"), F.sha2(part, 256).alias("window_sha256"))


def pending(all_windows: DataFrame, receipts: DataFrame, keys: list[str]) -> DataFrame:
    return all_windows.join(receipts.select(*keys).distinct(), keys, "left_anti")


def contained_windows(all_windows: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Windows that lie inside an already processed range of the same entry."""
    r = ranges.select(F.col(key).alias("_k"), F.col("char_start").alias("_a"), F.col("char_end").alias("_b"))
    inside = (F.col(key) == F.col("_k")) & (F.col("_a") <= F.col("char_start")) & (F.col("_b") >= F.col("char_end"))
    return all_windows.join(r, inside, "left_semi")


def startup_entries(entries: DataFrame, days: DataFrame, slugged: int = 4) -> DataFrame:
    """Entries of requested days: every exact page, and the newest ``slugged`` others of a day and scope."""
    day = days.select(F.col("user_id").alias("_u"), F.col("workspace_id").alias("_w"), F.col("day").alias("_d"))
    exact = F.col("path") == F.concat(F.lit("memory/"), F.col("_d"), F.lit(".md"))
    prefixed = F.col("path").startswith(F.concat(F.lit("memory/"), F.col("_d"), F.lit("-"))) & F.col("path").endswith(".md")
    hit = (F.col("user_id") == F.col("_u")) & (F.col("workspace_id") == F.col("_w")) & (F.col("logical_date") == F.col("_d")) & (exact | prefixed)
    rows = entries.join(day, hit).withColumn("is_exact", exact)
    w = Window.partitionBy("user_id", "workspace_id", "_d", "is_exact").orderBy(F.col("updated_at").desc(), F.col("path").desc(), F.col("id").desc())
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("is_exact") | (F.col("place") <= slugged)).drop("_u", "_w", "_d")


def within_budget(rows: DataFrame, keys: list[str], order: list[Column], size: Column, budget: int) -> DataFrame:
    """Leading rows of each group whose running size fits; the first that does not fit ends it."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("used", F.sum(size).over(w)).where(F.col("used") <= budget)
