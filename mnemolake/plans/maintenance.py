"""Maintenance cycle as one plan: pages of blocks, what is pending, packing, extraction, what is new, receipts, summary.

The extractor is injected: any function from packed transcripts (scope, ``source_path``, ``file_hash``,
``transcript``) to candidates (scope, ``content``, ``type``, ``canonical_key``, ``confidence``). The
default takes durable statements by their signal words.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.operators import daily, routing, selection

MIN_CONFIDENCE, PIPELINE_VERSION, MAX_CHARS, BATCH = 80, 1, 12_000, 200
KINDS = ["memory_log"]
SCOPE = ["user_id", "workspace_id"]
WINDOW = ["id", "pipeline_version", "window_index"]


def signal_extractor(packed: DataFrame) -> DataFrame:
    """Lines that state something durable, with full confidence."""
    lines = packed.select(*SCOPE, F.explode(F.split("transcript", "\n")).alias("content")).where(T.is_durable(F.col("content")))
    return lines.select(*SCOPE, T.whole_trim(F.col("content")).alias("content"), F.lit("note").alias("type"), F.lit(None).cast("string").alias("canonical_key"), F.lit(100).alias("confidence"))


def ordered_blocks(blocks: DataFrame, page_size: int = BATCH) -> DataFrame:
    """Blocks the extractor may read, in their order per scope, with the ``page`` they lie on."""
    w = Window.partitionBy(*SCOPE).orderBy("logical_date", "path", "block_index", "id")
    at = F.row_number().over(w) - 1
    return blocks.where(F.col("source_kind").isin(KINDS)).withColumn("at", at).withColumn("page", F.floor(F.col("at") / max(1, page_size)).cast("bigint"))


def block_windows(blocks: DataFrame) -> DataFrame:
    """Windows of ordered blocks: their coordinates, hash and content."""
    w = daily.windows(blocks, "id", "content").join(blocks.select("id", *SCOPE, "path", "logical_date", "block_index", "at", "page", T.plain_daily(F.col("content")).alias("_t")).hint("merge"), "id")
    part = F.substring(F.col("_t"), F.col("char_start") + 1, F.lit(daily.WINDOW))
    return w.withColumns({"content": part, "pipeline_version": F.lit(PIPELINE_VERSION)}).drop("_t")


def pending_windows(windows: DataFrame, receipts: DataFrame, batch: int = BATCH) -> DataFrame:
    """What one run of each scope takes: of the first page with pending windows those of its first pending path, at most ``batch``."""
    left = windows.join(receipts.select(*WINDOW).distinct().hint("merge"), WINDOW, "left_anti")
    order = [F.col("page"), F.col("at"), F.col("window_index")]
    first = left.groupBy(*SCOPE).agg(F.min(F.struct("page", "at", "path")).alias("_f")).select(*SCOPE, F.col("_f.page").alias("page"), F.col("_f.path").alias("path"))
    mine = left.join(first.hint("merge"), [*SCOPE, "page", "path"])
    return mine.withColumn("place", F.row_number().over(Window.partitionBy(*SCOPE).orderBy(*order))).where(F.col("place") <= max(1, batch))


def rendered_window() -> Column:
    """A window with its source lines, as the extractor sees it."""
    line = lambda n, c: F.concat(F.lit(f"{n}: "), c.cast("string"))
    chars = F.concat(F.lit("Chars: "), F.col("char_start").cast("string"), F.lit("-"), F.col("char_end").cast("string"))
    return F.concat_ws(
        "\n", line("Source", F.col("path")), line("Logical-Date", F.col("logical_date")), line("Block", F.col("block_index") + 1), line("Window", F.col("window_index") + 1), line("Pipeline-Version", F.col("pipeline_version")), chars, F.lit(""), F.col("content")
    )


def packed(pending: DataFrame, max_chars: int = MAX_CHARS) -> tuple[DataFrame, DataFrame]:
    """(transcripts, windows in them): windows in order until the first that no longer fits, joined by an empty line.

    A scope whose first window alone is too long has no transcript but ``error``.
    """
    running = Window.partitionBy(*SCOPE).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = pending.withColumn("_r", rendered_window()).withColumn("used", (F.sum(F.length("_r") + 2).over(running) - 2).cast("bigint"))
    fits = rows.where(F.col("used") <= max(1, max_chars))
    spot = lambda c: F.concat(c["path"], F.lit("#block="), (c["block_index"] + 1).cast("string"), F.lit("&window="), (c["window_index"] + 1).cast("string"))
    ends = F.struct("path", "block_index", "window_index")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "_r"))), lambda x: x["_r"]), "\n\n")
    made = fits.groupBy(*SCOPE).agg(joined.alias("transcript"), F.min_by(ends, "place").alias("a"), F.max_by(ends, "place").alias("b"))
    path = F.when(F.col("a") == F.col("b"), spot(F.col("a"))).otherwise(F.concat(spot(F.col("a")), F.lit(".."), spot(F.col("b"))))
    made = made.select(*SCOPE, "transcript", path.alias("source_path"), F.sha2("transcript", 256).alias("file_hash"), F.lit(None).cast("string").alias("error"))
    none = F.lit(None).cast("string")
    small = rows.where((F.col("place") == 1) & (F.col("used") > max(1, max_chars))).select(*SCOPE, none.alias("transcript"), none.alias("source_path"), none.alias("file_hash"), F.lit("transcript window too small for a single daily window").alias("error"))
    return made.unionByName(small), fits.drop("_r")


@dataclass
class Cycle:
    """What a pass leaves behind."""

    stored: DataFrame
    skipped: DataFrame
    receipts: DataFrame
    summary: DataFrame


def cycle(blocks: DataFrame, items: DataFrame, receipts: DataFrame, extract: Callable[[DataFrame], DataFrame] = signal_extractor, batch: int = BATCH, max_chars: int = MAX_CHARS) -> Cycle:
    """One pass over every scope.

    Candidates without confidence or under ``MIN_CONFIDENCE``, and those that the items (or an earlier
    candidate of the pass) say already, are skipped; every window read gets a receipt.
    """
    transcripts, read = packed(pending_windows(block_windows(ordered_blocks(blocks, batch)), receipts, batch), max_chars)
    found = extract(transcripts.where("error is null")).withColumn("cid", F.sha2(F.concat_ws("|", *SCOPE, "type", F.coalesce("canonical_key", F.lit("")), "content"), 256))
    sure = F.coalesce(F.col("confidence") >= MIN_CONFIDENCE, F.lit(False))
    unique = selection.first_rows(found.where(sure), [*SCOPE, F.coalesce("canonical_key", T.comparable(F.col("content")))], [F.col("cid")])
    known = routing.known_candidates(unique, items).hint("merge")  # none of the joins here is left to the optimizer, see search.small
    stored = unique.join(known, "cid", "left_anti")
    skipped = found.where(~sure).select(*SCOPE, "cid").unionByName(unique.join(known, "cid", "left_semi").select(*SCOPE, "cid"))
    return Cycle(stored, skipped, read.select(*SCOPE, *WINDOW, "path", "logical_date", "window_sha256", "char_start", "char_end"), selection.run_summary(read, stored, skipped, SCOPE))
