from datetime import datetime

from mnemolake.operators import search
from mnemolake.plans import maintenance

AT = datetime(2026, 1, 1)
BLOCK = "id string, user_id string, workspace_id string, path string, logical_date string, block_index bigint, content string, source_kind string, extra int"
ITEM = "user_id string, workspace_id string, id string, version int, status string, type string, title string, content string, canonical_key string, importance smallint, updated_at timestamp"


def test_a_pass_takes_one_path_and_skips_what_is_known(spark):
    long = "Remember that the red door of the house is always locked at night."
    blocks = [("a", "u", "w", "memory/1.md", "2026-01-01", 0, long, "memory_log", 1), ("b", "u", "w", "memory/1.md", "2026-01-01", 1, "Never forget that the blue door stays open on every Monday.", "memory_log", 1),
              ("c", "u", "w", "memory/2.md", "2026-01-02", 0, long, "memory_log", 1), ("d", "u", "w", "memory/0.md", "2026-01-01", 0, long, "compaction_flush", 1), ("e", "u", "v", "memory/1.md", "2026-01-01", 0, None, "memory_log", 1)]
    df = spark.createDataFrame(blocks, BLOCK)
    items = spark.createDataFrame([("u", "w", "i", 1, "active", "note", None, long.upper(), None, 1, AT)], ITEM)
    none = spark.createDataFrame([], "id string, pipeline_version int, window_index int")
    c = maintenance.cycle(df, items, none)
    assert [r["content"] for r in c.stored.collect()] == ["Never forget that the blue door stays open on every Monday."] and c.skipped.count() == 1
    assert sorted(r["id"] for r in c.receipts.collect()) == ["a", "b"]
    assert [tuple(r) for r in c.summary.collect()] == [("u", "w", "completed", 2, 2, 1, 1)]
    done = c.receipts.select("id", "pipeline_version", "window_index")
    assert [r["id"] for r in maintenance.cycle(df, items, done).receipts.collect()] == ["c"]
    assert maintenance.cycle(df.limit(0), items, none).receipts.count() == 0


def test_a_window_too_long_for_the_transcript(spark):
    df = spark.createDataFrame([("a", "u", "w", "memory/1.md", "2026-01-01", 0, "x" * 900, "memory_log", 1)], BLOCK)
    none = spark.createDataFrame([], "id string, pipeline_version int, window_index int")
    pending = maintenance.pending_windows(maintenance.block_windows(maintenance.ordered_blocks(df)), none)
    transcripts, read = maintenance.packed(pending, 100)
    assert [r["error"] is not None for r in transcripts.collect()] == [True] and read.count() == 0
    two, read = maintenance.packed(pending, 5_000)
    assert two.first()["source_path"] == "memory/1.md#block=1&window=1..memory/1.md#block=1&window=2" and read.count() == 2


def test_no_join_of_a_pass_is_left_to_the_optimizer(spark, monkeypatch):
    """Blocks and windows may be many times as large in memory as in their files (F5)."""
    monkeypatch.setattr(search, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(search, "BROADCAST_BYTES", 0)
    said = ["Remember that the red door of the house is always locked at night.", "Never forget that the blue door stays open on every Monday."]
    df = spark.createDataFrame([(f"b{n}", "u", "w", "memory/1.md", "2026-01-01", n, t, "memory_log", 1) for n, t in enumerate(said)], BLOCK)
    items = spark.createDataFrame([("u", "w", "i", 1, "active", "note", None, said[0], None, 1, AT)], ITEM)
    c = maintenance.cycle(df, items, spark.createDataFrame([("none", 1, 0)], "id string, pipeline_version int, window_index int"))
    assert [r["content"] for r in c.stored.collect()] == said[1:] and c.skipped.count() == 1 and c.receipts.count() == 2
    for part in (c.stored, c.skipped, c.receipts):
        assert "Broadcast" not in part._jdf.queryExecution().executedPlan().toString()
