import datetime
import shutil

from mnemolake.llm import conversations as C

SHAPE = (
    "row_id bigint, session_id string, record_type string, line_no int, role string, content string, timestamp string, provenance string, workspace_id string, ingested_at timestamp, zone string, hash int, turns int"
)
AT = datetime.datetime(2026, 1, 1)


def row(n, session, line, role, content, stamp="2026-01-01T00:00:00.000Z", kind="message", provenance=None):
    return (n, session, kind, line, role, content, stamp, provenance, "w", AT, "x", 1, 2)


ROWS = [
    row(1, "ok", 1, None, None, kind="session"), row(3, "ok", 2, " Human", "hi"), row(2, "ok", 2, "user", "hi"), row(4, "ok", 3, "tool", '{"exit":0}'), row(5, "ok", 4, "BOT", '[{"type":"text","text":"yes"}]'),
    row(10, "gap", 1, "user", "a"), row(11, "gap", 3, "ai", "b"),
    row(20, "two", 1, "user", "a"), row(21, "two", 1, "user", "b"), row(22, "two", 2, "ai", "c"),
    row(30, "cut", 1, "user", '[{"type": "text", "te'), row(31, "cut", 2, "ai", "c"),
    row(40, "noreply", 1, "user", "a"), row(41, "noreply", 2, "assistant", '{"action": "no_reply"}'),
    row(50, "assistant first", 1, "assistant", "a"), row(51, "assistant first", 2, "assistant", "b"),
    row(60, "blank", 1, "user", "​  "), row(61, "blank", 2, "user", None), row(62, "blank", 3, "user", "[]"), row(63, "blank", 4, "assistant", "NO_REPLY"),
    row(70, "lost", None, "assistant", "b", "2026-01-01T00:00:05.000Z"), row(71, "lost", None, "user", "a", "1767225601"), row(72, "lost", None, "human", "a", "2026-01-01T00:00:01Z"), row(73, "lost", None, "ai", "tail", "unknown"),
    row(80, "relayed", 1, "user", "a", provenance='{"kind": "inter_session"}'), row(81, "relayed", 2, "ai", "b"),
    row(90, "template", 1, "user", "{{name}} wrote [TITLE]"), row(91, "template", 2, "ai", "[TITLE] done"),
    row(95, None, 1, "user", "a"), row(96, "long", 1, "user", "x" * 200_000), row(97, "long", 2, "ai", "y"),
]
WANT = {("ok", 1, 2), ("ok", 2, 5), ("lost", 1, 71), ("lost", 2, 70), ("lost", 3, 73), ("template", 1, 90), ("template", 2, 91), ("long", 1, 96), ("long", 2, 97)}


def turns(spark, tmp_path, *batches, **kw):
    shutil.rmtree(tmp_path / "m", ignore_errors=True)
    for rows in batches:  # one file, and so one micro-batch, each
        spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(str(tmp_path / "m"))
    spaces = spark.createDataFrame([("w", '{"timezone": "UTC"}')], "id string, metadata string")
    stream = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1 if len(batches) > 1 else 100).parquet(str(tmp_path / "m"))
    return {tuple(r) for r in C.conversation_turns(spark.read.parquet(str(tmp_path / "m")), stream, spaces, **kw).collect()}


def test_cases_and_the_long_way(spark, tmp_path):
    assert turns(spark, tmp_path, ROWS) == WANT
    assert turns(spark, tmp_path, ROWS, max_lines=1) == WANT


def test_empty(spark, tmp_path):
    assert turns(spark, tmp_path, []) == set()


def test_far_dates_and_late_lines_in_three_batches(spark, tmp_path):
    """A line dated 9999 moves no clock, and lines that come after their session was closed still count."""
    at = lambda n, session, line, role, day, stamp: (*row(n, session, line, role, f"t{n}", stamp)[:9], datetime.datetime(2026, day, 1), "x", 1, 2)
    first = [at(1, "far", 1, "user", 1, "2026-01-01T00:00:00Z"), at(2, "far", 2, "ai", 1, "9999-01-01T00:00:00Z"), at(3, "late", 1, "user", 1, "2026-01-02T00:00:00Z")]
    second = [at(4, "new", 1, "user", 9, "2026-09-01T00:00:00Z"), at(5, "new", 2, "ai", 9, "2026-09-01T00:00:01Z")]
    third = [at(6, "late", 2, "ai", 1, "2026-01-02T00:00:05Z"), at(7, "old", 1, "user", 1, "0001-01-01T00:00:00Z"), at(8, "old", 2, "ai", 1, "2026-01-01T00:00:00Z")]
    want = {("far", 1, 1), ("far", 2, 2), ("late", 1, 3), ("late", 2, 6), ("new", 1, 4), ("new", 2, 5), ("old", 1, 7), ("old", 2, 8)}
    assert turns(spark, tmp_path, first + second + third) == want
    assert turns(spark, tmp_path, first, second, third) == want
    assert turns(spark, tmp_path, first, second, third, max_lines=1, delay="1 day", gap="1 day") == want
    assert turns(spark, tmp_path, first, second, ROWS) >= WANT
