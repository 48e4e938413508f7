"""Rebuilding conversations from message rows (problem 1): keyed streaming state.

Transcript lines arrive in any order, late and more than once. A Structured Streaming job keys them
by session, buffers them in state (JVM session windows over the event time, under a watermark) and
emits a session's lines when the watermark says that it is closed: nothing came for ``gap``, and
rows later than ``delay`` are no longer waited for. A closed session is put together: repeated
deliveries become one message, the rest is ordered, damaged sessions are dropped.

State holds no text: role class, visibility, a content hash and the order keys of each line. The
window step is an aggregation inside the JVM, not a Python function per session, because sessions
are short (tens of lines) and a call per key would cost more than the work.

The event time of a line is its own instant, but never later than its arrival, so one line dated far
ahead cannot close the windows of all others. The stream is drained first; only then does a clock
row come, in a second run on the same checkpoint, and close by timeout what is still open. Lines
that came later than ``delay`` after others (possible with several micro-batches) are refused by the
state; they are counted, and if there are any, they are fetched from the table and judged with their
sessions. A session that speaks again after it was closed is emitted again; all closings of a
session are gathered before it is judged. So the result depends neither on ``gap`` and ``delay`` nor
on the number of micro-batches.

Sessions of more than ``max_lines`` lines go through the same state in parts of bounded size (a hash
of ``row_id``); the parts are judged by aggregates and distributed ranks that never hold a session in
one task, by the same rules.

Defined results: null session ids are dropped; null or blank content, content of JSON parts without
text, the silent-reply marker alone, and invisible characters are no text; a message without
readable instant and without line number sorts after the others; where two messages without line
numbers share an instant, the smaller ``row_id`` comes first; repeated rows never count twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mnemolake.functions.ranks import group_rank
from mnemolake.functions.timestamps import once
from mnemolake.operators.normal_times import with_instant
from mnemolake.runtime import shared_path, written

# Spellings of the two speaking roles.
USER_ROLES = ["user", "human"]
ASSISTANT_ROLES = ["assistant", "ai", "bot", "model"]

USER, ASSISTANT = 1, 2
_INVISIBLE = "[\\s\\p{Z}\\p{C}\\u034f\\u115f\\u1160\\u2800\\u3164\\uffa0\\ufe0e\\ufe0f]+"
# Fixed value: the marker of a reply that is not to be shown, alone or as {"action": ...}
_SILENT = r"(?i)\{\s*\"action\"\s*:\s*\"\s*NO_REPLY\s*\"\s*\}|[*.]*\bNO_REPLY\b[*.]*"
_JSON_LIKE = r"^\s*(?:\[\s*(?:\{\s*(?:\"|\}|$)|\"|\]|$)|\{\s*(?:\"|\}|$))"
_JSON_LIST = r"^\s*\[\s*(?:\{\s*\"|\]|$)"
_PARTS = "array<struct<type:string,text:string>>"
_EPOCH, _LATEST, _CLOCK = "1970-01-01 00:00:00", "2199-01-01 00:00:00", "2290-01-01 00:00:00"
_LINE = ["k", "row_id", "instant", "who", "visible", "hash", "broken"]


def message_text(content: Column) -> Column:
    """Text of a message: itself, or its ``text`` parts where it is a JSON list of parts."""
    parts = F.filter(F.from_json(content, _PARTS), lambda p: p["type"] == "text")
    joined = F.array_join(F.transform(parts, lambda p: p["text"]), "\n")
    return F.when(content.rlike(_JSON_LIST), F.coalesce(joined, content)).otherwise(content)


def transcript_lines(messages: DataFrame, workspaces: DataFrame) -> DataFrame:
    """What the state needs of each row: keys, role class, visibility, hash; no text."""
    role = F.regexp_replace(F.lower(F.col("role")), _INVISIBLE, "")
    who = F.when(role.isin(USER_ROLES), USER).when(role.isin(ASSISTANT_ROLES), ASSISTANT).otherwise(0)
    rows = messages.where("session_id is not null").select("session_id", "row_id", "record_type", "line_no", "role", "content", "timestamp", "provenance", "workspace_id", "ingested_at")
    rows = with_instant(rows, workspaces)
    rows = rows.withColumns({
        "who": who,
        "json_like": F.coalesce(F.col("content").rlike(_JSON_LIKE), F.lit(False)),
        "has_text": F.regexp_replace(F.regexp_replace(message_text(F.col("content")), _SILENT, ""), _INVISIBLE, "") != "",
    })
    relayed = F.coalesce(F.get_json_object("provenance", "$.kind") == "inter_session", F.lit(False))
    lost = F.col("line_no").isNull()
    speaker = F.when(lost, F.when(F.col("who") > 0, F.col("who").cast("string")).otherwise(role))
    arrived = F.least("ingested_at", F.lit(_LATEST).cast("timestamp"))  # an instant after its own arrival is no clock
    content_hash = F.coalesce(F.xxhash64("content"), F.lit(0))
    return rows.select(
        "session_id",
        F.greatest(F.coalesce(F.least(F.col("instant").cast("timestamp"), arrived), F.lit(_EPOCH).cast("timestamp")), F.lit(_EPOCH).cast("timestamp")).alias("event_time"),
        F.struct(lost.alias("lost"), F.col("line_no").cast("int").alias("line"), F.when(lost, F.col("instant")).alias("at"), speaker.alias("speaker"), F.when(lost, F.xxhash64("content")).alias("said")).alias("k"),
        F.col("row_id").cast("bigint").alias("row_id"),
        "instant",
        "who",
        ((F.col("record_type") == "message") & (F.col("who") > 0) & ~relayed & F.coalesce("has_text", F.lit(False))).alias("visible"),
        content_hash.alias("hash"),
        (F.col("json_like") & F.try_parse_json("content").isNull()).alias("broken"),
    )


def closed_sessions(lines: DataFrame, gap: str, delay: str) -> DataFrame:
    """Streaming: one row (``session_id``, ``part``, ``lines``, ``n``) whenever a session, or a part of a long one, closes."""
    window = F.session_window("event_time", gap)
    seen = lines.withWatermark("event_time", delay).groupBy("session_id", "part", window.alias("span"))
    return seen.agg(F.collect_list(F.struct(*_LINE)).alias("lines")).select("session_id", "part", "lines", F.size("lines").alias("n"))


def judged(sessions: DataFrame) -> DataFrame:
    """Put closed sessions together; keeps the sound ones as (``session_id``, ``turns``: ordered row ids and speakers)."""
    s = once(sessions.select("session_id", F.array_sort("lines").alias("lines")), "lines")
    before = lambda i: F.get(F.col("lines"), i - 1)
    s = s.withColumns({
        "kept": F.filter("lines", lambda x, i: (i == 0) | ~x["k"].eqNullSafe(before(i)["k"])),
        "torn": F.exists(F.transform("lines", lambda x, i: (i > 0) & ~x["k"]["lost"] & (x["k"]["line"] == before(i)["k"]["line"]) & (x["hash"] != before(i)["hash"])), lambda b: F.coalesce(b, F.lit(False)))
        | F.exists("lines", lambda x: x["broken"]),
    })
    s = once(s.select("session_id", "kept", "torn"), "kept", "torn")
    numbered = F.filter("kept", lambda x: ~x["k"]["lost"] & (x["k"]["line"] >= 1))
    complete = F.size(numbered) == F.coalesce(F.array_max(F.transform("kept", lambda x: x["k"]["line"])), F.lit(0))
    shown = F.transform(
        F.filter("kept", lambda x: x["visible"]),
        lambda x: F.struct(x["k"]["lost"].alias("lost"), x["k"]["line"].alias("line"), x["instant"].isNull().alias("unread"), F.when(x["k"]["lost"], x["instant"]).alias("at"), x["row_id"].alias("row_id"), x["who"].alias("who")),
    )
    s = s.withColumn("sound", ~F.col("torn") & (complete | (F.size(numbered) == 0)))
    s = once(s.select("session_id", F.when(F.col("sound"), F.array_sort(shown)).alias("turns")), "turns")
    first, last = F.get("turns", F.lit(0))["who"], F.element_at("turns", -1)["who"]
    return s.where((F.size("turns") > 0)).where((first == USER) & (last == ASSISTANT))


def run_closed_sessions(lines: DataFrame, gap: str = "30 days", delay: str = "30 days", base: str | None = None, finish: bool = True) -> DataFrame:
    """Drain a stream of ``transcript_lines`` (plus ``part``) and return all closed sessions, as a table of the shared folder.

    ``base`` names a folder with the state of earlier calls, to go on from there; ``finish`` says that
    the input is complete, so the sessions still open close by timeout.
    """
    spark = lines.sparkSession
    base = base or shared_path(spark, "conversations")
    # the clock is a second, still empty file stream; its row lies past every event time
    clock_at, shape = f"{base}/clock", "event_time timestamp"
    spark.createDataFrame([], shape).write.mode("ignore").parquet(clock_at)
    clock = spark.readStream.schema(shape).parquet(clock_at)
    clock = clock.select(*[(F.col(f.name) if f.name == "event_time" else F.lit(None).cast(f.dataType).alias(f.name)) for f in lines.schema.fields])
    # no filter on the key here: it would be pushed below the watermark and take the clock row away;
    # the clock's own window lies past every watermark and is never emitted
    closed = closed_sessions(lines.unionByName(clock), gap, delay)

    def drain() -> None:
        closed.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option("path", f"{base}/closed").option("checkpointLocation", f"{base}/state").start().awaitTermination()

    drain()
    if finish:
        spark.range(1).select(F.lit(_CLOCK).cast("timestamp").alias("event_time")).write.mode("append").parquet(clock_at)
        drain()
    return spark.read.schema(closed.schema).parquet(f"{base}/closed")


def _long_turns(lines: DataFrame) -> DataFrame:
    """The same judgement for sessions too long for one array."""
    one = lines.groupBy("session_id", "k").agg(
        F.min(F.struct("row_id", "instant", "who", "visible")).alias("m"),
        F.min("hash").alias("h0"), F.max("hash").alias("h1"), F.max("broken").alias("broken"),
    )
    number = F.when(~F.col("k.lost") & (F.col("k.line") >= 1), 1)
    verdict = one.groupBy("session_id").agg(
        F.max((~F.col("k.lost") & (F.col("h0") != F.col("h1"))) | F.col("broken")).alias("torn"),
        F.count(number).alias("numbered"), F.coalesce(F.max("k.line"), F.lit(0)).alias("largest"),
    ).where("not torn and (numbered = largest or numbered = 0)").select("session_id")
    shown = one.where("m.visible").select("session_id", F.col("k.lost").alias("lost"), F.col("k.line").alias("line"), F.col("m.instant").isNull().alias("unread"), F.when(F.col("k.lost"), F.col("m.instant")).alias("at"), F.col("m.row_id").alias("row_id"), F.col("m.who").alias("who"))
    ranked = group_rank(shown.join(verdict, "session_id"), ["session_id"], [F.col(c) for c in ("lost", "line", "unread", "at", "row_id")], "place")
    ends = ranked.groupBy("session_id").agg(F.min_by("who", "place").alias("first"), F.max_by("who", "place").alias("last"))
    kept = ends.where((F.col("first") == USER) & (F.col("last") == ASSISTANT)).select("session_id")
    return ranked.join(kept, "session_id").select("session_id", (F.col("place") + 1).alias("turn_no"), "row_id")


def with_parts(lines: DataFrame, long_sessions: DataFrame | None, max_lines: int) -> DataFrame:
    """``lines`` plus ``part``: null, or the number of the part of a long session (about ``max_lines`` lines each)."""
    if long_sessions is None:
        return lines.withColumn("part", F.lit(None).cast("int"))
    parts = F.ceil(F.col("count") / max_lines)
    return lines.join(long_sessions, "session_id", "left").withColumn("part", F.pmod(F.xxhash64("row_id"), parts).cast("int")).drop("count")


def conversation_turns(messages: DataFrame, stream: DataFrame, workspaces: DataFrame, max_lines: int = 20_000, gap: str = "30 days", delay: str = "30 days") -> DataFrame:
    """(``session_id``, ``turn_no``, ``row_id``) of every visible message of each sound session.

    ``messages`` and ``stream`` are the same rows, as a table and as a stream. Of the table only the
    session ids are counted, and lines that the state refused as too late are taken.
    """
    counts = messages.where("session_id is not null").groupBy("session_id").count()
    counts = written(counts, "session-counts")
    long_ids = counts.where(F.col("count") > max_lines)
    some_long = not long_ids.isEmpty()
    parted = lambda rows: with_parts(transcript_lines(rows, workspaces), long_ids if some_long else None, max_lines)
    closed = run_closed_sessions(parted(stream), gap, delay).where("session_id is not null")
    late = (counts.agg(F.sum("count")).first()[0] or 0) - (closed.agg(F.sum("n")).first()[0] or 0)
    if late:
        known = closed.select(F.explode("lines.row_id").alias("row_id"))
        missed = parted(messages).join(known, "row_id", "left_anti").select("session_id", "part", F.array(F.struct(*_LINE)).alias("lines"), F.lit(1).alias("n"))
        closed = closed.unionByName(written(missed, "late-lines"))
    whole = closed.where("part is null").groupBy("session_id").agg(F.flatten(F.collect_list("lines")).alias("lines"))
    turns = judged(whole).select("session_id", F.posexplode("turns").alias("p", "t")).select(
        "session_id", (F.col("p") + 1).cast("bigint").alias("turn_no"), F.col("t.row_id").alias("row_id")
    )
    if some_long:
        turns = turns.unionByName(_long_turns(closed.where("part is not null").select("session_id", F.inline("lines"))))
    return turns
