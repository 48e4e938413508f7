"""Transcript files: listing, JSON lines with source coordinates, sessions made by machines, entries and chunks of an index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.functions import transcript_text as X
from mnemolake.functions.scalars import coerced_millis
from mnemolake.operators.reading import transcript_kind

LINE = "struct<type:string,timestamp:string,runId:string,sessionKey:string,data:struct<runId:string,sessionKey:string>,message:struct<role:string,content:string,timestamp:string,provenance:struct<kind:string>>>"


def regular_files(spark: SparkSession, folder: str, pattern: str = "*", max_bytes: int | None = None) -> DataFrame:
    """(``path``, ``name``, ``mtime``, ``size``, ``value``) of the text files of a folder tree; files over ``max_bytes`` are not read.

    Size and name are tested on the listing, before any content is loaded.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    if max_bytes is not None:
        files = files.where(F.col("length") <= max(1, int(max_bytes)))
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.col("modificationTime").alias("mtime"), F.col("length").alias("size"), F.decode("content", "UTF-8").alias("value"))


def transcript_files(spark: SparkSession, folder: str, max_bytes: int | None = None) -> DataFrame:
    """Transcripts of a folder tree and their archives: the files' columns and ``kind``; other files of the folder are left."""
    files = regular_files(spark, folder, "*.jsonl*", max_bytes)
    return files.withColumn("kind", transcript_kind(F.col("name"))).where("kind is not null")


def markdown_files(spark: SparkSession, folder: str) -> DataFrame:
    """Markdown files of a folder tree in order of their relative path: (``rel_path``, ``content``)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    bare = lambda c: F.regexp_replace(c, r"^[a-z0-9]+:/+", "/")  # noqa: E731 - a local root has one slash here and three there
    files = regular_files(spark, folder, "*.md")
    rel = F.substring(bare(F.col("path")), len("/" + root.split(":", 1)[-1].lstrip("/")) + 2, 2_000)
    return files.select(rel.alias("rel_path"), F.col("value").alias("content")).orderBy("rel_path")


def parsed_lines(files: DataFrame) -> DataFrame:
    """(``path``, ``line_no``, ``record``) of every line that is a JSON object; blank and broken lines are skipped."""
    lines = files.select("path", F.posexplode(F.split("value", r"\r?\n")).alias("n", "line"))
    sound = lines.where(F.col("line").rlike(r"^\s*\{") & F.try_parse_json("line").isNotNull())
    return sound.select("path", (F.col("n") + 1).alias("line_no"), F.from_json("line", LINE).alias("record"))


def generated_stems(stores: DataFrame) -> DataFrame:
    """(``agent_id``, ``stem``, ``dream``, ``cron``) of session stores (``agent_id``, ``json``: key to entry), as far as machines made the session.

    An entry names its file by ``sessionFile`` or by ``sessionId``; a file belongs to machines if any of its keys does.
    """
    entries = stores.select("agent_id", F.explode(F.from_json("json", "map<string,struct<sessionId:string,sessionFile:string>>")).alias("key", "e"))
    given = F.nullif(F.trim(F.col("e.sessionFile")), F.lit(""))
    name = F.coalesce(F.element_at(F.split(given, "/"), -1), F.concat(F.nullif(F.trim(F.col("e.sessionId")), F.lit("")), F.lit(".jsonl")))
    rows = entries.select("agent_id", F.regexp_replace(name, r"\.jsonl$", "").alias("stem"), X.is_dream_key(F.col("key")).alias("dream"), X.is_cron_run_key(F.col("key")).alias("cron"))
    return rows.where("stem is not null").groupBy("agent_id", "stem").agg(F.max("dream").alias("dream"), F.max("cron").alias("cron"))


def stem_of(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.jsonl(?:\.(?:reset|deleted)\..*)?$", "")


def visible_lines(lines: DataFrame, marks: X.Markers = X.Markers()) -> DataFrame:
    """(``path``, ``line_no``, ``role``, ``shown``, ``ms``): user and assistant messages with visible text, not relayed from another session.

    From the first record of a dreaming run on, nothing of a file is shown; nothing at all of an archive with a scheduled run.
    """
    m, r = F.col("record.message"), F.col("record")
    dream = F.greatest(*[F.coalesce(c.startswith(X.DREAM_RUN), F.lit(False)) for c in (r["runId"], r["sessionKey"], r["data"]["runId"], r["data"]["sessionKey"])])
    archive = transcript_kind(F.element_at(F.split("path", "/"), -1)).isin("reset", "deleted")
    said = X.message_parts(m["content"])
    prompt = F.coalesce((m["role"] == "user") & X.is_cron_prompt(T.one_line(said)), F.lit(False))
    cron = F.coalesce(archive, F.lit(False)) & (X.is_cron_run_key(r["sessionKey"]) | X.is_cron_run_key(r["data"]["sessionKey"]) | ((r["type"] == "message") & prompt))
    marked = lines.select("path", "line_no", "record", dream.alias("_dream"), F.coalesce(cron, F.lit(False)).alias("_cron"))
    made = marked.where("_dream or _cron").groupBy("path").agg(F.min(F.when(F.col("_cron"), 0).otherwise(F.col("line_no"))).alias("_until"))
    rows = marked.where((r["type"] == "message") & m["role"].isin("user", "assistant")).where(~F.coalesce((m["role"] == "user") & (m["provenance"]["kind"] == "inter_session"), F.lit(False)))
    rows = rows.join(made, "path", "left").where("_until is null or line_no < _until")
    rows = rows.withColumn("shown", X.visible_text(said, m["role"], marks)).where("shown is not null")
    return rows.select("path", "line_no", m["role"].alias("role"), "shown", coerced_millis(m["timestamp"], r["timestamp"]).alias("ms"))


def chunks(lines: DataFrame, width: int = 800) -> DataFrame:
    """Index chunks (``path``, ``chunk_index``, ``line_no``, ``text``, ``ms``): long lines wrapped, each piece with its speaker and source line."""
    speaker = F.when(F.col("role") == "user", "User: ").otherwise("Assistant: ")
    short = F.length("shown") <= max(80, width)
    pieces = F.when(short, F.array("shown")).otherwise(X.wrapped_text(F.when(~short, F.col("shown")), max(80, width)))
    rows = lines.select("path", "line_no", "ms", speaker.alias("_s"), F.posexplode(pieces).alias("piece", "_t"))
    at = F.row_number().over(Window.partitionBy("path").orderBy("line_no", "piece")) - 1
    return rows.select("path", at.alias("chunk_index"), "line_no", "piece", F.concat("_s", "_t").alias("text"), "ms")


def entries(pieces: DataFrame, files: DataFrame) -> DataFrame:
    """One row a file (``path``, ``hash``, ``line_count``): the hash covers content, source lines and times; files without text have one too."""
    parts = F.array_sort(F.collect_list(F.struct("chunk_index", "text", "line_no", "ms")))
    grouped = pieces.groupBy("path").agg(parts.alias("p"))
    joined = lambda f, by: F.array_join(F.transform(F.coalesce("p", F.array().cast("array<struct<chunk_index:int,text:string,line_no:int,ms:bigint>>")), lambda x: x[f].cast("string")), by)
    whole = F.concat(joined("text", "\n"), F.lit("\n"), joined("line_no", ","), F.lit("\n"), joined("ms", ","))
    return files.select("path").distinct().join(grouped, "path", "left").select("path", F.sha2(whole, 256).alias("hash"), F.coalesce(F.size("p"), F.lit(0)).alias("line_count"))


def synced(old: DataFrame, new: DataFrame, agent: str | None, full: bool = True, force: bool = False) -> DataFrame:
    """What a sync does with each file: (``path``, ``action``, ``hash``).

    ``old`` and ``new``: (``path``, ``hash``). New files are indexed, changed ones (all with ``force``)
    updated, others skipped; in a full sync files of the agent that are no longer there are removed.
    """
    o = old.select("path", F.col("hash").alias("_old"))
    both = new.select("path", "hash").join(o, "path", "full_outer")
    mine = F.lit(True) if agent is None else F.col("path").startswith(f"sessions/{agent}/")
    action = (
        F.when(F.col("hash").isNull(), F.when(mine & F.lit(full), "removed").otherwise("kept")).when(F.col("_old").isNull(), "indexed").when((F.col("_old") == F.col("hash")) & F.lit(not force), "skipped").otherwise("updated")
    )
    return both.select("path", action.alias("action"), F.coalesce("hash", "_old").alias("hash"))


def synced_tables(actions: DataFrame, old_chunks: DataFrame, new_chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(files, chunks) of the index after a sync: chunks of written files are replaced whole, of the others kept."""
    files = actions.where("action <> 'removed'").select("path", "hash")
    written_ = actions.where("action in ('indexed', 'updated')").select("path")
    kept = actions.where("action in ('skipped', 'kept')").select("path")
    return files, new_chunks.join(written_, "path", "left_semi").unionByName(old_chunks.join(kept, "path", "left_semi").select(*new_chunks.columns))


def sync_counts(actions: DataFrame, keys: list[str]) -> DataFrame:
    """Counters of a sync; an update counts as indexed too."""
    of = lambda *names: F.count_if(F.col("action").isin(*names))
    return actions.groupBy(*keys).agg(of("indexed", "updated").alias("indexed"), of("updated").alias("updated"), of("skipped").alias("skipped"), of("removed").alias("removed"))


def captured_messages(messages: DataFrame, keys: list[str], order: list[Column], mirror: Column, most: int = 15, max_chars: int = 1_200) -> DataFrame:
    """The last ``most`` messages of each group as (keys, ``n``, ``role``, ``text``), cleaned for a capture.

    Relayed user lines, commands (``/...``) and texts of which nothing is left are out, and mirrored
    deliveries (``mirror``) that repeat the assistant's text shown last; a user's message ends that memory.
    """
    relayed = (F.col("role") == "user") & (F.get_json_object("provenance", "$.kind") == "inter_session")
    rows = messages.where(F.col("role").isin("user", "assistant")).where(~F.coalesce(relayed, F.lit(False)))
    raw = T.whole_trim(X.first_part(F.col("content")))
    sound = F.coalesce((raw != "") & ~raw.startswith("/"), F.lit(False))
    rows = rows.withColumn("_text", F.when(sound, X.capture_text(raw, all_markers=True))).withColumn("_mirror", F.coalesce(mirror & (F.col("role") == "assistant"), F.lit(False)))
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = rows.withColumn("_turn", F.sum((F.col("role") == "user").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.where("_text is not null")
    spoken = Window.partitionBy(*keys, "_turn").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # a mirror is either dropped as a repeat or, being shown, the last text itself; so the last text before it is the last one there
    rows = rows.withColumn("_before", F.last(F.when(F.col("role") == "assistant", F.col("_text")), True).over(spoken))
    rows = rows.where(~(F.col("_mirror") & F.coalesce(F.col("_text") == F.col("_before"), F.lit(False))))
    back = Window.partitionBy(*keys).orderBy(*[c.desc() for c in order])
    rows = rows.withColumn("_r", F.row_number().over(back)).where(F.col("_r") <= most)
    return rows.select(*keys, F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_r").desc())).alias("n"), "role", T.message_cut(F.col("_text"), max_chars).alias("text"))
