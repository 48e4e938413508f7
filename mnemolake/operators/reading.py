"""Paged reads, references and paths, Markdown import, extractor output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T


def continuation(next_from: Column) -> Column:
    """The notice after a text that goes on."""
    more = F.concat(F.lit("[More content available. Use from="), next_from.cast("string"), F.lit(" to continue.]"))
    return F.concat(F.lit("\n\n"), F.coalesce(more, F.lit("[More content available. Requested excerpt exceeded the default maxChars budget.]")))


def page(df: DataFrame, content: str, first: int, lines: int, max_chars: int) -> DataFrame:
    """``df`` plus ``page``, ``page_lines``, ``truncated``, ``next_from``, ``total_lines``: lines from ``first`` (1-based) on.

    At most ``lines``, and only as many whole ones as fit ``max_chars``; a first line too long is cut, and
    then there is no next line. What goes on ends with a notice.
    """
    first, lines, max_chars = max(1, first), max(1, lines), max(1, max_chars)
    rows = df.withColumn("_l", F.split(F.coalesce(content, F.lit("")), "\n", -1)).withColumn("total_lines", F.size("_l"))
    rows = rows.withColumn("_w", F.slice("_l", first, lines))
    # running ends in one pass; a line fits if its own end does
    ends = F.aggregate("_w", F.struct(F.lit(-1).alias("e"), F.lit(0).alias("n"), F.lit(False).alias("full")), lambda a, y: F.struct(
        (a["e"] + F.length(y) + 1).alias("e"), F.when(a["full"] | (a["e"] + F.length(y) + 1 > max_chars), a["n"]).otherwise(a["n"] + 1).alias("n"), (a["full"] | (a["e"] + F.length(y) + 1 > max_chars)).alias("full"),
    ), lambda a: a["n"])
    rows = rows.withColumn("_fit", ends)
    cut = (F.size("_w") > 0) & (F.col("_fit") == 0)
    shown = F.when(cut, 1).otherwise(F.col("_fit"))
    text = F.when(cut, F.substring(F.get("_w", F.lit(0)), 1, max_chars)).otherwise(F.array_join(F.slice("_w", F.lit(1), F.col("_fit")), "\n"))
    more = F.lit(first - 1) + F.size("_w") < F.col("total_lines")
    rows = rows.withColumns({"page_lines": shown, "truncated": cut | (F.col("_fit") < F.size("_w")) | more, "next_from": F.when(~cut & (more | (F.col("_fit") < F.size("_w"))), F.lit(first) + shown), "_t": text})
    whole = F.when(F.col("truncated") & (F.col("_t") != ""), F.concat("_t", continuation(F.col("next_from")))).otherwise(F.col("_t"))
    return rows.withColumn("page", whole).drop("_l", "_w", "_fit", "_t")


def session_page(chunks: DataFrame, keys: list[str], first: int, lines: int, max_chars: int) -> DataFrame:
    """A page of each indexed session (keys, ``page``, ``from_line``, ``page_lines``, ``truncated``, ``next_from``) over its sparse source lines.

    ``chunks``: (keys, ``start_line``, ``chunk_index``, ``text``). Pieces of one source line stay together
    where whole lines are counted; the next page begins at the next source line that exists.
    """
    first, stop, max_chars = max(1, first), max(1, first) + max(1, lines), max(1, max_chars)
    rows = chunks.where("start_line > 0").withColumn("text", F.coalesce("text", F.lit("")))
    beyond = rows.where(F.col("start_line") >= stop).groupBy(*keys).agg(F.min("start_line").alias("_beyond"))
    w = Window.partitionBy(*keys).orderBy("start_line", "chunk_index")
    here = rows.where((F.col("start_line") >= first) & (F.col("start_line") < stop))
    here = here.withColumns({"_i": F.row_number().over(w), "_end": F.sum(F.length("text") + 1).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1})
    here = here.withColumn("_in", (F.col("_end") <= max_chars) | (F.col("_i") == 1))
    by_line = here.groupBy(*keys, "start_line").agg(F.min("_in").alias("_whole"), F.max("_i").alias("_last"))
    lines_of = by_line.groupBy(*keys).agg(F.min("start_line").alias("from_line"), F.count_if("_whole").alias("page_lines"), F.min(F.when(~F.col("_whole"), F.col("start_line"))).alias("_inside"))
    parts = F.array_sort(F.collect_list(F.when(F.col("_in"), F.struct("_i", "text"))))
    text = here.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x["text"]), "\n").alias("_t"), F.min(F.when(F.col("_i") == 1, F.col("_end"))).alias("_first"), F.min("_in").alias("_all"))
    out = chunks.select(*keys).distinct().join(text, keys, "left").join(lines_of, keys, "left").join(beyond, keys, "left")
    cut = F.coalesce(F.col("_first") > max_chars, F.lit(False))
    truncated = F.coalesce(cut | ~F.col("_all") | F.col("_beyond").isNotNull(), F.lit(False)) & F.col("_t").isNotNull()
    # of one line cut hard the pieces after it do not count
    whole = F.when(cut, F.when(F.col("_inside").isNull() | (F.col("_inside") > F.col("from_line")), 1).otherwise(0)).otherwise(F.coalesce("page_lines", F.lit(0)))
    out = out.withColumns({"page_lines": whole.cast("bigint"), "truncated": truncated, "from_line": F.coalesce("from_line", F.lit(first))})
    out = out.withColumn("next_from", F.when(F.col("_t").isNotNull() & ~cut & (F.col("page_lines") > 0), F.coalesce("_inside", "_beyond")))
    body = F.coalesce(F.substring("_t", 1, max_chars), F.lit(""))
    return out.select(*keys, F.when(truncated & (body != ""), F.concat(body, continuation(F.col("next_from")))).otherwise(body).alias("page"), "from_line", "page_lines", "truncated", "next_from")


def line_reference(ref: Column) -> dict[str, Column]:
    """Parts of ``path#L3-L9``: path, first and last line."""
    at = lambda i: F.regexp_extract(ref, r"^(.*?)(?:#L(\d+)(?:-L?(\d+))?)?$", i)
    start = at(2).try_cast("int")
    return {"path": at(1), "from_line": start, "to_line": F.coalesce(at(3).try_cast("int"), start)}


_UUID = "[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
_STAMP = r"\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2}(?:\.\d{3})?Z"


def path_kind(path: Column) -> Column:
    """Which read a path asks for: item, daily_id, export, session, daily or other."""
    p = F.regexp_replace(T.whole_trim(path), r"/+", "/")
    return (
        F.when(p.rlike(rf"(?i)^db-memory/items/{_UUID}\.md$"), "item").when(p.rlike(rf"(?i)^db-memory/daily/{_UUID}\.md$"), "daily_id")
        .when((p == "db-memory/export/MEMORY.md") | (p == "MEMORY.md"), "export").when(session_path(path).isNotNull(), "session")
        .when(p.startswith("memory/") & ~p.contains("..") & (p != "memory/"), "daily").otherwise("other")
    )


def session_path(path: Column) -> Column:
    """``sessions/<agent>/<file>`` in its plain form, or null: three parts, either slash, no dots as a name."""
    plain = F.regexp_replace(F.translate(T.whole_trim(path), "\\", "/"), r"/+", "/")
    plain = F.regexp_replace(plain, r"/$", "")
    return F.when(plain.rlike(r"^sessions/[^/]+/[^/]+$") & ~plain.rlike(r"/\.{1,2}$"), plain)


def transcript_kind(name: Column) -> Column:
    """Primary transcripts and their archives (named by the time they were put away); other files of the folder are none."""
    checkpoint = name.rlike(r"(?i)^.+\.checkpoint\.[0-9a-f]{8}-[0-9a-f]{4}-[1-5][0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}\.jsonl$")
    return (
        F.when(name.rlike(rf"\.reset\.{_STAMP}$"), "reset").when(name.rlike(rf"\.deleted\.{_STAMP}$"), "deleted").when(name.rlike(rf"\.bak\.{_STAMP}$"), None)
        .when((name == "sessions.json") | name.endswith(".trajectory.jsonl") | checkpoint, None).when(name.endswith(".jsonl"), "primary")
    )


def export_document(items: DataFrame, generated_at: Column, limit: int = 200) -> DataFrame:
    """Snapshot of each scope (``user_id``, ``workspace_id``, ``content``): its first active items by importance, rendered."""
    scope = ["user_id", "workspace_id"]
    w = Window.partitionBy(*scope).orderBy(F.col("importance").desc_nulls_last(), F.col("updated_at").desc(), F.col("id"))
    rows = items.where("status = 'active'").withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= limit)
    title = F.coalesce(F.nullif(T.whole_trim(F.col("title")), F.lit("")), F.col("id"))
    field = lambda n, c: F.concat(F.lit(f"- {n}: `"), c.cast("string"), F.lit("`"))
    block = F.concat_ws(
        "\n", F.concat(F.lit("### ("), "type", F.lit(") "), title), F.lit(""), field("id", F.col("id")), field("status", F.col("status")), field("source", F.coalesce("source", F.lit(""))),
        field("updated_at", F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")), F.lit(""), "content", F.lit(""),
    )
    blocks = rows.groupBy(*scope).agg(F.array_sort(F.collect_list(F.struct("_n", block.alias("b")))).alias("_b"))
    all_ = items.select(*scope).distinct().join(blocks, scope, "left")
    head = F.concat_ws("\n", F.lit("# MEMORY.md (Export)"), F.lit(""), F.concat(F.lit("- Generated: "), generated_at), F.concat(F.lit("- Scope: user="), "user_id", F.lit(" workspace="), "workspace_id"), F.lit(""))
    body = F.when(F.col("_b").isNull(), "_No active durable memory items._").otherwise(F.concat(F.lit("## Durable Items\n\n"), F.array_join(F.transform("_b", lambda x: x["b"]), "\n")))
    return all_.select(*scope, F.concat(head, F.lit("\n"), body).alias("content"))


def read_routes(lookups: DataFrame, items: DataFrame, entries: DataFrame, chunks: DataFrame, exports: DataFrame) -> DataFrame:
    """What each lookup (``lookup``, scope) reads: (``lookup``, scope, ``kind``, ``content``); a null content was not found.

    Deleted items and internal kinds of entries are not found. Sessions are read from the index, their lines in order.
    """
    scope = ["user_id", "workspace_id"]
    asked = lookups.withColumn("kind", path_kind(F.col("lookup")))
    ident = F.lower(F.regexp_extract("lookup", r"([0-9a-fA-F-]{36})\.md$", 1))
    visible = entries.where("source_kind <> 'session_memory'")
    texts = F.array_sort(F.collect_list(F.struct("start_line", "chunk_index", "text")))
    files = chunks.groupBy(*scope, "path").agg(F.array_join(F.transform(texts, lambda x: x["text"]), "\n").alias("content"))
    by = lambda kind, rows, key: asked.where(F.col("kind") == kind).withColumn("_k", key).join(rows, [*scope, "_k"], "left").select("lookup", *scope, "kind", "content")
    rest = asked.where("kind = 'other'").select("lookup", *scope, "kind", F.lit(None).cast("string").alias("content"))
    return (
        by("item", items.where("status <> 'deleted'").select(*scope, F.lower("id").alias("_k"), "content"), ident)
        .unionByName(by("daily_id", visible.select(*scope, F.lower("id").alias("_k"), "content"), ident))
        .unionByName(by("daily", visible.groupBy(*scope, F.col("path").alias("_k")).agg(F.min_by("content", "id").alias("content")), T.whole_trim(F.col("lookup"))))
        .unionByName(by("session", files.withColumnRenamed("path", "_k"), session_path(F.col("lookup"))))
        .unionByName(by("export", exports.select(*scope, F.lit("x").alias("_k"), "content"), F.lit("x"))).unionByName(rest)
    )


def heading_title(path: Column) -> Column:
    """Title of a heading path: without a generic first heading, joined; ``Memory`` of none."""
    segments = heading_segments(path)
    return F.when(F.size(segments) > 0, F.array_join(segments, " > ")).otherwise("Memory")


def heading_segments(path: Column) -> Column:
    generic = F.lower(F.trim(F.get(path, F.lit(0)))).isin("memory", "long-term memory")
    return F.when((F.size(path) > 1) & generic, F.slice(path, F.lit(2), F.size(path))).otherwise(path)


def guessed_type(title: Column) -> Column:
    return F.when(F.lower(F.trim(title)).rlike("fact|preference"), "fact").otherwise("note")


def markdown_items(docs: DataFrame, key: str, content: str) -> DataFrame:
    """Blocks under headings: (key, ``block``, ``title``, ``type``, ``canonical_key``, ``content``).

    Headings are tracked per level by windows over the lines of one document; a block is a run of
    lines between blanks and headings.
    """
    lines = docs.select(key, F.posexplode(F.split(F.regexp_replace(content, "\r\n", "\n"), "\n")).alias("n", "line"))
    level = F.length(F.regexp_extract("line", r"^(#{1,6})\s+.+?\s*$", 1))
    lines = lines.withColumn("level", level)
    w = Window.partitionBy(key).orderBy("n")
    breaks = ((F.col("level") > 0) | (F.trim("line") == "")).cast("int")
    lines = lines.withColumn("_b", F.sum(breaks).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    name = F.trim(F.regexp_extract("line", r"^#{1,6}\s+(.+?)\s*$", 1))
    # the newest heading of each level, void once a higher one came after it
    for i in range(1, 7):
        lines = lines.withColumn(f"_h{i}", F.last(F.when(F.col("level") == i, F.struct("n", name.alias("t"))), True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    valid = lambda i: F.when(F.coalesce(F.greatest(*[F.coalesce(F.col(f"_h{j}.n"), F.lit(-1)) for j in range(1, i)], F.lit(-1)) < F.col(f"_h{i}.n"), F.lit(False)), F.col(f"_h{i}.t")) if i > 1 else F.col("_h1.t")
    path = F.array_compact(F.array(*[valid(i) for i in range(1, 7)]))
    body = lines.where("level = 0 and trim(line) <> ''").withColumn("path", path)
    blocks = body.groupBy(key, F.col("_b").alias("block")).agg(F.first("path").alias("path"), F.array_sort(F.collect_list(F.struct("n", "line"))).alias("ls"))
    blocks = blocks.withColumn("segments", heading_segments(F.col("path")))
    title = heading_title(F.col("path"))
    kind = guessed_type(title)
    suffix = F.array_join(F.filter(F.transform("segments", T.slugify), lambda s: s != ""), ":")
    text = F.trim(F.array_join(F.transform("ls", lambda x: x["line"]), "\n"))
    return blocks.select(key, "block", title.alias("title"), kind.alias("type"), F.concat(kind, F.lit(":"), F.when(suffix == "", "memory").otherwise(suffix)).alias("canonical_key"), text.alias("content"))


def import_key(canonical_key: Column, content: Column) -> Column:
    return F.concat(F.lit("memory.md:"), canonical_key, F.lit(":"), F.sha2(F.trim(F.regexp_replace(content, "\r\n", "\n")), 256))
