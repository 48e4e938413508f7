"""Smaller selections: visibility, startup days, merged orders, extractor output, captures, labels of runs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.functions import transcript_text as X
from mnemolake.functions.scalars import is_transient


def visible_hits(hits: DataFrame, allowed: DataFrame) -> DataFrame:
    """Memory hits pass; session hits need an allowed session key."""
    memory = hits.where("corpus <> 'sessions'")
    return memory.unionByName(hits.where("corpus = 'sessions'").join(allowed.select("session_key").distinct(), "session_key", "left_semi").select(*hits.columns))


def startup_days(zone: Column, now: Column, days: int = 2) -> Column:
    """Local days from today backwards; the UTC day is put before if it is ahead, after if it is behind and not among them."""
    today = F.from_utc_timestamp(now, zone).cast("date")
    utc = now.cast("date")
    local = F.transform(F.sequence(F.lit(0), F.lit(days - 1)), lambda i: F.date_format(F.date_sub(today, i), "yyyy-MM-dd"))
    name = F.date_format(utc, "yyyy-MM-dd")
    return F.when(utc > today, F.concat(F.array(name), local)).when((utc < today) & ~F.array_contains(local, name), F.concat(local, F.array(name))).otherwise(local)


def websearch(words: Column, text: Column, query: str) -> Column:
    """Web-style query over the lexemes ``words`` of ``text``: quoted phrases, ``or``, leading minus; plain words must all be there."""
    joined = F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))
    groups: list[list[Column]] = [[]]
    for m in re.finditer(r'(-?)"([^"]*)"|(-?)(\S+)', query.lower()):
        minus, phrase = (m[1], m[2]) if m[2] is not None else (m[3], m[4])
        if phrase == "or" and m[4]:
            groups.append([])
            continue
        lexemes = re.findall(r"[^\W_]+", phrase)
        if lexemes:
            hit = joined.contains(f" {' '.join(lexemes)} ")
            groups[-1].append(~hit if minus else hit)
    wanted = F.lit(False)
    for g in groups:
        if g:
            all_of = g[0]
            for c in g[1:]:
                all_of = all_of & c
            wanted = wanted | all_of
    return wanted


def extractor_candidates(outputs: DataFrame, key: str, text: str, cap: int = 10) -> DataFrame:
    """Candidates out of a model's answer: a JSON object in a fence or in prose, taken only if all of it is as it must be.

    Strict: a text ``summary`` and a list ``candidates``; each with content, type fact or note, a key that is
    no blank where it is there, a finite number as confidence where it is there (floored, within 0 and 100).
    One bad candidate spoils the answer; the first ``cap`` are taken.
    """
    fenced = F.regexp_extract(F.col(text), r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    body = F.when(F.col(text).rlike(r"(?s)```(?:json)?\s*.*?\s*```") & (fenced != ""), F.trim(fenced)).otherwise(F.regexp_extract(F.col(text), r"(?s)(\{.*\})", 1))
    rows = outputs.select(key, F.nullif(body, F.lit("")).alias("_b"))
    rows = rows.where(F.try_parse_json("_b").isNotNull() & F.col("_b").rlike(r"^\s*\{"))
    rows = rows.withColumn("_o", F.from_json("_b", "struct<summary:string,candidates:array<string>>"))
    is_text = lambda j, p: F.schema_of_variant(F.variant_get(F.try_parse_json(j), p, "variant")) == "STRING"
    kind = lambda j, p: F.schema_of_variant(F.variant_get(F.try_parse_json(j), p, "variant"))
    number = lambda k: k.startswith("BIGINT") | k.startswith("DECIMAL") | k.startswith("DOUBLE")
    rows = rows.where(is_text(F.col("_b"), "$.summary") & F.coalesce(kind(F.col("_b"), "$.candidates").startswith("ARRAY"), F.lit(False)))
    shape = "struct<content:string,type:string,canonicalKey:string,confidence:double>"

    def sound(j: Column) -> Column:
        c, k, n = F.from_json(j, shape), kind(j, "$.canonicalKey"), kind(j, "$.confidence")
        return F.coalesce(
            j.rlike(r"^\s*\{") & is_text(j, "$.content") & (T.whole_trim(c["content"]) != "") & c["type"].isin("fact", "note")
            & (k.isNull() | ((k == "STRING") & (T.whole_trim(c["canonicalKey"]) != ""))) & (n.isNull() | number(n)), F.lit(False),
        )

    rows = rows.where(F.forall("_o.candidates", sound)).select(key, F.posexplode(F.slice("_o.candidates", 1, cap)).alias("place", "_j")).withColumn("c", F.from_json("_j", shape))
    confidence = F.greatest(F.lit(0), F.least(F.lit(100), F.floor("c.confidence"))).cast("int")
    return rows.select(key, "place", T.whole_trim(F.col("c.content")).alias("content"), F.col("c.type").alias("type"), T.whole_trim(F.col("c.canonicalKey")).alias("canonical_key"), F.when(F.col("c.confidence").isNotNull(), confidence).alias("confidence"))


def capture_turns(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Messages of a stored capture: after the heading of its summary (or from the start), a line ``role: text`` opens one, the lines after it go on.

    Texts are cleaned as captures are; empty ones are left, and an assistant's text that repeats the message before it.
    """
    whole = F.replace(F.col(text), F.lit("\r\n"), F.lit("\n"))
    lines = docs.select(key, F.posexplode(F.split(whole, "\n", -1)).alias("n", "line"))
    w = Window.partitionBy(key)
    lines = lines.withColumn("_from", F.min(F.when(T.whole_trim(F.col("line")) == "### Conversation Summary", F.col("n"))).over(w)).where("_from is null or n > _from")
    head = F.col("line").rlike(r"^(?:user|assistant):(?:\s|$)")
    lines = lines.withColumn("turn", F.sum(head.cast("int")).over(w.orderBy("n").rowsBetween(Window.unboundedPreceding, 0))).where("turn > 0")
    parts = F.array_sort(F.collect_list(F.struct("n", "line")))
    turns = lines.groupBy(key, "turn").agg(F.array_join(F.transform(parts, lambda x: x["line"]), "\n").alias("t"))
    turns = turns.select(key, "turn", F.regexp_extract("t", "^(user|assistant):", 1).alias("role"), X.capture_text(F.regexp_replace("t", r"^(?:user|assistant):\s?", ""), all_markers=True).alias("text"))
    turns = turns.where("text is not null")
    before = Window.partitionBy(key).orderBy("turn")
    # of a row of equal assistant texts the first stands, and what follows it is compared with the same text
    again = (F.col("role") == "assistant") & (F.lag("role").over(before) == "assistant") & (F.lag("text").over(before) == F.col("text"))
    turns = turns.withColumn("_again", F.coalesce(again, F.lit(False))).where("not _again")
    return turns.select(key, F.row_number().over(before).alias("turn"), "role", "text")


def recent_tail(turns: DataFrame, key: str, budget: int, marker: str = "...[earlier session messages omitted]...") -> DataFrame:
    """Newest whole messages of each capture (``turn``, ``role``, ``text``) that fit ``budget`` characters, as one text; a marker leads where some were left out and it fits."""
    line = F.concat("role", F.lit(": "), "text")
    back = Window.partitionBy(key).orderBy(F.col("turn").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = turns.withColumn("_line", line).withColumns({"_used": F.sum(F.length("_line") + 1).over(back) - 1, "_all": F.count("*").over(Window.partitionBy(key))})
    kept = rows.where(F.col("_used") <= budget).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("turn", "_line"))).alias("_l"), F.max("_used").alias("_u"), F.max("_all").alias("_n"))
    body = F.array_join(F.transform("_l", lambda x: x["_line"]), "\n")
    marked = (F.size("_l") < F.col("_n")) & (F.col("_u") + 1 + len(marker) <= budget)
    return kept.select(key, F.when(marked, F.concat(F.lit(marker + "\n"), body)).otherwise(body).alias("text"), F.size("_l").alias("shown"))


RUN = ["user_id", "workspace_id", "source_kind", "source_path", "source_sha256"]


def next_runs(wanted: DataFrame, runs: DataFrame) -> DataFrame:
    """Import runs to start: ``wanted`` (``RUN``) whose newest run has not completed, with the attempt that is due.

    ``runs``: (``RUN``, ``status``, ``attempt_count``, ``started_at``).
    """
    newest = runs.groupBy(*RUN).agg(F.max_by(F.struct("status", "attempt_count"), "started_at").alias("_l"))
    joined = wanted.select(*RUN).distinct().join(newest, RUN, "left")
    open_ = joined.where(F.coalesce(F.col("_l.status") != "completed", F.lit(True)))
    return open_.select(*RUN, F.lit("running").alias("status"), (F.coalesce("_l.attempt_count", F.lit(0)) + 1).alias("attempt_count"))


def ended_runs(runs: DataFrame, cleanup: bool) -> DataFrame:
    """Runs with their end: ``error`` (null if all went well) decides between completed, worth a retry and for good."""
    passing = is_transient(F.col("error"))
    status = F.when(F.col("error").isNull(), "completed").when(passing, "failed_retryable").otherwise("failed_permanent")
    code = F.when(F.col("error").isNull(), None).when(passing, "transient_db_error").otherwise("import_failed")
    tidy = F.when(F.col("error").isNull() & F.lit(cleanup), "failed").otherwise("not_needed")  # until the clean-up reports
    return runs.withColumns({"status": status, "last_error_code": code, "cleanup_status": tidy})


def cleaned_runs(runs: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Runs after their clean-up reported (``RUN``, ``cleaned`` boolean)."""
    joined = runs.join(cleaned.select(*RUN, "cleaned").distinct(), RUN, "left")
    return joined.withColumn("cleanup_status", F.when(F.col("cleaned"), "completed").when(F.col("cleaned").isNotNull(), "failed").otherwise(F.col("cleanup_status"))).drop("cleaned")


def run_summary(windows: DataFrame, stored: DataFrame, skipped: DataFrame, keys: list[str]) -> DataFrame:
    """Per scope what a maintenance pass did: windows seen, durable ones among them, items stored, candidates left out."""
    seen = windows.groupBy(*keys).agg(F.count("*").alias("scanned_count"), F.count_if(T.is_durable(F.col("content"))).alias("heuristic_candidate_count"))
    count = lambda df, n: df.groupBy(*keys).agg(F.count("*").alias(n))
    all_ = seen.join(count(stored, "inserted_count"), keys, "left").join(count(skipped, "skipped_count"), keys, "left")
    return all_.select(*keys, F.lit("completed").alias("status"), "scanned_count", "heuristic_candidate_count", *[F.coalesce(n, F.lit(0)).alias(n) for n in ("inserted_count", "skipped_count")])


def import_state(content: Column, readable: Column, logical_date: Column, imported: Column, is_page: Column) -> Column:
    """State of a file of a workspace to import: the durable page may be absent or a stub, day files unsupported without a date."""
    stub = T.without_comments(F.coalesce(content, F.lit(""))) == ""
    known = F.when(imported, "already_imported_active").otherwise("pending")
    page = F.when(content.isNull(), "absent").when(stub, "stub").otherwise(known)
    return F.when(is_page, page).otherwise(F.when(~readable | content.isNull(), "unreadable").when(logical_date.isNull(), "unsupported").otherwise(known))


def first_rows(rows: DataFrame, keys: list[Column | str], order: list[Column]) -> DataFrame:
    """The first row of each key, which may be an expression."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
