"""Search entry points: which corpus answers, what is shown, in which order, and what to do with it.

All of them take tables of requests and give hits as (``request``, ``corpus``, ``id``, ``path``,
``title``, ``snippet``, ``score``, ``importance``, ``updated_at``, ``start_line``, ``end_line``, ``rank``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.operators import records, search
from mnemolake.operators.selection import visible_hits
from mnemolake.runtime import written

SHOWN = ["request", "corpus", "id", "path", "title", "snippet", "source_kind", "canonical_key", "score", "importance", "updated_at", "start_line", "end_line", "rank"]


@dataclass
class Corpus:
    """The tables that searches read; what is not there is None and never asked."""

    items: DataFrame | None = None
    entries: DataFrame | None = None
    embeddings: DataFrame | None = None
    chunks: DataFrame | None = None
    lines: DataFrame | None = None  # lines of transcript files: scope, path, line_no, text, mtime, session_key
    allowed: DataFrame | None = None  # session keys that may be shown


def _ranked(hits: DataFrame, order: list[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("request").orderBy(*order))
    return hits.withColumn("rank", place).where(F.col("rank") <= k)


def shown(hits: DataFrame, corpus: Corpus) -> DataFrame:
    """Memory and daily hits with title and snippet of their rows; of the tables only the rows of hits are looked at."""
    hits = written(hits, "hits")
    ids = search.small(hits.select("id").distinct(), hits.count())
    parts = []
    if corpus.items is not None:
        i = search.live_items(corpus.items.select("id", "version", "updated_at", "title", "content", "canonical_key").join(ids, "id", "left_semi"))
        parts.append(i.select("id", F.lit("memory").alias("corpus"), "title", T.snippet(F.col("content")).alias("snippet"), F.lit(None).cast("string").alias("source_kind"), "canonical_key"))
    if corpus.entries is not None:
        e = search.live_entries(corpus.entries.select("id", "updated_at", "path", "content", "source_kind").join(ids, "id", "left_semi"))
        parts.append(e.select("id", F.lit("daily").alias("corpus"), F.col("path").alias("title"), T.snippet(F.col("content")).alias("snippet"), "source_kind", F.lit(None).cast("string").alias("canonical_key")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    none = F.lit(None).cast("int")
    return hits.join(rows, ["corpus", "id"], "left").withColumns({"start_line": none, "end_line": none}).select(*SHOWN)


def first_lines(lines: DataFrame, requests: DataFrame, k: int = 10) -> DataFrame:
    """Scan of transcript files: the first line of each file that holds the query, in the ``k`` newest files; every hit scores 1."""
    asked = requests.select("request", "user_id", "workspace_id", F.lower(F.trim("query")).alias("_needle")).where("_needle <> ''")
    found = lines.join(asked, ["user_id", "workspace_id"]).where(F.instr(F.lower("text"), F.col("_needle")) > 0)
    first = found.groupBy("request", "path").agg(F.min_by(F.struct("text", "line_no", "mtime", "session_key"), "line_no").alias("l"))
    none = F.lit(None)
    rows = first.select(
        "request", F.lit("sessions").alias("corpus"), F.col("path").alias("id"), "path", none.cast("string").alias("title"), T.snippet(F.col("l.text")).alias("snippet"), none.cast("string").alias("source_kind"), none.cast("string").alias("canonical_key"),
        F.lit(1.0).alias("score"), none.cast("int").alias("importance"), F.col("l.mtime").alias("updated_at"), F.col("l.line_no").cast("int").alias("start_line"), F.col("l.line_no").cast("int").alias("end_line"), F.col("l.session_key").alias("session_key"),
    )
    return _ranked(rows, [F.col("updated_at").desc_nulls_last(), F.col("path")], k)


def without_index(requests: DataFrame, chunks: DataFrame, agent: str | None = None) -> DataFrame:
    """Requests whose scope (or agent in it) has no index rows, so that the files must be scanned."""
    rows = chunks if agent is None else chunks.where(F.col("path").startswith(f"sessions/{agent}/"))
    return requests.join(rows.select("user_id", "workspace_id").distinct(), ["user_id", "workspace_id"], "left_anti")


def sessions(corpus: Corpus, requests: DataFrame, k: int = 10, agent: str | None = None) -> DataFrame:
    """Index hits; the scan of files only where there is no index at all; then what the caller may see."""
    c = search.session_hits(corpus.chunks, requests, k, agent)
    cut = F.substring("text", 1, 240)
    none = F.lit(None)
    hits = c.select(
        "request", F.lit("sessions").alias("corpus"), "id", "path", none.cast("string").alias("title"), F.when(F.length(cut) == 240, F.concat(cut, F.lit("…"))).otherwise(cut).alias("snippet"), none.cast("string").alias("source_kind"), none.cast("string").alias("canonical_key"),
        "score", none.cast("int").alias("importance"), F.col("file_updated_at").alias("updated_at"), "start_line", "end_line", F.regexp_extract("path", r"([^/]+?)(?:\.jsonl.*)?$", 1).alias("session_key"), "rank",
    )
    if corpus.lines is not None:
        hits = hits.unionByName(first_lines(corpus.lines, without_index(requests, corpus.chunks, agent), k))
    if corpus.allowed is not None:
        hits = visible_hits(hits, corpus.allowed)
    return hits.select(*SHOWN)


def memory(corpus: Corpus, requests: DataFrame, vectors: DataFrame | None = None, k: int = 10) -> DataFrame:
    """The lexical cascade, fused with vector hits where there are any."""
    lexical = search.cascade(corpus.items, corpus.entries, requests, k)
    if vectors is None or corpus.embeddings is None:
        return shown(lexical, corpus)
    near = search.semantic(corpus.items, corpus.embeddings, vectors, k).withColumn("corpus", F.lit("memory"))
    return shown(search.fuse(lexical, near, k), corpus)


def with_backlog(corpus: Corpus, vectors: DataFrame, embed: Callable[[DataFrame], DataFrame], profile: str, k: int = 10) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vector search that first embeds a little of what is missing: (hits, new embeddings, requests to queue).

    ``embed`` turns items (``id``, ``content``, ``version``) into rows of the embeddings table; at most
    five (and ``k``) newest missing items a scope are embedded. Scopes with a rest are queued.
    """
    live = search.live_items(corpus.items)
    current = search.current_embeddings(corpus.embeddings)
    todo = records.candidates_for_embedding(live, current, profile, min(5, k))
    fresh = written(embed(todo.select("id", "content", "version")), "inline-embeddings")
    hits = search.semantic(corpus.items, corpus.embeddings.unionByName(fresh, allowMissingColumns=True), vectors, k)
    left = records.embedding_backlog(live, search.current_embeddings(corpus.embeddings.unionByName(fresh, allowMissingColumns=True)), profile)
    queue = left.groupBy("user_id", "workspace_id").agg(F.count("*").alias("missing")).select("user_id", "workspace_id", F.lit(profile).alias("profile_key"), F.lit("search_missing").alias("reason"), "missing")
    return hits, fresh, queue


def across_order() -> list[Column]:
    """Order of hits from several corpora: score, durable and daily before sessions, path; importance does not count."""
    return [F.col("score").desc(), (F.col("corpus") == "sessions").cast("int"), F.col("path").asc()]


def exact_order() -> list[Column]:
    """Order for one exact value: titles or snippets that are markers gain two points, which the shown score does not have."""
    marked = T.is_marker(F.col("title")) | T.is_marker(F.col("snippet"))
    boosted = F.col("score") + F.when(marked, 2.0).otherwise(0.0)
    return [boosted.desc(), *search.hit_order()[1:]]


def routed(corpus_name: str, corpus: Corpus, requests: DataFrame, vectors: DataFrame | None = None, k: int = 10, min_score: float | None = None, agent: str | None = None) -> DataFrame:
    """Hits of the named corpus (memory, daily, sessions, all) with ``mode``: how they were found.

    ``min_score`` is applied after fusion, then requests for an exact value are ordered anew. Another
    name gives no hits.
    """
    requests = written(requests, "requests")
    found = F.lit(None).cast("string")
    if corpus_name == "memory":
        hits = memory(corpus, requests, vectors, k)
        found = F.lit("fts_memory")
    elif corpus_name == "daily":
        hits = shown(search.daily_cascade(corpus.entries, requests, k), corpus)
        found = F.lit("fts_daily")
    elif corpus_name == "sessions":
        hits = sessions(corpus, requests, k, agent)
        found = F.lit("sessions_index")
    elif corpus_name == "all":
        both = memory(corpus, requests, vectors, k).unionByName(sessions(corpus, requests, k, agent))
        hits = _ranked(both.drop("rank"), across_order(), k).select(*SHOWN)
        found = F.lit("all_merge_lexical")
    else:
        hits = memory(corpus, requests.limit(0), None, k)
    if vectors is not None and corpus_name in ("memory", "all"):
        near = vectors.select("request").distinct().withColumn("_v", F.lit(True))
        hits = hits.join(near, "request", "left")
        found = F.when(F.col("_v"), "hybrid_memory" if corpus_name == "memory" else "all_merge_hybrid").otherwise(found)
    elif corpus_name == "sessions" and corpus.lines is not None:
        bare = without_index(requests, corpus.chunks, agent).select("request").distinct().withColumn("_v", F.lit(True))
        hits = hits.join(bare, "request", "left")
        found = F.when(F.col("_v"), "sessions_fallback").otherwise(found)
    hits = hits.withColumn("mode", found).drop("_v")
    if min_score is not None:
        hits = hits.where(F.col("score") >= min_score)
    modes = requests.select("request", T.query_mode(F.col("query")).alias("query_mode"))
    hits = hits.join(search.small(modes, requests.count()), "request")
    exact = F.row_number().over(Window.partitionBy("request").orderBy(*exact_order()))
    kept = F.row_number().over(Window.partitionBy("request").orderBy("rank"))
    return hits.withColumn("rank", F.when(F.col("query_mode") == "exact_value", exact).otherwise(kept))


def advice(hits: DataFrame, requests: DataFrame) -> DataFrame:
    """Per request: ``exact_top1`` (title or snippet of the first hit is the query), its value, and what to do."""
    plain = lambda c: F.lower(T.whole_trim(c))
    top = hits.groupBy("request").agg(F.min_by(F.struct("title", "snippet"), "rank").alias("t"))
    joined = requests.join(top, "request", "left")
    query, title, snippet = plain(F.col("query")), plain(F.col("t.title")), plain(F.col("t.snippet"))
    exact = F.coalesce((query != "") & (F.coalesce(title == query, F.lit(False)) | F.coalesce(snippet == query, F.lit(False))), F.lit(False))
    value = F.when(exact, F.coalesce(F.nullif(T.whole_trim(F.col("t.title")), F.lit("")), F.nullif(T.whole_trim(F.col("t.snippet")), F.lit(""))))
    action = F.when(exact, "return_exact").when(F.col("t").isNotNull(), "inspect_top").otherwise("stop_not_found")
    return joined.select("request", exact.alias("exact_top1"), value.alias("exact_value"), action.alias("action"))


def visible_output(hits: DataFrame) -> DataFrame:
    """What is shown of each hit: line range, citation ``path#Ln-Lm``, notes, and its line of the list."""
    start = F.when(F.col("start_line") > 0, F.col("start_line")).otherwise(1)
    end = F.greatest(start, F.when(F.col("end_line") > 0, F.col("end_line")).otherwise(start))
    cite = F.when(F.coalesce("path", F.lit("")) == "", "").otherwise(F.concat("path", F.lit("#L"), start.cast("string"), F.when(end > start, F.concat(F.lit("-L"), end.cast("string"))).otherwise("")))
    daily = F.col("corpus") == "daily"
    capture = F.when(F.col("source_kind") == "session_memory", "Entry type: session capture from /new or /reset.")
    notes = F.when(daily, F.concat_ws("\n", F.lit("Scope: date-specific daily memory."), capture)).when(F.col("canonical_key") != "", F.concat(F.lit("Canonical key: "), "canonical_key"))
    source = F.concat(F.lit("\n\nSource: "), F.when(daily, "DB daily entry ").otherwise(""), cite)
    body = F.concat(F.col("snippet"), F.coalesce(F.concat(F.lit("\n\n"), notes), F.lit("")), F.when(cite != "", source).otherwise(""))
    label = F.when(daily, "daily DB entry").otherwise(F.col("corpus"))
    line = F.concat(F.col("rank").cast("string"), F.lit(". ["), label, F.lit("] "), cite, F.lit(" (score "), F.format_string("%.3f", F.col("score").cast("double")), F.lit(")"))
    return hits.withColumns({"citation": cite, "shown": F.when(F.coalesce("snippet", F.lit("")) != "", body).otherwise(""), "line": line})


def manager(corpus: Corpus, requests: DataFrame, sources: tuple[str, ...] = ("memory",), k: int = 10, min_score: float | None = None, agent: str | None = None) -> DataFrame:
    """Search over named sources, lexical only: mapped hits by score, memory before sessions, path."""
    requests = written(requests, "requests")
    parts = []
    if "memory" in sources:
        parts.append(memory(corpus, requests, None, k))
    if "sessions" in sources:
        parts.append(sessions(corpus, requests, k, agent))
    hits = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    start = F.when(F.col("start_line") > 0, F.col("start_line")).otherwise(1)
    end = F.when(F.col("end_line") >= start, F.col("end_line")).otherwise(start)
    source = F.when(F.col("corpus") == "sessions", "sessions").otherwise("memory")
    mapped = hits.select("request", "id", "path", "score", "snippet", start.alias("start_line"), end.alias("end_line"), source.alias("source"))
    if min_score is not None:
        mapped = mapped.where(F.col("score") >= min_score)
    return _ranked(mapped, [F.col("score").desc(), F.col("source").asc(), F.col("path").asc(), F.col("id").asc()], k)


def known_candidates(candidates: DataFrame, items: DataFrame) -> DataFrame:
    """Candidates (unique ``cid``, scope, ``type``, ``canonical_key``, ``content``) that the active items say already.

    One of: an item of the type with the key (namespaces do not matter); an item with the same
    comparable content; of the three items most like it among those with all its words, one that
    contains it or is contained in it. A candidate without words is known.
    """
    scope = ["user_id", "workspace_id"]
    same = T.comparable(F.col("content"))
    active = search.item_docs(items).withColumn("_same", same)
    c = written(candidates.select("cid", *scope, "type", "canonical_key", "content", same.alias("_same")), "said-candidates")
    by_key = c.join(active.select(*scope, "type", "canonical_key").distinct().hint("merge"), [*scope, "type", "canonical_key"], "left_semi").select("cid")
    by_text = c.join(active.select(*scope, "_same").distinct().hint("merge"), [*scope, "_same"], "left_semi").select("cid")
    blank = c.where(F.coalesce("_same", F.lit("")) == "").select("cid")
    asked = c.select(F.col("cid").alias("request"), *scope, F.col("content").alias("query"))
    met = search.candidates(active.select("_d", *scope, "id", "content", "_doc"), asked)
    hits = F.aggregate(F.transform("_q", lambda q: F.size(F.filter("_doc", lambda w: w == q))), F.lit(0), lambda a, x: a + x)
    a, b = same, T.comparable(F.col("query"))
    rated = met.select("request", "id", (hits / F.size("_doc")).alias("_share"), ((a != "") & ((F.instr(a, b) > 0) | (F.instr(b, a) > 0))).alias("_held"))
    best = Window.partitionBy("request").orderBy(F.col("_share").desc(), F.col("id"))
    held = rated.withColumn("_n", F.row_number().over(best)).where("_n <= 3").where("_held").select(F.col("request").alias("cid"))
    return by_key.unionByName(by_text).unionByName(blank).unionByName(held).distinct()
