"""Retrieval: strict, relaxed and fuzzy tiers, vectors, fusion, for many requests at once.

A request is a row (``request``, ``user_id``, ``workspace_id``, ``query``). A text request meets the
postings (scope, lexeme) of its rarest lexeme, so of a hot scope only the rows with that lexeme
are looked at, and the join key of a hot scope is as many keys as it has lexemes; the candidates are
then tested whole, ranked inside the request and cut there. So one plan answers one request or a
million. Requests come from callers, their number is bounded by the caller; where it is small the
optimizer broadcasts them by its own size check.

Defined results: null content matches only by title or key; a query without lexemes finds nothing;
equal scores are ordered by importance, update time (newer first) and id; repeated rows of an item
count once; extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mnemolake.functions import text as T
from mnemolake.runtime import written



def live_items(items: DataFrame) -> DataFrame:
    """One row per item id: the newest version. Only the columns that are there decide, so callers prune first."""
    tie = [F.xxhash64("content")] if "content" in items.columns else []
    newest = Window.partitionBy("id").orderBy(F.col("version").desc_nulls_last(), F.col("updated_at").desc_nulls_last(), *tie)
    return items.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def live_entries(entries: DataFrame) -> DataFrame:
    newest = Window.partitionBy("id").orderBy(F.col("updated_at").desc_nulls_last(), F.xxhash64("content"))
    return entries.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


SCOPE = ["user_id", "workspace_id"]


BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8_000_000


def indexed(docs: DataFrame) -> DataFrame:
    """``docs`` written once with a short key ``_d`` of each row, for several passes of ``candidates``."""
    return written(docs.withColumn("_d", F.monotonically_increasing_id()), "search-docs")


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df`` to be broadcast if it has few ``rows``, else to be joined by sorting.

    The optimizer is never left to choose: it takes the compressed size of a written table for its
    size in memory, and would have the driver hold what is many times its limit.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df.hint("merge")


def light(df: DataFrame, size: int) -> DataFrame:
    """As ``small``, for wide rows of ``size`` bytes altogether."""
    return F.broadcast(df) if size <= BROADCAST_BYTES else df.hint("merge")


def _row_bytes(*texts: str) -> Column:
    """About what a row takes in memory."""
    return F.lit(200) + sum((F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in texts), F.lit(0))


def _word_key(word: str) -> Column:
    return F.xxhash64(*SCOPE, word).alias("_k")


def _bits(words: Column) -> Column:
    """One bit of 64 for each word: all bits of a request are among those of every text that holds its words."""
    one = lambda w: F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.xxhash64(w), F.lit(64)).cast("int"))
    return F.aggregate(words, F.lit(0).cast("bigint"), lambda a, w: a.bitwiseOR(one(w)))


def candidates(docs: DataFrame, requests: DataFrame) -> DataFrame:
    """``docs`` (``indexed``; scope, unique ``id``, ``_doc`` lexemes) with every request of their scope whose lexemes all are among ``_doc``.

    Candidates come from the postings of the lexeme of the request that the fewest texts of its scope
    have. Pairs are two numbers until the bits of both sides agree; then they are tested whole.
    """
    asked = requests.select("request", *SCOPE, "query", F.array_distinct(T.lexemes(F.col("query"))).alias("_q")).where(F.size("_q") > 0)
    asked = written(asked.withColumn("_r", F.monotonically_increasing_id()), "search-asked")
    words = asked.select("_r", *SCOPE, _bits(F.col("_q")).alias("_qb"), F.explode("_q").alias("_w")).select("_r", "_qb", _word_key("_w"))
    postings = docs.select("_d", *SCOPE, _bits(F.col("_doc")).alias("_db"), F.explode(F.array_distinct("_doc")).alias("_w")).select("_d", "_db", _word_key("_w"))
    many, heavy = asked.agg(F.coalesce(F.sum(F.size("_q")), F.lit(0)), F.coalesce(F.sum(_row_bytes("request", *SCOPE, "query") + 24 * F.size("_q")), F.lit(0))).first()
    held = postings.select("_k")
    if many <= BROADCAST_ROWS:
        held = held.join(F.broadcast(words.select("_k").distinct()), "_k", "left_semi")
    counts = held.groupBy("_k").agg(F.count("*").alias("_n"))
    least = F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_k").alias("k"), "_qb"))
    picked = words.join(small(counts, many), "_k", "left").groupBy("_r").agg(least.alias("_l")).where(F.col("_l.n") > 0)
    picked = written(picked.select("_r", F.col("_l.k").alias("_k"), F.col("_l._qb").alias("_qb"), F.col("_l.n").alias("_n")), "search-picked")
    rows, pairs_at_most = picked.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0))).first()
    pairs = postings.join(small(picked.drop("_n"), rows), "_k").where(F.col("_db").bitwiseAND(F.col("_qb")) == F.col("_qb")).select("_d", "_r")
    met = docs.join(small(pairs, pairs_at_most), "_d")
    mine = asked.select("_r", "request", F.col("user_id").alias("_user"), F.col("workspace_id").alias("_workspace"), "query", "_q")
    same_scope = (F.col("user_id") == F.col("_user")) & (F.col("workspace_id") == F.col("_workspace"))
    return met.join(light(mine, heavy), "_r").where(same_scope & T.matches_all(F.col("_doc"), F.col("_q"))).drop("_d", "_r", "_user", "_workspace")


def cover_density(doc: Column, query: Column, weight: float = 0.1) -> Column:
    """Sum over minimal covers of the query's lexemes, each worth less the more it spans.

    One pass over the places of the query's lexemes, which remembers the last place of each: at every
    place the least of them is the start of the cover that ends there; it never falls, and a start
    seen before was met by a shorter cover. So the work is linear in the text.
    """
    places = F.filter(F.transform(doc, lambda w, i: F.struct(w.alias("w"), (i + 1).alias("p"))), lambda x: F.array_contains(query, x["w"]))
    places = F.transform(places, lambda x, k: F.struct(x["w"].alias("w"), x["p"].alias("p"), k.alias("k")))
    none = F.transform(query, lambda q: F.lit(None).cast("struct<p:int,k:int>"))

    def step(s: Column, x: Column) -> Column:
        last = F.transform(s["last"], lambda l, j: F.when(F.get(query, j) == x["w"], F.struct(x["p"].alias("p"), x["k"].alias("k"))).otherwise(l))

        def after(n: Column) -> Column:
            low = F.array_min(n)
            same = F.exists(n, lambda y: y.isNull()) | (low["p"] == s["b"])
            worth = F.lit(weight) / (1 + (x["p"] - low["p"]) - (x["k"] - low["k"]))
            return F.struct(n.alias("last"), F.when(same, s["b"]).otherwise(low["p"]).alias("b"), (s["total"] + F.when(same, 0.0).otherwise(worth)).alias("total"))

        return F.get(F.transform(F.array(last), after), F.lit(0))

    return F.aggregate(places, F.struct(none.alias("last"), F.lit(0).alias("b"), F.lit(0.0).alias("total")), step, lambda s: s["total"])


def _ranked(hits: DataFrame, order: list[Column], k: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("request").orderBy(*order))
    return hits.withColumn("rank", place).where(F.col("rank") <= k)


def item_order() -> list[Column]:
    return [F.col("score").desc(), F.col("importance").desc_nulls_last(), F.col("updated_at").desc_nulls_last(), F.col("id").asc()]


def daily_order() -> list[Column]:
    return [F.col("score").desc(), F.col("logical_date").desc_nulls_last(), F.col("updated_at").desc_nulls_last(), F.col("id").asc()]


ITEM_COLUMNS = ["user_id", "workspace_id", "id", "version", "status", "type", "title", "content", "canonical_key", "importance", "updated_at"]


def item_docs(items: DataFrame) -> DataFrame:
    """Active items as ``candidates`` and the fuzzy tier read them, written once."""
    live = live_items(items.select(*ITEM_COLUMNS)).where("status = 'active'")
    return indexed(live.withColumns({"_doc": T.lexemes(T.search_text(F.col("title"), F.col("content"), F.col("canonical_key"))), "path": item_path()}))


def strict_items(items: DataFrame, requests: DataFrame, k: int = 10) -> DataFrame:
    return _strict_items(item_docs(items), requests, k)


def _strict_items(doc: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    low = F.lower("query")
    boost = (
        F.when(F.lower(F.coalesce("title", F.lit(""))) == low, 3.0).when(F.lower("content") == low, 2.5).when(F.lower(F.coalesce("canonical_key", F.lit(""))) == low, 2.25).otherwise(0.0)
    )
    scored = candidates(doc, requests).withColumn("score", F.round(cover_density(F.col("_doc"), F.col("_q")) + boost, 6))
    return _ranked(scored, item_order(), k)


def item_path() -> Column:
    return F.concat(F.lit("db-memory/items/"), F.col("id"), F.lit(".md"))


def daily_docs(entries: DataFrame) -> DataFrame:
    """Entries as ``candidates`` reads them, written once; internal source kinds stay hidden."""
    live = live_entries(entries.select("user_id", "workspace_id", "id", "path", "content", "source_kind", "logical_date", "updated_at")).where("source_kind <> 'session_memory'")
    return indexed(live.withColumn("_doc", T.lexemes(F.col("content"))))


def strict_daily(entries: DataFrame, requests: DataFrame, k: int = 10) -> DataFrame:
    """Internal source kinds stay hidden."""
    return _strict_daily(daily_docs(entries), requests, k)


def _strict_daily(doc: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    boost = F.when(F.lower("content") == F.lower("query"), 2.5).otherwise(0.0)
    scored = candidates(doc, requests).withColumn("score", F.round(cover_density(F.col("_doc"), F.col("_q")) + boost, 6))
    return _ranked(scored, daily_order(), k)


def relaxed(requests: DataFrame) -> DataFrame:
    """One row per relaxed form: (``request``, ``base``, ``form``, scope, ``query``)."""
    forms = requests.select("user_id", "workspace_id", F.col("request").alias("base"), F.posexplode(T.relaxed_queries(F.col("query"))).alias("form", "query"))
    return forms.withColumn("request", F.concat_ws("#", F.col("base").cast("string"), F.col("form").cast("string")))


_SHOWN = ["request", "corpus", "id", "path", "score", "importance", "updated_at"]


def _items_as_hits(hits: DataFrame) -> DataFrame:
    return hits.select("request", F.lit("memory").alias("corpus"), "id", "path", "score", F.col("importance").cast("int").alias("importance"), "updated_at")


def _daily_as_hits(hits: DataFrame) -> DataFrame:
    return hits.select("request", F.lit("daily").alias("corpus"), "id", "path", "score", F.lit(None).cast("int").alias("importance"), "updated_at")


def hit_order() -> list[Column]:
    """The one total order of merged lists: score, durable first, then importance (none is 0) and update time of durable rows, path."""
    durable = F.col("corpus") == "memory"
    return [
        F.col("score").desc(), durable.cast("int").desc(), F.when(durable, F.coalesce("importance", F.lit(0))).desc_nulls_last(),
        F.when(durable, F.col("updated_at")).desc_nulls_last(), F.col("path").asc(),
    ]


def _relaxed_hits(items: DataFrame | None, entries: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    """Hits of all relaxed forms among ``item_docs`` and ``daily_docs``, the best of each row: its highest score, of equal ones the first form's."""
    forms = written(relaxed(requests), "search-forms")
    hits = _daily_as_hits(_strict_daily(entries, forms, k))
    if items is not None:
        hits = _items_as_hits(_strict_items(items, forms, k)).unionByName(hits)
    joined = hits.join(small(forms.select("request", "base", "form"), forms.count()), "request")
    best = Window.partitionBy("base", "corpus", "id").orderBy(F.col("score").desc(), F.col("form"))
    kept = joined.withColumn("_b", F.row_number().over(best)).where("_b = 1").drop("request").withColumnRenamed("base", "request")
    return kept.select(*_SHOWN)


def fuzzy_items(items: DataFrame, requests: DataFrame, k: int = 10) -> DataFrame:
    """Trigram tier: set similarity, best-extent similarity, and substring boosts (``%`` and ``_`` stay live)."""
    return _fuzzy_items(live_items(items.select(*ITEM_COLUMNS)).where("status = 'active'").withColumn("path", item_path()), requests, k)


def _fuzzy_items(live: DataFrame, requests: DataFrame, k: int) -> DataFrame:
    st = F.lower(T.search_text(F.col("title"), F.col("content"), F.col("canonical_key")))
    doc = live.select("user_id", "workspace_id", "id", "path", "importance", "updated_at", st.alias("_st"), F.lower(F.coalesce("canonical_key", F.lit(""))).alias("_key"), T.trigrams(st).alias("_tg"))
    asked = requests.select("request", "user_id", "workspace_id", F.lower("query").alias("_low"), T.trigrams(F.col("query")).alias("_qg"))
    asked = written(asked, "fuzzy-asked")
    heavy = asked.agg(F.coalesce(F.sum(_row_bytes("request", *SCOPE, "_low") + 24 * F.size("_qg")), F.lit(0))).first()[0]
    pairs = doc.join(light(asked, heavy), ["user_id", "workspace_id"])
    like, like_key = F.expr("_st like concat('%', _low, '%')"), F.expr("_key like concat('%', _low, '%')")
    pairs = pairs.withColumns({"_like": like, "_like_key": like_key, "_share": F.size(F.array_intersect("_tg", "_qg")), "_sim": T.trigram_similarity(F.col("_tg"), F.col("_qg"))})
    near = pairs.where("_like or _like_key or _share > 0")

    @F.pandas_udf("double")
    def extent(texts: pd.Series, grams: pd.Series) -> pd.Series:
        return pd.Series([word_similarity(t, set(g)) for t, g in zip(texts, grams)], dtype="float64")

    rated = near.withColumn("_word", extent("_st", "_qg"))
    kept = rated.where("_like or _like_key or _word >= 0.45 or _sim >= 0.35")
    boost = F.when(F.col("_like"), 0.6).when(F.col("_like_key"), 0.4).otherwise(0.0)
    return _ranked(kept.withColumn("score", F.round(F.greatest("_sim", "_word") + boost, 6)), item_order(), k)


def word_similarity(text: str, grams: set[str]) -> float:
    """Best share of ``grams`` in any run of the text's ordered trigrams, over their union."""
    import re

    ordered = [f"  {w} "[i : i + 3] for w in re.findall(r"[^\W_]+", text.lower()) for i in range(len(w) + 1)]
    hits = [i for i, g in enumerate(ordered) if g in grams]
    best = 0.0
    for a in range(len(hits)):
        seen: set[str] = set()
        shared: set[str] = set()
        at = hits[a]
        for b in hits[a:]:
            for g in ordered[at : b + 1]:
                seen.add(g)
                if g in grams:
                    shared.add(g)
            at = b + 1
            ratio = len(shared) / (len(grams) + len(seen) - len(shared))
            best = max(best, ratio)
            if len(grams) / len(seen) < best:
                break
    return best


def cascade(items: DataFrame, entries: DataFrame, requests: DataFrame, k: int = 10) -> DataFrame:
    """Strict hits; where a request has none, relaxed hits; where it still has none, fuzzy hits.

    Each tier is written before the next is planned, so it is computed once and the next sees only what is left.
    """
    requests = written(requests, "search-requests")
    items, entries = item_docs(items), daily_docs(entries)
    strict = _items_as_hits(_strict_items(items, requests, k)).unionByName(_daily_as_hits(_strict_daily(entries, requests, k)))
    tiers = [written(strict.withColumn("tier", F.lit(1)), "tier-1")]
    left = written(requests.join(tiers[0].select("request").distinct(), "request", "left_anti"), "search-left")
    tiers.append(written(_relaxed_hits(items, entries, left, k).withColumn("tier", F.lit(2)), "tier-2"))
    left = left.join(tiers[1].select("request").distinct(), "request", "left_anti")
    tiers.append(_items_as_hits(_fuzzy_items(items, left, k)).withColumn("tier", F.lit(3)))
    return _ranked(tiers[0].unionByName(tiers[1]).unionByName(tiers[2]), hit_order(), k)


def daily_cascade(entries: DataFrame, requests: DataFrame, k: int = 10) -> DataFrame:
    """Strict, then relaxed, over daily entries alone."""
    requests, entries = written(requests, "search-requests"), daily_docs(entries)
    strict = written(_daily_as_hits(_strict_daily(entries, requests, k)).withColumn("tier", F.lit(1)), "tier-1")
    left = requests.join(strict.select("request").distinct(), "request", "left_anti")
    return _ranked(strict.unionByName(_relaxed_hits(None, entries, left, k).withColumn("tier", F.lit(2))), hit_order(), k)


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    size = norm(a) * norm(b)
    return F.when(size > 0, dot / size)


def is_usable(vector: Column, dimensions: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & (F.size(vector) == dimensions) & finite, F.lit(False))


def current_embeddings(embeddings: DataFrame) -> DataFrame:
    """Newest row per (item, profile)."""
    newest = Window.partitionBy("memory_item_id", "profile_key").orderBy(F.col("memory_item_version").desc_nulls_last(), F.col("updated_at").desc_nulls_last())
    return embeddings.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def semantic(items: DataFrame, embeddings: DataFrame, requests: DataFrame, k: int = 10) -> DataFrame:
    """Exact cosine scan inside the scope; requests carry ``profile_key`` and ``vector``; stale or misfit vectors are out.

    It compares every vector of the scope with every request of it, as an exact scan must; for all
    against all there is the index of problem 4.
    """
    live = live_items(items.select("user_id", "workspace_id", "id", "version", "status", "importance", "updated_at")).where("status = 'active'").drop("status")
    emb = current_embeddings(embeddings).where(is_usable(F.col("embedding"), F.col("dimensions"))).select(
        F.col("memory_item_id").alias("id"), "profile_key", "embedding", F.col("memory_item_version").alias("_v"), "dimensions"
    )
    asked = written(requests, "vector-asked")
    heavy = asked.agg(F.coalesce(F.sum(_row_bytes("request", *SCOPE, "profile_key") + 4 * F.size("vector")), F.lit(0))).first()[0]
    pairs = live.join(emb.hint("merge"), "id").where(F.col("version").eqNullSafe(F.col("_v"))).join(light(asked, heavy), [*SCOPE, "profile_key"])
    scored = pairs.where(F.size("vector") == F.col("dimensions")).withColumn("score", F.round(cosine(F.col("embedding"), F.col("vector")), 6)).where("score is not null")
    return _ranked(scored.withColumn("path", item_path()), item_order(), k)


def fuse(lexical: DataFrame, vector: DataFrame, k: int = 10, base: int = 60) -> DataFrame:
    """Reciprocal ranks of two ranked lists (``request``, ``corpus``, ``id``, ``path``, ``score``, ``importance``, ``updated_at``, ``rank``).

    Ranks are summed per hit; the appearance with the higher score represents it (of equal ones the
    lexical) and lends it everything but the score. A request without vector hits keeps its list and scores.
    """
    shown = F.struct(F.col("score").alias("shown_score"), F.lit(0).alias("_first"), "corpus", "path", "importance", "updated_at")
    part = lambda df, first: df.select("request", "id", (1.0 / (base + F.col("rank"))).alias("r"), shown.withField("_first", F.lit(first)).alias("s"), F.when(F.lit(first) == 1, F.col("rank")).alias("lex"))
    hybrid = vector.select("request").distinct().withColumn("_h", F.lit(True))
    both = part(lexical, 1).unionByName(part(vector, 0)).join(hybrid.hint("merge"), "request", "left")
    merged = both.groupBy("request", "id").agg(F.sum("r").alias("rrf"), F.max("s").alias("s"), F.min("lex").alias("lex"), F.max(F.coalesce("_h", F.lit(False))).alias("hybrid"))
    rows = merged.select("request", "id", "s.*", "lex", "hybrid", F.round(F.when(F.col("hybrid"), F.col("rrf")).otherwise(F.col("s.shown_score")), 9).alias("score")).drop("_first")
    return _ranked(rows, [F.when(~F.col("hybrid"), F.col("lex")).asc_nulls_first(), *hit_order()], k).drop("lex")


def session_files(chunks: DataFrame) -> DataFrame:
    """The files of an index: (scope, ``path``, ``file_updated_at``, ``lines``)."""
    return chunks.groupBy("user_id", "workspace_id", "path").agg(F.max("created_at").alias("file_updated_at"), F.count("*").alias("lines"))


def session_hits(chunks: DataFrame, requests: DataFrame, k: int = 10, agent: str | None = None) -> DataFrame:
    """Transcript index: path words weigh 1.0, text words 0.4; newer files first among equals."""
    newest = Window.partitionBy("id").orderBy(F.col("created_at").desc_nulls_last())
    rows = chunks.select("user_id", "workspace_id", "id", "path", "chunk_index", "start_line", "end_line", "text", "created_at").withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")
    if agent is not None:
        rows = rows.where(F.col("path").startswith(f"sessions/{agent}/"))
    doc = indexed(rows.join(session_files(rows), ["user_id", "workspace_id", "path"]))
    doc = doc.withColumns({"_p": T.lexemes(F.col("path")), "_t": T.lexemes(F.col("text"))}).withColumn("_doc", F.array_union("_p", "_t"))
    found = candidates(doc, requests)
    in_text = F.when(T.matches_all(F.col("_t"), F.col("_q")), cover_density(F.col("_t"), F.col("_q"), 0.4)).otherwise(0.0)
    in_path = F.when(T.matches_all(F.col("_p"), F.col("_q")), cover_density(F.col("_p"), F.col("_q"), 1.0)).otherwise(0.0)
    scored = found.withColumn("score", F.round(in_text + in_path, 6))
    return _ranked(scored, [F.col("score").desc(), F.col("file_updated_at").desc_nulls_last(), F.col("path"), F.col("chunk_index"), F.col("id")], k)
